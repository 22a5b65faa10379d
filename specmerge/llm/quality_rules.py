"""Quality by weak supervision: rules vote or abstain, and EM weighs them.

Each rule of RULES votes good (1), bad (-1) or abstains (0) on a document. Expectation-maximisation estimates
how often each rule casts each vote on good and on bad documents, its accuracy, and the share of good ones,
from the votes alone: all documents are counted by their pattern of votes, at most 3 ** rules rows, and
the iterations run over these counts. The posterior probability that a document is good replaces a list of
filters that all must pass; it is a plain expression, the log odds of the share plus those of each vote.

Everything runs as DataFrame expressions; whole texts are read once, with no shuffle but that of the counts.

Defined cases: null and blank texts have no words and fail the base test; a null doc_id and repeated rows
are judged like any other row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, WORD_SPLIT, only_ids, saved

SYMBOLS = "#*$%&|<>"
#: The commonest function words of the corpus' four languages.
STOP_WORDS = (
    "the of and to in a is that it for on was as be with by this are not or de la le et les des que un une en du dans "
    "el los las y se por con para su der die das und zu den von mit im ist ein sich nicht auch"
).split()


@dataclass(frozen=True)
class Rule:
    """bad and good are SQL predicates over the features; where neither holds the rule abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "n_symbols > 0.15 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("repeats", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
    Rule("lines", "n_dup_lines > 0.8 * n_lines", "n_dup_lines = 0 and n_lines >= 2"),
    Rule("capitals", "n_capital_words > 0.3 * n_words", "n_capital_words <= 0.05 * n_words"),
    Rule("word_length", "word_chars > 14 * n_words or word_chars < 2.5 * n_words", "word_chars between 3.5 * n_words and 9 * n_words"),
    Rule("stop_words", "n_stop_words < 0.04 * n_words", "n_stop_words >= 0.12 * n_words"),
    Rule("variety", "n_distinct_words < 0.15 * n_words", "n_distinct_words >= 0.4 * n_words or n_words >= 2000 and n_distinct_words >= 0.25 * n_words"),
    Rule("shouting", "n_exclaims > 0.05 * n_words", "n_exclaims <= 0.01 * n_words"),
)


def _count(text: Column, chars: str) -> Column:
    """Number of characters of text that are in chars."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules use, of every whole text.

    Windows of three words are compared by 64-bit hashes. If any repeats, they are sorted with their
    positions; equal neighbours give the positions to cover, each covering the words up to the next or three.
    """
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    df = df.select("doc_id", "t", F.array_remove(F.split("t", WORD_SPLIT), "").alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("w")
    df = df.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        n.cast("long").alias("n_words"),
        (F.length("t") - _count(F.col("t"), ASCII_SPACE)).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _count(F.col("t"), "!").cast("long").alias("n_exclaims"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: (F.length(x) > 1) & (x == F.upper(x)) & (x != F.lower(x)))).cast("long").alias("n_capital_words"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct_words"),
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).alias("g"),
    )
    plain = [c for c in df.columns if c != "g"]
    repeated = F.size(F.array_distinct("g")) < F.size("g")
    df = df.select(*plain, F.when(repeated, F.sort_array(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"))
    rest = F.size("s") - 1
    equal = F.zip_with(F.slice("s", 1, rest), F.slice("s", 2, rest), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.select(*plain, F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull())))).alias("p"))
    spans = F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))), lambda a, b: F.when(a.isNotNull(), F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))))
    covered = F.aggregate(spans, F.lit(0).cast("long"), lambda x, y: x + F.coalesce(y, F.lit(0)))
    return df.select(*plain, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def vote(rule: Rule) -> Column:
    return F.expr(f"case when n_words = 0 then 0 when {rule.bad} then -1 when {rule.good} then 1 else 0 end")


def estimate(patterns: list[tuple[tuple[int, ...], int]], steps: int = 200) -> tuple[float, list[dict[int, float]]]:
    """Log odds of the share of good documents, and of each rule's votes, from (votes, documents).

    A rule's accuracy is the chance of each of its votes on good and on bad documents; what it tells is the
    ratio of the two. The iterations start from documents without a bad vote being good. A rule never counts
    against its own direction: a bad vote's log odds are at most 0, a good vote's at least 0.
    """
    n = len(patterns[0][0]) if patterns else 0
    good = [0.05 if -1 in votes else 0.95 for votes, _ in patterns]
    share, odds = 0.0, [{-1: 0.0, 0: 0.0, 1: 0.0} for _ in range(n)]
    for _ in range(steps):
        counts = [{(y, v): 1.0 for y in (0, 1) for v in (-1, 0, 1)} for _ in range(n)]
        total = [1.0, 4.0]
        for (votes, docs), p in zip(patterns, good, strict=True):
            total = [total[0] + docs * (1 - p), total[1] + docs * p]
            for j, v in enumerate(votes):
                counts[j][1, v] += docs * p
                counts[j][0, v] += docs * (1 - p)
        share = log(total[1] / total[0])
        for j, c in enumerate(counts):
            of = [sum(c[y, v] for v in (-1, 0, 1)) for y in (0, 1)]
            odds[j] = {v: log(c[1, v] / of[1]) - log(c[0, v] / of[0]) for v in (-1, 0, 1)}
            odds[j][-1], odds[j][1] = min(0.0, odds[j][-1]), max(0.0, odds[j][1])
        now = [posterior(share, odds, votes) for votes, _ in patterns]
        moved = max((abs(x - y) for x, y in zip(now, good, strict=True)), default=0.0)
        good = now
        if moved < 1e-9:
            break
    return share, odds


def posterior(share: float, odds: list[dict[int, float]], votes: tuple[int, ...]) -> float:
    total = share + sum(o[v] for v, o in zip(votes, odds, strict=True))
    return 1 / (1 + exp(-min(700.0, max(-700.0, total))))


def judge(docs: DataFrame, *, rules: tuple[Rule, ...] = RULES, least: float = 0.5) -> DataFrame:
    """doc_id, the features, votes, quality (the posterior), base_failed and kept (quality at least ``least``, base not failed)."""
    measured = saved(features(docs).withColumn("votes", F.array(*(vote(r) for r in rules))).withColumn("base_failed", base_failed()), "quality")
    counted = measured.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** rules rows
    share, odds = estimate(sorted((tuple(r.votes), r.n) for r in counted))
    total = F.lit(share)
    for j, o in enumerate(odds):
        v = F.get("votes", F.lit(j))
        total = total + F.when(v < 0, o[-1]).when(v > 0, o[1]).otherwise(o[0])
    quality = 1 / (1 + F.exp(-total))
    return measured.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs whose document is kept."""
    return only_ids(docs, judge(docs).where("kept"), keep=True)
