import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from specmerge.llm import ppm

from . import corpus


def plain_model(rows):
    """log10 probability of a text by the definition, byte after byte, and one context after another."""
    ctx, words = {}, Counter()
    for r in rows:
        if not held(r[0]):
            words.update(ppm.tokens(r[1]))
            s = b"\n" * 5 + ppm.running(ppm.tokens(r[1]))
            for i in range(5, len(s)):
                for k in range(6):
                    ctx.setdefault(s[i - k : i], Counter())[s[i]] += 1
    cache, cases = {}, {}
    size = lambda x, single: x if x <= single else single + x.bit_length()
    kind = lambda before, n, d: (len(before), size(n, 8), size(d, 4))
    for before, seen in ctx.items():
        n, d = seen.total(), len(seen)
        for count in seen.values():
            if n > 1:  # each of its occurrences is left out in turn
                new, cls = count == 1, kind(before, n - 1, d - (count == 1))
                cases.setdefault(cls, [0, 0])[0 if new else 1] += count

    def prob(before, symbol):
        if (before, symbol) not in cache:
            seen, out = ctx.get(before), None
            lower = lambda x: prob(before[1:], x) if before else 1 / 256
            if not seen:
                out = lower(symbol)
            else:
                n, d = seen.total(), len(seen)
                new, old = cases.get(kind(before, n, d), (0, 0))
                e = (new + d / n) / (new + old + 2)
                out = (1 - e) * (seen[symbol] - 0.5) / (n - d / 2) if symbol in seen else e * lower(symbol) / (1 - sum(map(lower, seen)))
            cache[before, symbol] = out
        return cache[before, symbol]

    def score(text):
        s = b"\n" * 5 + ppm.running(ppm.tokens(text))
        return sum(math.log10(prob(s[i - 5 : i], s[i])) for i in range(5, len(s)))

    return words, score


def held(doc):
    return zlib.crc32(str("" if doc is None else doc).encode()) % 5 == 1


@pytest.mark.parametrize("head", [0, 5, 1 << 18])
def test_scores_by_definition(spark, head):
    rows = [r for r in corpus.rows(7, 24) if len(r[1] or "") < 20_000] + [(3000, "A" * 100 + " " + "B" * 70, "fr", "", 1, "", 1, ""), (3001, "x\0y 日本語テスト\x1c語", "", "", 1, "", 1, "")]
    c, score = plain_model(rows)
    total, v = c.total(), len(c)
    base = lambda w: math.log10((c[w] + 0.5) / (total + 0.5 * (v + 1)))
    out = ppm.score_documents(spark.createDataFrame(rows, corpus.SCHEMA).repartition(3), head=head)
    assert out.count() == len(rows)
    want = {}
    for r in rows:
        said = ppm.tokens(r[1])
        want[r[0]] = len(said), sum(c[w] > 0 for w in said), sum(map(base, said)), score(r[1])
    for r in out.collect():
        n, known, first, best = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, held(r.doc_id))
        assert r.base_score == pytest.approx(first) and r.score == pytest.approx(best, rel=1e-9)


def test_probabilities_add_up():
    """Over all bytes after a context, seen or not."""
    g = lambda s: int.from_bytes(s, "big")
    low = ppm.Low(np.array([g(b"  a"), g(b" ab"), g(b"ab ")]), np.array([3, 2, 2]))
    for before in (b"  ", b"ab", b"\1\2"):
        assert low(np.array([g(before + bytes([x])) for x in range(256)])).sum() == pytest.approx(1)
    stats = {k: ppm.left_out(np.array([4, 9, 1]), np.array([2, 3, 1]), np.array([1, 2, 1])) for k in (3, 4, 5)}
    for before in (b"xy ab", b"zy ab", b"qq ab", b"qqqab"):
        keys = sorted({g(before + bytes([x])) for x in range(256)} | {g(b"zy abc"), g(b"ww abd")})
        seen = {g(b"xy ab "): 3, g(b"xy abq"): 1, g(b"zy abc"): 2, g(b"ww abd"): 1, g(b"qqqab!"): 4}
        p = 10 ** ppm.code(np.array(keys, np.uint64), np.array([seen.get(k, 0) for k in keys]), low, stats)
        assert p[[keys.index(g(before + bytes([x]))) for x in range(256)]].sum() == pytest.approx(1)


def test_table_finds_all():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 48, 5000, np.uint64))
    table = ppm.Table(keys[::2], np.arange(len(keys[::2]), dtype=float))
    values, missing = table(keys)
    assert sorted(missing.tolist()) == list(range(1, len(keys), 2)) and (values[::2] == np.arange(len(keys[::2]))).all()
    assert len(ppm.Table(keys[:0], np.zeros(0))(keys)[1]) == len(keys)


def test_branches_larger_than_batches(spark):
    """A model of batches of a few grams is that of large ones."""
    rows = corpus.frame(spark)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    score = lambda: sorted(tuple(r) for r in ppm.score_documents(rows).select("doc_id", "n_tokens", F.round("score", 6)).fillna(-9).collect())
    whole = score()
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert score() == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_order_of_words_counts(spark):
    """The same words in an order that training has, and in another."""
    rows = [(i, "a cold wind blew over the empty hill"[:36], "", "", 1, "", 1, "") for i in range(30)] + [(100, "a cold wind blew over the empty hill"[:36], "", "", 1, "", 1, ""), (101, "empty a hill over blew wind the cold", "", "", 1, "", 1, "")]
    out = {r.doc_id: r for r in ppm.score_documents(spark.createDataFrame(rows, corpus.SCHEMA), held_out=F.col("doc_id") >= 100).collect()}
    assert out[100].base_score == pytest.approx(out[101].base_score) and out[100].score > out[101].score + 1


def test_own_split_and_empty(spark):
    df = corpus.frame(spark)
    out = ppm.score_documents(df.drop("lang"), held_out=F.lit(False))
    assert out.where("held_out").count() == 0 and out.where("score is null or isnan(score)").count() == 0
    assert ppm.score_documents(corpus.empty(spark)).count() == 0
    assert ppm.score_documents(df, held_out=F.lit(True)).where("isnan(score) or score > 0").count() == 0


def test_better_than_base_on_held_out_words(spark):
    """Unseen words with seen parts, and two languages that share few words."""
    import random

    rng = random.Random(3)
    parts = {"x": ["ba", "be", "bi", "dan", "den"], "y": ["kru", "kro", "stra", "stro", "plu"]}
    make = lambda lang: "".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3)))
    rows = [(i, " ".join(make("xy"[i % 2]) for _ in range(80)), "xy"[i % 2], "", 1, "", 1, "") for i in range(120)]
    out = ppm.score_documents(spark.createDataFrame(rows, corpus.SCHEMA)).where("held_out")
    r = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b
