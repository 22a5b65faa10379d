r"""Language-model scores of documents by prediction by partial matching over bytes.

A document is the running bytes of its words, A-Z lower-cased, each followed by a space, and a newline at the end;
before it stand newlines. A byte is predicted from the ``ORDER`` bytes before it, across spaces and word ends,
however long a word is. Escape goes order by order: from ``ORDER`` bytes to one less, down to none and then to
all 256 bytes alike. How likely an escape is, is estimated from the training text itself: contexts are put in
classes by how often they were seen, n, and with how many different bytes, d, and the chance is how often a byte of such a
context would be new if it were left out (a context's d / (2 n), method D, counts as two more cases). What escape leaves
is shared by (c - 1 / 2) / (n - d / 2) for a byte seen c times. On escape, the next order's probabilities hold without
the bytes seen so far: they are divided by what those leave (symbol exclusion). The model is pretrained on the training documents.

1. Tasks count the grams, ORDER bytes and the byte after them, of their documents; an aggregation sums them. A gram is
   a 64-bit number and no hash, so that counts are exact.
2. The trie of contexts is dealt by its branches at three bytes: a gram's last three bytes of context. All counts
   of orders three and up lie within a branch, and a branch has at most 256 ** (ORDER - 2) grams, 2 ** 24, whatever
   the corpus. Counts of lower orders, three bytes with the symbol, have at most 2 ** 24 rows and are sent to all tasks.
   Each gram's code length is computed once.
3. Documents add up the code lengths of their grams: the ``HEAD`` most frequent are sent to all tasks as a hash
   table, and the others, few of a text's bytes, meet theirs in a join. Words meet their counts, for the base score,
   in the same way.

Defined cases: null text is the end alone; a null doc_id is in the training part; repeated rows are scored, and
counted, each; other columns are not read; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, saved, slices

ORDER = 5
#: Most grams, and words of at most HEAD_BYTES, that are sent to all tasks; grams and words that a task holds before it gives them out.
HEAD, HEAD_BYTES, FLUSH, HELD = 1 << 18, 40, 400_000, 6_000_000
END = b"\n"
_BEFORE = END * ORDER
_ODD = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def running(said: list[bytes]) -> bytes:
    """The bytes that are scored, of a document's tokens."""
    return b" ".join(said)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of some documents' running bytes in a row, and where each document's begin."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(_BEFORE + _BEFORE.join(texts) + bytes(8), np.uint8)
    # eight bytes from each place on, of which ORDER + 1 count
    wide = np.ndarray(len(data) - 8, ">u8", data, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (7 - ORDER))
    starts = np.cumsum(sizes + ORDER) - sizes - ORDER
    keep = np.ones(len(wide), bool)
    keep[(starts + sizes)[:, None] + np.arange(ORDER)] = False  # begin in one document and end in the next
    return wide[keep], np.cumsum(sizes) - sizes


def _counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their n."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys))) if n is None else np.add.reduceat(n, first)


COUNTED = "g bigint, w binary, n_all bigint, c bigint"


def _counts(docs: DataFrame) -> DataFrame:
    """COUNTED of every gram (g, w null) and word (w, g null) of docs (text, held_out): occurrences, and those in training documents."""

    def count(batches):
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        words = (Counter(), Counter())

        def merged():
            out = _counted(np.concatenate([k for k, _ in seen]), np.concatenate([n for _, n in seen]))
            seen[:] = [out]
            return out

        def gram_rows():
            keys, n = merged()  # a key ends in whether its document is held out
            g, both = keys >> np.uint64(1), np.concatenate([[True], (keys[1:] ^ keys[:-1]) > 1])
            first = np.flatnonzero(both)
            train = np.add.reduceat(np.where(keys & np.uint64(1), 0, n), first)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(g[first].view(np.int64)), pa.nulls(len(first), pa.binary()), pa.array(np.add.reduceat(n, first)), pa.array(train)], ["g", "w", "n_all", "c"])

        def word_rows():
            for held, found in enumerate(words):
                if found:
                    n = np.fromiter(found.values(), np.int64, len(found))
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), pa.array(list(found), pa.binary()), pa.array(n), pa.array(n * (not held))], ["g", "w", "n_all", "c"])
                    found.clear()

        for batch in slices(batches):
            parts: tuple[list[bytes], list[bytes]] = ([], [])
            for text, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                said = tokens(text)
                words[held].update(said)
                parts[held].append(running(said))
            for held, texts in enumerate(parts):
                if texts:
                    seen.append(_counted(grams(texts)[0] << np.uint64(1) | np.uint64(held)))
            if sum(len(k) for k, _ in seen) > HELD and len(merged()[0]) > HELD // 2:
                yield gram_rows()
            if sum(map(len, words)) > FLUSH:
                yield from word_rows()
        if seen:
            yield gram_rows()
        yield from word_rows()

    found = docs.select("text", "held_out").mapInArrow(count, COUNTED)
    return saved(found.groupBy("g", "w").agg(F.sum("n_all").alias("n_all"), F.sum("c").alias("c")), "counts")


#: Classes of n and of d; (9 to 15, 16 to 31, ... make one each).
CLASSES = (72, 16)


def _class(x: np.ndarray, single: int) -> np.ndarray:
    return np.where(x <= single, x, single + np.frexp(x)[1]).astype(np.int64)


def _classes(n: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of a context by how often it was seen and with how many different bytes."""
    return _class(n, 8), _class(d, 4)


def left_out(n: np.ndarray, d: np.ndarray, once: np.ndarray, times: np.ndarray | int = 1) -> np.ndarray:
    """(2, classes of n, classes of d): escapes and stays if each byte in turn is predicted from all others, over contexts with n, d and ``once``, the bytes seen once."""
    out = np.zeros((2, *CLASSES))
    n, d, once, times = (np.broadcast_to(np.asarray(x, np.float64), np.shape(n)) for x in (n, d, once, times))
    for k, (kinds, count) in enumerate(((d - 1, once), (d, n - once))):
        ok = (n > 1) & (count > 0)
        np.add.at(out[k], _classes(n[ok] - 1, kinds[ok]), (count * times)[ok])
    return out


def escape(stats: np.ndarray, n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Chance of a byte that a context hasn't seen: how often that was so in its class, method D counting as two cases."""
    at = _classes(n, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        return (stats[0][at] + 2 * d / (2 * n)) / (stats[0][at] + stats[1][at] + 2)


def mixed(c, n, d, lower, seen_lower, stats):
    """Probability in a context where the symbol was seen c times of n, with d different symbols of lower probability seen_lower."""
    e = escape(stats, n, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, lower, np.where(c > 0, (1 - e) * (c - 0.5) / (n - d / 2), e * lower / np.maximum(1 - seen_lower, 1e-12)))


class Low:
    """Orders two, one and none: probability of each byte after two, from counts of three (before, before, byte)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        rows, of = np.unique(keys >> 8, return_inverse=True)
        two = np.zeros((max(1, len(rows)), 256))
        np.add.at(two, (of, keys & 255), counts)
        one = np.zeros((256, 256))
        np.add.at(one, rows & 255, two[: len(rows)])
        zero = self._mixed(one.sum(axis=0)[None, :], np.full((1, 256), 1 / 256))
        self.one = self._mixed(one, np.repeat(zero, 256, axis=0))
        self.two = self._mixed(two, self.one[rows & 255] if len(rows) else self.one[:1])
        self.row = np.full(1 << 16, -1)
        self.row[rows] = np.arange(len(rows))

    @staticmethod
    def _mixed(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        n, d, once, known = (x.sum(axis=1) for x in (counts, counts > 0, counts == 1, np.where(counts > 0, lower, 0)))
        return mixed(counts, n[:, None], d[:, None], lower, known[:, None], left_out(n, d, once))

    def __call__(self, three: np.ndarray) -> np.ndarray:
        row = self.row[three >> 8]
        return np.where(row >= 0, self.two[row, three & 255], self.one[three >> 8 & 255, three & 255])


def code(g: np.ndarray, c: np.ndarray, low: Low, stats: dict[int, np.ndarray]) -> np.ndarray:
    """log10 probability of the last byte of each gram after the others, given whole branches of grams with their counts; stats: left_out() of each order."""
    keys, p = None, None
    for order in range(3, ORDER + 1):
        own = g & np.uint64((1 << 8 * (order + 1)) - 1)
        now, of = np.unique(own, return_inverse=True)
        n = np.bincount(of, c, len(now))
        shorter = now & np.uint64((1 << 8 * order) - 1)
        lower = low(shorter.astype(np.int64)) if order == 3 else p[np.searchsorted(keys, shorter)]
        context = now >> np.uint64(8)
        new = np.concatenate([[True], context[1:] != context[:-1]])
        first, at = np.flatnonzero(new), np.cumsum(new) - 1
        total, kinds, known = (np.add.reduceat(v, first)[at] for v in (n, (n > 0).astype(np.float64), np.where(n > 0, lower, 0.0)))
        keys, p = now, mixed(n, total, kinds, lower, known, stats[order])
    return np.log10(p[np.searchsorted(keys, g)])


def _escapes(counts: DataFrame) -> dict[int, np.ndarray]:
    """left_out() of orders three and up, over all contexts of counts."""
    size = lambda x, single: F.when(x <= single, x).otherwise(single + F.length(F.bin(x)))  # noqa: E731  as in _class
    seen, out = counts.where("c > 0").select("g", "c"), {}
    for order in range(ORDER, 2, -1):
        if order < ORDER:
            seen = seen.groupBy(F.col("g").bitwiseAND((1 << 8 * (order + 1)) - 1).alias("g")).agg(F.sum("c").alias("c"))
        contexts = seen.groupBy(F.shiftrightunsigned("g", 8).alias("x")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"), F.count_if(F.col("c") == 1).alias("once"))
        by = contexts.where("n > 1").groupBy(size(F.col("n") - 1, 8).alias("n"), size(F.col("d") - 1, 4).alias("less"), size(F.col("d"), 4).alias("d"))
        out[order] = np.zeros((2, *CLASSES))
        for r in by.agg(F.sum("once").alias("once"), F.sum(F.col("n") - F.col("once")).alias("rest")).collect():  # a row per pair of classes
            out[order][0, r.n, r.less] += r.once
            out[order][1, r.n, r.d] += r.rest
    return out


def model(counts: DataFrame) -> DataFrame:
    """g, n_all and lp, the code length as log10 probability, of every gram of counts."""
    three = F.col("g").bitwiseAND((1 << 24) - 1).alias("three")
    found = counts.where("c > 0").groupBy(three).agg(F.sum("c").cast("double").alias("n")).toArrow()  # at most 2 ** 24 rows
    low = counts.sparkSession.sparkContext.broadcast((Low(found["three"].to_numpy().astype(np.int64), found["n"].to_numpy()), _escapes(counts)))

    def score(batches):
        held: list[pa.RecordBatch] = []

        def done(parts):
            g, n_all, c = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in (1, 2, 3))
            return pa.RecordBatch.from_arrays([pa.array(g), pa.array(n_all), pa.array(code(g.view(np.uint64), c, *low.value))], ["g", "n_all", "lp"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # the branch that ends a batch may go on in the next
            s = batch.column(0).to_numpy()
            if held and s[-1] != held[-1].column(0)[0].as_py():
                cut = int(np.flatnonzero(s != s[-1])[-1]) + 1 if s[0] != s[-1] else 0
                yield done([*held, batch.slice(0, cut)])
                held, batch = [], batch.slice(cut)
            elif not held and s[0] != s[-1]:
                cut = int(np.flatnonzero(s != s[-1])[-1]) + 1
                yield done([batch.slice(0, cut)])
                batch = batch.slice(cut)
            held.append(batch)
        if held:
            yield done(held)

    branch = F.shiftrightunsigned(F.col("g"), 8).bitwiseAND((1 << 24) - 1).alias("s")
    rows = counts.select(branch, "g", "n_all", "c").repartition("s").sortWithinPartitions("s", "g")
    return saved(rows.mapInArrow(score, "g bigint, n_all bigint, lp double"), "model")


class Table:
    """Hash table from grams to code lengths, with open addresses, read for many grams at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, np.uint64(2**64 - 1)), np.zeros(1 << bits)
        at, left = self._at(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == self.keys.dtype.type(2**64 - 1)
            slots, first = np.unique(at[left[free]], return_index=True)
            put = left[free][first]
            self.keys[slots], self.values[slots] = keys[put], values[put]
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 for keys that aren't there, and the places of those."""
        at = self._at(keys)
        out = self.values[at]
        left = np.flatnonzero(self.keys[at] != keys)
        out[left] = 0
        at, missing = at[left], []
        while len(left):
            none = self.keys[at] == np.uint64(2**64 - 1)
            missing.append(left[none])
            left, at = left[~none], (at[~none] + 1) & (len(self.keys) - 1)
            hit = self.keys[at] == keys[left]
            out[left[hit]] = self.values[at[hit]]
            left, at = left[~hit], at[~hit]
        return out, np.concatenate(missing) if missing else left


def _least(rows: DataFrame, head: int) -> int:
    """Least n_all of which at most head rows have it or more. Frequencies are counted, and there are fewer of them than the root of the corpus."""
    least, n = 1 << 62, 0
    for r in sorted(rows.groupBy("n_all").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n_all")).limit(head).collect(), reverse=True):
        if n + r.n > head:
            break
        least, n = r.n_all, n + r.n
    return least


class _Head(dict):
    def __init__(self):
        self.tail = Counter()

    def __missing__(self, word):
        self.tail[word] += 1
        return -1


PART = "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, lp double, tail array<struct<hash:binary,n:bigint>>, grams array<struct<g:bigint,n:bigint>>"


def score_documents(docs: DataFrame, *, held_out=None, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs (doc_id, text).

    held_out: Column of bool; without one, documents whose crc32(doc_id as text) mod 5 is 1.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    if held_out is None:
        held_out = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")) % 5 == 1
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    counts = _counts(docs)
    scored, words = model(counts.where("w is null").select("g", "n_all", "c")), counts.where("g is null").select("w", "n_all", "c")

    total = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = total.n or 0, total.v or 0
    base = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    short = F.length("w") <= HEAD_BYTES
    in_head = short & (F.col("n_all") >= _least(words.where(short), head))
    top = words.where(in_head).select("w", "c").toArrow()  # at most head rows of HEAD_BYTES
    c = np.append(top["c"].to_numpy(), 0).astype(np.int64)
    often = F.col("n_all") >= _least(scored, 2 * head)
    best = scored.where(often).select("g", "lp").toArrow()  # at most 2 * head rows
    sent = spark.sparkContext.broadcast((top["w"].to_pylist(), np.append(base(c[:-1]), 0.0), (c > 0).astype(np.int64), Table(best["g"].to_numpy().view(np.uint64), best["lp"].to_numpy())))
    del top, best

    def add(batches):
        names, bases, known, lengths = sent.value
        table = _Head()
        table.update(zip(names, range(len(names)), strict=True))
        part, at = TaskContext.get().partitionId() << 40, 0
        for batch in slices(batches):
            held, sums, tails, texts = batch.column(2), [], [], []
            for text in batch.column(1).to_pylist():
                said = tokens(text)
                idx = np.fromiter(map(table.__getitem__, said), np.int64, len(said))
                tails.append(table.tail)
                table.tail = Counter()
                sums.append((len(said), int(known[idx].sum()), float(bases[idx].sum())))
                texts.append(running(said))
            keys, starts = grams(texts)
            lp, missing = lengths(keys)
            # the other grams of each document, counted
            doc = np.searchsorted(starts, missing, "right") - 1
            order = np.lexsort((keys[missing], doc))
            doc, own = doc[order], keys[missing][order]
            first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (own[1:] != own[:-1])])) if len(doc) else doc
            ends = np.searchsorted(doc[first], np.arange(len(texts) + 1))
            rare = pa.StructArray.from_arrays([pa.array(own[first].view(np.int64)), pa.array(np.diff(np.append(first, len(doc))))], ["g", "n"])
            hashes = pa.array([hashlib.md5(w).digest() for t in tails for w in t], pa.binary())
            tail = pa.StructArray.from_arrays([hashes, pa.array([k for t in tails for k in t.values()], pa.int64())], ["hash", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part + at + np.arange(len(texts))), batch.column(0), held, *(pa.array([s[i] for s in sums], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))),
                    pa.array(np.add.reduceat(lp, starts)), pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tails)]), pa.int32()), tail), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare),
                ],
                [x.split()[0] for x in PART.split(", ")],
            )
            at += len(texts)

    parts = saved(docs.select("doc_id", "text", "held_out").mapInArrow(add, PART), "heads")
    rest = words.where(~in_head).select(F.unhex(F.md5("w")).alias("hash"), "c")
    each = F.log10((F.col("c") + 0.5) / F.lit(n + 0.5 * (v + 1)))
    tail = parts.select("rid", F.explode("tail").alias("t")).select("rid", "t.*").join(rest, "hash")
    tail = tail.select("rid", F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"), (F.col("n") * each).alias("base"), F.lit(0.0).alias("lp"))
    rare = parts.select("rid", F.explode("grams").alias("t")).select("rid", "t.*").join(scored.where(~often).select("g", "lp"), "g")
    rare = rare.select("rid", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), (F.col("n") * F.col("lp")).alias("lp"))
    more = tail.unionByName(rare).groupBy("rid").agg(F.sum("known").alias("known"), F.sum("base").alias("more_base"), F.sum("lp").alias("more_lp"))
    out = parts.drop("tail", "grams").join(more, "rid", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("lp") + F.coalesce("more_lp", F.lit(0.0))).alias("score"),
    )
