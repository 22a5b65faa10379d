"""Benchmark decontamination by size-partitioned MinHash containment search.

An item of a benchmark is short and a document may be long, so that the Jaccard similarity of the two says
little. Items are partitioned by size: class c has more than ``8 * 2 ** (c - 1)`` and at most ``u = 8 * 2 ** c`` shingles. For
each class that has items, a document is read in windows of ``2 u`` shingles that start every ``u``: any
stretch of ``u`` shingles lies in a window, where the item makes up a fixed share. Windows and items
have bottom-k MinHash sketches (their ``SKETCH`` smallest shingle hashes); a document is a candidate for an
item if a sketch of its windows shares a value with the item's. The chance that a passage with containment
``threshold`` is missed is below ``(1 - threshold / 8) ** SKETCH`` in the worst case, an item just above
its class's lower bound, and in the mean case many orders smaller, as k smallest values are compared with k.

Candidates are then confirmed on the whole document: the share of the item's distinct shingles that the
document holds. Words are runs of letters and digits, lower-cased; a shingle is five words, or the whole
item if it has fewer.

Most documents hold no value of any sketch; where the sketches are small enough to be sent to all tasks, these
documents are left out before windows are made, which loses nothing.

All steps are DataFrame expressions. The item sketches, and the candidate documents, are broadcast if they
are within BROADCAST_BYTES and joined by shuffle if not.

Defined cases: items and documents without words match nothing; null doc_id and item_id match nothing;
repeated rows count once; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, only_ids, saved

SHINGLE, SKETCH, FIRST_CLASS = 5, 64, 8


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def with_shingles(df: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Adds g, the hash of the shingle that begins at each word, from w, the words."""
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))
    # words beyond the end are null, and null changes no hash: a short text is one shingle
    return df.withColumn("g", F.when(n > 0, F.transform(starts, lambda i: F.xxhash64(*(F.get("w", i + k) for k in range(width))))))


def _sketch(values: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(values)), 1, SKETCH)


def _class_of(size: Column) -> Column:
    return F.greatest(F.lit(0), F.ceil(F.log2(size / FIRST_CLASS))).cast("int")


def _window(u: int):
    return lambda start: _sketch(F.slice("g", start, 2 * u))


def _fits(df: DataFrame, row_bytes: int) -> bool:
    return df.count() * row_bytes <= BROADCAST_BYTES


def contaminated(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.75) -> DataFrame:
    """doc_id, item_id, n_shingles of the item, n_found of them in the document, and containment, of every pair at or above threshold."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).where("doc_id is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text")).alias("w")).where("item_id is not null and size(w) > 0")
    items = with_shingles(items).select("item_id", F.array_distinct("g").alias("g")).withColumn("class", _class_of(F.size("g")))
    items = saved(items, "items", small=True)
    total = items.agg(F.sum(F.size("g"))).first()[0] or 0
    hint = F.broadcast if 40 * total <= BROADCAST_BYTES else (lambda df: df)  # item, class and hash of each shingle
    # one value of the sketch per row; the classes that occur, a number that grows with the log of the longest item
    keys = items.select("item_id", "class", F.explode(_sketch(F.col("g"))).alias("value")).distinct()
    classes = sorted(r[0] for r in items.select("class").distinct().collect())
    if not classes:
        return spark.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_found long, containment double")

    shingled = lambda df: with_shingles(df.select("doc_id", tokens(F.col("text")).alias("w"))).select("doc_id", "g")  # noqa: E731  g is null without words
    reading = docs
    if 40 * total <= BROADCAST_BYTES:  # a document without a value of any sketch has no window that shares one
        # explode_outer, as explode would have its array made once more, for a filter
        some = shingled(docs).select("doc_id", F.explode_outer("g").alias("value")).join(F.broadcast(keys.select("value").distinct()), "value", "left_semi")
        some = saved(some.select("doc_id").distinct(), "readers", small=True)
        reading = docs.join((F.broadcast if _fits(some, 16) else (lambda df: df))(some), "doc_id", "left_semi")
    parsed, sketches = shingled(reading), []
    for c in classes:
        u = FIRST_CLASS << c
        starts = F.sequence(F.lit(1), F.size("g"), F.lit(u))
        windows = F.transform(starts, _window(u))
        sketches.append(F.struct(F.lit(c).alias("class"), F.array_distinct(F.flatten(windows)).alias("values")))
    values = parsed.select("doc_id", F.explode(F.array(*sketches)).alias("s")).select("doc_id", F.col("s.class").alias("class"), F.explode("s.values").alias("value"))
    pairs = saved(values.join(hint(keys), ["class", "value"]).select("doc_id", "item_id").distinct(), "candidates", small=True)

    found = docs.join((F.broadcast if _fits(pairs, 16) else (lambda df: df))(pairs.select("doc_id").distinct()), "doc_id", "left_semi")
    found = with_shingles(found.select("doc_id", tokens(F.col("text")).alias("w"))).select("doc_id", F.explode(F.array_distinct("g")).alias("value")).distinct()
    wanted = items.select("item_id", F.explode("g").alias("value"))
    both = found.join(hint(wanted), "value").join(pairs, ["doc_id", "item_id"], "left_semi").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_found"))
    out = both.join(hint(items.groupBy("item_id").agg(F.max(F.size("g")).cast("long").alias("n_shingles"))), "item_id")
    out = out.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("containment") >= threshold)
    return out.select("doc_id", "item_id", "n_shingles", "n_found", "containment")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.75) -> DataFrame:
    """The rows of docs whose document holds no benchmark item."""
    return only_ids(docs, contaminated(docs, benchmark, threshold=threshold), keep=False)
