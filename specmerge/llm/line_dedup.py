"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

State, as tables below one folder:

* ``refs``     one row per (line key, document) that holds it: the exact references;
* ``counts``   one row per key: number of documents and the largest doc_id, the holder;
* ``filters``  one cuckoo filter per shard with the keys that at least ``min_docs`` documents hold.

``insert`` adds documents and ``delete`` takes them out again; both move only the keys whose count crosses
``min_docs`` in or out of the filters. There are as many shards as keys need, ``SHARD_KEYS`` each, when the filters are built
anew. ``apply`` probes lines with the filters, and only lines that pass meet the exact table, so that false
positives of the filters drop nothing. Filters within BROADCAST_BYTES are probed where the text is read; beyond,
the distinct keys of the lines go to their shard's filter.

Defined cases: a null or empty text is one empty line; a line is dropped in all documents but the largest
doc_id that holds it; rows that repeat a doc_id count as one document and get the same treatment; a null
doc_id is a document of its own that holds a line only if no other does. Other columns pass through; the counts are
n_lines and n_dropped, with an underscore more where docs has a column of that name.
Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_SPACE, BROADCAST_BYTES, bounded_batches, fresh, scratch, slices
from .cuckoo import CuckooFilter

#: Keys of a filter when it is built; it holds twice as many.
SHARD_KEYS = 1 << 15
REF = "key binary, doc_id bigint"
FILTER = "shard int, slots binary, stash binary"


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """128-bit key of each line; None for lines that are too short to be dropped."""
    out: list[bytes | None] = []
    for line in (text or "").split("\n"):
        line = line.strip(ASCII_SPACE)
        out.append(hashlib.md5(line.encode("utf-8", "surrogatepass").lower()).digest() if len(line) >= min_chars else None)
    return out


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64)[::2]


def _shards(keys: list[bytes], shards: int) -> np.ndarray:
    return (np.frombuffer(b"".join(keys), np.uint64)[1::2] % np.uint64(shards)).astype(np.int32)


class LineIndex:
    def __init__(self, spark: SparkSession, path: str | None = None, *, shards: int = 64, min_chars: int = 20, min_docs: int = 3):
        self.spark, self.path = spark, path or scratch(spark, "line-index")
        self.shards, self.least_shards, self.min_chars, self.min_docs = shards, shards, min_chars, min_docs
        self.refs = self.counts = self.filters = None
        self.version = self.room = 0
        bounded_batches(spark)

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        refs = self._refs(docs, text).distinct()
        if self.refs is not None:
            refs = refs.join(self.refs, (refs.key == self.refs.key) & refs.doc_id.eqNullSafe(self.refs.doc_id), "left_anti")
        added = self._write("refs", refs)
        counts = added.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder"))
        if self.counts is not None:
            counts = self.counts.unionByName(counts).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder"))
        self._advance(self._write("counts", counts))
        self.refs = added if self.refs is None else self.refs.unionByName(added)
        return self

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take out the documents whose doc_id is in doc_ids; ids that aren't held are ignored."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        match = self.refs.doc_id.eqNullSafe(ids.gone)
        keys = self.refs.join(ids, match, "left_semi").select("key").distinct()
        left = self._write("refs", self.refs.join(ids, match, "left_anti"))
        again = left.join(keys, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder"))
        self._advance(self._write("counts", self.counts.join(keys, "key", "left_anti").unionByName(again)))
        self.refs = left
        return self

    def repeated(self) -> DataFrame:
        return self.counts.where(F.col("n_docs") >= self.min_docs)

    def apply(self, docs: DataFrame, text: str = "text", *, counts: bool = True) -> DataFrame:
        """docs with the lines to drop gone from text, plus, if wanted, n_lines and n_dropped (lines before, lines dropped)."""
        held = self._passed(docs, text)
        drop = held.join(self.repeated(), "key").where(~F.col("holder").eqNullSafe(F.col("doc_id")))
        own, gone = fresh(docs, "__doc"), fresh(docs, "__drop")
        drop = drop.groupBy(F.col("doc_id").alias(own)).agg(F.collect_set("key").alias(gone))
        rows = docs.join(drop, docs.doc_id.cast("long").eqNullSafe(drop[own]), "left").drop(own)
        made = [fresh(docs, "n_lines"), fresh(docs, "n_dropped")] if counts else []
        schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in made)])
        schema[text].nullable = True
        min_chars, names = self.min_chars, [f.name for f in schema.fields]

        def cut(batches):
            for batch in slices(batches):
                texts, lines, dropped = [], [], []
                for whole, keys in zip(batch.column(text).to_pylist(), batch.column(gone).to_pylist(), strict=True):
                    whole = whole or ""
                    n, k = whole.count("\n") + 1, 0
                    if keys:
                        keys = set(keys)
                        keep = [a for a, b in zip(whole.split("\n"), line_keys(whole, min_chars), strict=True) if b not in keys]
                        k, whole = n - len(keep), "\n".join(keep)
                    texts.append(whole), lines.append(n), dropped.append(k)
                new = {text: pa.array(texts, pa.string()), **dict(zip(made, (pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())), strict=False))}
                yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names)

        return rows.mapInArrow(cut, schema)

    def _refs(self, docs: DataFrame, text: str = "text", probe=None) -> DataFrame:
        min_chars = self.min_chars

        def extract(batches):
            for batch in slices(batches):
                keys, ids = [], []
                for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    found = {k for k in line_keys(whole, min_chars) if k}
                    keys += found
                    ids += [doc] * len(found)
                if probe is not None and keys:
                    keep = probe(keys)
                    keys, ids = [k for k, y in zip(keys, keep, strict=True) if y], [i for i, y in zip(ids, keep, strict=True) if y]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"])

        return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(extract, REF)

    def _passed(self, docs: DataFrame, text: str) -> DataFrame:
        """Key and doc_id of the lines that a filter holds."""
        shards = self.shards
        size = self.filters.agg(F.sum(F.length("slots") + F.length("stash"))).first()[0] or 0
        if size <= BROADCAST_BYTES:
            sent, opened = self.spark.sparkContext.broadcast({r.shard: (bytes(r.slots), bytes(r.stash)) for r in self.filters.collect()}), {}

            def probe(keys: list[bytes]) -> np.ndarray:
                if not opened:
                    opened.update({k: CuckooFilter.of(*v) for k, v in sent.value.items()})
                at, hashes, out = _shards(keys, shards), _hashes(keys), np.zeros(len(keys), bool)
                for shard in np.unique(at):
                    if int(shard) in opened:
                        out[at == shard] = opened[int(shard)].contains(hashes[at == shard])
                return out

            return self._refs(docs, text, probe).distinct()

        def tag(batches):
            for batch in batches:
                keys = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(_shards(keys, shards) if keys else [], pa.int32()), batch.column(0)], ["shard", "key"])

        def look(batches):
            """Keys that their shard's filter holds; a shard's rows are its filter, if it has one, and then its keys, and may go on in the next batch."""
            shard, opened = None, None
            for batch in batches:
                at, late, out = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
                starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
                for i, end in zip(starts, np.append(starts[1:], len(at)), strict=True):
                    if at[i] != shard:
                        shard, opened = int(at[i]), None
                    if not late[i]:
                        opened, i = CuckooFilter.of(batch.column(2)[int(i)].as_py(), batch.column(3)[int(i)].as_py()), i + 1
                    if opened is not None and i < end:
                        keys = batch.column(4).slice(i, end - i).to_pylist()
                        out += [k for k, y in zip(keys, opened.contains(_hashes(keys)), strict=True) if y]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["key"])

        refs = self._write("lines", self._refs(docs, text).distinct())
        keys = refs.select("key").distinct().mapInArrow(tag, "shard int, key binary").withColumn("late", F.lit(1))
        rows = self.filters.withColumn("late", F.lit(0)).unionByName(keys, allowMissingColumns=True).select("shard", "late", "slots", "stash", "key")
        passed = rows.repartition("shard").sortWithinPartitions("shard", "late").mapInArrow(look, "key binary")
        return refs.join(passed, "key", "left_semi")

    def _advance(self, counts: DataFrame) -> None:
        """Make counts the exact table and move the keys that crossed min_docs in or out of their shard's filter."""
        now = counts.where(F.col("n_docs") >= self.min_docs).select("key")
        held = now.count()
        if self.counts is None or held > self.room:  # (re)build: no filter is ever filled beyond what it was made for
            self.room = 2 * held + 1000
            self.shards = max(self.least_shards, -(-held // SHARD_KEYS))
            moved = now.select("key", F.lit(1).alias("step"))
            filters = self.spark.createDataFrame([], FILTER)
        else:
            was = self.repeated().select("key")
            moved = now.join(was, "key", "left_anti").select("key", F.lit(1).alias("step")).unionByName(was.join(now, "key", "left_anti").select("key", F.lit(-1).alias("step")))
            filters = self.filters
        shards = self.shards

        def tag(batches):
            for batch in batches:
                keys = [bytes(k) for k in batch["key"]]
                yield pd.DataFrame({"shard": _shards(keys, shards), "hash": _hashes(keys).astype(np.int64), "step": batch["step"]})

        def update(key, held, steps):
            new = steps["hash"].to_numpy().astype(np.uint64)
            step = steps["step"].to_numpy()
            old = CuckooFilter.of(held["slots"].iloc[0], held["stash"].iloc[0]) if len(held) else CuckooFilter(2 * len(new) + 64)
            old.delete(new[step < 0])
            old.insert(new[step > 0])
            slots, stash = old.state()
            return pd.DataFrame({"shard": [key[0]], "slots": [slots], "stash": [stash]})

        tagged = moved.mapInPandas(tag, "shard int, hash bigint, step int")
        self.filters = self._write("filters", filters.groupBy("shard").cogroup(tagged.groupBy("shard")).applyInPandas(update, FILTER))
        self.counts = counts

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        self.version += 1
        path = f"{self.path}/{name}-{self.version}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def dedup_lines(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3, shards: int = 64, counts: bool = True) -> DataFrame:
    """Index docs and drop their repeated lines in one go."""
    return LineIndex(docs.sparkSession, min_chars=min_chars, min_docs=min_docs, shards=shards).insert(docs).apply(docs, counts=counts)


__all__ = ["LineIndex", "dedup_lines", "line_keys"]
