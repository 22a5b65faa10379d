"""Lexical retrieval packing: windows filled with the BM25 neighbours of a seed document.

1. Texts are encoded once and saved as token ids.
2. Document frequencies of all token ids over all documents are summed; their number is bounded by the
   tokenizer's vocabulary, so the table is sent to every task.
3. Documents are taken in index shards of at most ``shard_tokens`` ids. A shard is an inverted index, token
   id to (document, BM25 weight). The first unused document is the seed: its best weighted terms are the
   query, and unused neighbours follow it in order of their scores until the window is full. A document that
   crosses the end of its window goes on in the next one and is the seed there.
4. What is left at the end of a shard, less than a window, is cut at powers of two, which need no padding.

Each id lies in exactly one piece; no document is dropped, capped or sampled. Memory of a task is bounded by
shard_tokens and its longest document. Defined cases: a null text is the end id alone; rows that repeat a
doc_id are documents of their own; a null doc_id stays null; an empty table has no pieces; other columns are
not read. Ties in score go to the document read first.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, saved, slices
from .tokens import as_binary, encoder, id_type, with_end

WINDOW = 4096
K1, B = 1.2, 0.75
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id and ids (little-endian, unsigned, as wide as id_type says) of every whole text."""

    def encode(batches):
        coder = encoder(tokenizer)
        kind = id_type(coder.size, end_id)
        for some in slices(batches, 2000):
            flat, n = with_end(*coder.encode(some.column(1)), end_id)
            yield pa.RecordBatch.from_arrays([some.column(0), as_binary(flat, n, kind)], ["doc_id", "ids"])
        coder.rest()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, "doc_id bigint, ids binary")


def _decode(batch, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch in a row and the number of each document's."""
    ids = batch.column(1)
    at = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, ids.offset * 4)
    return np.frombuffer(ids.buffers()[2], kind, (at[-1] - at[0]) // kind.itemsize, int(at[0])), np.diff(at) // kind.itemsize


def terms_of(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """document, term and frequency of all terms of some documents, in order of document and term."""
    wide = np.uint32 if len(sizes) <= 1 << 16 and ids.dtype.itemsize == 2 else np.uint64
    shift = wide(16 if wide is np.uint32 else 32)
    keys = np.sort((np.repeat(np.arange(len(sizes), dtype=wide), sizes) << shift) | ids.astype(wide))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, tf = keys[first], np.diff(np.append(first, len(keys)))
    return (keys >> shift).astype(np.int64), (keys & wide((1 << int(shift)) - 1)).astype(np.int64), tf


def document_frequencies(tokens: DataFrame, kind: np.dtype) -> DataFrame:
    """Number of documents of each token id; id -1 holds the number of all documents, -2 that of all ids."""

    def count(batches):
        df, docs, total = np.zeros(1 << 16, np.int64), 0, 0
        for batch in slices(batches, 2000):
            ids, sizes = _decode(batch, kind)
            found = np.bincount(terms_of(ids, sizes)[1])
            if len(found) > len(df):
                df = np.concatenate([df, np.zeros(len(found) - len(df), np.int64)])
            df[: len(found)] += found
            docs, total = docs + len(sizes), total + len(ids)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([seen, [-1, -2]])), pa.array(np.concatenate([df[seen], [docs, total]]))], ["id", "n"])

    return tokens.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


class Shard:
    """Inverted index of some documents and the greedy filling of windows from it."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float, query_terms: int):
        self.docs, self.query_terms = docs, query_terms
        sizes = np.array([len(d) for d in docs])
        owner, terms, tf = terms_of(np.concatenate(docs), sizes)
        weight = (idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (sizes / mean_length)[owner]))).astype(np.float32)
        self.doc_at, self.doc_terms, self.doc_weight = np.searchsorted(owner, np.arange(len(docs) + 1)), terms, weight
        order = np.argsort(terms.astype(np.uint16) if len(idf) <= 1 << 16 else terms, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(idf)))])
        self.unused = np.ones(len(docs), bool)

    def neighbours(self, seed: int):
        """Unused documents that share a query term with seed, best first."""
        a, b = self.doc_at[seed], self.doc_at[seed + 1]
        best = np.argsort(-self.doc_weight[a:b], kind="stable")[: self.query_terms]
        spans = [(self.at[t], self.at[t + 1]) for t in self.doc_terms[a:b][best]]
        owner = np.concatenate([self.owner[x:y] for x, y in spans])
        scores = np.bincount(owner, np.concatenate([self.weight[x:y] for x, y in spans]), minlength=len(self.docs))
        scores *= self.unused
        found = np.flatnonzero(scores)
        if len(found) > 128:  # most windows need a few: the others are ordered only if these don't fill it
            least = np.partition(scores[found], -64)[-64]
            near = found[scores[found] >= least]
            yield from near[np.argsort(-scores[near], kind="stable")]
            found = found[scores[found] < least]
        yield from found[np.argsort(-scores[found], kind="stable")]

    def order(self, window: int):
        """All documents: each seed, then its neighbours until the window is full. The document that crosses the end is the next seed."""
        at, first, seed = 0, 0, None
        while True:
            if seed is None:
                while first < len(self.docs) and not self.unused[first]:
                    first += 1
                if first == len(self.docs):
                    return
                seed = first
                self.unused[seed] = False
                yield seed
                at += len(self.docs[seed])
            end = -(-at // window) * window  # of the window that the seed is in
            near, seed = self.neighbours(seed) if at < end else (), None
            for x in near:
                self.unused[x] = False
                yield int(x)
                at += len(self.docs[x])
                if at >= end:
                    seed = int(x) if at > end else None
                    break


def lay(sizes: list[int], window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of documents laid end to end; the last window is cut at powers of two."""
    total = sum(sizes)
    cuts = list(range(0, total - total % window, window)) + [total - total % window]
    rest = total % window
    while rest:
        step = 1 << (rest.bit_length() - 1)
        cuts.append(cuts[-1] + step)
        rest -= step
    out, at, k = [], 0, 0
    for d, size in enumerate(sizes):
        start = 0
        while start < size:
            while cuts[k + 1] <= at:
                k += 1
            n = min(size - start, cuts[k + 1] - at)
            out.append((d, start, n, k, at - cuts[k]))
            start, at = start + n, at + n
    return out


def pack(docs: DataFrame, *, tokenizer: str, end_id: int = 2, window: int = WINDOW, shard_tokens: int = 4_000_000, query_terms: int = 24, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: PIECE columns, and with_ids the ids of each piece (little-endian, unsigned 32 bits).

    tokenizer: path of its file on every machine.
    """
    bounded_batches(docs.sparkSession)
    tokens = saved(tokenized(docs, tokenizer, end_id), "token-ids")
    kind = id_type(encoder(tokenizer).size, end_id)
    found = {r.id: r.n for r in document_frequencies(tokens, kind).collect()}  # a row per id of the vocabulary
    n_docs, n_ids = found.pop(-1, 0) or 0, found.pop(-2, 0) or 0
    idf = np.zeros(max([end_id, *found]) + 1, np.float64)
    for i, n in found.items():
        idf[i] = np.log1p((n_docs - n + 0.5) / (n + 0.5))
    sent, mean = docs.sparkSession.sparkContext.broadcast(idf), max(1.0, n_ids / max(1, n_docs))

    def fill(batches):
        part, made = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []

        def flush():
            nonlocal made
            order = list(Shard(ids, sent.value, mean, query_terms).order(window))
            sizes = [len(ids[d]) for d in order]
            rows = lay(sizes, window)
            where = [order[r[0]] for r in rows]
            parts = [ids[d][r[1] : r[1] + r[2]].astype("<u4").tobytes() for d, r in zip(where, rows, strict=True)]
            cols = [[names[d] for d in where], [r[1] for r in rows], [r[2] for r in rows], [zlib.crc32(p) for p in parts], [len(ids[d]) for d in where], [(part << 32) + made + r[3] for r in rows], [r[4] for r in rows]]
            made += rows[-1][3] + 1
            out = [pa.array(c, pa.int64()) for c in cols] + ([pa.array(parts, pa.binary())] if with_ids else [])
            ids.clear(), names.clear()
            return pa.RecordBatch.from_arrays(out, [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * with_ids)

        held = 0
        for batch in batches:
            flat, sizes = _decode(batch, kind)
            for name, x in zip(batch.column(0).to_pylist(), np.split(flat.copy(), np.cumsum(sizes)[:-1]), strict=True):
                if held and held + len(x) > shard_tokens:
                    yield flush()
                    held = 0
                ids.append(x), names.append(name)
                held += len(x)
        if ids:
            yield flush()

    return tokens.mapInArrow(fill, PIECE + ", ids binary" * with_ids)
