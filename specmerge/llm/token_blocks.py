"""Token-id files in patched frame-of-reference blocks.

A segment holds some documents' ids in blocks of 256 values. Of each block the minimum is subtracted, and
the rest is packed at a width that covers one of PERCENTILES of its values, whichever makes the block
smallest; values that need more bits are patched from an exception list. All numbers are little-endian:

    "PFB1"  u32 documents, u32 blocks, u64 values, u64 exceptions
    i64 doc_id, u8 has doc_id, u32 ids               of each document
    u32 start (in words), u32 minimum, u8 width, u16 exceptions   of each block: the block index
    u32 words                                        256 * width / 32 of each block
    u8 place, u32 value less minimum                 of each exception

A dataset is a folder of Parquet files with a segment per row, written and committed by Spark, so that a
lost task leaves nothing behind; segments are in ascending doc_id order by (part, segment).

Defined cases: null text is empty; a null doc_id comes first and stays null; rows that repeat a doc_id are
documents of their own, in any order; other columns are not read. An empty table gives an empty dataset. Special
strings of the tokenizer are special in a text too, as the tokenizers library has it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, slices
from .tokens import as_binary, encoder, id_type, with_end

BLOCK = 256
PERCENTILES = (50, 75, 90, 95, 98, 100)
HEAD = struct.Struct("<4sIIQQ")
SEGMENT_IDS = 500_000
#: Values that a reader unpacks at a time, but for longer documents.
STEP_IDS = 1 << 18

_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if x.size and int(x.max()) < len(_BITS):
        return _BITS[x]
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def pack(rows: np.ndarray, width: int) -> np.ndarray:
    """(n, 256) values below 2**width as (n, 8 * width) words; 32 values lie in width words."""
    rows = rows.reshape(len(rows) * 8, 32).astype(np.uint64)
    out = np.zeros((len(rows), width + 1), np.uint64)
    for j in range(32):
        word, shift = divmod(j * width, 32)
        value = rows[:, j] << np.uint64(shift)
        out[:, word] |= value & np.uint64(0xFFFFFFFF)
        out[:, word + 1] |= value >> np.uint64(32)
    return out[:, :width].astype(np.uint32).reshape(-1, 8 * width)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = np.zeros((len(words) * 8, width + 1), np.uint64)
    rows[:, :width] = words.reshape(-1, width) if width else 0
    out, mask = np.empty((len(rows), 32), np.uint32), np.uint64((1 << width) - 1)
    for j in range(32):
        word, shift = divmod(j * width, 32)
        after = rows[:, word + 1] << np.uint64(32) if word + 1 <= width else np.uint64(0)
        out[:, j] = ((rows[:, word] | after) >> np.uint64(shift)) & mask
    return out.reshape(-1, BLOCK)


def encode_segment(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    rows = np.zeros(blocks * BLOCK, np.int64)
    rows[:n] = ids
    rows[n:] = ids[-1] if n else 0
    rows = rows.reshape(blocks, BLOCK)
    least = rows.min(axis=1) if blocks else np.zeros(0, np.int64)
    rows = rows - least[:, None]
    bits = _bits(rows)
    order = np.sort(bits, axis=1, kind="stable")
    widths = np.stack([order[:, BLOCK * p // 100 - 1] for p in PERCENTILES]).astype(np.int64)
    over = np.stack([(bits > w[:, None]).sum(axis=1) for w in widths.astype(np.uint8)]) if blocks else np.zeros((len(PERCENTILES), 0), np.int64)
    best = np.argmin(widths * BLOCK + over * 40, axis=0)
    width, late = widths[best, np.arange(blocks)], over[best, np.arange(blocks)]
    starts = np.cumsum(width * 8) - width * 8
    words = np.zeros(int((width * 8).sum()), np.uint32)
    patched = bits > width[:, None]
    low = rows & ((np.int64(1) << width) - 1)[:, None]
    for w in np.unique(width[width > 0]):
        which = np.flatnonzero(width == w)
        words[starts[which][:, None] + np.arange(8 * w)] = pack(low[which], int(w))
    places = np.nonzero(patched)
    return b"".join([
        HEAD.pack(b"PFB1", len(doc_ids), blocks, n, len(places[0])),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], np.uint8).tobytes(), np.asarray(sizes, "<u4").tobytes(),
        starts.astype("<u4").tobytes(), least.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(), late.astype("<u2").tobytes(),
        words.astype("<u4").tobytes(), places[1].astype(np.uint8).tobytes(), rows[places].astype("<u4").tobytes(),
    ])


class Segment:
    """Reader of one segment."""

    def __init__(self, data: bytes):
        magic, docs, blocks, self.n, late = HEAD.unpack_from(data)
        if magic != b"PFB1":
            raise ValueError("not a token segment")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        ids, there = take("<i8", docs), take("u1", docs)
        self.doc_ids = [int(d) if y else None for d, y in zip(ids, there, strict=True)]
        self.sizes = take("<u4", docs).astype(np.int64)
        self.starts, self.least, self.width, self.late = take("<u4", blocks).astype(np.int64), take("<u4", blocks), take("u1", blocks).astype(np.int64), take("<u2", blocks).astype(np.int64)
        self.words = take("<u4", int((self.width * 8).sum()))
        self.place, self.value = take("u1", late), take("<u4", late)
        self.late_starts = np.cumsum(self.late) - self.late

    def read(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids from begin to end; only the blocks that hold them are unpacked."""
        end = self.n if end is None else min(end, self.n)
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = begin // BLOCK, -(-end // BLOCK)
        rows = np.zeros((last - first, BLOCK), np.uint32)
        width = self.width[first:last]
        for w in np.unique(width[width > 0]):
            which = np.flatnonzero(width == w)
            rows[which] = unpack(self.words[self.starts[first:last][which][:, None] + np.arange(8 * w)], int(w))
        a, b = self.late_starts[first], self.late_starts[last - 1] + self.late[last - 1]
        rows[np.repeat(np.arange(last - first), self.late[first:last]), self.place[a:b]] = self.value[a:b]
        rows += self.least[first:last, None]
        return rows.reshape(-1)[begin - first * BLOCK : end - first * BLOCK]


def _bounds(docs: DataFrame, parts: int) -> np.ndarray:
    """At most parts - 1 doc_ids that part the rows in ascending ranges; an id that fills ranges of its own is there more than once."""
    shares = [k / parts for k in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(max(1000, 10 * parts))).alias("q")).first().q if shares else None
    return np.array(found or [], np.int64)


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode the text of docs and write the dataset in ascending doc_id order. tokenizer: path of its file.

    Texts are encoded where they are read, and ids are dealt to tasks by ranges of doc_id, whose bounds come from that
    column alone. Rows of an id that makes up several ranges are dealt to all of them.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, parts)

    def encode(batches):
        coder, at = encoder(tokenizer), 0
        kind = id_type(coder.size, end_id)
        for some in slices(batches, 2000):
            flat, n = with_end(*coder.encode(some.column(1)), end_id)
            there = some.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = some.column(0).fill_null(0).to_numpy()
            low, high = np.searchsorted(bounds, ids), np.searchsorted(bounds, ids, "right")
            part = np.where(there, low + (at + np.arange(len(ids))) % (high - low + 1), 0)
            at += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), some.column(0), as_binary(flat, n, kind)], ["part", "doc_id", "ids"])
        coder.rest()

    def write(batches):
        kind = id_type(encoder(tokenizer).size, end_id)
        now, segment = None, 0
        start = held = 0
        doc_ids, sizes, ids = [], [], []

        def flush():
            nonlocal segment, start, held
            whole = np.concatenate(ids)
            row = [pa.array([now]), pa.array([segment]), pa.array([start]), pa.array([len(whole)]), pa.array([encode_segment(doc_ids, np.array(sizes), whole)], pa.binary())]
            segment, start, held = segment + 1, start + len(whole), 0
            doc_ids.clear(), sizes.clear(), ids.clear()
            return pa.RecordBatch.from_arrays(row, ["part", "segment", "part_start", "n_ids", "data"])

        for some in slices(batches):
            for part, doc_id, data in zip(*(some.column(i).to_pylist() for i in range(3)), strict=True):
                if doc_ids and (part != now or held >= segment_ids):
                    yield flush()
                if part != now:
                    now, segment, start = part, 0, 0
                x = np.frombuffer(data, kind)
                doc_ids.append(doc_id), sizes.append(len(x)), ids.append(x.astype(np.uint32))
                held += len(x)
        if doc_ids:
            yield flush()

    coded = docs.mapInArrow(encode, "part int, doc_id bigint, ids binary")
    rows = coded.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id")
    rows.mapInArrow(write, "part bigint, segment bigint, part_start bigint, n_ids bigint, data binary").write.mode("overwrite").parquet(path)


def read_blocks(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if wanted, ids of a dataset's documents."""
    bounded_batches(spark)
    segments = spark.read.parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # a row for each writing task
    before = spark.sparkContext.broadcast(dict(zip([r.part for r in parts], np.cumsum([0, *(r.n for r in parts)]).tolist(), strict=False)))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids

    def decode(batches):
        for batch in batches:
            for part, start, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                segment = Segment(data)
                ends = np.cumsum(segment.sizes)
                i = 0
                while i < len(ends):  # some documents at a time
                    first = int(ends[i] - segment.sizes[i])
                    j = max(i + 1, int(np.searchsorted(ends, first + STEP_IDS, "right")))
                    ids = segment.read(first, int(ends[j - 1])).astype("<u4")
                    here = ends[i:j] - first
                    begins, view = here - segment.sizes[i:j], memoryview(ids).cast("B")
                    out = [
                        pa.array(segment.doc_ids[i:j], pa.int64()), pa.array(begins + first + start + before.value[part], pa.int64()), pa.array(segment.sizes[i:j], pa.int64()),
                        pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), here.tolist(), strict=True)], pa.int64()),
                    ]
                    if with_ids:
                        out.append(pa.ListArray.from_arrays(pa.array([0, *here], pa.int32()), pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(out)])
                    i = j

    return segments.select("part", "part_start", "data").mapInArrow(decode, schema)
