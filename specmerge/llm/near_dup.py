"""Near-duplicate documents by HyperMinHash registers.

Sets: distinct 5-word shingles of the whole text, as 64-bit hashes. A set's hashes fall into ``REGISTERS``
buckets; of the least hash in a bucket the register keeps the leading-zero count and ``MANTISSA`` more bits.
Empty buckets take the register of the first filled bucket on a fixed random walk of their own.

1. Documents with equal sets form a class; its smallest doc_id stands for it.
2. Bands of ``ROWS`` registers are hashed. In each bucket of equal bands, documents are joined whose Jaccard
   estimate is within five standard deviations of the threshold or above it. The estimate comes from one bit
   of each of 128 registers, corrected for the half of the bits that agree by chance. The registers of a set of
   few shingles are copies of each other, so that no estimate rejects a pair with fewer than ``SMALL``. Buckets of more than
   ``BUCKET`` documents are joined whole. A map task sends at most BUCKET documents of a bucket to the
   shuffle: more are joined on the spot, and one stands for them.
3. The connected components of these candidates hold every pair that shares a band. Only their documents'
   sets are shuffled, each once. Within a component the registers' estimate, corrected for register
   collisions, selects pairs, and set intersections over an inverted index confirm them. A component of more than ``BLOCK`` shingles,
   or ``DOCUMENTS`` documents, is split in blocks, and each pair of blocks is a task; pairs already connected are not counted again.
4. Components of the confirmed links give the result.

A pair at the threshold of 0.75 shares no band with probability 3e-11 and falls below the estimates' margin
with probability 3e-7; at a larger corpus, raise ROWS to keep unrelated documents with common passages apart.

Defined cases: texts without words have the empty set, have n_shingles 0 and are linked with nothing; texts
of one to four words have one shingle, the whole sequence; a null doc_id is linked with nothing, its
component_id is null and it is kept; rows that repeat a doc_id are placed each by its own text. Other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from .common import bounded_batches, only_ids, saved, slices

REGISTERS, MANTISSA, ROWS, BUCKET, BLOCK, DOCUMENTS, SIGNATURE, SMALL = 256, 10, 4, 256, 1_500_000, 8192, 128, 64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    def __missing__(self, word):
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


_WORDS = _Words()


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    if len(_WORDS) > 150_000:
        _WORDS.clear()
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += _mix(hashes[k : k + n] ^ _ODD[k % 5]) * _ODD[(k + 1) % 5]
    return np.unique(_mix(total))


def _walks(steps: int = 64) -> np.ndarray:
    return np.random.default_rng(12345).integers(0, REGISTERS, (steps, REGISTERS))


_WALKS = _walks()


def registers(values: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set that isn't empty."""
    out = np.zeros(REGISTERS, np.uint16)
    bucket = (((values >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rest = values[first] * np.uint64(REGISTERS)
    zeros = np.clip(64 - np.frexp(rest.astype(np.float64))[1], 0, 62).astype(np.uint64)
    mantissa = ((rest << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out[bucket[first]] = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) + mantissa.astype(np.uint16)
    if len(first) < REGISTERS:
        filled = np.zeros(REGISTERS, bool)
        filled[bucket[first]] = True
        empty = np.flatnonzero(~filled)
        walk, step = _WALKS, 0
        while len(empty):
            if step == len(walk):
                walk, step = np.random.default_rng(int(walk[-1, 0]) + len(walk)).integers(0, REGISTERS, (4 * len(walk), REGISTERS)), 0
            to = walk[step, empty]
            hit = filled[to]
            out[empty[hit]] = out[to[hit]]
            empty, step = empty[~hit], step + 1
    return out


#: Probability that registers of two different least hashes agree.
COLLISION = 2.0**-MANTISSA / 3


def estimate(equal: np.ndarray, count: int = REGISTERS, collision: float = COLLISION) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, less what agrees by chance."""
    return (equal / count - collision) / (1 - collision)


def _margin(threshold: float, count: int, collision: float) -> float:
    p = threshold + (1 - threshold) * collision
    return threshold - 5 * (p * (1 - p) / count) ** 0.5 / (1 - collision)


def _signature(regs: np.ndarray) -> np.ndarray:
    return np.packbits((regs[:, :SIGNATURE] & 1).astype(np.uint8), axis=1).view(np.uint64)


def _band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) keys."""
    parts = regs.reshape(len(regs), -1, rows).astype(np.uint64)
    out = np.arange(parts.shape[1], dtype=np.uint64)[None, :] + np.zeros((len(regs), 1), np.uint64)
    for k in range(rows):
        out = _mix(out * _ODD[0] + parts[:, :, k] + np.uint64(1))
    return out


def _spanning(size: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Root, the least member, of each of size nodes."""
    root = list(range(size))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [top(x) for x in range(size)]


def _alike(sig: np.ndarray, n: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose sizes and signatures allow the threshold."""
    least = _margin(threshold, SIGNATURE, 0.5)
    apart = np.bitwise_count(sig[:, None, :] ^ sig[None, :, :]).sum(axis=2)
    ok = (estimate(SIGNATURE - apart.astype(np.float64), SIGNATURE, 0.5) >= least) | (np.minimum(n[:, None], n[None, :]) < SMALL)
    ok &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :])
    return np.nonzero(np.triu(ok, 1))


#: A document of a bucket; whole: it stands for a bucket that is joined whole. link: doc and s0 are joined already, key only spreads them.
BAND = "key bigint, doc bigint, n bigint, s0 bigint, s1 bigint, whole boolean, link boolean"
LINK = "a bigint, b bigint"


def _bands(batches, rows: int, bucket: int):
    """Rows of BAND of each batch: of a bucket with many of its documents one row, marked whole, and links that join the others to it."""
    for batch in batches:
        doc, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(doc):
            continue
        regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(len(doc), REGISTERS)
        sig, keys = _signature(regs).view(np.int64), _band_keys(regs, rows).view(np.int64)
        at, key = np.repeat(np.arange(len(doc)), keys.shape[1]), keys.reshape(-1)
        order = np.lexsort((doc[at], key))
        at, key = at[order], key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        large = np.repeat(sizes > bucket, sizes)
        head = np.repeat(starts, sizes) == np.arange(len(key))
        send = ~large | head
        yield _band_batch(key[send], doc[at[send]], n[at[send]], sig[at[send]], large[send], False)
        if (joined := large & ~head).any():
            leader = doc[at[np.repeat(starts, sizes)[joined]]]
            member = at[joined]
            pairs = np.unique(np.stack([doc[member], leader], 1), axis=0)
            yield _band_batch(_mix(pairs[:, 0].astype(np.uint64)).view(np.int64), pairs[:, 0], pairs[:, 1], pairs[:, [1, 1]], np.zeros(len(pairs), bool), True)


def _band_batch(key, doc, n, sig, whole, link: bool):
    cols = [key, doc, n, sig[:, 0], sig[:, 1], whole, np.full(len(doc), link)]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], [c.split()[0] for c in BAND.split(", ")])


def _join_buckets(batches, threshold: float, bucket: int):
    """Links of the documents of each bucket, from rows in order of key; a bucket may go on in the next batch."""
    carry = None
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
        if (link := cols.pop()).any():
            yield pa.RecordBatch.from_arrays([pa.array(cols[1][link]), pa.array(cols[3][link])], ["a", "b"])
            cols = [c[~link] for c in cols]
        if carry is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(carry, cols, strict=True)]
        if not len(cols[0]):
            continue
        last = int(np.searchsorted(cols[0], cols[0][-1]))
        if len(cols[0]) - last > 4 * bucket:  # a large bucket: join what is here, one row stands for it
            yield _links(cols, threshold, bucket)
            carry = [c[last : last + 1].copy() for c in cols]
            carry[5][:] = True
            continue
        carry = [c[last:] for c in cols]
        if last:
            yield _links([c[:last] for c in cols], threshold, bucket)
    if carry is not None and len(carry[0]):
        yield _links(carry, threshold, bucket)


def _links(cols: list[np.ndarray], threshold: float, bucket: int):
    key, doc, n, s0, s1, whole = cols
    sig = np.stack([s0, s1], 1).view(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    marked = np.add.reduceat(whole.astype(np.int64), starts) > 0
    a, b = [], []
    two = starts[(sizes == 2) & ~marked]
    apart = np.bitwise_count(sig[two] ^ sig[two + 1]).sum(axis=1)
    ok = (estimate(SIGNATURE - apart.astype(np.float64), SIGNATURE, 0.5) >= _margin(threshold, SIGNATURE, 0.5)) | (np.minimum(n[two], n[two + 1]) < SMALL)
    ok &= np.minimum(n[two], n[two + 1]) >= threshold * np.maximum(n[two], n[two + 1])
    a.append(doc[two[ok]]), b.append(doc[two[ok] + 1])
    for s, m in zip(*(x[(sizes > 2) | ((sizes == 2) & marked)].tolist() for x in (starts, sizes)), strict=True):
        mine = doc[s : s + m]
        if m > bucket or whole[s : s + m].any():
            a.append(mine[1:]), b.append(np.full(m - 1, mine[0]))
        else:
            root = np.array(_spanning(m, *_alike(sig[s : s + m], n[s : s + m], threshold)))
            moved = root != np.arange(m)
            a.append(mine[moved]), b.append(mine[root[moved]])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"])


def confirm(docs: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], regs: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the exact similarity graph of some documents; if they are of two blocks, of pairs across the blocks alone.

    A document's overlaps with all others are counted over the inverted index, if the estimate lets any
    document that isn't connected with it yet pass.
    """
    m, across = len(docs), len(np.unique(blocks)) > 1
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    posting = owner[np.argsort(ids, kind="stable")]
    at = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(values)))])
    ends = np.cumsum(sizes)
    root, a, b = np.arange(m), [], []
    least = _margin(threshold, REGISTERS, COLLISION)
    parts = int(round(threshold * 10_000))
    for u in range(m):
        apart = root[u + 1 :] != root[u]
        if across:
            apart &= blocks[u + 1 :] != blocks[u]
        left = np.flatnonzero(apart) + u + 1
        if not len(left):
            continue
        left = left[np.minimum(sizes[left], sizes[u]) * 10_000 >= parts * np.maximum(sizes[left], sizes[u])]
        left = left[(estimate((regs[left] == regs[u]).sum(axis=1)) >= least) | (np.minimum(sizes[left], sizes[u]) < SMALL)] if len(left) else left
        if not len(left):
            continue
        mine = ids[ends[u] - sizes[u] : ends[u]]
        if len(left) <= 4:
            both = np.array([len(np.intersect1d(mine, ids[ends[v] - sizes[v] : ends[v]], assume_unique=True)) for v in left])
        else:
            lengths = at[mine + 1] - at[mine]
            flat = np.repeat(at[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
            both = np.bincount(posting[flat], minlength=m)[left]
        for v in left[both * 10_000 >= parts * (sizes[left] + sizes[u] - both)]:
            if root[v] != root[u]:
                root[root == max(root[u], root[v])] = min(root[u], root[v])
                a.append(u), b.append(v)
    if not across:  # each to the least of its component: a star
        root = np.array(_spanning(m, np.array(a, int), np.array(b, int)))
        a = np.flatnonzero(root != np.arange(m))
        b = root[a]
    return docs[np.array(a, int)], docs[np.array(b, int)]


def _confirm_groups(batches, threshold: float):
    """confirm() of each group of rows with the same (grp, i, j), in that order; a group may go on in the next batch."""
    key, held = None, []

    def done():
        doc = np.array([h[0] for h in held])
        order = np.argsort(doc, kind="stable")
        sets = [np.frombuffer(held[k][2], np.uint64) for k in order]
        regs = np.stack([registers(s) for s in sets])
        a, b = confirm(doc[order], np.array([held[k][1] for k in order]), sets, regs, threshold)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        for grp, i, j, block, doc, values in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if key != (grp, i, j):
                if len(held) > 1:
                    yield done()
                key, held = (grp, i, j), []
            held.append((doc, block, values))
    if len(held) > 1:
        yield done()


def near_duplicates(docs: DataFrame, *, threshold: float = 0.75, rows: int = ROWS, bucket: int = BUCKET, block: int = BLOCK, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sketch(batches):
        for batch in slices(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            regs = [registers(s).astype("<u2").tobytes() if len(s) else None for s in sets]
            keys = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "set_key", "regs"])

    sketched = saved(source.mapInArrow(sketch, "doc_id bigint, n_shingles bigint, set_key binary, regs binary"), "sketches")
    classes = saved(sketched.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size")), "classes", small=True)
    reps = sketched.join(classes.select(F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"], "left_semi").select("doc_id", "n_shingles", "regs")

    buckets = reps.mapInArrow(lambda x: _bands(x, rows, bucket), BAND).repartition("key").sortWithinPartitions("key")
    candidates = components(buckets.mapInArrow(lambda x: _join_buckets(x, threshold, bucket), LINK))

    # every document of a candidate component, its set once; blocks of a component by their number of shingles
    grouped = candidates.unionByName(candidates.select(F.col("root").alias("node"), "root").distinct()).select(F.col("node").alias("doc_id"), F.col("root").alias("grp"))
    sizes = grouped.join(classes, grouped.doc_id == classes.rep)
    parts = sizes.groupBy("grp").agg(F.ceil(F.greatest(F.sum("size") / block, F.count(F.lit(1)) / documents)).cast("int").alias("parts"))
    grouped = saved(grouped.join(parts, "grp").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")), "groups", small=True)

    def sets_of(batches):
        for batch in slices(batches):
            values = pa.array([shingles(t).tobytes() for t in batch.column(3).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(4), values], ["grp", "parts", "block", "doc", "values"])

    texts = source.join(grouped, "doc_id").select("grp", "parts", "block", "text", F.col("doc_id").alias("doc"))
    sets = texts.mapInArrow(sets_of, "grp bigint, parts int, block int, doc bigint, values binary")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tasks = sets.select("grp", "block", "doc", "values", other).select("grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc", "values")
    tasks = tasks.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    roots = components(tasks.mapInArrow(lambda x: _confirm_groups(x, threshold), LINK))

    placed = classes.join(roots, classes.rep == roots.node, "left").select("set_key", F.coalesce("root", "rep").alias("component"))
    out = sketched.select("doc_id", "n_shingles", "set_key").join(placed, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, *, threshold: float = 0.75) -> DataFrame:
    """The rows of docs whose document stands for its group; rows that repeat its doc_id stay with it."""
    return only_ids(docs, near_duplicates(docs, threshold=threshold).where("kept"), keep=True)
