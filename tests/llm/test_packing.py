"""Packing: exact cover of every id, no padding, and neighbours that share words."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from specmerge.llm.packing import Shard, lay, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_lay_covers_and_pads_nothing():
    rows = lay([5, 4096, 1, 9000, 3], 4096)
    total = 5 + 4096 + 1 + 9000 + 3
    by = {}
    for d, start, n, k, at in rows:
        assert by.get(k, 0) == at
        by[k] = at + n
    assert sum(by.values()) == total
    assert all(v == 4096 or v & (v - 1) == 0 for v in by.values())
    assert lay([], 4096) == []


def test_neighbours_share_terms():
    docs = [np.array(x, np.uint16) for x in ([1, 1, 7], [2, 2, 8], [1, 1, 9], [2, 2, 9])]
    shard = Shard(docs, np.ones(16), 3.0, 8)
    assert list(shard.order(6)) == [0, 2, 1, 3]


@pytest.mark.parametrize("window", [16, 4096])
def test_every_id_once(spark, window):
    texts = ["the cat sat", None, "", "a dog " * 40, "the cat sat", "x"]
    df = spark.createDataFrame([(i if i != 5 else None, t, "b") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = pack(df, tokenizer=PATH, window=window, with_ids=True).collect()
    coder = Tokenizer.from_file(PATH)
    for i, t in enumerate(texts):
        whole = coder.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in rows if r.doc_id == (i if i != 5 else None)), key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in mine]).tolist() == whole
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.doc_tokens == len(whole) and r.length == len(r.ids) // 4 for r in mine)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert all(v == window or v & (v - 1) == 0 for v in ends.values())


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer=PATH).count() == 0


def test_crossing_document_is_the_next_seed():
    docs = [np.array(x, np.uint16) for x in ([1] * 8, [2] * 5, [3] * 3, [2] * 3, [2] * 3)]
    assert list(Shard(docs, np.ones(16), 4.4, 8).order(10)) == [0, 1, 3, 4, 2]


def greedy(docs, window, query_terms):
    """The order by the definition: BM25 scores of every document for each seed, one after another."""
    n, mean = len(docs), np.mean([len(d) for d in docs])
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]))
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    weight = [{t: np.float32(idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))) for t, tf in zip(*np.unique(d, return_counts=True))} for d in docs]
    left, out, at, seed = set(range(n)), [], 0, None

    def put(d):
        nonlocal at
        left.remove(d), out.append(d)
        at += len(docs[d])

    while left:
        if seed is None:
            seed = min(left)
            put(seed)
        end = -(-at // window) * window
        query = sorted(weight[seed], key=lambda t: (-weight[seed][t], t))[:query_terms]
        score = {d: sum(float(weight[d].get(t, 0)) for t in query) for d in left}
        seed = None
        for d in sorted((d for d in left if score[d] > 0), key=lambda d: (-score[d], d)) if at < end else ():
            put(d)
            if at >= end:
                seed = d if at > end else None
                break
    return out, idf, mean


def test_order_is_the_greedy_one():
    rng = np.random.default_rng(3)
    docs = [np.append(rng.zipf(1.6, rng.integers(1, 60)) % 300 + 3, 2).astype(np.uint16) for _ in range(220)]
    want, idf, mean = greedy(docs, 128, 8)
    assert list(Shard(docs, idf, mean, 8).order(128)) == want
