import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from specmerge.llm import line_dedup
from specmerge.llm.common import ASCII_SPACE
from specmerge.llm.cuckoo import CuckooFilter

from . import corpus


@given(st.lists(st.integers(0, 2**64 - 1), max_size=300), st.integers(1, 400))
@settings(max_examples=40, deadline=None)
def test_cuckoo_holds_what_is_left(hashes, capacity):
    f = CuckooFilter(capacity)
    h = np.array(hashes, np.uint64)
    f.insert(h)
    assert f.contains(h).all()
    f.delete(h[: len(h) // 2])
    assert f.contains(h[len(h) // 2 :]).all()
    g = CuckooFilter.of(*f.state())
    assert (g.contains(h) == f.contains(h)).all()
    f.delete(h[len(h) // 2 :])
    assert not f.slots.any() and not f.stash


def test_cuckoo_says_no():
    rng = np.random.default_rng(1)
    f = CuckooFilter(5000)
    f.insert(rng.integers(0, 2**63, 5000).astype(np.uint64))
    assert f.contains(rng.integers(0, 2**63, 5000).astype(np.uint64)).mean() < 0.01


def plain(rows):
    """kept text, lines, dropped of each row."""
    split = [(r[0], (r[1] or "").split("\n")) for r in rows]
    key = lambda x: x.strip(ASCII_SPACE).encode().lower()
    long = lambda x: len(x.strip(ASCII_SPACE)) >= 20
    held = {}
    for d, lines in split:
        for x in lines:
            if long(x):
                held.setdefault(key(x), set()).add(d)
    top = {k: max([d for d in v if d is not None], default=None) for k, v in held.items() if len(v) >= 3}
    out = []
    for d, lines in split:
        keep = [x for x in lines if not (long(x) and key(x) in top and top[key(x)] != d)]
        out.append((-1 if d is None else d, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in df.collect())


def test_whole_corpus(spark):
    df = corpus.frame(spark)
    out = line_dedup.dedup_lines(df)
    assert result(out) == plain(corpus.rows())
    assert [c for c in out.columns if c not in ("n_lines", "n_dropped")] == df.columns
    assert sum(r.n_dropped for r in out.collect()) > 10


def test_filters_beyond_broadcast_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    assert result(line_dedup.dedup_lines(corpus.frame(spark))) == plain(corpus.rows())


def test_insert_and_delete_are_reversible(spark):
    rows = corpus.rows()
    a, b = rows[:45], rows[45:]
    frame = lambda x: spark.createDataFrame(x, corpus.SCHEMA)
    index = line_dedup.LineIndex(spark, shards=4).insert(frame(a))
    counts = lambda i: sorted((bytes(r.key), r.n_docs, r.holder) for r in i.counts.collect())
    before = counts(index)
    index.insert(frame(b))
    assert counts(index) == counts(line_dedup.LineIndex(spark, shards=4).insert(frame(rows)))
    assert result(index.apply(frame(rows))) == plain(rows)
    index.insert(frame(b))  # again: nothing new
    new = [r for r in b if r[0] not in {x[0] for x in a}]
    index.delete(frame(new).select("doc_id"))
    assert counts(index) == before
    assert result(index.apply(frame(a))) == plain(a)


def test_empty(spark):
    assert line_dedup.dedup_lines(corpus.empty(spark)).count() == 0


@pytest.mark.parametrize("min_docs", [2, 5])
def test_parameters(spark, min_docs):
    rows = [(i, "x" * 30 if i < min_docs else "y" * 30, "", "", 1, "", 1, "") for i in range(2 * min_docs - 1)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, corpus.SCHEMA), min_docs=min_docs).where("n_dropped = 1").collect()
    assert sorted(r.doc_id for r in got) == list(range(min_docs - 1))


def test_clashing_names_and_another_text_column(spark):
    df = corpus.frame(spark).withColumnsRenamed({"lang": "n_lines", "source": "N_Dropped", "n_chars": "__doc", "key": "__drop", "text": "body"})
    index = line_dedup.LineIndex(spark).insert(df, "body")
    out = index.apply(df, "body")
    assert out.columns == [*df.columns, "n_lines_", "n_dropped_"]
    assert result(out.select("doc_id", F.col("body").alias("text"), F.col("n_lines_").alias("n_lines"), F.col("n_dropped_").alias("n_dropped"))) == plain(corpus.rows())
    assert index.apply(df, "body", counts=False).columns == df.columns


def test_shards_grow_with_the_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    index = line_dedup.LineIndex(spark, shards=1, min_docs=1).insert(corpus.frame(spark))
    assert index.shards == -(-index.counts.count() // 2) and index.filters.count() > 20
    monkeypatch.undo()
    assert result(line_dedup.LineIndex(spark, shards=1).insert(corpus.frame(spark)).apply(corpus.frame(spark))) == plain(corpus.rows())
