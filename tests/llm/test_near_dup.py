import random

import numpy as np
import pytest

from specmerge.llm import near_dup

from . import corpus


def sets_of(rows):
    out = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)) if w else frozenset())
    return out


def plain(rows):
    """(n_shingles, component) of each row with a doc_id."""
    rows = [r for r in rows if r[0] is not None]
    sets, ids = sets_of(rows), [r[0] for r in rows]
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(ids[i]), top(ids[j])
                root[max(a, b)] = min(a, b)
    return sorted((d, len(s), top(d)) for d, s in zip(ids, sets))


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None)


def test_corpus(spark):
    out = near_dup.near_duplicates(corpus.frame(spark))
    assert result(out) == plain(corpus.rows())
    by = {r.doc_id: r for r in out.collect()}
    assert by[None].component_id is None and by[None].kept
    assert all(r.kept == (r.doc_id == r.component_id) for r in by.values())
    kept = near_dup.keep_one(corpus.frame(spark))
    assert kept.columns == corpus.frame(spark).columns
    assert sorted({-1 if r.doc_id is None else r.doc_id for r in kept.collect()}) == sorted({-1 if d is None else d for d, r in by.items() if r.kept})


def family(n, words, edits, seed=3):
    """Near copies of one text, from almost equal to hardly alike."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(9999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("limits", [(256, 1_500_000), (3, 1_500_000), (256, 900), (2, 300)])
def test_dense_family_is_exact_at_any_limit(spark, limits):
    """Large buckets are joined whole and large components split in blocks; no link may be lost."""
    texts = family(60, 70, 8) + family(30, 12, 2, 4) + family(20, 6, 1, 5)
    rows = [(i, t, "", "", 1, "", 1, "") for i, t in enumerate(texts)]
    got = result(near_dup.near_duplicates(spark.createDataFrame(rows, corpus.SCHEMA).repartition(4), bucket=limits[0], block=limits[1]))
    assert got == plain(rows)
    assert 3 < len({c for _, _, c in got}) < len(rows)


def test_estimate_is_close():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.75, 0.95):
        n = 4000
        pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[int(n * (1 - share)) : int(n * (1 - share)) + n])
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = near_dup.estimate((near_dup.registers(a) == near_dup.registers(b)).sum())
        assert abs(got - exact) < 0.13


def test_registers_of_tiny_sets():
    assert len(np.unique(near_dup.registers(near_dup.shingles("one two")))) == 1
    assert len(near_dup.shingles("")) == 0 and len(near_dup.shingles(None)) == 0
    assert len(near_dup.shingles("a b c d e f")) == 2


def test_empty(spark):
    assert near_dup.near_duplicates(corpus.empty(spark)).count() == 0


def tiny_pairs(n, words):
    """(a, b): the shingles of n texts of words different words and of the same texts without the last word."""
    return [tuple(near_dup.shingles(" ".join(f"t{i}x{k}" for k in range(m))) for m in (words, words - 1)) for i in range(n)]


def test_no_tiny_pair_is_lost_to_estimates():
    """8 words against their first 7 have 3 of 4 shingles in common, the threshold itself."""
    for words in (8, 10, 16):
        pairs = tiny_pairs(1500, words)
        regs = np.stack([near_dup.registers(s) for p in pairs for s in p])
        n, sig = np.array([len(s) for p in pairs for s in p]), near_dup._signature(regs)
        keys = near_dup._band_keys(regs, near_dup.ROWS)
        for i, p in enumerate(pairs):
            two = slice(2 * i, 2 * i + 2)
            assert (keys[2 * i] == keys[2 * i + 1]).any()
            assert len(near_dup._alike(sig[two], n[two], 0.75)[0]) == 1
            assert len(near_dup.confirm(np.array([0, 1]), np.zeros(2, int), list(p), regs[two], 0.75)[0]) == 1
        cols = [np.repeat(np.arange(len(pairs)), 2), np.arange(len(n)), n, *sig.view(np.int64).T, np.zeros(len(n), bool)]
        assert near_dup._links(cols, 0.75, near_dup.BUCKET).num_rows == len(pairs)


def test_tiny_pairs_are_linked(spark):
    rows = []
    for i in range(400):
        w = [f"t{i}x{k}" for k in range(8)]
        rows += [(2 * i, " ".join(w), "", "", 1, "", 1, ""), (2 * i + 1, " ".join(w[:7]), "", "", 1, "", 1, "")]
    got = result(near_dup.near_duplicates(spark.createDataFrame(rows, corpus.SCHEMA).repartition(4)))
    assert [c for _, _, c in got] == [2 * (i // 2) for i in range(800)]


def test_clashing_names_pass_through(spark):
    df = corpus.frame(spark).withColumnsRenamed({"lang": "__id", "source": "kept", "n_chars": "__ID_", "key": "quality"})
    want = sorted(r.text or "" for r in near_dup.keep_one(corpus.frame(spark)).collect())
    out = near_dup.keep_one(df)
    assert out.columns == df.columns and sorted(r.text or "" for r in out.collect()) == want
