import random
import re

import pytest

from specmerge.llm import decontaminate as d

from . import corpus


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + min(5, len(w))]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(docs, items, threshold=0.75):
    out = set()
    for doc, text in docs:
        s = shingles(text)
        for item, t in items:
            q = shingles(t)
            if doc is not None and item is not None and q and len(q & s) >= threshold * len(q):
                out.add((doc, item, len(q), len(q & s)))
    return sorted(out)


def case(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 5, 6, 9, 12, 13, 20, 36, 37, 40, 68, 69, 130, 300])]
    docs = []
    for i in range(60):
        body = [word() for _ in range(rng.choice([10, 200, 3000]))]
        if i % 2:
            _, text = items[i % len(items)]
            w = text.split()
            if i % 4 == 3 and len(w) > 12:  # an edit in the passage
                w[rng.randrange(len(w))] = "edited"
            at = rng.randrange(len(body))
            body[at:at] = [x.upper() + "," if i % 3 else x for x in w]
        docs.append((i, " ".join(body)))
    return docs, items


@pytest.mark.parametrize("bound", [8 << 20, 0])
def test_finds_what_brute_force_finds(spark, monkeypatch, bound):
    monkeypatch.setattr(d, "BROADCAST_BYTES", bound)
    docs, items = case()
    docs += [(100, None), (None, docs[1][1]), (101, ""), docs[1]]
    items += [(500, None), (501, " ,. "), (None, items[3][1]), items[4]]
    got = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    found = sorted((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect())
    assert found == plain(docs, items) and len(found) > 20
    assert "Python" not in got._jdf.queryExecution().toString()


def test_stage_drops_only_those(spark):
    docs, items = case()
    rows = [(i, t, "en", "s", 1, "k", 1, "x") for i, t in docs] + [(None, docs[1][1], "en", "s", 1, "k", 1, "x")]
    df = spark.createDataFrame(rows, corpus.SCHEMA)
    out = d.drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    bad = {x[0] for x in plain(docs, items)}
    assert out.columns == df.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in out.collect()) == sorted([-1] + [i for i, _ in docs if i not in bad])


def test_empty(spark):
    docs, items = case()
    df, none = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated(df, none).count() == 0
    assert d.contaminated(corpus.empty(spark), spark.createDataFrame(items, "item_id long, text string")).count() == 0
