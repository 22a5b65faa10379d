"""The pipeline's stages, each on all that the one before kept, against plain versions of them."""

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as p
from specmerge.llm.tokens import encoder
from specmerge.llm.queries import vocabulary_path

from . import corpus, test_decontaminate, test_line_dedup, test_near_dup


def write(spark, tmp_path):
    rows = [r for r in corpus.rows(11, 80)]
    long = [t for _, t, *_ in rows if t and len(t.split()) > 120][:3]
    items = [(i, " ".join(t.split()[20:50])) for i, t in enumerate(long)] + [(9, None)]
    spark.createDataFrame(rows, corpus.SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return items


def test_stages(spark, tmp_path):
    items = write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    seen = []
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(p.STAGES) - 1:
            assert out.columns == names, name
            rows, was = ([tuple(r) for r in x.collect()] for x in (out, docs))
            seen.append((was, rows))
            assert rows, name
        docs = out
    ids = lambda rows: sorted(-1 if r[0] is None else r[0] for r in rows)
    (was, good), (lines_was, lines), (dup_was, dup), (leak_was, leak) = seen
    assert set(ids(good)) < set(ids(was)) and -1 in ids(good) and all(len(r[1].split()) >= 50 for r in good)
    assert sorted((-1 if r[0] is None else r[0], (r[1]).count("\n") + 1) for r in lines) == sorted((d, n - k) if n > k else (d, 1) for d, n, k, _ in test_line_dedup.plain(lines_was))
    assert all(r[4] == len(r[1]) for r in lines)
    tops = {d: c for d, _, c in test_near_dup.plain(dup_was)}
    assert ids(dup) == sorted(d for d in ids(dup_was) if tops.get(d, d) == d) and len(dup) < len(dup_was)
    bad = {x[0] for x in test_decontaminate.plain([r[:2] for r in leak_was], items)}
    assert bad and ids(leak) == [d for d in ids(leak_was) if d not in bad]
    total = sum(len(encoder(vocabulary_path("word_bpe_49k.json")).tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in leak)
    assert docs.agg({"length": "sum"}).first()[0] == total
    assert sum(len(np.frombuffer(r.ids, "<u4")) for r in docs.collect()) == total
    assert p.run(spark, str(tmp_path)).count() == docs.count()


def test_stages_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = corpus.empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and out.columns == docs.columns
    assert p.packed(spark, docs, str(tmp_path)).count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and 4 <= len(p.STAGES) <= 5
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("stage", [s for _, s in p.STAGES[:-1]])
def test_other_columns_pass(spark, tmp_path, stage):
    spark.createDataFrame([(1, "nothing like it at all here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = corpus.frame(spark)
    out = stage(spark, df, str(tmp_path))
    assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
