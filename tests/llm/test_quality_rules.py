import re
from collections import defaultdict

from specmerge.llm import quality_rules as q

from . import corpus


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = defaultdict(list)
    for i in range(len(w) - 2):
        seen[tuple(w[i : i + 3])].append(i)
    cover = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def test_base_counts(spark):
    rows = corpus.rows() + [(2000, "a b c a b c a b\nx|<>#*$%&\n\n x\nx\nx", None, None, 1, None, 1, None), (2001, "a a a a", None, None, 1, None, 1, None)]
    out = q.judge(spark.createDataFrame(rows, corpus.SCHEMA).repartition(3))
    assert out.count() == len(rows)
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect())
    assert got == sorted((r[0] or -1, *plain(r[1])) for r in rows)
    for r in out.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_plan_has_no_python(spark):
    plan = q.judge(corpus.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_estimate_finds_the_bad():
    """Two rules that agree on a tenth of documents, one that votes at random."""
    patterns = [((-1, -1, 1), 45), ((-1, -1, -1), 45), ((-1, 0, 1), 10), ((1, 1, 1), 440), ((1, 1, -1), 440), ((0, 1, 1), 20)]
    share, odds = q.estimate(patterns)
    assert q.posterior(share, odds, (-1, -1, 1)) < 0.01 < 0.99 < q.posterior(share, odds, (1, 1, -1))
    assert abs(odds[2][1] - odds[2][-1]) < 0.5 and odds[0][-1] < -2
    assert q.estimate([]) == (0.0 + q.estimate([])[0], [])


def test_junk_goes_and_prose_stays(spark):
    prose = [t for t in corpus.texts(9, 80) if len(t.split()) > 60 and not t.startswith(("x x", "A" * 9))]
    junk = [" ".join(f"{w}$$$" if i % 2 else f"{w}###" for i, w in enumerate(t.split())) for t in prose[:8]]
    rows = [(i, t, "", "", 1, "", 1, "") for i, t in enumerate(prose + junk)]
    kept = {r.doc_id for r in q.keep_good(spark.createDataFrame(rows, corpus.SCHEMA)).collect()}
    assert not kept & set(range(len(prose), len(rows)))
    assert len(kept) >= 0.95 * len(prose)


def test_empty(spark):
    assert q.judge(corpus.empty(spark)).count() == 0
    assert q.keep_good(corpus.empty(spark)).columns == corpus.empty(spark).columns


def test_clashing_names_pass_through(spark):
    df = corpus.frame(spark).withColumnsRenamed({"lang": "__id", "source": "kept", "n_chars": "__ID_", "key": "quality"})
    want = sorted(r.text or "" for r in q.keep_good(corpus.frame(spark)).collect())
    out = q.keep_good(df)
    assert out.columns == df.columns and sorted(r.text or "" for r in out.collect()) == want
