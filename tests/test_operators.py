"""Operators on small literal tables."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from specmerge.functions import capacity, keys
from specmerge.operators import agree, enrich, guards, match, normalize, publish, report, view
from specmerge.operators.graph import components
from specmerge.operators.view import Condition, QuerySpec, Sort

ATTRS = "attrs map<string,string>"


def ordered(spark, records):
    """Maps in the order of their keys, which a Python dict loses on its way."""
    df = spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in records], "j string")
    return df.select(F.from_json("j", "map<string,string>").alias("attrs"))


def test_normalize_rows(spark):
    rows = [{"id": "7", "name": "小米15 Ultra", "brand": "xiaomi", "CPU型号": "骁龙8", "处理器": "a", "CPU": "骁龙8", "机身尺寸": "raw", "长度": "161.3mm", "宽度": "75.3", "厚度": "9.4", "内存": "16GB>游戏运行流畅纠错", "后置视频拍摄": "8K", "url": "u"}]
    a = normalize.normalize_rows(ordered(spark, rows), "CNMO").first().attrs
    assert (a["品牌"], a["型号"], a["手机ID"], a["数据来源"]) == ("小米", "小米15 Ultra", "7", "CNMO")
    assert a["处理器"] == "骁龙8|a|骁龙8"  # a value is compared with the whole cell
    assert a["机身尺寸"] == "161.3 x 75.3 x 9.4 mm" and a["机身宽度"] == "75.3 mm"
    assert a["内存"] == "16GB" and a["摄像头参数"] == "视频: 8K" and "url" not in a


def test_normalize_is_stable_under_partitions(spark):
    rows = [({"id": str(i), "name": f"vivo X{i}", "电池类型": "a", "电池": "b"},) for i in range(50)]
    df = spark.createDataFrame(rows, ATTRS)
    run = lambda n: sorted(json.dumps(r.attrs, sort_keys=True) for r in normalize.normalize_rows(df.repartition(n), "x").collect())
    assert run(1) == run(7)


def test_alias_fold_twice_is_once(spark):
    df = ordered(spark, [{"NFC功能": "支持", "NFC": "支持|是", "机身颜色": "-", "手机颜色": "黑"}])
    once = df.select(normalize.fold_aliases(F.col("attrs")).alias("attrs"))
    assert once.first().attrs == {"NFC": "支持|是", "手机颜色": "黑"}
    assert once.select(normalize.fold_aliases(F.col("attrs")).alias("a")).first().a == once.first().attrs


def test_rename_and_nested(spark):
    df = ordered(spark, [{"a": "xx", "b": "xxxx", "c": "-", "N - 5G": "支持", "N - 4G": "部分", "q": "1"}])
    assert df.select(normalize.rename_keep_longer(F.col("attrs"), {"a": "z", "b": "z", "c": "z"}).alias("m")).first().m["z"] == "xxxx"
    assert df.select(normalize.fold_nested_columns(F.col("attrs"), {"q": "r"}).alias("m")).first().m["N"] == "5G, 部分"
    assert df.select(normalize.spec_first(F.array(F.lit("OLED"), F.lit("6.85英寸"))).alias("s")).first().s == "6.85英寸|OLED"


STATUS = [
    ([{"电池": "5000mAh"}], "单源", "-"),
    ([{"电池": "5000mAh", "内存": "8GB"}, {"电池": "5000mAh", "内存": "-"}], "双源一致", "-"),
    ([{"电池": "5000mAh"}, {"电池": "4000mAh"}], "双源差异", "A缺失处理器；B缺失处理器"),
    ([{"内存": "8GB"}, {"电池": "1mAh"}], "多源未校验", None),
    ([{"内存": "8GB"}] * 3, "三源一致", None),
    ([{"内存": "8GB"}, {"内存": "8GB"}, {"内存": "12GB"}], "双源一致", None),
    ([{"内存": "8GB"}, {"内存": "6GB"}, {"内存": "12GB"}], "三源差异", None),
    ([{"内存": "8GB"}] * 4, "多源未校验", "来源数量超过三源判定范围"),
]


def test_agreement(spark):
    rows = [(i, [(n, a) for n, a in zip("ABCD", s)]) for i, (s, _, _) in enumerate(STATUS)]
    df = spark.createDataFrame(rows, "id int, sources array<struct<name:string,attrs:map<string,string>>>")
    got = {r.id: r for r in agree.classify(df, "id").collect()}
    for i, (_, status, diff) in enumerate(STATUS):
        assert got[i].status == status, i
        if diff:
            assert got[i].differences.startswith(diff), got[i].differences
    assert got[2].differences.endswith("电池: A=5000mAh; B=4000mAh")


def _match_rows(spark, names):
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    sig, exact = capacity.signature("name"), keys.model_key("name")
    return df.select("id", exact.alias("exact"), keys.fuzzy_key(exact).alias("fuzzy"), sig.alias("signature"), F.when(F.size(sig) > 0, F.array(sig)).otherwise(F.array().cast("array<array<int>>")).alias("options"), F.col("id").alias("ord"))


@pytest.mark.parametrize(
    "base,extra,want",
    [
        (["HUAWEI Mate 60 Pro（12GB/1TB）"], ["华为Mate60 Pro(12+1T)"], [(0, 0)]),
        (["测试 Pro"], ["测试 Pro(12+1T)"], [(0, 0)]),
        (["测试 Pro", "测试 Pro"], ["测试 Pro(12+1T)"], []),
        (["测试 Pro+"], ["测试 Pro"], []),
        (["测试 Pro(5G版)"], ["测试 Pro"], []),
        (["Xiaomi 17T"], ["小米17T(12GB+256GB)", "小米17T(12GB+512GB)"], [(0, 0), (1, 0)]),
        (["小米15 Ultra"], ["小米15 Ultra(双卫星版)"], [(0, 0)]),
    ],
)
def test_append_rules(spark, base, extra, want):
    got = match.append_rules(_match_rows(spark, base), _match_rows(spark, extra)).collect()
    assert sorted((r.extra_id, r.base_id) for r in got) == want


def test_greedy_uses_each_row_once(spark):
    left = _match_rows(spark, ["A 1(8GB+1TB)", "A 1(8GB+1TB)", "B", "C-1", "D", "D"])
    right = _match_rows(spark, ["a1(8GB+1TB)", "b", "c.1", "D", "x"])
    for n in (1, 5):
        got = match.greedy_match(left.repartition(n), right.repartition(n)).collect()
        assert sorted((r.left_id, r.right_id) for r in got) == [(0, 0), (2, 1), (3, 2), (4, 3)]


def test_unmatched_and_assemble(spark):
    extra = spark.createDataFrame([(0, "a", 0), (1, "a", 1), (2, None, 2), (3, None, 3), (4, "b", 4)], "id long, who string, ord long")
    done = spark.createDataFrame([(4,)], "extra_id long")
    assert sorted(r.id for r in match.unmatched(extra, done, F.col("who")).collect()) == [0, 2, 3]


def test_guard(spark):
    rows = [("1", "2026年08月", "￥1,000"), ("2", "2021年", "x"), ("3", None, "9"), ("4", "2026年07月", "8元起"), ("5", "2022年", "7")]
    df = spark.createDataFrame(rows, "id string, released string, price string")
    skip = spark.createDataFrame([("5",), (" ",)], "id string")
    got = guards.guard_rows(df, as_of=datetime.date(2026, 7, 12), dates=["released"], ids="id", skip=skip, prices=["price"]).collect()
    assert sorted((r.id, r.price) for r in got) == [("3", "9"), ("4", "")]


PUB = "id string, keys array<string>, config string, n_sources int, ord int"


def test_preserve_keeps_what_is_lost(spark):
    base = spark.createDataFrame([("a", ["id:1"], "c1", 1, 0), ("b", ["id:2", "id:3"], "c2", 2, 1), ("c", ["id:3"], "c3", 1, 2), ("d", ["id:4"], "c4", 1, 3), ("e", ["id:5", "id:6"], "c5", 1, 4), ("f", ["id:6", "id:7"], "c6", 3, 5)], PUB)
    cand = spark.createDataFrame([("x", ["id:1"], "z", 1, 0), ("y", ["id:9"], "c4", 1, 1)], PUB)
    kept = publish.preserve(base, cand)
    assert sorted(r.id for r in kept.collect()) == ["b", "e", "f"]  # c is covered by b; d by its configuration
    assert publish.attach_by_config(base, cand).collect()[0].attached == ["4"]
    lost = publish.missing_keys(base.select(F.explode("keys").alias("key")), cand.select(F.explode("keys").alias("key")))
    assert lost.count() == 6
    with pytest.raises(ValueError):
        publish.verify_superset(base.select(F.explode("keys").alias("key")), cand.select(F.explode("keys").alias("key")))
    with pytest.raises(ValueError):
        publish.require_rows(base)


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (7, 7), (None, 3)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 4: 1, 11: 10, 12: 10, **{101 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_reports(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "x")], "k string, s string")
    sets = report.source_sets(rows, ["k"], "s")
    assert report.multi_single(sets, F.col("n_sources")).first().multi_rate == 50.0
    assert {r.source: r.single_rate for r in report.per_source_rates(sets).collect()} == {"x": 50.0, "y": 0.0}
    one = json.loads(report.evidence_report(rows, F.array("s"), "k").first().report)
    assert one["total"] == 4 and one["source_counts"] == {"x": 3, "y": 1} and one["status_counts"] == {"a": 2, "b": 2}
    text = spark.createDataFrame([("摄像头参数: A=视频: 4K；前置视频: 2K; B=-；内存: A=8; B=9",), ("-",), (None,)], "t string")
    assert {r.field: r.n_rows for r in report.diff_field_counts(text, "t").collect()} == {"摄像头参数": 1, "内存": 1}


def test_view_order_and_spec(spark):
    df = spark.createDataFrame([(1, 2, "¥900"), (2, 3, "暂无"), (3, 1, "800"), (4, 3, "1000"), (5, 1, None)], "ord int, n int, price string")
    ids = lambda *sorts: [r.ord for r in view.run(df, QuerySpec(sorts=sorts), "ord", "n").collect()]
    assert ids() == [2, 4, 1, 3, 5]
    assert ids(Sort("n")) == [3, 5, 1, 2, 4]
    assert [r.ord for r in df.orderBy(*view.sort_keys(df, [Sort("price")], "ord")).collect()][:3] == [3, 1, 4]
    spec = QuerySpec(search="x", conditions=(Condition("c", fields=("n",), least=1),), sorts=(Sort("n", True, ("a",)),), visible=("ord", "gone"))
    assert QuerySpec.from_json(spec.to_json()) == spec
    assert QuerySpec.from_json(spec.to_json(), ["ord", "n"]).visible == ("ord",)
    assert [r.rank for r in view.ranked(df, [view.Down("n"), F.col("ord")]).orderBy("ord").collect()] == [3, 1, 4, 2, 5]
    assert [r.ord for r in view.page(df, [F.asc("ord")], 99, 2).collect()] == [5]
    assert view.default_spec({"conditions": [{"id": "a", "field": "n", "defaultEnabled": True, "defaultMin": 2}], "defaultVisibleColumns": ["n", "zz"]}, ["ord", "n"]) == QuerySpec(conditions=(Condition("a", fields=("n",), least=2),), visible=("n",))
    assert view.visible_columns(["b", "q"], ["a", "b", "c"], ["c"]) == ["b", "a"]


def test_cells_without_numbers_fail_all_but_contains(spark):
    df = spark.createDataFrame([("abc",), ("12GB",), (None,)], "c string")
    run = lambda op, v: [r.x for r in df.select(view.column_test(F.col("c"), op, v).alias("x")).collect()]
    assert run("contains", "B") == [True, True, False]
    assert run("equals", "12") == [False, True, False]
    assert run("gte", "1") == [False, True, False]


def test_enrich(spark):
    rows = spark.createDataFrame([(i, "b", f"m{i % 10}", "未知" if i % 2 else "是") for i in range(30)], "ord int, brand string, model string, status string")
    cache = spark.createDataFrame([("m1", "否")], "model string, status string")
    out = enrich.with_cache(rows, cache, "model", "status")
    assert {r.status for r in out.where("model = 'm1'").collect()} == {"否"} and out.where("pending").count() == 12
    asked = enrich.requests(rows, ["brand"], "model", "ord")
    assert asked.first().samples == [f"m{i}" for i in range(8)] and asked.first().n_rows == 30
    assert enrich.exact_cover(rows, rows, "model").first().valid is False
    assert enrich.exact_cover(cache, cache, "model").first().valid is True


def test_dataset_and_view_columns(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "-"), (3, "c", "x")], "id int, name string, v string")
    fields = {"v": F.col("v") != "-"}
    assert not guards.is_valid_dataset(df, fields, F.col("name") != "")
    assert guards.is_valid_dataset(df, fields, F.col("name") != "", least_percent=66)
    assert not guards.is_valid_dataset(df, fields, F.col("name") != "b", least_percent=60)
    assert not guards.is_valid_dataset(df, fields, F.col("name") != "", least_percent=60, between=(20, 30))
    rows = ordered(spark, [{"brand": "vivo", "型号": "X1", "N - 5G": "支持", "蓝牙": "√"}, {"品牌": "小米", "型号": "Y", "机身": "黑", "蓝牙": "有"}])
    rows = rows.withColumn("ord", F.when(F.col("attrs")["型号"] == "X1", 0).otherwise(1))
    out, shown = view.initialise(rows, {"机身": "颜色"}, ["型号", "品牌"], "ord", hidden=["brand"], drop_uniform=["蓝牙", "颜色z"])
    assert shown == ["型号", "品牌", "N", "颜色"]
    assert sorted((r["品牌"], r["N"], r["颜色"]) for r in out.collect() if r["N"]) == [("vivo", "5G", None)]


def test_scratch_tables_are_cleaned(spark):
    from pyspark.errors import AnalysisException

    from specmerge.sources import shared

    kept = shared.saved(spark.range(3), "three")
    assert kept.count() == 3 and kept.inputFiles()[0].startswith("file:")
    assert shared.clean(spark) >= 1 and shared.clean(spark) == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(kept.inputFiles()[0].rsplit("/", 1)[0]).count()


def test_preserve_equals_the_loop(spark):
    """Random rows that share keys: the same rows stay as with one pass in order."""
    rng = random.Random(5)
    rows = [(i, sorted({f"id:{rng.randrange(40)}" for _ in range(rng.randrange(1, 5))}), f"c{i}", rng.randrange(3), rng.randrange(50)) for i in range(120)]
    known = {"id:3", "id:7"}
    seen, want = set(known), set()
    for i, ks, _, _, _ in sorted(rows, key=lambda r: (-r[3], -len(r[1]), r[4], r[0])):
        if not set(ks) <= seen:
            want.add(i)
            seen |= set(ks)
    kind = "id long, keys array<string>, config string, n_sources int, ord int"
    cand = spark.createDataFrame([(1000, sorted(known), "x", 1, 0)], kind)
    assert {r.id for r in publish.preserve(spark.createDataFrame(rows, kind), cand).collect()} == want


def test_published_rows_are_clean(spark):
    kind = "id string, attrs map<string,string>"
    cand = spark.createDataFrame([("a", {"内存": "8GB 游戏运行流畅", "NFC功能": "支持"})], kind)
    kept = spark.createDataFrame([("b", {"存储": "256GB、约1万张照片", "交叉验证差异": "-", "x": " y "})], kind)
    got = {r.id: r.attrs for r in publish.published(cand, kept).collect()}
    assert got["a"] == {"内存": "8GB", "NFC": "支持"}
    assert got["b"] == {"存储": "256GB", "交叉验证差异": "-", "x": " y "}
    same = publish.published(cand, kept.limit(0), only_if_kept=True).collect()
    assert [r.attrs for r in same] == [{"内存": "8GB 游戏运行流畅", "NFC功能": "支持"}]
    assert publish.published(cand, kept.limit(0)).collect()[0].attrs["内存"] == "8GB"


def test_similar_sets_equal_all_pairs(spark):
    rng = random.Random(1)
    sets = [sorted({f"w{int(rng.random() ** 2 * 30)}" for _ in range(rng.randrange(0, 12))}) for _ in range(80)]
    a = spark.createDataFrame(list(enumerate(sets[:50])), "a long, w array<string>")
    b = spark.createDataFrame(list(enumerate(sets[50:])), "b long, w array<string>")
    for least in (0.2, 0.5, 1.0):
        got = {(r.a, r.b): r.common for r in match.similar_sets(a, b, "a", "b", least).collect()}
        want = {(i, j): len(set(x) & set(y)) for i, x in enumerate(sets[:50]) for j, y in enumerate(sets[50:]) if set(x) & set(y) and len(set(x) & set(y)) >= least * len(set(x) | set(y)) - 1e-12}
        assert got == want


def test_hot_keys_keep_one_row(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"), F.lit("x").alias("v"))
    assert sorted((r.k, r.o, r.v) for r in match.keep(rows, ["k"], ["o"], last=True).collect()) == [(0, 998, "x"), (1, 999, "x")]
    fresh = spark.createDataFrame([(0, 5, "new"), (7, 6, "n")], "k long, o long, v string")
    assert sorted((r.k, r.o, r.v) for r in match.upsert(rows, fresh, ["k"], "o").collect()) == [(0, 0, "new"), (1, 1, "x"), (7, 6, "n")]


def test_view_state_begins_anew():
    spec = view.QuerySpec(search="a", visible=("x",))
    state = view.ViewState().synced(spec).more().toggled("s")
    assert (state.limit, state.expanded) == (48, {"s"})
    assert state.synced(view.QuerySpec(search="a", visible=("y",))) is state
    assert state.synced(view.QuerySpec(search="b")) == view.ViewState(view.signature(view.QuerySpec(search="b")))
