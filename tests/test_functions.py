"""Scalar functions against literal values of the data contract."""

import datetime

import pytest
from pyspark.sql import functions as F

from specmerge.functions import capacity, dates, equality, keys, text


@pytest.fixture(scope="module")
def ev(spark):
    def run(f, *values):
        df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
        return df.select(f(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x

    return run


@pytest.mark.parametrize("value,want", [("￥3,999", "3999"), ("3999.00", "3999.00"), ("暂无报价", ""), ("2026年09月", ""), ("3999元起", "")])
def test_price(ev, value, want):
    assert ev(text.price, value) == want


@pytest.mark.parametrize("value,want", [("2026年07月12日", False), ("2026年07月13日", True), ("2026年07月", False), ("2026年08月", True), ("2027年", True), ("待定", False), ("2026年02月31日", False), (None, False)])
def test_future(ev, value, want):
    assert ev(lambda c: dates.is_future(c, datetime.date(2026, 7, 12)), value) is want


@pytest.mark.parametrize("value,want", [("vivo X300s()16GB/+512GB", [16, 512]), ("一加11（12GB/256GB/5G版）", [12, 256]), ("Xiaomi 17T", []), ("X 17TB", [17408]), ("苹果iPhone 16 Pro(256GB)", [256]), (None, [])])
def test_signature(ev, value, want):
    assert ev(capacity.signature, value) == want


def test_signature_from_fields(ev):
    assert ev(capacity.signature, "A", "8GB", "256GB") == [8, 256]
    assert ev(capacity.signature, "A", None, "1TB") == [1024]
    assert ev(capacity.signature, "A", "8GB 12GB", "256GB") == []
    assert sorted(ev(capacity.options, "A", "8GB 12GB", "256GB")) == [[8, 256], [12, 256]]


@pytest.mark.parametrize("value,want", [("一加13T(12GB+256GB)", "oneplus13t"), ("华为Pura 90 12GB+512GB", "huaweipura90"), ("华为 Pura90(12GB+512GB)", "huaweipura90"), ("HUAWEI Mate 60 Pro（12GB/1TB）", "huaweimate60pro"), ("华为Mate60 Pro(12+1T)", "huaweimate60pro"), ("小米15 Ultra(双卫星版)", "xiaomi15ultra"), ("-", ""), (None, ""), ("测试 Pro(5G版)", "测试pro(5g版)"), ("荣耀X 5G", "honorx")])
def test_model_key(ev, value, want):
    assert ev(keys.model_key, value) == want


def test_cleaning(ev):
    assert ev(text.clean_value, " a　b\n纠错 ") == "a b"
    assert ev(text.clean_value, " 纠错") == "-"
    assert ev(text.clean_value, None) is None
    assert ev(lambda c: text.clean_spec_value("内存", c), "16GB>游戏运行流畅纠错") == "16GB"
    assert ev(lambda c: text.clean_spec_value("存储", c), "256GB（约）,无扩展卡功能") == "256GB（约）|不支持容量扩展"
    assert ev(text.strip_residue, "打孔屏,多点触摸•多点触摸是什么•查看所有多点触摸iQOO,电容屏|19.8:9|144Hz") == "打孔屏,多点触摸|19.8:9|144Hz"
    assert ev(text.normalize_model, " 小米　15   Ultra ") == "小米 15 ultra"


def test_identity(ev):
    ids = lambda a, r, n: keys.identity_keys([a], keys.related_ids(r), [n])
    assert ev(ids, " 5 ", "7|8,5", "m") == ["id:5", "id:7", "id:8"]
    assert ev(ids, "", "", " 小米　15   Ultra ") == ["model:小米 15 ultra"]
    assert ev(ids, None, None, None) == []


@pytest.mark.parametrize(
    "field,a,b,want",
    [
        ("存储", "256GB|UFS 3.1|不支持容量扩展", "256GB", True),
        ("电池", "5000mAh", "4500mAh", False),
        ("电池", "7025mAh x", "7050mAh", True),
        ("电池", "不可拆卸式电池", "5000mAh", True),
        ("电池", "可拆卸", "5000mAh不可拆卸", False),
        ("屏幕", "6.82英寸|144Hz|AMOLED", "6.83英寸|AMOLED|144Hz", True),
        ("屏幕", "6.82英寸|AMOLED", "6.83英寸|AMOLED", False),
        ("屏幕", "--|10.7亿色", "6.8英寸", True),
        ("屏幕", "AMOLED", "6.8英寸 AMOLED", True),
        ("摄像头参数", "5000万像素,超广角", "5000+5000万像素", True),
        ("摄像头参数", "200万像素", "800万像素", False),
        ("上市时间", "2026年", "2026年03月", True),
        ("上市时间", "2026年03月", "2026年04月", False),
        ("上市时间", "2026年03月", "2026-03-05", True),
        ("处理器", "骁龙 8 Elite Gen5|2×Prime", "高通骁龙8 Elite Gen5|3nm", True),
        ("处理器", "Ａ17", "a17", True),
        ("处理器", None, "a17", False),
    ],
)
def test_same_value_both_ways(ev, field, a, b, want):
    assert ev(lambda x, y: equality.same_value(field, x, y), a, b) is want
    assert ev(lambda x, y: equality.same_value(field, x, y), b, a) is want


def test_dialects(ev):
    assert [ev(lambda c, d=d: dates.release_year(c, d), "20220") for d in ("publish", "view", "verify")] == [2022, None, 2022]
    assert ev(lambda c: dates.release_year(c, "view"), "12022") is None
    assert ev(lambda c: keys.tokens(c, r"[,，+、|/]"), "仅A+ B、A|-") == ["A", "B"]
    assert ev(keys.extract_soc, "Cortex-A720 骁龙 8 Gen3") == "A720"


def test_urls(ev):
    page = "https://a.com/x/y.html?q#z"
    assert [ev(text.resolve_url, page, u) for u in ("b.html", "/b", "//c.com/d", "https://e.com/")] == ["https://a.com/x/b.html", "https://a.com/b", "https://c.com/d", "https://e.com/"]
    assert ev(lambda b, u: text.param_url(b, u, "a.com"), page, "/1/param.shtml") == "https://a.com/1/param.shtml"
    assert ev(lambda b, u: text.param_url(b, u, "a.com"), page, "https://evil.com/1/param.shtml") is None
