"""Readers and writers on small files."""

import csv
import datetime
import io
import json
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from specmerge.sources import html, records, shared, sinks


def put(path, data):
    path.write_text(data if isinstance(data, str) else json.dumps(data, ensure_ascii=False), encoding="utf-8")


def test_records_keep_key_order_and_envelopes(spark, tmp_path):
    put(tmp_path / "a.json", [{"b": "1", "a": "2"}, {"z": "3"}])
    put(tmp_path / "b.json", {"items": [{"q": "4"}]})
    put(tmp_path / "c.json", {"only": "5"})
    put(tmp_path / "d.json", "not json")
    rows = records.read_records(spark, str(tmp_path))
    assert rows.count() == 4
    first = rows.where("row_ord = 0 and file like '%a.json'").select(F.map_keys("attrs").alias("k")).first().k
    assert first == ["b", "a"]
    assert records.read_records(spark, str(tmp_path / "none")).count() == 0
    assert records.read_strict(spark, str(tmp_path / "a.json")).count() == 2
    with pytest.raises(PySparkException):
        records.read_strict(spark, str(tmp_path / "c.json")).count()


def test_strict_json():
    assert records.strict_json('{"a": 1.5}') == {"a": 1.5}
    for bad in ('{"a": 1, "a": 2}', "[NaN]", "[Infinity]", "[1e309]", "{"):
        with pytest.raises(ValueError):
            records.strict_json(bad)


def test_dedupe_first_and_latest(spark):
    rows = [("x/1_p_20240101.json", 0, {"id": "7", "v": "old"}), ("x/1_p_20240301.json", 0, {"id": " 7", "v": "new"}), ("x/1_p_20240101.json", 1, {"v": "none"}), ("x/1_p_20240301.json", 1, {"v": "none"})]
    df = spark.createDataFrame(rows, records.RECORD)
    assert sorted(r.attrs["v"] for r in records.dedupe(df).collect()) == ["none", "none", "old"]
    last = records.dedupe(df, latest=True)
    assert sorted(r.attrs["v"] for r in last.collect()) == ["new", "none", "none"]
    assert last.where("attrs['v'] = 'new'").first().place.f.date == "20240101"


def test_files_and_skip_list(spark, tmp_path):
    assert records.data_files(["a/progress.json", "a/x.json"]) == ["a/x.json"]
    assert records.data_files(["a/progress.json"]) == ["a/progress.json"]
    assert records.newest([("a_20240102.json", 1.0), ("a_20240101.json", 9.0)]) == "a_20240102.json"
    assert records.newest([("a.json", 1.0), ("b.json", 9.0)]) == "b.json" and records.newest([]) is None
    put(tmp_path / "s.json", {"skip_phone_ids": [" 1 ", "", "2"]})
    assert sorted(r.id for r in records.skip_ids(spark, str(tmp_path / "s.json")).collect()) == ["1", "2"]
    assert records.skip_ids(spark, str(tmp_path / "none.json")).count() == 0


def _zip(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def test_archive_is_taken_whole_or_not():
    ok = lambda name, r: r.get("id") == name
    assert records.archive_records(_zip([("d/1.json", '{"id": "1"}')]), ok) == [{"id": "1"}]
    for bad in ([("../1.json", '{"id": "1"}')], [("1.json", '{"id": "2"}')], [("1.json", '{"id": "1"}'), ("d/1.json", '{"id": "1"}')], [("1.txt", "x")]):
        with pytest.raises(ValueError):
            records.archive_records(_zip(bad), ok)
    now = datetime.datetime(2026, 1, 2)
    arts = [{"name": "p-1", "branch": "main", "run": 1, "created_at": now, "bad": True}, {"name": "p-0", "branch": "main", "run": 0, "created_at": datetime.datetime(2026, 1, 1)}, {"name": "p-9", "branch": "main", "run": 9, "created_at": now}]

    def load(a):
        if a.get("bad"):
            raise ValueError("broken")
        return [a["name"]]

    assert records.first_valid(arts, load, prefix="p-", branch="main", run="9", now=now) == ["p-0"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, json.dumps({"b": 'x,"y"', "a": ""})), (2, json.dumps({"c": "中\n文", "a": "1"}))], "ord int, j string")
    df = df.select("ord", F.from_json("j", "map<string,string>").alias("attrs"))
    assert sinks.field_order(df, "attrs", ["id"], "ord") == ["id", "b", "a", "c"]
    assert sinks.field_order(df, "attrs", ["id"], rest="sorted") == ["id", "a", "b", "c"]
    flat = sinks.flat(df.orderBy("ord"), "attrs", ["b", "a", "c"], "-")
    assert sinks.export_csv(flat, str(tmp_path / "o" / "x.csv")) == 2
    raw = (tmp_path / "o" / "x.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf")
    assert list(csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline=""))) == [["b", "a", "c"], ['x,"y"', "-", "-"], ["-", "1", "中\n文"]]
    assert records.csv_rows(spark, str(tmp_path / "o" / "x.csv")) == 2
    assert sinks.export_json(flat, str(tmp_path / "x.json")) == 2
    assert json.loads((tmp_path / "x.json").read_text())[1]["c"] == "中\n文"
    assert sinks.export_json(flat.limit(0), str(tmp_path / "e.json")) == 0 and json.loads((tmp_path / "e.json").read_text()) == []
    assert sinks.write_if_any(flat.limit(0), str(tmp_path / "n.csv")) is False and not (tmp_path / "n.csv").exists()
    sinks.write_csv(flat, str(tmp_path / "folder"))
    assert spark.read.csv(str(tmp_path / "folder"), header=True, multiLine=True, escape='"').count() == 2
    assert sinks.put_record(str(tmp_path / "r"), {"id": 5}).endswith("5.json")
    with pytest.raises(ValueError):
        sinks.put_record(str(tmp_path), {"id": "../x"})


def test_swap_folder(spark, tmp_path):
    (tmp_path / "new").mkdir(), (tmp_path / "old").mkdir()
    (tmp_path / "new" / "f").write_text("1")
    sinks.swap_folder(str(tmp_path / "new"), str(tmp_path / "old"))
    assert (tmp_path / "old" / "f").read_text() == "1" and sorted(p.name for p in tmp_path.iterdir()) == ["old"]
    with pytest.raises(OSError):
        sinks.swap_folder(str(tmp_path / "none"), str(tmp_path / "old"))
    assert (tmp_path / "old" / "f").exists()


PAGE = '<ul id="L"><li><a href="/cell/index11.shtml">Alpha 1</a></li><li><a href="/cell/index12.shtml" title="Beta 2"></a></li><a href="/cell/index11.shtml">Alpha</a><a href="/x">no</a></ul>'


def test_html(spark):
    assert html.params_of('<table><tr><th>屏幕：</th><td>6.8 <b>英寸</b></td></tr><tr><td>x</td></tr></table><li>电池：5000mAh：x</li><li paramname="CPU" paramvalue="A1"></li>') == {"屏幕": "6.8 英寸", "电池": "5000mAh：x", "CPU": "A1"}
    assert html.params_of(None) == {}
    df = spark.createDataFrame([(1, "<p></p>" + PAGE), (2, PAGE)], "page int, html string")
    out = html.list_pages(df, "html", r"index(\d+)\.shtml", container='<ul id="L"').orderBy("page").collect()
    assert [(x.id, x.name) for x in out[0]["items"]] == [("11", "Alpha 1"), ("12", "Beta 2")]
    assert len(html.list_pages(df, "html", r"index(\d+)\.shtml", distinct=False).first()["items"]) == 3
    with pytest.raises(PySparkException):
        html.list_pages(df, "html", r"index(\d+)", container="<missing").collect()
    raw = spark.createDataFrame([("处理器".encode("gbk"),), (None,)], "content binary")
    assert [r.html for r in html.decode(raw).collect()] == ["处理器", None]
    got = df.select(html.slugs(F.lit('<a href="/vivo/">.<a href="/c12/">.<a href="/x/">.<a href="/oppo/">.<a href="/vivo/">'), '<a href="/([a-z0-9]+)/"').alias("s")).first().s
    assert got == ["vivo", "oppo"]
    ranks = html.first_ranks(spark.createDataFrame([(1, ["b", "a", "b"])], "k int, l array<string>"), "k", "l")
    assert {r.item: r.rank for r in ranks.collect()} == {"b": 1, "a": 2}
    rows = spark.createDataFrame([("x", 0), ("a", 1), ("b", 2), ("y", 3)], "item string, ord int")
    assert [r.item for r in html.rank_join(rows, ranks.select("item", "rank"), "item", "ord").collect()] == ["b", "a", "x", "y"]


def test_latest_or_fallback(spark, tmp_path):
    put(tmp_path / "rows.json", [{"a": "1"}])
    put(tmp_path / "manifest.json", {"latest": "rows.json"})
    assert records.read_latest(spark, str(tmp_path / "manifest.json")).first().attrs == {"a": "1"}
    assert records.read_latest(spark, str(tmp_path / "none.json"), fallback=[{"b": "2"}]).first().attrs == {"b": "2"}
    assert records.read_latest(spark, str(tmp_path / "none.json")).count() == 0


def test_no_local_folder_on_a_cluster():
    class Session:
        conf = sparkContext = None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    session = Session()
    session.conf, session.sparkContext = Conf(), Context()
    with pytest.raises(ValueError):
        shared.shared_dir(session)
