"""Progress records, retries, replays and resumable ingest."""

import json
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from specmerge.streaming import progress


STATE = "who string, side int, seen array<string>, why map<string,string>, total long, brand int, page int, name string, plan array<string>, done boolean, extra string"


def merged(spark, *sides, plan="plan"):
    """One state of sides, each a dict, the nearest first."""
    fields = [f.split()[0] for f in STATE.split(", ")][2:]
    rows = [("x", i, *(s.get(f) for f in fields)) for i, s in enumerate(sides)]
    out = progress.merge_sides(spark.createDataFrame(rows, STATE), ["who"], "side", lists=["seen"], maps=["why"], totals=["total"], cursor=["brand", "page"], moves=["name"], plan=plan, done="done")
    return out.collect()[0]


def test_earliest_whole_cursor_wins(spark):
    plan = ["a", "b"]
    mine = {"brand": 1, "page": 2, "name": "b", "plan": plan, "done": True, "seen": ["1", "2"], "why": {"9": "year:2019"}, "total": 2}
    ours = {"brand": 0, "page": 7, "name": "a", "plan": plan, "done": True, "seen": ["2", "3"], "total": 5, "extra": "e"}
    out = merged(spark, mine, ours)
    assert (out.brand, out.page, out.name, out.plan) == (0, 7, "a", plan)
    assert out.seen == ["1", "2", "3"] and out.total == 5 and out.done is True and out.extra == "e"
    out = merged(spark, mine, {**ours, "plan": ["b", "a"], "done": False}, {"why": {"9": "retry", "8": "nodate"}})
    assert (out.brand, out.page, out.name, out.plan, out.done) == (None, None, None, None, False)
    assert out.why == {"9": "year:2019", "8": "nodate"}
    out = merged(spark, {**mine, "page": None}, ours, {"done": True})
    assert (out.brand, out.page, out.done) == (0, 7, True)  # a cursor that isn't whole doesn't count
    assert merged(spark, {**mine, "plan": []}, {**ours, "plan": []}).page is None


def test_pages_without_a_plan(spark):
    out = merged(spark, {"page": 3, "seen": ["1"]}, {"page": 5, "seen": ["2", "1"]}, {})
    assert out.page == 5 and out.brand is None and out.seen == ["1", "2"] and out.done is False
    out = merged(spark, {"brand": 1, "page": 3}, {"brand": 0, "page": 5}, plan=None)
    assert (out.brand, out.page) == (1, 5)
    assert merged(spark, {}).seen == []


def test_cursor_and_scan(spark):
    tries = spark.createDataFrame([("x", 0, 2, False), ("x", 0, 3, True), ("x", 1, 1, True), ("x", 1, 2, False), ("y", 4, 4, False)], "who string, brand int, page int, bad boolean")
    got = {r.who: (r.brand, r.page, r.again, r.n_failed) for r in progress.cursors(tries, ["who"], ["brand", "page"], F.col("bad")).collect()}
    assert got == {"x": (0, 3, True, 2), "y": (4, 4, False, 0)}
    pages = spark.createDataFrame([("a", i, 10) for i in range(1, 150)] + [("b", 1, 4), ("b", 2, 0), ("b", 3, 9)], "brand string, page int, n int")
    read = lambda **k: {b: sorted(r.page for r in progress.scanned(pages, ["brand"], "page", "n", **k).collect() if r.brand == b) for b in "ab"}
    assert read() == {"a": list(range(1, 101)), "b": [1]}
    assert read(wanted=10) == {"a": [1, 2, 3], "b": [1]}


def test_retry_settled_replay(spark):
    fails = spark.createDataFrame([("a",)] * 3 + [("b",)], "id string")
    assert {r.id: r.state for r in progress.retry_states(fails, ["id"]).collect()} == {"a": "retry-exhausted", "b": "retry"}
    cached = spark.createDataFrame([("1",)], "id string")
    skipped = spark.createDataFrame([("2", "year:2019"), ("3", "year:2024"), ("4", "nodate"), ("5", "no_release_year")], "id string, reason string")
    assert sorted(r.id for r in progress.settled(cached, skipped, 2021).collect()) == ["1", "2", "4"]
    pages = spark.createDataFrame([("x", 1, ["a", "b"]), ("x", 2, ["b", "a"]), ("y", 3, ["a", "b"]), ("x", 4, []), ("x", 5, [])], "brand string, page int, ids array<string>")
    assert [(r.brand, r.page, r.known_page) for r in progress.replayed_pages(pages, "brand", "page", "ids").collect()] == [("x", 2, 1)]


def test_state_by_batches_in_any_order(spark):
    rows = [(1, "a", 10, 0), (1, "a", 11, 5), (2, "a", 12, 1), (1, "a", 13, 2)]
    df = spark.createDataFrame(rows, "user_id int, event_type string, value int, place int")
    whole = progress.state_of(df, 0)
    a, b = progress.state_of(df.where("place < 2"), 0), progress.state_of(df.where("place >= 2"), 0)
    pick = lambda s: sorted((r.user_id, r.value, r.place) for r in s.collect())
    assert pick(progress.merge_state(a, b)) == pick(progress.merge_state(b, a)) == pick(whole) == [(1, 11, 0), (2, 12, 1)]


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType())])
    (tmp_path / "in").mkdir()
    put = lambda n, rows: (tmp_path / "in" / n).write_text("\n".join(json.dumps(r) for r in rows))
    sink = progress.upsert_sink(str(tmp_path / "out"), ["id"], ["v"])
    put("1.json", [{"id": "a", "v": 1}, {"id": "b", "v": 1}])
    progress.ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "check"), sink)
    put("2.json", [{"id": "a", "v": 2}])
    progress.ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "check"), sink)
    progress.ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "check"), sink)
    got = spark.read.parquet(str(tmp_path / "out" / "v1"))
    assert sorted((r.id, r.v) for r in got.collect()) == [("a", 2), ("b", 1)]
    assert got.select(F.max("__batch")).first()[0] == 1


def test_saved_not_finished(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType())])
    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps(r) for r in [{"id": str(i), "v": i}, {"id": None, "v": i}]))
    sink = progress.apart(progress.upsert_sink(str(tmp_path / "out"), ["id"], ["v"]), F.col("id").isNotNull(), str(tmp_path / "dead"))

    def slow(batch, number):
        sink(batch, number)
        time.sleep(1)

    run = lambda **k: progress.ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "check"), slow, files=1, **k)
    assert run(batches=2) is False
    assert run(seconds=0.0) is False
    assert run() is True and run() is True
    last = max(tmp_path.glob("out/v*"), key=lambda p: int(p.name[1:]))
    assert sorted(r.id for r in spark.read.parquet(str(last)).collect()) == list("01234")
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 5
