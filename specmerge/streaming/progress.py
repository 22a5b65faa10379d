"""Incremental ingest: resumable steps, running tables, retries and three-way merges of progress."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FINAL = ("nodate", "retry-exhausted")


def state_of(rows: DataFrame, side: int, keys: Sequence[str] = ("user_id", "event_type"), place: str = "place") -> DataFrame:
    """A row per key: its last row's values and its first place, by (side, place)."""
    values = [c for c in rows.columns if c not in (*keys, place)]
    at = F.struct(F.lit(side).alias("side"), F.col(place).alias("at"))
    return rows.groupBy(*keys).agg(*(F.max_by(F.struct(F.col(v)), at).alias(v) for v in values), F.max(at).alias("last"), F.min(at).alias("first")).select(*keys, *(F.col(f"{v}.{v}").alias(v) for v in values), "first", "last", F.col("first.at").alias(place))


def merge_state(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("user_id", "event_type"), place: str = "place") -> DataFrame:
    """Two running tables as one; an aggregation, so that batches can come in any order."""
    rows = a.unionByName(b)
    values = [c for c in rows.columns if c not in (*keys, place, "first", "last")]
    out = rows.groupBy(*keys).agg(*(F.max_by(F.struct(F.col(v)), "last").alias(v) for v in values), F.min("first").alias("first"), F.max("last").alias("last"))
    return out.select(*keys, *(F.col(f"{v}.{v}").alias(v) for v in values), "first", "last", F.col("first.at").alias(place))


def retry_states(failures: DataFrame, key: Sequence[str], most: int = 3) -> DataFrame:
    """key, n_attempts, state: failed keys are tried again until the attempt ``most``."""
    out = failures.groupBy(*key).agg(F.count(F.lit(1)).alias("n_attempts"))
    return out.withColumn("state", F.when(F.col("n_attempts") >= most, "retry-exhausted").otherwise("retry"))


def settled(cached: DataFrame, skipped: DataFrame, min_year: int) -> DataFrame:
    """id of what needs no other try: cached, or skipped for a final reason; skipped: id, reason."""
    year = F.regexp_extract("reason", "^year:([0-9]{4})$", 1).try_cast("int")
    done = skipped.where(F.col("reason").isin(*FINAL) | (year < min_year)).select("id")
    return cached.select("id").union(done).distinct()


def merge_sides(
    states: DataFrame,
    scope: Sequence[str],
    side: str,
    *,
    lists: Sequence[str] = (),
    maps: Sequence[str] = (),
    totals: Sequence[str] = (),
    cursor: Sequence[str] = (),
    moves: Sequence[str] = (),
    plan: str | None = None,
    done: str | None = None,
) -> DataFrame:
    """One state per scope from those of its sides, at most one row each; the least side is the nearest.

    lists are united, of maps the nearest side's entry wins, of totals the largest. The columns of cursor say
    how far a side came, in order; those of moves go with them. If a side has a plan, the earliest whole cursor
    wins, and if whole cursors follow different plans, all columns of cursor, moves and plan are null: start
    anew. Without a plan, each column of cursor is the largest. done holds only if it does on all sides. Other columns
    are the nearest side's that isn't null.
    """
    special = {side, *scope, *lists, *maps, *totals, *cursor, *moves, *filter(None, (plan, done))}
    others = [c for c in states.columns if c not in special]
    nearer = lambda a, b: F.when(a[side] < b[side], -1).when(a[side] > b[side], 1).otherwise(0)  # noqa: E731  maps have no order
    rows = states.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct(side, F.struct(*(c for c in states.columns if c not in (*scope, side))).alias("s"))), nearer).alias("sides"))
    each = lambda f: F.transform("sides", lambda x: f(x["s"]))
    out = [F.get(F.array_compact(each(lambda s, c=c: s[c])), F.lit(0)).alias(c) for c in others]
    out += [F.array_distinct(F.flatten(F.array_compact(each(lambda s, c=c: s[c])))).alias(c) for c in lists]
    for c in maps:
        kind = states.schema[c].dataType.simpleString()
        nearest = lambda done, more: F.map_zip_with(done, F.coalesce(more, F.create_map().cast(kind)), lambda k, a, b: F.coalesce(a, b))  # noqa: B023, E731
        out.append(F.aggregate(each(lambda s, c=c: s[c]), F.create_map().cast(kind), nearest).alias(c))
    out += [F.array_max(each(lambda s, c=c: s[c])).alias(c) for c in totals]
    if cursor:
        whole = F.filter("sides", lambda x: functools.reduce(lambda a, b: a & b, (x["s"][c].isNotNull() for c in cursor)))
        first = F.array_min(F.transform(whole, lambda x: F.struct(*(x["s"][c].alias(c) for c in cursor), x[side].alias(side))))
        at = F.get(F.filter("sides", lambda x: x[side] == first[side]), F.lit(0))["s"]
        planned = F.exists("sides", lambda x: x["s"][plan].isNotNull()) if plan else F.lit(False)
        plans = F.transform(whole, lambda x: x["s"][plan] if plan else F.lit(None))
        follow = (F.size(whole) == 1) | (F.forall(plans, lambda p: p.isNotNull() & (F.size(p) > 0)) & (F.size(F.array_distinct(plans)) == 1)) if plan else F.lit(True)
        out += [F.when(planned, F.when(follow, at[c])).otherwise(F.array_max(each(lambda s, c=c: s[c]))).alias(c) for c in cursor]
        told = lambda c: F.get(F.array_compact(each(lambda s: s[c])), F.lit(0))
        out += [F.when(planned, F.when(follow, at[c])).otherwise(told(c)).alias(c) for c in (*moves, *filter(None, (plan,)))]
    if done:
        out.append(F.forall("sides", lambda x: F.coalesce(x["s"][done], F.lit(False))).alias(done))
    return rows.select(*scope, *out)


def cursors(attempts: DataFrame, scope: Sequence[str], place: Sequence[str], failed: Column) -> DataFrame:
    """Where each scope goes on: its earliest failed place, or else after its last; n_failed. Failures hold nothing up."""
    at = F.struct(*place)
    out = attempts.groupBy(*scope).agg(F.min(F.when(failed, at)).alias("retry"), F.max(at).alias("last"), F.count_if(failed).alias("n_failed"))
    return out.select(*scope, *(F.coalesce("retry", "last")[c].alias(c) for c in place), F.col("retry").isNotNull().alias("again"), "n_failed")


def scanned(pages: DataFrame, group: Sequence[str], page: str, n: str, *, wanted: int = 0, spare: int = 3, most_pages: int = 100) -> DataFrame:
    """The pages that a scan reads: of each group up to its first page without items, most_pages at most, and none after ``spare * wanted`` items (0: no limit)."""
    rows = pages.where((F.col(page) >= 1) & (F.col(page) <= most_pages))
    before = Window.partitionBy(*group).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)  # most_pages rows
    rows = rows.withColumn("__n", F.coalesce(F.sum(n).over(before), F.lit(0))).withColumn("__least", F.coalesce(F.min(n).over(before), F.lit(1)))
    rows = rows.where((F.col("__least") > 0) & (F.col(n) > 0))
    return (rows.where(F.col("__n") < spare * wanted) if wanted else rows).drop("__n", "__least")


def replayed_pages(pages: DataFrame, group: str, page: str, ids: str) -> DataFrame:
    """group, page, known_page: pages whose set of ids is that of an earlier page of the group."""
    marked = pages.select(group, page, F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("mark")).where(F.size(ids) > 0)
    first = marked.groupBy(group, "mark").agg(F.min(page).alias("known_page"))
    return marked.join(first, [group, "mark"]).where(F.col(page) != F.col("known_page")).select(group, page, "known_page")


def ingest(
    spark: SparkSession,
    source: str,
    schema: StructType,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    *,
    fmt: str = "json",
    files: int = 100,
    seconds: float | None = None,
    batches: int | None = None,
) -> bool:
    """Read what is new in a folder, files at a time, and hand each batch to sink once; a later call goes on.

    True: all is read. False: saved, not finished, as the time or the number of batches is used up. A batch that
    the end breaks off is handed over again, with the same number, by the next call.
    """
    handed, end = [], None if seconds is None else time.monotonic() + seconds

    def put(batch: DataFrame, number: int) -> None:
        sink(batch, number)
        handed.append(number)

    rows = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files).load(source)
    query = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    while not query.awaitTermination(0.2):
        if (batches is not None and len(handed) >= batches) or (end is not None and time.monotonic() >= end):
            query.stop()
            return False
    if error := query.exception():
        raise error
    return True


def apart(sink: Callable[[DataFrame, int], None], valid: Column, path: str) -> Callable[[DataFrame, int], None]:
    """A sink that gets the valid rows alone; the others, the dead letters, go to a folder of the batch below path."""

    def put(batch: DataFrame, number: int) -> None:
        ok = F.coalesce(valid, F.lit(False))
        batch.where(~ok).write.mode("overwrite").parquet(f"{path}/batch={number}")
        sink(batch.where(ok), number)

    return put


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the last row of each key in versions below path; a batch that is replayed rewrites its own version."""

    def put(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("__batch", F.lit(number))
        if number and (old := _version(batch.sparkSession, path, number - 1)) is not None:
            rows = old.unionByName(rows, allowMissingColumns=True)
        last = F.max_by(F.struct(*rows.columns), F.struct("__batch", *order))
        rows.groupBy(*keys).agg(last.alias("r")).select("r.*").write.mode("overwrite").parquet(f"{path}/v{number}")

    return put


def _version(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{path}/v{number}")
    except AnalysisException:
        return None
