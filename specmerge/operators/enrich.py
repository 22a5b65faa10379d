"""Enrichment by grouped questions: cache, grouping, and applying a response to the rows it is about. Answers are tables; nothing is fetched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = ["未知", "", "-"]


def with_cache(rows: DataFrame, cache: DataFrame, key: str, value: str) -> DataFrame:
    """rows with value from the cache where their own is unknown, known_before and pending."""
    hit = cache.groupBy(key).agg(F.first(value, ignorenulls=True).alias("__hit"))
    own = F.col(value)
    unknown = own.isNull() | F.trim(own).isin(*UNKNOWN)
    out = rows.join(hit, key, "left").withColumn("known_before", ~unknown)
    out = out.withColumn(value, F.when(unknown, F.coalesce("__hit", own)).otherwise(own)).drop("__hit")
    return out.withColumn("pending", out[value].isNull() | F.trim(out[value]).isin(*UNKNOWN))


def requests(rows: DataFrame, group: Sequence[str], sample: str, ord_col: str, n: int = 8) -> DataFrame:
    """group, n_rows and the first n distinct samples of each group in order; only those n leave a group's rows."""
    first = rows.groupBy(*group, sample).agg(F.min(ord_col).alias(ord_col), F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy(*group).orderBy(ord_col, sample)
    total = first.groupBy(*group).agg(F.sum("n_rows").alias("n_rows"))
    some = first.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(ord_col, sample))).alias("s"))
    return some.join(total, list(group)).select(*group, "n_rows", F.transform("s", lambda x: x[sample]).alias("samples"))


def exact_cover(asked: DataFrame, answered: DataFrame, key: str) -> DataFrame:
    """One row: whether the answers are for exactly what was asked, each once; with the numbers of missing, foreign and repeated."""
    a = asked.select(key).distinct().withColumn("asked", F.lit(1))
    b = answered.groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    both = a.join(b, key, "full_outer")
    out = both.agg(F.count_if(F.col("times").isNull()).alias("n_missing"), F.count_if(F.col("asked").isNull()).alias("n_foreign"), F.count_if(F.col("times") > 1).alias("n_repeated"))
    return out.withColumn("valid", (F.col("n_missing") + F.col("n_foreign") + F.col("n_repeated")) == 0)


def propagate(rows: DataFrame, answers: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """rows with the answer of their group."""
    return rows.join(answers.select(*group, F.col(value).alias(f"{value}_answer")), list(group), "left")
