"""The query catalogue: every registered query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.view import Condition, QuerySpec, filtered, representatives

from . import relations, values, views  # noqa: F401
from .registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship query: parts in a range of storage, a representative of each name, the cheapest first."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").withColumn("storage", F.expr(views.UNITS))
    spec = QuerySpec(conditions=(Condition("storage", fields=("storage",), least=20, most=20480, tera=True),))
    groups = representatives(filtered(part, spec), ["p_name"], "p_retailprice", "p_partkey", carry=["p_brand"])
    return groups.orderBy("rep_price", "p_name")
