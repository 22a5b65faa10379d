"""Registry of queries: each a function of (spark, folder) with the SQL that it must equal, if SQL can say it."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function whose parameters are named as the tables it reads."""

    def add(f):
        tables = list(inspect.signature(f).parameters)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return f(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
