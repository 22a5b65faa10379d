"""Admission of rows: dates, skip lists, validity and dataset quality. The date is always an argument."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import first_year, is_future_any
from ..functions.text import col, price


def guard_rows(rows: DataFrame, *, as_of: datetime.date, dates: Sequence[Column | str], ids: Column | str, skip: DataFrame | None = None, years: int = 4, prices: Sequence[str] = ()) -> DataFrame:
    """rows without skipped ids (skip: one column), future dates and dates more than years back; rows without a date stay."""
    if skip is not None:
        listed = skip.select(F.trim(F.col(skip.columns[0]).cast("string")).alias("__skip")).where("__skip <> ''").distinct()
        rows = rows.join(listed, F.trim(col(ids).cast("string")) == F.col("__skip"), "left_anti")
    year = first_year(dates)
    rows = rows.where(~is_future_any(dates, as_of) & (year.isNull() | (year >= as_of.year - years)))
    return rows.withColumns({c: price(c) for c in prices}) if prices else rows


def score(preds: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a + b, (F.coalesce(p, F.lit(False)).cast("int") for p in preds))


def valid_record(must: Sequence[Column], some: Sequence[Column], least: int) -> Column:
    """All of must, and at least ``least`` of some."""
    return functools.reduce(lambda a, b: a & b, (F.coalesce(p, F.lit(False)) for p in must), F.lit(True)) & (score(some) >= least)


def dataset_quality(rows: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """One row: n_rows, n_<field> with a value, and the least field's share in whole percent, cut off."""
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(p).alias(f"n_{k}") for k, p in fields.items()))
    least = F.least(*(F.col(f"n_{k}") for k in fields)) if len(fields) > 1 else F.col(f"n_{next(iter(fields))}")
    return counts.withColumn("percent", F.when(F.col("n_rows") > 0, F.floor(least * 100 / F.col("n_rows"))).otherwise(0).cast("long"))


def is_valid_dataset(rows: DataFrame, fields: Mapping[str, Column], named: Column, *, least_percent: int = 70, between: tuple[int, int] | None = None) -> bool:
    """Whether rows may be used: the least field's share, a name in every row, and between so many rows if asked."""
    q = dataset_quality(rows, {**fields, "__name": named}).drop("percent").first()
    least = min((q[f"n_{k}"] for k in fields), default=0)
    sized = between is None or between[0] <= q.n_rows <= between[1]
    return q.n_rows > 0 and sized and q["n___name"] == q.n_rows and least * 100 // q.n_rows >= least_percent


def scope(rows: DataFrame, source: Column, brand: Column, only: str, allowed: Sequence[str]) -> DataFrame:
    """rows without those that only one source has and whose brand isn't allowed."""
    return rows.where((source != only) | brand.isin(*allowed))
