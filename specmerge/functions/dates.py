"""Dates of which only a year, or a year and month, may be known."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: How each reader finds a date or year in a text.
DATE = r"(?<![0-9])((?:19|20)[0-9]{2})(?:\s*[年\-/.]\s*([0-9]{1,2}))?(?:\s*[月\-/.]\s*([0-9]{1,2}))?"
YEAR = {"publish": r"(?<![0-9])((?:19|20)[0-9]{2})", "verify": r"((?:19|20)[0-9]{2})", "view": r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", "crawl": r"(20[0-9]{2})\s*年", "list": r"(20[0-9]{2})"}


def _part(text: Column, group: int) -> Column:
    found = F.regexp_extract(text, "(?U)" + DATE, group)
    return F.when(found != "", found).cast("int")


def partial_date(c: Column | str) -> Column:
    """struct<y,m,d> of the first date in a text; what isn't given is null."""
    text = F.coalesce(col(c), F.lit(""))
    return F.struct(_part(text, 1).alias("y"), _part(text, 2).alias("m"), _part(text, 3).alias("d"))


def release_year(c: Column | str, dialect: str = "publish") -> Column:
    found = F.regexp_extract(F.coalesce(col(c), F.lit("")), "(?U)" + YEAR[dialect], 1)
    return F.when(found != "", found).cast("int")


def first_year(cols: Sequence[Column | str], dialect: str = "publish") -> Column:
    return F.coalesce(*(release_year(c, dialect) for c in cols))


def is_future(c: Column | str, as_of: datetime.date) -> Column:
    """Whether a text's date is after as_of, compared at the date's own precision; no date or no such day: no."""
    d = partial_date(c)
    y, m, day = d["y"], d["m"], d["d"]
    months = y * 12 + m
    date = F.to_date(F.format_string("%04d-%02d-%02d", y, m, day))
    valid = F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, day)) if hasattr(F, "try_to_date") else date
    out = F.when(y.isNull(), False).when(m.isNull(), y > as_of.year).when(day.isNull(), months > as_of.year * 12 + as_of.month)
    return out.otherwise(F.coalesce(valid > F.lit(as_of), F.lit(False)))


def is_future_any(cols: Sequence[Column | str], as_of: datetime.date) -> Column:
    """is_future of the first column that has a date."""
    out = F.lit(False)
    for c in reversed(cols):
        out = F.when(partial_date(c)["y"].isNotNull(), is_future(c, as_of)).otherwise(out)
    return out


def same_granularity(a: Column, b: Column) -> Column:
    """Equal year and month with a day on one side at most; unknown parts count as 0."""
    zero = lambda d, k: F.coalesce(d[k], F.lit(0))
    return a["y"].isNotNull() & b["y"].isNotNull() & (a["y"] == b["y"]) & (zero(a, "m") == zero(b, "m")) & ((zero(a, "d") == 0) | (zero(b, "d") == 0))


def in_window(ts: Column | str, begin: str, end: str) -> Column:
    """Whether a timestamp's time of day is from begin to end, 'HH:MM', ends included."""
    minute = F.hour(col(ts)) * 60 + F.minute(col(ts))
    at = [int(x[:2]) * 60 + int(x[3:]) for x in (begin, end)]
    return minute.between(*at)
