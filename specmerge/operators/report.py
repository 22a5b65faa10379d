"""Counts and rates over sources, agreement and difference texts."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..profiles import phones


def counts(rows: DataFrame, by: Column | str, name: str, array: bool = False) -> DataFrame:
    """name, n_rows by value, or by element of an array."""
    c = F.col(by) if isinstance(by, str) else by
    return rows.select((F.explode(c) if array else c).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"))


def combos(rows: DataFrame, sources: Column, name: str = "combo", sep: str = "+", other: str = "unknown") -> DataFrame:
    joined = F.array_join(F.array_sort(sources), sep)
    return counts(rows, F.when(joined == "", other).otherwise(joined), name)


def multi_single(rows: DataFrame, n_sources: Column) -> DataFrame:
    """One row: n_rows, n_multi, n_single and their rates in percent, rounded."""
    out = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(n_sources > 1).alias("n_multi"), F.count_if(n_sources == 1).alias("n_single"))
    rate = lambda c: F.when(F.col("n_rows") > 0, F.round(F.col(c) * 100.0 / F.col("n_rows"), 2)).otherwise(0.0)
    return out.withColumns({"multi_rate": rate("n_multi"), "single_rate": rate("n_single")})


def source_sets(rows: DataFrame, key: Sequence[str], source: str) -> DataFrame:
    """key, n_rows, sources (sorted), n_sources."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_set(source)).alias("sources")).withColumn("n_sources", F.size("sources"))


def per_source_rates(sets: DataFrame) -> DataFrame:
    """source, n_covered, n_alone, single_rate in percent, from source_sets."""
    lines = sets.select(F.explode("sources").alias("source"), (F.col("n_sources") == 1).alias("alone"))
    out = lines.groupBy("source").agg(F.count(F.lit(1)).alias("n_covered"), F.count_if("alone").alias("n_alone"))
    return out.withColumn("single_rate", F.round(F.col("n_alone") * 100.0 / F.col("n_covered"), 2))


def merge_gap(rows: DataFrame, full: Sequence[str], base: str, source: str) -> DataFrame:
    """Identities that one source has although their base has several: full, base, n_base_sources.

    The base's sources are counted in their own aggregation and joined: no group meets in one task.
    """
    sets = source_sets(rows, [*full, base], source).where("n_sources = 1")
    bases = rows.where(F.col(base).isNotNull()).select(base, source).distinct().groupBy(base).agg(F.count(F.lit(1)).alias("n_base_sources"))
    return sets.join(bases.where("n_base_sources > 1"), base).select(*full, base, "n_base_sources")


def diff_fields(text: Column, fields: Sequence[str] = phones.VALIDATION_FIELDS) -> Column:
    """Fields of a difference text: blocks are parted only where a field's name follows."""
    blocks = F.split(text, "；(?=(?:" + "|".join(fields) + "): )")
    names = F.transform(blocks, lambda b: F.regexp_extract(b, "^(" + "|".join(fields) + "): ", 1))
    return F.filter(names, lambda n: n != "")


def diff_field_counts(rows: DataFrame, text: str, fields: Sequence[str] = phones.VALIDATION_FIELDS) -> DataFrame:
    return counts(rows, diff_fields(F.col(text), fields), "field", array=True)


def some_but_not_all(values: Column, pattern: str) -> Column:
    """Whether some of an array's values have a pattern and others not."""
    has = lambda v: F.coalesce(v, F.lit("")).rlike(pattern)
    return F.exists(values, has) & ~F.forall(values, has)


def signals(a: Column, b: Column) -> Column:
    """'mergeable' if two sets of values meet, 'conflict' if neither is empty and they don't."""
    return F.when(F.arrays_overlap(a, b), "mergeable").when((F.size(a) > 0) & (F.size(b) > 0), "conflict")


def top(rows: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    return rows.orderBy(*by).limit(n)


def flags(rows: DataFrame, preds: Mapping[str, Column]) -> DataFrame:
    """One row: n_rows and the number of rows of each predicate."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(p).alias(k) for k, p in preds.items()))


def success_rate(rows: DataFrame, good: str, bad: str) -> DataFrame:
    """One row: n_rows, n_usable (more successes than failures), total_good, total_bad and rate in per cent, null if there were no tries."""
    total = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(good) > F.col(bad)).alias("n_usable"), F.coalesce(F.sum(good), F.lit(0)).alias("total_good"), F.coalesce(F.sum(bad), F.lit(0)).alias("total_bad"))
    tries = F.col("total_good") + F.col("total_bad")
    return total.withColumn("rate", F.when(tries > 0, F.round(F.col("total_good") * 100.0 / tries, 1)))


def field_diff(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str], ord_col: str, missing: Sequence[str] = ("-",)) -> DataFrame:
    """key, field, left_value, right_value where both sides have different values; of a key's right rows the last counts."""
    last = right.groupBy(key).agg(*(F.max_by(f, ord_col).alias(f"r_{f}") for f in fields))
    both = left.select(key, *(F.col(f).alias(f"l_{f}") for f in fields)).join(last, key)
    lines = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"l_{f}").cast("string").alias("left_value"), F.col(f"r_{f}").cast("string").alias("right_value")) for f in fields))).alias("e")
    there = functools.reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.col(c).isin(*missing) for c in ("left_value", "right_value")))
    return both.select(key, lines).select(key, "e.*").where(there & (F.col("left_value") != F.col("right_value")))


def evidence_report(rows: DataFrame, sources: Column, status: str, diffs: DataFrame | None = None) -> DataFrame:
    """One row, report: JSON with counts of rows, sources, combinations and status, keys in a fixed order."""
    pairs = lambda df, c: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n_rows")))).alias("m"))
    out = rows.agg(F.count(F.lit(1)).alias("total"))
    parts = {"source_counts": counts(rows, sources, "source", array=True), "source_combinations": combos(rows, sources, "source"), "status_counts": counts(rows, status, "source")}
    one = F.lit(1)
    out = out.withColumn("__k", one)
    for name, df in parts.items():
        out = out.join(pairs(df, "source").select(F.col("m").alias(name)).withColumn("__k", one), "__k")
    out = out.withColumn("diff_row_count", F.lit(diffs.count() if diffs is not None else 0))
    return out.select(F.to_json(F.struct("total", *parts, "diff_row_count")).alias("report"))
