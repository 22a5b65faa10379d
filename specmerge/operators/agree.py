"""Agreement of one to three sources on a record's fields, and the merged row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.equality import lenient_same, same_value
from ..functions.text import clean_value, is_missing, is_validation_missing, strip_residue
from ..profiles import phones


def status_of(n: Column, comparable: Column, equal_pairs: Column, names: dict[str, str] = phones.STATUS) -> Column:
    """Status from the numbers of sources, of comparable fields and of pairs that agree on all of them."""
    out = F.when(n < 2, names["single"]).when((n > 3) | (comparable == 0), names["unverified"])
    out = out.when(n == 2, F.when(equal_pairs > 0, names["two_same"]).otherwise(names["two_differ"]))
    return out.when(equal_pairs == 3, names["three_same"]).when(equal_pairs > 0, names["two_same"]).otherwise(names["three_differ"])


def classify(rows: DataFrame, key: str, sources: str = "sources", fields: Sequence[str] = phones.VALIDATION_FIELDS, same=same_value) -> DataFrame:
    """key, status, differences of every row; sources: array<struct<name,attrs map>> in order.

    A row becomes a line per field, where the two or three values are compared; a field is comparable if
    all sources have it. Lines are put together by key again.
    """
    s = F.col(sources)
    value = lambda i: F.try_element_at(F.get(s, F.lit(i))["attrs"], F.col("field"))
    lines = rows.select(key, s, F.posexplode(F.array(*(F.lit(f) for f in fields))).alias("pos", "field"))
    lines = lines.select(key, "pos", "field", F.size(s).alias("n"), F.transform(s, lambda x: x["name"]).alias("names"), *(value(i).alias(f"v{i}") for i in range(3)))
    gone = [is_validation_missing(F.col(f"v{i}")) & (F.col("n") > i) for i in range(3)]
    lines = lines.withColumn("gone", F.array(*gone)).withColumn("comparable", ~F.exists("gone", lambda x: x))
    pairs = {"e01": (0, 1), "e02": (0, 2), "e12": (1, 2)}
    lines = lines.withColumns({k: same(F.col("field"), F.col(f"v{i}"), F.col(f"v{j}")) for k, (i, j) in pairs.items()})
    label = lambda i: F.concat(F.get("names", F.lit(i)), F.lit("="), strip_residue(F.coalesce(F.col(f"v{i}"), F.lit(""))))
    told = F.concat(F.col("field"), F.lit(": "), F.when(F.col("n") > 2, F.concat_ws("; ", label(0), label(1), label(2))).otherwise(F.concat_ws("; ", label(0), label(1))))
    differs = F.col("comparable") & (~F.col("e01") | ((F.col("n") > 2) & ~F.col("e02")))
    missing = F.concat_ws("；", *(F.when(F.get("gone", F.lit(i)), F.concat(F.get("names", F.lit(i)), F.lit(phones.MISSING_WORD), F.col("field"))) for i in range(3)))
    lines = lines.withColumn("told", F.when(differs, told)).withColumn("missing", F.when(missing != "", missing))
    agg = [F.min(F.when(F.col("comparable"), F.col(k))).alias(k) for k in pairs]
    ordered = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("pos", F.col(c).alias("t"))))), lambda x: x["t"]), "；")
    out = lines.groupBy(key).agg(F.max("n").alias("n"), F.count_if("comparable").alias("comparable"), *agg, ordered("told").alias("told"), ordered("missing").alias("missing"))
    equal = F.col("e01").cast("int") + F.when(F.col("n") == 3, F.col("e02").cast("int") + F.col("e12").cast("int")).otherwise(0)
    status = status_of(F.col("n"), F.col("comparable"), F.coalesce(equal, F.lit(0)))
    text = F.concat_ws("；", F.nullif(F.col("missing"), F.lit("")), F.nullif(F.col("told"), F.lit("")))
    text = F.when((F.col("n") < 2) | ((F.col("n") == 2) & (status == phones.STATUS["two_same"])), "-").when(F.col("n") > 3, phones.TOO_MANY_SOURCES).when(text == "", "-").otherwise(text)
    return out.select(key, status.alias("status"), text.alias("differences"))


def merged_cell(a: Column, b: Column, names: Sequence[str], same=lenient_same) -> Column:
    """A cell of two sources: the one that has it, the first if they are alike, else both with their names."""
    x, y = clean_value(a), clean_value(b)
    both = F.concat(F.lit(f"{names[0]}: "), x, F.lit(f" | {names[1]}: "), y)
    return F.when(is_missing(x), y).when(is_missing(y), x).when(same(x, y), x).otherwise(both)
