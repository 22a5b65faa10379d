"""Records of any keys to canonical fields, each within its own row: no explode, no shuffle.

A record is a map column ``attrs`` whose key order is the source's. Quirks of the data contract that show in its
results are kept: fields of FIXED_FIELDS are dropped from the raw keys and come back through aliases or derivation; a
value is appended to a cell if it differs from the whole cell, so that a, b, a gives a|b|a; the camera
summary replaces the camera text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import brand_of, normalize_brand
from ..functions.text import clean_spec_value, clean_value, col, distinct_join, first_number_text, has_positive_value, is_missing, numbers
from ..profiles import phones


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def map_header(c: Column | str, table: Mapping[str, str] = phones.HEADER_MAP) -> Column:
    """Canonical name of a header: exact, else of the first key that holds it or that it holds, else itself."""
    header = col(c)
    exact = F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), header)
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("to")) for k, v in table.items()))
    near = F.get(F.filter(pairs, lambda p: header.contains(p["key"]) | p["key"].contains(header)), F.lit(0))["to"]
    return F.coalesce(exact, near, header)


def fold_fields(entries: Column, first: Column) -> Column:
    """Map of field to value from entries (field, value) in order, after the pairs of first.

    A filled cell gets a later value appended by '|' unless it is missing or equals the whole cell.
    """
    every = F.concat(first, entries)
    fields = F.array_distinct(F.transform(every, lambda e: e["field"]))

    def value(field: Column) -> Column:
        own = F.transform(F.filter(every, lambda e: e["field"] == field), lambda e: e["value"])
        blank = lambda x: x.isNull() | x.isin("", "-")
        step = lambda acc, v: F.when(blank(acc), v).when(blank(v) | (v == acc), acc).otherwise(F.concat(acc, F.lit("|"), v))
        return F.aggregate(own, F.lit(None).cast("string"), step)

    return F.map_from_arrays(fields, F.transform(fields, value))


def normalize_rows(records: DataFrame, source: Column | str, table: Mapping[str, str] = phones.HEADER_MAP) -> DataFrame:
    """records (attrs) with attrs in canonical fields: brand and identity cleaned, headers mapped, specs cleaned and folded, fields derived."""
    raw = F.col("attrs")
    at = lambda k: F.try_element_at(raw, F.lit(k))
    model = F.coalesce(clean_value(at("型号")), at("name"))
    own = F.when(at("品牌").isNotNull(), normalize_brand(at("品牌")))
    backfill = F.when(F.trim(F.coalesce(at("brand"), F.lit(""))) != "", normalize_brand(at("brand"))).otherwise(F.nullif(brand_of(model), F.lit("")))
    named = {
        "数据来源": col(source) if isinstance(source, Column) else F.lit(source),
        "品牌": F.when(own.isNull() | own.isin("", "-"), backfill).otherwise(own),
        "型号": model,
        "手机ID": F.coalesce(clean_value(at("手机ID")), at("id")),
        "上市时间": clean_value(at("上市时间")),
        "价格": clean_value(at("价格")),
    }
    first = F.array_compact(F.array(*(F.when(v.isNotNull(), F.struct(F.lit(k).alias("field"), v.alias("value"))) for k, v in named.items())))
    skip = [*phones.FIXED_FIELDS, *phones.TECHNICAL_KEYS]
    mapped = F.transform(F.filter(F.map_entries(raw), lambda e: ~e["key"].isin(*skip)), lambda e: F.struct(map_header(e["key"], table).alias("field"), e["value"].alias("value")))
    entries = F.transform(mapped, lambda e: F.struct(e["field"].alias("field"), clean_spec_value(e["field"], e["value"]).alias("value")))
    df = records.withColumn("__entries", entries).withColumn("__first", first)
    df = df.withColumn("attrs", fold_fields(F.col("__entries"), F.col("__first"))).drop("__entries", "__first")
    return add_derived(df)


def put(attrs: Column, values: Mapping[str, Column]) -> Column:
    """attrs with the values that aren't null or empty put in."""
    new = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items())), lambda e: e["value"].isNotNull() & (e["value"] != "")))
    return F.map_concat(F.map_filter(attrs, lambda k, v: ~F.map_contains_key(new, k)), new)


def body_size(own: Column, length: Column, width: Column, thickness: Column) -> Column:
    parts = [first_number_text(c) for c in (length, width, thickness)]
    whole = (parts[0] != "") & (parts[1] != "") & (parts[2] != "")
    return F.when(has_positive_value(own), clean_value(own)).when(whole, F.concat(F.concat_ws(" x ", *parts), F.lit(" mm"))).otherwise("")


def body_width(own: Column, size: Column) -> Column:
    number = first_number_text(clean_value(own))
    second = F.get(numbers(size), F.lit(1))
    plain = F.regexp_replace(F.format_string("%.6f", second), r"\.?0+$", "")
    return F.when(has_positive_value(own), F.when(number != "", F.concat(number, F.lit(" mm"))).otherwise(clean_value(own))).when(second.isNotNull(), F.concat(plain, F.lit(" mm"))).otherwise("")


def camera_summary(attrs: Column, parts: Sequence[tuple[str, str]] = phones.CAMERA_PARTS) -> Column:
    out = []
    for label, key in parts:
        raw = F.try_element_at(attrs, F.lit(key))
        text = clean_value(raw)
        told = text.contains(f"{label}:") | text.contains(f"{label}：")
        out.append(F.when(has_positive_value(raw), F.when(told, text).otherwise(F.concat(F.lit(f"{label}: "), text))))
    return F.array_join(F.array_compact(F.array(*out)), "；")


def ultrawide_zoom(text: Column) -> Column:
    found = [F.nullif(F.regexp_extract(text, "(?U)" + p, 1), F.lit("")) for p in phones.ULTRAWIDE]
    return F.regexp_replace(F.coalesce(*found, F.lit("")), r"(?U)\s+", "")


def add_derived(df: DataFrame) -> DataFrame:
    at = lambda k: F.try_element_at(F.col("attrs"), F.lit(k))
    df = df.withColumn("attrs", put(F.col("attrs"), {"机身尺寸": body_size(at("机身尺寸"), at("机身长度"), at("机身宽度"), at("机身厚度"))}))
    df = df.withColumn("attrs", put(F.col("attrs"), {"机身宽度": body_width(at("机身宽度"), at("机身尺寸"))}))
    df = df.withColumn("attrs", put(F.col("attrs"), {"摄像头参数": camera_summary(F.col("attrs"))}))
    text = F.concat_ws(" ", *(F.when(has_positive_value(at(k)), clean_value(at(k))) for k in phones.ULTRAWIDE_KEYS))
    return df.withColumn("attrs", put(F.col("attrs"), {"超广角缩放倍数": ultrawide_zoom(text)}))


def fold_aliases(attrs: Column, aliases: Mapping[str, str] = phones.AUDITED_ALIASES) -> Column:
    """attrs with alias keys renamed; values that meet are joined, distinct."""
    table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
    named = F.transform(F.map_entries(attrs), lambda e: F.struct(F.coalesce(F.try_element_at(table, F.trim(e["key"])), e["key"]).alias("field"), e["value"].alias("value")))
    fields = F.array_distinct(F.transform(named, lambda e: e["field"]))

    def value(field: Column) -> Column:
        own = F.transform(F.filter(named, lambda e: e["field"] == field), lambda e: e["value"])
        return F.when(F.size(own) == 1, F.get(own, F.lit(0))).otherwise(F.coalesce(distinct_join(own), F.get(own, F.lit(0))))

    return F.map_from_arrays(fields, F.transform(fields, value))


def rename_keep_longer(attrs: Column, names: Mapping[str, str]) -> Column:
    """attrs with keys renamed exactly; where two meet, a filled cell replaces an empty one and else the longer stays."""
    table = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    named = F.transform(F.map_entries(attrs), lambda e: F.struct(F.coalesce(F.try_element_at(table, e["key"]), e["key"]).alias("field"), e["value"].alias("value")))
    fields = F.array_distinct(F.transform(named, lambda e: e["field"]))

    def value(field: Column) -> Column:
        own = F.transform(F.filter(named, lambda e: e["field"] == field), lambda e: e["value"])
        step = lambda acc, v: F.when(is_missing(acc), v).when(is_missing(v) | (F.length(v) <= F.length(acc)), acc).otherwise(v)
        return F.aggregate(own, F.lit(None).cast("string"), step)

    return F.map_from_arrays(fields, F.transform(fields, value))


def spec_first(values: Column, unit: str = r"[0-9](?:\.[0-9]+)?\s*(?:英寸|mAh|Hz|GB|TB|mm)") -> Column:
    """Distinct values joined by '|', those with a number and unit first."""
    kept = F.array_distinct(F.filter(values, lambda v: ~is_missing(v)))
    return F.array_join(F.concat(F.filter(kept, lambda v: v.rlike(unit)), F.filter(kept, lambda v: ~v.rlike(unit))), "|")


#: Marks that say no more than yes, and how a column names its parent.
MARKS = ["支持", "是", "有", "●", "√", "true"]
NESTED = r"^(.+?)\s+-\s+(\S+.*)$"


def fold_nested_columns(attrs: Column, aliases: Mapping[str, str]) -> Column:
    """View columns: 'Parent - Value' folds into Parent, as Value's name if the cell is a mere mark; aliases fold; ', ' joins distinct values."""
    table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)) if aliases else F.create_map().cast("map<string,string>")

    def renamed(e: Column) -> Column:
        parent, name = (F.trim(F.regexp_extract(e["key"], "(?U)" + NESTED, k)) for k in (1, 2))
        mark = F.lower(F.trim(e["value"])).isin(*MARKS)
        return F.struct(F.when(parent != "", parent).otherwise(F.coalesce(F.try_element_at(table, e["key"]), e["key"])).alias("field"), F.when((parent != "") & mark, name).otherwise(e["value"]).alias("value"))

    named = F.filter(F.transform(F.map_entries(attrs), renamed), lambda e: ~is_missing(e["value"]))
    fields = F.array_distinct(F.transform(named, lambda e: e["field"]))
    return F.map_from_arrays(fields, F.transform(fields, lambda f: F.array_join(F.array_distinct(F.transform(F.filter(named, lambda e: e["field"] == f), lambda e: e["value"])), ", ")))


def unpivot(df: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """key, field, value: a row per field, in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("e")
    return df.select(*key, pairs).select(*key, "e.field", "e.value")
