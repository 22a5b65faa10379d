"""Memory and storage capacities in names and fields, in GB."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

AMOUNT = r"([0-9]+)\s*([gt]b?)"


def _gb(number: Column, unit: Column) -> Column:
    return number.cast("int") * F.when(F.lower(unit).startswith("t"), 1024).otherwise(1)


def amounts(c: Column | str) -> Column:
    """All amounts in a text, in GB, in order."""
    text = F.coalesce(col(c), F.lit(""))
    found = F.regexp_extract_all(text, F.lit("(?iU)" + AMOUNT), 0)
    return F.transform(found, lambda x: _gb(F.regexp_extract(x, "[0-9]+", 0), F.regexp_extract(x, "(?i)[gt]", 0)))


def signature(name: Column | str, memory: Column | str | None = None, storage: Column | str | None = None) -> Column:
    """(memory, storage), (storage,) or () as the name says it or else single amounts of the fields."""
    text = F.translate(F.coalesce(col(name), F.lit("")), "（）", "()")
    pair = r"(?iU)([0-9]+)\s*(?:gb)?\s*[+/]+\s*([0-9]+)\s*([gt]b?)"
    is_pair = text.rlike(pair)
    both = F.array(F.regexp_extract(text, pair, 1).cast("int"), _gb(F.regexp_extract(text, pair, 2), F.regexp_extract(text, pair, 3)))
    groups = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"\(([^)]*)\)"), 1), lambda g: amounts(g)), lambda a: F.size(a) == 1)
    tail = r"(?iU)([0-9]+)\s*(gb|tb)\s*$"
    none = F.array().cast("array<int>")
    m, s = (amounts(c) if c is not None else none for c in (memory, storage))
    fields = F.when((F.size(m) == 1) & (F.size(s) == 1), F.concat(m, s)).when((F.size(m) == 0) & (F.size(s) == 1), s).otherwise(none)
    out = F.when(is_pair, both).when(F.size(groups) > 0, F.get(groups, F.lit(0)))
    return out.when(text.rlike(tail), F.array(_gb(F.regexp_extract(text, tail, 1), F.regexp_extract(text, tail, 2)))).otherwise(fields)


def options(name: Column | str, memory: Column | str, storage: Column | str) -> Column:
    """The signature alone, or all pairs of at most 16, or up to 8 storage amounts."""
    own = signature(name, memory, storage)
    m, s = F.array_distinct(amounts(memory)), F.array_distinct(amounts(storage))
    pairs = F.flatten(F.transform(m, lambda x: F.transform(s, lambda y: F.array(x, y))))
    none = F.array().cast("array<array<int>>")
    out = F.when(F.size(own) > 0, F.array(own)).when((F.size(m) > 0) & (F.size(s) > 0), F.when(F.size(m) * F.size(s) <= 16, pairs).otherwise(none))
    return out.when((F.size(m) == 0) & (F.size(s) > 0) & (F.size(s) <= 8), F.transform(s, lambda x: F.array(x))).otherwise(none)
