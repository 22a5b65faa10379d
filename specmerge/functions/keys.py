"""Keys that tell which records are the same thing."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profiles import phones
from .text import clean_value, col, is_missing, normalize_model, strip


def brand_of(c: Column | str, patterns: Sequence[tuple[str, Sequence[str]]] = phones.BRAND_PATTERNS) -> Column:
    """Brand of the first pattern that the lower-cased text holds, else ''."""
    text, out = F.lower(F.coalesce(col(c), F.lit(""))), F.lit("")
    for name, words in reversed(patterns):
        out = F.when(functools.reduce(lambda a, b: a | b, (text.contains(w) for w in words)), name).otherwise(out)
    return out


def normalize_brand(c: Column | str, aliases: Mapping[str, str] = phones.BRAND_ALIASES, patterns: Sequence[tuple[str, Sequence[str]]] = phones.BRAND_PATTERNS) -> Column:
    """Alias as written, alias in lower case, else brand_of."""
    text = strip(F.coalesce(col(c), F.lit("")))
    table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
    return F.coalesce(F.try_element_at(table, text), F.try_element_at(table, F.lower(text)), brand_of(text, patterns))


def model_key(c: Column | str) -> Column:
    """Comparison key of a model name: without capacity, marketing copy, white space and radio suffixes, brand in Latin letters."""
    name = F.lower(clean_value(c))
    name = F.regexp_replace(name, "(?iU)" + phones.KEY_CAPACITY_BRACKET, "")
    name = F.regexp_replace(name, "(?iU)" + phones.KEY_CAPACITY_TAIL, "")
    name = F.replace(name, F.lit("()"), F.lit(""))
    name = F.regexp_replace(F.regexp_replace(name, "(?iU)" + phones.KEY_MARKETING, ""), r"(?U)\s+", "")
    latin = F.create_map(*(F.lit(x) for kv in phones.KEY_BRANDS.items() for x in kv))
    any_brand = "|".join(phones.KEY_BRANDS)
    brand = F.regexp_extract(name, f"^(?:{any_brand})", 0)
    latin = F.concat(F.coalesce(F.try_element_at(latin, brand), F.lit("")), F.regexp_replace(name, f"^(?:{any_brand})", ""))
    name = F.regexp_replace(latin, *phones.KEY_DESIGN)
    for suffix in phones.KEY_SUFFIXES:
        name = F.regexp_replace(name, rf"\Q{suffix}\E$", "")
    name = F.regexp_replace(name, "[/_-]+$", "")
    return F.when(is_missing(c) | is_missing(clean_value(c)), "").otherwise(name)


def fuzzy_key(key: Column | str) -> Column:
    """A model key without anything in brackets, dots and dashes."""
    return F.regexp_replace(col(key), r"[（(].*?[）)]|[.-]", "")


def spu_key(brand: Column | str, key: Column | str, memory: Column | str, storage: Column | str) -> Column:
    digits = lambda c: F.substring(F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^0-9]", ""), 1, 4)
    return F.concat(F.lit("spu:"), F.concat_ws("|", F.coalesce(col(brand), F.lit("")), F.coalesce(col(key), F.lit("")), digits(memory), digits(storage)))


def related_ids(c: Column | str) -> Column:
    """Ids of a list text."""
    return F.array_distinct(F.filter(F.split(F.coalesce(col(c), F.lit("")), r"(?U)[|,，\s]+"), lambda x: x != ""))


def identity_keys(ids: Sequence[Column | str], related: Column, names: Sequence[Column | str]) -> Column:
    """'id:' keys of the first id that isn't blank and of the related ids; only without any, one 'model:' key."""
    filled = [F.when(strip(c) != "", strip(c)) for c in ids]
    keys = F.array_distinct(F.array_compact(F.concat(F.array(F.coalesce(*filled)), related)))
    keys = F.transform(keys, lambda x: F.concat(F.lit("id:"), x))
    models = [F.when(normalize_model(c) != "", F.concat(F.lit("model:"), normalize_model(c))) for c in names]
    return F.when(F.size(keys) > 0, keys).otherwise(F.array_compact(F.array(F.coalesce(*models, F.lit(None).cast("string")))))


def kind_identity(parts: Sequence[Column | str], needed: Sequence[Column | str] = ()) -> Column:
    """Parts that aren't blank, lower-cased, white space collapsed, joined by '|'; null if a needed one is blank."""
    norm = lambda c: F.lower(F.regexp_replace(strip(F.coalesce(col(c).cast("string"), F.lit(""))), r"(?U)\s+", " "))
    joined = F.concat_ws("|", *(F.when(norm(c) != "", norm(c)) for c in parts))
    ok = functools.reduce(lambda a, b: a & b, (norm(c) != "" for c in needed), F.lit(True))
    return F.when(ok & (joined != ""), joined)


def base_name(c: Column | str) -> Column:
    """A name without anything in brackets."""
    return strip(F.regexp_replace(col(c), r"[（(][^）)]*[）)]", ""))


def base_identity(brand: Column | str, model: Column | str) -> Column:
    """brand|model without a capacity in brackets, or null."""
    b, m = (F.lower(strip(F.coalesce(col(c), F.lit("")))) for c in (brand, model))
    m = strip(F.regexp_replace(F.regexp_replace(m, "•.*?查看所有[^|]*", ""), r"(?U)[（(]\s*[0-9]+\s*[gG][bB][^）)]*[）)]", ""))
    return F.when((b != "") & (m != ""), F.concat_ws("|", b, m))


#: Families of processors, the last that is found wins.
SOC = [(r"(骁龙|Snapdragon)\s*([0-9]+)\s*(Gen\s*[0-9]+)?", "骁龙"), (r"(天玑|Dimensity)\s*([0-9]+)", "天玑"), (r"(麒麟|Kirin)\s*([0-9]+)", "麒麟"), (r"(Exynos|猎户座)\s*([0-9]+)", "Exynos"), (r"(A[0-9]+)\s*(Bionic|仿生)?", "")]


def extract_soc(c: Column | str, families: Sequence[tuple[str, str]] = SOC, other: str = "未知SOC") -> Column:
    text, found = F.coalesce(col(c), F.lit("")), []
    for pattern, prefix in reversed(families):
        p = "(?iU)" + pattern
        name = F.concat(F.lit(prefix), F.regexp_extract(text, p, 2), F.regexp_extract(text, p, 3) if pattern.count("(") - pattern.count("(?") > 2 else F.lit("")) if prefix else F.regexp_extract(text, p, 1)
        found.append(F.when(text.rlike(p), name))
    return F.coalesce(*found, F.lit(other))


def tokens(c: Column | str, seps: str, drop: Sequence[str] = ("", "-", "--"), aliases: Mapping[str, str] | None = None) -> Column:
    """Distinct names of a source text, in order; seps: regular expression between names."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), seps), lambda x: strip(F.regexp_replace(strip(x), r"(?U)^(仅|单源\s*[:：]?)", "")))
    parts = F.filter(parts, lambda x: ~F.lower(x).isin(*drop))
    if aliases:
        table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
        parts = F.transform(parts, lambda x: F.coalesce(F.try_element_at(table, F.lower(x)), x))
    return F.array_distinct(parts)


def known_sources(c: Column | str, known: Sequence[str]) -> Column:
    """The known names that a text holds, in the order of known."""
    text = F.coalesce(col(c), F.lit(""))
    return F.array_compact(F.array(*(F.when(text.contains(k), F.lit(k)) for k in known)))


def source_count(c: Column | str) -> Column:
    """Sources of a '+'-joined text; one for a text that says only or one source; else of a comma list."""
    text = strip(F.coalesce(col(c), F.lit("")))
    out = F.when(text == "", 0).when(text.contains("+"), F.size(F.filter(F.split(text, r"\+"), lambda x: strip(x) != "")))
    return out.when(text.contains("仅"), 1).otherwise(F.size(F.filter(F.split(text, "[,，]"), lambda x: strip(x) != "")))
