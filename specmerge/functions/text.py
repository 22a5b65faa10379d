"""Text columns: cleaning, missing-value predicates, numbers and prices.

Patterns that come from the data contract are Unicode-aware, hence ``(?U)``; white space includes U+3000.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from ..profiles import phones

NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def replace_all(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Regular expressions applied in order."""
    return functools.reduce(lambda x, rule: F.regexp_replace(x, "(?U)" + rule[0], rule[1]), rules, col(c))


def clean_value(c: Column | str, noise: str = "纠错") -> Column:
    """Without noise, white space collapsed and trimmed; '-' if nothing is left; null stays null."""
    text = strip(F.regexp_replace(F.replace(col(c), F.lit(noise), F.lit("")), r"(?U)\s+", " "))
    return F.when(text == "", "-").otherwise(text)


def clean_spec_value(field: Column | str, c: Column | str) -> Column:
    """clean_value; capacity fields also lose marketing copy and have one separator."""
    text, field = clean_value(c), field if isinstance(field, Column) else F.lit(field)

    def spec(rules):
        x = replace_all(text, rules)
        x = F.regexp_replace(x, "(?U)" + phones.SPEC_EMPTY_BRACKETS, "")
        x = F.regexp_replace(F.regexp_replace(x, "(?U)" + phones.SPEC_SEPARATORS, "|"), r"^[ |]+|[ |]+$", "")
        return F.when(x == "", "-").otherwise(x)

    out = text
    for name, rules in phones.SPEC_COPY.items():
        out = F.when((field == name) & (text != "-"), spec(rules)).otherwise(out)
    return out


def strip_residue(c: Column | str) -> Column:
    return replace_all(c, phones.RESIDUE)


def is_missing(c: Column | str) -> Column:
    return col(c).isNull() | strip(c).isin("", "-")


def is_validation_missing(c: Column | str) -> Column:
    return col(c).isNull() | F.lower(strip(c)).isin(*phones.VALIDATION_MISSING)


def has_positive_value(c: Column | str) -> Column:
    return ~is_missing(c) & ~strip(c).isin(*phones.NEGATIVE_VALUES)


def has_value(c: Column | str) -> Column:
    """Neither null nor blank nor a lone dash."""
    return ~is_missing(c) & ~strip(c).isin("--")


def first_number_text(c: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), NUMBER, 0)


def first_number(c: Column | str) -> Column:
    """First unsigned number; a thousands separator ends it; null if there is none."""
    text = first_number_text(c)
    return F.when(text != "", text).cast("double")


def numbers(c: Column | str) -> Column:
    return F.when(is_missing(c), F.array().cast("array<double>")).otherwise(F.regexp_extract_all(col(c), F.lit(NUMBER), 0).cast("array<double>"))


def price(c: Column | str) -> Column:
    """The amount of a price text, or '' if anything but currency signs and separators stands beside it."""
    text = F.regexp_replace(strip(c), "[￥¥,]", "")
    return F.when(text.rlike(rf"^{NUMBER}$"), text).otherwise("")


@pandas_udf(StringType())
def _nfkc_casefold(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFKC").str.casefold()


def nfkc_casefold(c: Column | str) -> Column:
    """Compatibility form, case-folded: Spark has no function for either. ASCII texts, of which both are lower case, go to no worker."""
    ascii_only = col(c).rlike(r"\A[\x00-\x7F]*\z")
    return F.when(ascii_only, F.lower(col(c))).otherwise(_nfkc_casefold(F.when(~ascii_only, col(c))))


def normalize_model(c: Column | str) -> Column:
    return F.regexp_replace(strip(nfkc_casefold(col(c))), r"(?U)\s+", " ")


def csv_escape(c: Column | str) -> Column:
    """A CSV field, quoted only if it has a quote, comma or line break."""
    text = F.coalesce(col(c).cast("string"), F.lit(""))
    return F.when(text.rlike('[",\n\r]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_line(cols: Sequence[Column | str]) -> Column:
    return F.concat_ws(",", *(csv_escape(c) for c in cols))


def keyword_class(c: Column | str, classes: Sequence[tuple[str, Sequence[str]]], other: str) -> Column:
    """Name of the first class of which a keyword is in the text, lower-cased."""
    text, out = F.lower(col(c)), F.lit(other)
    for name, words in reversed(classes):
        out = F.when(functools.reduce(lambda a, b: a | b, (text.contains(w) for w in words)), name).otherwise(out)
    return out


def distinct_join(values: Column, sep: str = "|") -> Column:
    """Trimmed distinct pieces of an array of values, in order, without missing ones; null if none is left."""
    pieces = F.flatten(F.transform(values, lambda v: F.when(v.isNull() | strip(v).isin("", "-", "--"), F.array().cast("array<string>")).otherwise(F.split(v, r"\|"))))
    pieces = F.array_distinct(F.filter(F.transform(pieces, lambda p: strip(p)), lambda p: p != ""))
    return F.when(F.size(pieces) > 0, F.array_join(pieces, sep))


def url_host(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def resolve_url(base: Column | str, link: Column | str) -> Column:
    """Absolute form of a link on a page: as it is, by scheme, by host, or by folder."""
    base, link = col(base), strip(link)
    root = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", 0)
    folder = F.regexp_replace(F.regexp_extract(base, r"^[^?#]*", 0), r"(?<=[^/:])/[^/]*$", "")
    out = F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^[^:]*:", 0), link))
    return out.when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(folder, F.lit("/"), link))


def redact_url(c: Column | str) -> Column:
    """Scheme and host of a url, the rest hidden; '<invalid-url>' without a host."""
    found = F.regexp_extract(F.coalesce(strip(c), F.lit("")), r"^([a-zA-Z][a-zA-Z0-9+.-]*)?://([^/?#]+)", 0)
    return F.when(found == "", "<invalid-url>").otherwise(F.concat(found, F.lit("/***")))


def encode_base64(c: Column | str) -> Column:
    """A text's UTF-8 bytes in one line of base64."""
    return F.regexp_replace(F.base64(F.encode(col(c), "utf-8")), r"\s", "")


def decode_base64(c: Column | str) -> Column:
    """The text of base64 with white space anywhere; null if it isn't base64 of UTF-8."""
    clean = F.regexp_replace(col(c), r"\s", "")
    return F.try_validate_utf8(F.try_to_binary(clean, F.lit("base64")).cast("string"))


def allowed_url(c: Column | str, host: str, path_end: str) -> Column:
    return (url_host(c) == host) & F.regexp_extract(col(c), r"^[^?#]*", 0).endswith(path_end)


def param_url(base: Column | str, link: Column | str, host: str, path_end: str = "/param.shtml") -> Column:
    """The resolved link if it is on host and ends in path_end, else null."""
    url = resolve_url(base, link)
    return F.when(allowed_url(url, host, path_end), url)
