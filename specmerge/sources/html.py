"""Fields of crawled pages: links and titles by expressions, tables by the standard library's parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions.text import col


def title(c: Column | str) -> Column:
    return F.regexp_extract(col(c), "<title>([^<]*)</title>", 1)


def links(c: Column | str, pattern: str = '<a href="([^"]*)"') -> Column:
    return F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(pattern), 1)


def first_ranks(rows: DataFrame, key: str, items: str) -> DataFrame:
    """key, item, rank of the first occurrence of each item of an array."""
    lines = rows.select(key, F.posexplode(items).alias("pos", "item")).groupBy(key, "item").agg(F.min("pos").alias("pos"))
    return lines.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("pos")).cast("long")).drop("pos")


def rank_join(rows: DataFrame, ranks: DataFrame, key: str, ord_col: str) -> DataFrame:
    """rows with their rank; those with one come first, the others keep their order."""
    return rows.join(ranks, key, "left").orderBy(F.col("rank").isNull(), F.coalesce("rank", ord_col))


class _Pairs(HTMLParser):
    """Cells and links of a page, by what encloses them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.items: list[str] = []
        self.links: list[dict[str, str]] = []
        self.attrs: list[tuple[str, str]] = []
        self._cell = self._item = self._link = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if "paramname" in a:
            self.attrs.append((a["paramname"] or "", a.get("paramvalue") or ""))
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self._cell = []
        elif tag in ("li", "dt", "dd"):
            self._item = []
        elif tag == "a" and a.get("href"):
            self._link = (a["href"], a.get("title") or "", [])

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(_squeeze(self._cell))
            self._cell = None
        elif tag in ("li", "dt", "dd") and self._item is not None:
            self.items.append(_squeeze(self._item))
            self._item = None
        elif tag == "a" and self._link is not None:
            href, name, text = self._link
            self.links.append({"href": href, "name": _squeeze(text) or name})
            self._link = None

    def handle_data(self, data):
        for part in (self._cell, self._item, self._link and self._link[2]):
            if part is not None:
                part.append(data)


def _squeeze(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def parse(source: str | None) -> _Pairs:
    page = _Pairs()
    page.feed(source or "")
    page.close()
    return page


def params_of(source: str | None) -> dict[str, str]:
    """Fields of a page: attribute pairs, the first two cells of table rows, and 'key：value' items; a later pair of a key wins."""
    page, out = parse(source), {}
    for item in page.items:
        key, sep, value = item.replace(":", "：", 1).partition("：")
        if sep and key.strip() and len(key) <= 30:
            out[key.strip()] = value.strip()
    for row in page.rows:
        if len(row) >= 2 and row[0]:
            out[row[0].rstrip("：:").strip()] = row[1]
    out.update({k.strip(): v.strip() for k, v in page.attrs if k.strip()})
    return out


@pandas_udf(MapType(StringType(), StringType()))
def params(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(params_of)


LINK = ArrayType(StructType([StructField("id", StringType()), StructField("href", StringType()), StructField("name", StringType())]))


def list_of(source: str | None, pattern: str, least_name: int = 3) -> list[dict[str, str]]:
    """Links whose target fits a pattern with one group, the id; names of at least so many letters."""
    out = []
    for x in parse(source).links:
        m = re.search(pattern, x["href"])
        if m and len(x["name"]) >= least_name:
            out.append({"id": m[1], **x})
    return out


def list_pages(pages: DataFrame, html: str, pattern: str, *, container: str = "", distinct: bool = True, exclude: tuple[str, ...] = ()) -> DataFrame:
    """pages with items: the links of a list page. Only what follows container counts; a page without it is an error, not an empty list."""

    @pandas_udf(LINK)
    def items(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda s: [x for x in list_of(s, pattern) if x["id"] not in exclude])

    body = F.col(html)
    if container:
        at = F.instr(F.coalesce(body, F.lit("")), container)
        body = F.when(at > 0, F.substr(body, at)).otherwise(F.raise_error(F.lit(f"list page without {container}")).cast("string"))
    out = pages.withColumn("items", items(body))
    if not distinct:
        return out
    first = F.filter("items", lambda x, i: ~F.exists(F.slice(F.col("items"), 1, i), lambda y: y["id"] == x["id"]))
    return out.withColumn("items", first)


def decode(raw: DataFrame, content: str = "content", encoding: str = "gbk") -> DataFrame:
    """Binary pages as text; bytes that aren't of the encoding are replaced."""

    @pandas_udf(StringType())
    def text(batch: pd.Series) -> pd.Series:
        return batch.map(lambda b: b.decode(encoding, "replace") if b is not None else None)

    return raw.withColumn("html", text(F.col(content)))


def slugs(c: Column | str, pattern: str, exclude: tuple[str, ...] = ()) -> Column:
    """Distinct names of a directory page in order: no page or category marks, no numbers, two letters at least."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(pattern), 1))
    return F.filter(found, lambda x: ~x.isin("", *exclude) & ~x.rlike("^[cp][0-9]+$") & ~x.rlike("^[0-9]+$") & (F.length(x) >= 2))
