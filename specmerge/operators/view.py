"""Interactive queries: a declarative specification to a filtered, sorted, grouped and paged table.

``QuerySpec`` is the JSON that a view saves. Semantics that users see are kept: a row without a year is dropped by the
year filter; a cell without a number fails every comparison but ``contains``; unless a
sort asks for it, rows with more sources come first; sorting ends with the row's own order, so that pages are
stable. Text order is by Unicode collation for Chinese; numbers inside texts aren't compared as numbers.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_number, has_positive_value, is_missing
from ..sources.shared import saved
from ..sources.sinks import field_order
from .normalize import fold_nested_columns, put


@dataclass(frozen=True)
class Condition:
    """Range: a number between bounds, TB counting as 1024 GB. Feature: a positive cell of fields or with a keyword."""

    id: str
    type: str = "range"
    fields: tuple[str, ...] = ()
    least: float | None = None
    most: float | None = None
    tera: bool = False
    keywords: tuple[str, ...] = ()
    require_keyword: bool = False
    explicit: tuple[str, ...] = ("支持", "有", "是", "√")


@dataclass(frozen=True)
class Sort:
    column: str
    descending: bool = False
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class QuerySpec:
    search: str = ""
    equals: tuple[tuple[str, str], ...] = ()
    conditions: tuple[Condition, ...] = ()
    columns: tuple[tuple[str, str, str], ...] = ()
    sorts: tuple[Sort, ...] = ()
    visible: tuple[str, ...] = ()
    min_year: int | None = None

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, sort_keys=True)

    @classmethod
    def from_json(cls, text: str, known: Sequence[str] | None = None) -> QuerySpec:
        """A saved specification; columns that aren't known are left out."""
        d = json.loads(text)
        ok = lambda c: known is None or c in known
        tuples = lambda rows: tuple(tuple(r) for r in rows)
        return cls(
            search=d.get("search", ""),
            equals=tuple(r for r in tuples(d.get("equals", ())) if ok(r[0])),
            conditions=tuple(Condition(**{k: tuple(v) if isinstance(v, list) else v for k, v in c.items()}) for c in d.get("conditions", ())),
            columns=tuple(r for r in tuples(d.get("columns", ())) if ok(r[0])),
            sorts=tuple(Sort(s["column"], s.get("descending", False), tuple(s.get("order", ()))) for s in d.get("sorts", ()) if ok(s["column"])),
            visible=tuple(c for c in d.get("visible", ()) if ok(c)),
            min_year=d.get("min_year"),
        )


#: Cards that a view shows at first.
FIRST_CARDS = 24


def signature(spec: QuerySpec) -> str:
    """What a view's rows and order depend on; the visible columns don't count."""
    return replace(spec, visible=()).to_json()


@dataclass(frozen=True)
class ViewState:
    """How much of a view is shown; it begins anew with any change of filters or sorting."""

    signature: str = ""
    limit: int = FIRST_CARDS
    expanded: frozenset[str] = frozenset()

    def synced(self, spec: QuerySpec) -> ViewState:
        now = signature(spec)
        return self if now == self.signature else ViewState(now)

    def more(self, step: int = FIRST_CARDS) -> ViewState:
        return replace(self, limit=self.limit + step)

    def toggled(self, group: str) -> ViewState:
        return replace(self, expanded=self.expanded ^ {group})


def default_spec(config: Mapping, known: Sequence[str]) -> QuerySpec:
    """Specification of a view configuration: conditions that are on by default, and visible columns, or else the first 18."""
    on = [c for c in config.get("conditions", ()) if c.get("defaultEnabled")]
    conditions = tuple(
        Condition(id=c["id"], type=c.get("type", "range"), fields=tuple(c.get("fields") or [c["field"]]), least=c.get("defaultMin"), most=c.get("defaultMax"), tera=c.get("unit") == "GB", keywords=tuple(c.get("keywords", ())), require_keyword=bool(c.get("requireKeyword")))
        for c in on
    )
    visible = [c for c in config.get("defaultVisibleColumns", ()) if c in known] or list(known)[:18]
    return QuerySpec(conditions=conditions, visible=tuple(visible))


def any_column(cols: Sequence[str], text: str, names: bool = True) -> Column:
    """Whether a value, or a column's name, holds text, in any case."""
    low = text.lower()
    if names and any(low in c.lower() for c in cols):
        return F.lit(True)
    return functools.reduce(lambda a, b: a | b, (F.coalesce(F.lower(F.col(c).cast("string")).contains(low), F.lit(False)) for c in cols))


def range_test(c: Column, least: float | None, most: float | None, tera: Column | None = None) -> Column:
    n = first_number(c.cast("string"))
    if tera is not None:
        n = F.when(tera, n * 1024).otherwise(n)
    out = n.isNotNull()
    if least is not None:
        out = out & (n >= least)
    if most is not None:
        out = out & (n <= most)
    return out


def column_test(c: Column, op: str, value: str) -> Column:
    """contains on text; gte, lte and equals on the cell's first number, which must be there."""
    if op == "contains":
        return F.coalesce(F.lower(c.cast("string")).contains(value.lower()), F.lit(False))
    n, v = first_number(c.cast("string")), float(value)
    return F.coalesce({"gte": n >= v, "lte": n <= v, "equals": n == v}[op], F.lit(False))


def feature_test(cells: Mapping[str, Column], c: Condition) -> Column:
    """A positive cell whose field is of the condition, or whose text has a keyword; with require_keyword the keyword, or explicit support in the exact field."""
    tests = []
    for name, cell in cells.items():
        near = any(f in name or name in f for f in c.fields)
        text = F.lower(cell.cast("string"))
        word = functools.reduce(lambda a, b: a | b, (text.contains(k.lower()) for k in c.keywords), F.lit(False))
        if c.require_keyword:
            explicit = functools.reduce(lambda a, b: a | b, (text.contains(e) for e in c.explicit)) if name in c.fields else F.lit(False)
            hit = word | explicit
        else:
            hit = F.lit(True) if near else word
        tests.append(has_positive_value(cell.cast("string")) & F.coalesce(hit, F.lit(False)))
    return functools.reduce(lambda a, b: a | b, tests, F.lit(False))


def condition_test(df: DataFrame, c: Condition) -> Column:
    if c.type == "feature":
        return feature_test({n: F.col(n) for n in df.columns}, c)
    cells = [F.col(f) for f in c.fields if f in df.columns]
    tera = lambda x: F.lower(x.cast("string")).rlike("[0-9]\\s*tb") if c.tera else None
    return functools.reduce(lambda a, b: a | b, (range_test(x, c.least, c.most, tera(x)) for x in cells), F.lit(False))


def filtered(df: DataFrame, spec: QuerySpec, year: str | None = None) -> DataFrame:
    """Cheap tests first; all are one filter for the planner."""
    if spec.min_year is not None and year:
        df = df.where(F.col(year) >= spec.min_year)
    for c, v in spec.equals:
        df = df.where(F.col(c) == v)
    for c in spec.conditions:
        df = df.where(condition_test(df, c))
    for c, op, v in spec.columns:
        df = df.where(column_test(F.col(c), op, v))
    return df.where(any_column(df.columns, spec.search)) if spec.search else df


def sort_keys(df: DataFrame, sorts: Sequence[Sort], ord_col: str, n_sources: str | None = None) -> list[Column]:
    """More sources first unless asked for otherwise, the sorts, and the row's own order."""
    keys = [F.desc(n_sources)] if n_sources and all(s.column != n_sources for s in sorts) else []
    for s in sorts:
        c = F.col(s.column)
        side = (lambda x: x.desc_nulls_last()) if s.descending else (lambda x: x.asc_nulls_last())
        if s.order:
            place = F.lit(len(s.order))
            for i, word in reversed(list(enumerate(s.order))):
                place = F.when(F.coalesce(c.cast("string"), F.lit("")).contains(word), i).otherwise(place)
            keys.append(side(place))
        elif dict(df.dtypes)[s.column] == "string":
            keys += [side(first_number(c)), side(F.collate(c, "zh_Hans"))]
        else:
            keys.append(side(c))
    return [*keys, F.asc(ord_col)]


def page(df: DataFrame, order: Sequence[Column], number: int, size: int, total: int | None = None) -> DataFrame:
    """A page of the ordered rows; number is clamped to 1 and the last page."""
    total = df.count() if total is None else total
    number = max(1, min(number, -(-total // size)))
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def ranked(df: DataFrame, order: Sequence[Column | Down], name: str = "rank") -> DataFrame:
    """df with its place, from 1, in a total order.

    Rows are dealt by ranges of the order and numbered within each; the ranges' sizes, one number a task,
    give where each begins. No task gets all rows.
    """
    keys = [f"__o{i}" for i in range(len(order))]
    plain = [_key(c) for c in order]
    dealt = df.withColumns(dict(zip(keys, (c for c, _ in plain), strict=True)))
    by = [F.col(k).desc_nulls_last() if down else F.col(k).asc_nulls_last() for k, (_, down) in zip(keys, plain, strict=True)]
    dealt = saved(dealt.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).withColumn("key", F.lit(1))
    before = sizes.withColumn("__before", F.sum("n").over(Window.partitionBy("key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*by)) + F.coalesce("__before", F.lit(0))
    return dealt.join(before.select("__part", "__before"), "__part").withColumn(name, place.cast("long")).drop("__part", "__before", *keys)


def _key(c: Column | Down) -> tuple[Column, bool]:
    """A sort's expression and whether it is descending."""
    if isinstance(c, Down):
        return c.column, True
    return c, False


class Down:
    """A descending key of ranked()."""

    def __init__(self, c: Column | str):
        self.column = F.col(c) if isinstance(c, str) else c


def representatives(df: DataFrame, group: Sequence[str], price: str, row_id: str, highest: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """group, n_rows, and of the row with the least (or highest) price above zero its id, price and carried columns; ties go to the least id."""
    p = F.when(F.col(price) > 0, F.col(price))
    cells = F.struct(F.col(row_id).alias("rep_id"), p.alias("rep_price"), *carry)
    best = F.max_by(cells, F.struct(p.isNotNull(), p, -F.col(row_id))) if highest else F.min_by(cells, F.struct(p.isNull(), p, F.col(row_id)))
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), best.alias("__r")).select(*group, "n_rows", "__r.*")


def facet(df: DataFrame, c: str) -> DataFrame:
    """Distinct filled values of a column."""
    return df.select(F.trim(F.col(c).cast("string")).alias("value")).where(~is_missing("value")).distinct()


def uniform_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, all_positive, n_filled of each column: a view drops those whose filled cells are all a positive mark."""
    lines = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols))).alias("e")).select("e.*")
    positive = F.when(~is_missing("value"), has_positive_value("value"))
    return lines.groupBy("column").agg(F.coalesce(F.min(positive), F.lit(False)).alias("all_positive"), F.count(positive).alias("n_filled"))


def visible_columns(defaults: Sequence[str], columns: Sequence[str], hidden: Sequence[str] = ()) -> list[str]:
    """Defaults that exist, then the others as first seen, without hidden ones."""
    return [c for c in dict.fromkeys([*(d for d in defaults if d in columns), *columns]) if c not in hidden]


def initialise(rows: DataFrame, aliases: Mapping[str, str], defaults: Sequence[str], ord_col: str, *, attrs: str = "attrs", brand: str = "品牌", hidden: Sequence[str] = (), drop_uniform: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """rows with a view's columns, and their order: defaults, then as first seen.

    The brand is filled from 'brand', nested and alias columns fold, hidden columns are left out, and so are
    those of drop_uniform whose filled cells are all positive.
    """
    own = F.try_element_at(F.col(attrs), F.lit(brand))
    filled = F.when(is_missing(own), F.try_element_at(F.col(attrs), F.lit("brand"))).otherwise(own)
    base = rows.withColumn(attrs, fold_nested_columns(put(F.col(attrs), {brand: filled}), aliases))
    cells = base.select(F.explode(attrs).alias("column", "value")).where(F.col("column").isin(*drop_uniform) & (F.col("value") != ""))
    uniform = [r.column for r in cells.groupBy("column").agg(F.min(has_positive_value("value")).alias("all")).where("all").collect()]
    shown = visible_columns(defaults, field_order(base, attrs, [], ord_col), [*hidden, *uniform])
    return base.select(*(c for c in rows.columns if c != attrs), *(F.try_element_at(F.col(attrs), F.lit(c)).alias(c) for c in shown)), shown


def run(df: DataFrame, spec: QuerySpec, ord_col: str, n_sources: str | None = None, year: str | None = None) -> DataFrame:
    """Filter, sort and project; visible is empty for all columns."""
    out = filtered(df, spec, year).orderBy(*sort_keys(df, spec.sorts, ord_col, n_sources))
    return out.select(*spec.visible) if spec.visible else out


