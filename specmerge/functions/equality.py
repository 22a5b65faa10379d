"""When two sources say the same in different words.

``same_value`` is the conservative test that decides agreement; ``lenient_same`` is the generous one that only
chooses the text of a merged cell. Both are expressions; only compatibility normalisation runs in Arrow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profiles import phones
from .dates import same_granularity
from .text import col, nfkc_casefold, strip, strip_residue


def found(c: Column, pattern: str, group: int = 0) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), group))


def meet(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


def within(a: Column, b: Column, share: float) -> Column:
    """Whether some number of a and some of b differ by at most share of the larger."""
    return F.exists(a, lambda x: F.exists(b, lambda y: F.abs(x - y) / F.greatest(x, y, F.lit(1e-300)) <= share))


def close_numbers(a: Column | str, b: Column | str, share: float = 0.01) -> Column:
    return F.abs(col(a) - col(b)) / F.greatest(F.abs(col(a)), F.abs(col(b))) <= share


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements: 1 if both are empty, 0 if one is."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def length_ratio(a: Column | str, b: Column | str) -> Column:
    la, lb = F.length(strip(a)), F.length(strip(b))
    return F.when((la == 0) & (lb == 0), 1.0).when((la == 0) | (lb == 0), 0.0).otherwise(F.least(la, lb) / F.greatest(la, lb))


def normalized(c: Column | str) -> Column:
    return F.regexp_replace(F.replace(strip_residue(strip(nfkc_casefold(col(c)))), F.lit("纠错"), F.lit("")), r"(?U)\s+", "")


def _loose_date(c: Column) -> Column:
    p = r"((?:19|20)[0-9]{2})[^0-9]*([0-9]{1,2})?[^0-9]*([0-9]{1,2})?"
    part = lambda k: F.when(c.rlike(p), F.coalesce(F.regexp_extract(c, p, k).try_cast("int"), F.lit(0)))
    return F.struct(part(1).alias("y"), part(2).alias("m"), part(3).alias("d"))


def _battery(a: Column, b: Column) -> list[tuple[Column, Column]]:
    sets = [found(x, r"(?iU)[0-9]+\s*mAh") for x in (a, b)]
    values = [F.transform(s, lambda x: F.regexp_extract(x, "[0-9]+", 0).cast("double")) for s in sets]
    removable = [x.contains("可拆卸") & ~x.contains("不可拆卸") for x in (a, b)]
    one = (F.size(sets[0]) > 0) != (F.size(sets[1]) > 0)
    return [(meet(*sets), F.lit(True)), (within(*values, 0.01), F.lit(True)), (one, removable[0] == removable[1])]


def _camera(a: Column, b: Column) -> list[tuple[Column, Column]]:
    return [(meet(found(a, r"(?U)[0-9]+\s*万像素"), found(b, r"(?U)[0-9]+\s*万像素")), F.lit(True))]


def _screen(a: Column, b: Column) -> list[tuple[Column, Column]]:
    size = [found(x, r"(?U)[0-9]+(?:\.[0-9]+)?\s*英寸") for x in (a, b)]
    material = [found(x, phones.SCREEN_MATERIAL) for x in (a, b)]
    hz = [found(x, r"(?U)[0-9]+\s*Hz") for x in (a, b)]
    sized = [F.size(s) > 0 for s in size]
    told = [s | (F.size(m) > 0) for s, m in zip(sized, material, strict=True)]
    blank = [x.rlike(r"(?U)^\s*--") & ~t for x, t in zip((a, b), told, strict=True)]
    first = [F.regexp_extract(x, r"(?U)([0-9]+(?:\.[0-9]+)?)\s*英寸", 1).try_cast("double") for x in (a, b)]
    return [
        ((blank[0] & told[1]) | (blank[1] & told[0]), F.lit(True)),
        ((sized[0] != sized[1]) & meet(*material), F.lit(True)),
        (sized[0] & sized[1] & (F.abs(first[0] - first[1]) <= 0.1) & meet(*hz), F.lit(True)),
    ]


def _release(a: Column, b: Column) -> list[tuple[Column, Column]]:
    years = [F.array_sort(found(x, "(20[0-9]{2})年", 1)) for x in (a, b)]
    month = [F.regexp_extract(x, r"(?U)20[0-9]{2}年[,，]?\s*([0-9]+)月", 1) for x in (a, b)]
    day = [F.regexp_extract(x, r"(?U)20[0-9]{2}年[,，]?\s*[0-9]{1,2}月\s*([0-9]{1,2})日", 1) for x in (a, b)]
    same = (F.size(years[0]) > 0) & (years[0] == years[1])
    grain = ((month[0] != "") != (month[1] != "")) | ((month[0] != "") & (month[0] == month[1]) & ((day[0] != "") != (day[1] != "")))
    return [(same & grain, F.lit(True))]


def _processor(a: Column, b: Column) -> list[tuple[Column, Column]]:
    core = [F.lower(F.regexp_replace(F.regexp_extract(x, "(?iU)" + phones.PROCESSOR_CORE, 1), r"(?U)\s+", "")) for x in (a, b)]
    return [((core[0] != "") & (core[1] != "") & (core[0].contains(core[1]) | core[1].contains(core[0])), F.lit(True))]


def compatible(field: Column | str, left: Column, right: Column) -> Column:
    """Rules in order, the first that holds decides; raw texts are compared, so that 256GB isn't 256 GB. Of a field that is named only its rules are planned."""
    a, b = F.coalesce(left, F.lit("")), F.coalesce(right, F.lit(""))
    rules = [(meet(found(a, r"(?iU)[0-9]+\s*[GT]B"), found(b, r"(?iU)[0-9]+\s*[GT]B")), F.lit(True)), *_battery(a, b)]
    rules.append((meet(found(a, r"(?U)[0-9]+(?:\.[0-9]+)?\s*英寸"), found(b, r"(?U)[0-9]+(?:\.[0-9]+)?\s*英寸")), F.lit(True)))
    for name, more in (("摄像头参数", _camera), ("屏幕", _screen), ("上市时间", _release), ("处理器", _processor)):
        if isinstance(field, Column):
            rules += [((field == name) & when, then) for when, then in more(a, b)]
        elif field == name:
            rules += more(a, b)
    out = F.lit(False)
    for when, then in reversed(rules):
        out = F.when(F.coalesce(when, F.lit(False)), then).otherwise(out)
    return left.isNotNull() & right.isNotNull() & out


def same_value(field: Column | str, left: Column | str, right: Column | str) -> Column:
    """Whether two sources' values of a field agree."""
    left, right = col(left), col(right)
    a, b = normalized(left), normalized(right)
    equal = a == b
    if isinstance(field, Column) or field == "上市时间":
        # dates are found before white space goes, as it parts the numbers
        dates = [_loose_date(F.replace(strip_residue(strip(nfkc_casefold(x))), F.lit("纠错"), F.lit(""))) for x in (left, right)]
        is_date = dates[0]["y"].isNotNull() & dates[1]["y"].isNotNull()
        equal = F.when(is_date & (field == "上市时间" if isinstance(field, Column) else F.lit(True)), (dates[0] == dates[1]) | same_granularity(*dates)).otherwise(equal)
    return F.coalesce(equal, F.lit(False)) | compatible(field, left, right)


#: Words of a specification that matter.
KEYWORDS = [
    r"[A-Z]{2,}[0-9]+[A-Z]*", r"[A-Za-z]+[- ]?[0-9]+[A-Za-z]*", r"[0-9]+\.?[0-9]*[GM]Hz", r"[0-9]+[GM]B",
    r"[0-9]+\.?[0-9]*\s*(?:英寸|寸|mm|ppi|nits|Hz)", r"[0-9]+\.?[0-9]*[x×][0-9]+",
]


def core_keywords(c: Column | str, patterns: list[str] = KEYWORDS) -> Column:
    text = F.coalesce(col(c), F.lit(""))
    words = F.flatten(F.array(*(F.regexp_extract_all(text, F.lit("(?i)" + p), 0) for p in patterns)))
    return F.array_distinct(F.transform(words, lambda w: F.replace(F.replace(F.upper(w), F.lit(" "), F.lit("")), F.lit("×"), F.lit("X"))))


def lenient_same(left: Column | str, right: Column | str) -> Column:
    """Equal without white space and case; or alike in keywords and length; or equal first numbers, or year and month."""
    a, b = (F.coalesce(col(c), F.lit("")) for c in (left, right))
    squeezed = [F.lower(F.regexp_replace(x, r"(?U)\s+", "")) for x in (a, b)]
    alike = (jaccard(core_keywords(a), core_keywords(b)) >= 0.5) & (length_ratio(a, b) >= 0.3)
    bare = [F.regexp_extract(F.regexp_replace(x, "[￥¥,]", ""), r"[0-9]+\.?[0-9]*", 0).try_cast("double") for x in (a, b)]
    date = r"([0-9]{4})[年\-,.\s]*([0-9]{1,2})[月\-,.\s]*"
    months = [F.when(x.rlike(date), F.concat_ws("-", F.regexp_extract(x, date, 1), F.regexp_extract(x, date, 2))) for x in (a, b)]
    rest = F.coalesce(F.abs(bare[0] - bare[1]) < 0.01, F.lit(False)) | F.coalesce(months[0] == months[1], F.lit(False))
    return (squeezed[0] == squeezed[1]) | alike | rest
