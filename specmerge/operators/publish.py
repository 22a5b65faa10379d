"""Publishing that never loses an identity that was published before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_spec_value, strip_residue
from ..profiles import phones
from .normalize import fold_aliases


def missing_keys(baseline: DataFrame, candidate: DataFrame, key: str = "key") -> DataFrame:
    """Distinct keys of baseline that candidate has not."""
    return baseline.select(key).where(F.col(key).isNotNull()).distinct().join(candidate.select(key).distinct(), key, "left_anti")


def verify_superset(baseline: DataFrame, candidate: DataFrame, key: str = "key") -> None:
    lost = missing_keys(baseline, candidate, key).limit(5).collect()
    if lost:
        raise ValueError(f"candidate loses published identities, among them {[r[key] for r in lost]}")


def attach_by_config(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """candidate id and the uncovered baseline ids that join it: of the first candidate (ord) with an equal config key.

    Both: id, keys array<string>, config, ord.
    """
    covered = candidate.select(F.explode("keys").alias("key")).distinct()
    loose = baseline.select("config", F.explode("keys").alias("key")).where(F.col("key").startswith("id:")).distinct().join(covered, "key", "left_anti")
    first = candidate.groupBy("config").agg(F.min_by("id", "ord").alias("id"))
    return loose.join(first, "config").groupBy("id").agg(F.array_sort(F.collect_set(F.substr("key", F.lit(4)))).alias("attached"))


def preserve(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Ids of the baseline rows that must stay, by the order of most sources, most keys, ord: those with a key that neither candidate nor a row kept before has.

    Both: id, keys array<string>, config, n_sources, ord. Rows whose config key the candidate has are replaced
    by it. The first row of a key finds it uncovered and stays, and all later ones find it covered: a row stays
    if, and only if, it is the first of one of its keys. So this order needs no loop, only the least row of each key.
    """
    covered = candidate.select(F.explode("keys").alias("key")).distinct()
    rows = baseline.join(candidate.select("config").distinct(), "config", "left_anti")
    keys = rows.select("id", (-F.col("n_sources")).alias("a"), (-F.size("keys")).alias("b"), "ord", F.explode("keys").alias("key"))
    first = keys.join(covered, "key", "left_anti").groupBy("key").agg(F.min_by("id", F.struct("a", "b", "ord", "id")).alias("id"))
    return first.select("id").distinct()


def published(candidate: DataFrame, kept: DataFrame, diff_field: str = "交叉验证差异", *, only_if_kept: bool = False) -> DataFrame:
    """candidate and the kept baseline rows (attrs map<string,string> and equal other columns), cleaned as they are written.

    Audited headers fold, capacity fields lose marketing copy, and the text of differences loses page residue.
    only_if_kept leaves candidate as it is where nothing was kept, as a publisher does that rewrites its files only then.
    """
    at = lambda k: F.try_element_at(F.col("attrs"), F.lit(k))
    rows = candidate.unionByName(kept, allowMissingColumns=True).withColumn("attrs", fold_aliases(F.col("attrs")))
    diff = F.when(at(diff_field) == "-", "-").otherwise(strip_residue(at(diff_field)))
    cells = {**{f: clean_spec_value(f, at(f)) for f in phones.SPEC_COPY}, diff_field: diff}
    names = F.create_map(*(x for k, v in cells.items() for x in (F.lit(k), v)))
    clean = F.transform_values("attrs", lambda k, v: F.when(k.isin(*cells), F.try_element_at(names, k)).otherwise(v))
    rows = rows.withColumn("attrs", clean)
    return candidate if only_if_kept and kept.isEmpty() else rows


def require_rows(rows: DataFrame, least: int = 10) -> DataFrame:
    """rows, or an error if there are fewer than least."""
    if rows.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows: not published")
    return rows
