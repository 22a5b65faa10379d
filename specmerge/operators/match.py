"""Entity resolution across sources by keys: one to one, greedy, and one to many."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import saved


def unique_pairs(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> DataFrame:
    """key and the two ids where the key is once on either side. Both sides are counted before they meet."""
    one = lambda df, c: df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias(c)).where("n = 1").drop("n")
    return one(left, left_id).join(one(right, right_id), key)


def match_ambiguity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, n_left, n_right of all keys that both sides have."""
    count = lambda df, name: df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return count(left, "n_left").join(count(right, "n_right"), key)


SIDE = ["id", "exact", "fuzzy", "signature", "ord"]


def _greedy(left: pd.DataFrame, right: pd.DataFrame) -> list[tuple]:
    """Pairs of one fuzzy group: each left row takes the only free right row of its signature, by exact key first.

    Free right rows are held by signature, and by exact key and signature: a left row costs two look-ups.
    """
    by_exact: dict[tuple, list] = {}
    by_fuzzy: dict[tuple, list] = {}
    for r in right.assign(signature=[tuple(s) for s in right["signature"]]).sort_values(["exact", "signature", "ord"]).itertuples():
        if r.exact:
            by_exact.setdefault((r.exact, r.signature), []).append(r)
        if r.fuzzy and r.fuzzy != r.exact:
            by_fuzzy.setdefault(r.signature, []).append(r)
    out = []
    for row in left.assign(signature=[tuple(s) for s in left["signature"]]).sort_values(["exact", "signature", "ord"]).itertuples():
        for free in (by_exact.get((row.exact, row.signature), []), by_fuzzy.get(row.signature, [])):
            if len(free) == 1:
                r = free[0]
                for held in (by_exact.get((r.exact, r.signature), []), by_fuzzy.get(r.signature, [])):
                    held[:] = [x for x in held if x.id != r.id]
                out.append((row.id, r.id))
                break
    return out


def greedy_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """left_id, right_id of two tables with SIDE columns, matched in order.

    Rows meet only within a fuzzy key and a signature, so that these make the groups. Where a group has one row
    on each side, the pair is decided by expressions; of the others only those with rows on both sides go to the loop.
    Both sides are saved, as long expressions make their keys, and groups are counted by aggregation.
    """
    key = F.coalesce(F.nullif(F.col("fuzzy"), F.lit("")), F.concat(F.lit("\0"), F.col("id").cast("string")))
    left, right = (saved(df.select(*SIDE).withColumn("grp", key), "keyed") for df in (left, right))
    by = ["grp", "signature"]
    count = lambda df, name: df.groupBy(*by).agg(F.count(F.lit(1)).alias(name), F.min(F.struct("id", "exact", "fuzzy")).alias(name[2:]))
    groups = saved(count(left, "n_l").join(count(right, "n_r"), by), "groups")
    reach = ((F.col("l.exact") != "") & (F.col("l.exact") == F.col("r.exact"))) | ((F.col("r.fuzzy") != "") & (F.col("r.fuzzy") != F.col("r.exact")))
    plain = groups.where((F.col("n_l") == 1) & (F.col("n_r") == 1) & reach).select(F.col("l.id").alias("left_id"), F.col("r.id").alias("right_id"))
    hard = groups.where("n_l > 1 or n_r > 1").select(*by)
    schema = f"left_id {left.schema['id'].dataType.simpleString()}, right_id {right.schema['id'].dataType.simpleString()}"
    left, right = (df.join(hard, by, "left_semi") for df in (left, right))
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))  # both sides may come from one table

    def loop_of(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_greedy(a, b.rename(columns=lambda c: c[2:])), columns=["left_id", "right_id"])

    loop = left.groupBy(*by).cogroup(right.groupBy("r_grp", "r_signature")).applyInPandas(loop_of, schema)
    return plain.unionByName(loop)


def assemble(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """left_id and right_id of every row of both sides, null where it has no partner, and n_sources."""
    lefts = left.select(F.col("id").alias("left_id")).join(pairs, "left_id", "left")
    rights = right.select(F.col("id").alias("right_id")).join(pairs, "right_id", "left_anti")
    out = lefts.unionByName(rights, allowMissingColumns=True)
    return out.withColumn("n_sources", F.col("left_id").isNotNull().cast("int") + F.col("right_id").isNotNull().cast("int"))


def append_rules(base: DataFrame, extra: DataFrame) -> DataFrame:
    """extra_id, base_id, rule of extra rows that join a base row (id, exact, fuzzy, signature, options).

    Candidates have the same exact key, or the same fuzzy key if none has. The first rule with one candidate
    decides: the same signature that isn't empty, an option in common, a base row without a signature.
    Base rows aren't used up.
    """
    b = base.select(F.col("id").alias("base_id"), F.col("exact").alias("b_exact"), F.col("fuzzy").alias("b_fuzzy"), F.col("signature").alias("b_signature"), F.col("options").alias("b_options"))
    e = extra.select(F.col("id").alias("extra_id"), "exact", "fuzzy", "signature", "options")
    exact = e.join(b, (F.col("exact") == F.col("b_exact")) & (F.col("exact") != ""))
    rest = e.join(b.select("b_exact").distinct(), F.col("exact") == F.col("b_exact"), "left_anti")
    fuzzy = rest.join(b, (F.col("fuzzy") == F.col("b_fuzzy")) & (F.col("fuzzy") != "") & (F.col("fuzzy") != F.col("exact")))
    both = exact.unionByName(fuzzy)
    rules = {
        "same": (F.size("signature") > 0) & (F.col("signature") == F.col("b_signature")),
        "option": (F.size("options") > 0) & F.arrays_overlap("options", "b_options"),
        "model": F.size("b_signature") == 0,
    }
    n = both.groupBy("extra_id").agg(*(x for k, p in rules.items() for x in (F.count_if(p).alias(f"n_{k}"), F.min(F.when(p, F.col("base_id"))).alias(k))))
    rule = F.when(F.col("n_same") == 1, "same").when(F.col("n_option") == 1, "option").when(F.col("n_model") == 1, "model")
    chosen = F.when(F.col("n_same") == 1, F.col("same")).when(F.col("n_option") == 1, F.col("option")).when(F.col("n_model") == 1, F.col("model"))
    return n.select("extra_id", chosen.alias("base_id"), rule.alias("rule")).where("rule is not null")


def unmatched(extra: DataFrame, matched: DataFrame, identity: Column, ord_col: str = "ord") -> DataFrame:
    """Rows of extra without a match, the first of each identity; rows without an identity all stay."""
    rest = extra.join(matched.select(F.col("extra_id").alias("id")), "id", "left_anti").withColumn("__id", F.nullif(identity, F.lit("")))
    first = keep(rest.where("__id is not null"), ["__id"], [ord_col, "id"])
    return first.unionByName(rest.where("__id is null")).drop("__id")


def keep(rows: DataFrame, key: list[str], order: list, last: bool = False) -> DataFrame:
    """The first, or last, row of each key by order: an aggregation, so that a hot key is a row per task."""
    best = (F.max_by if last else F.min_by)(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*(F.col(k).alias(f"__{k}") for k in key)).agg(best.alias("__row")).select("__row.*")


def upsert(previous: DataFrame, fresh: DataFrame, key: list[str], ord_col: str) -> DataFrame:
    """previous and fresh, the last row of each key at the place of the first; ord_col orders all rows and becomes that place."""
    rows = previous.withColumn("__side", F.lit(0)).unionByName(fresh.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    at = F.struct("__side", ord_col)
    out = rows.groupBy(*(F.col(k).alias(f"__{k}") for k in key)).agg(F.max_by(F.struct(*rows.columns), at).alias("__row"), F.min(at)[ord_col].alias("__first"))
    return out.select(*(F.col("__first").alias(c) if c == ord_col else F.col("__row")[c].alias(c) for c in rows.columns if c != "__side"))


def merge_ids(*lists: Column) -> Column:
    """Sorted distinct ids of arrays, joined by '|'."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.concat(*lists), lambda x: x.isNotNull() & (x != "")))), "|")


def similar_sets(left: DataFrame, right: DataFrame, left_id: str, right_id: str, least: float) -> DataFrame:
    """The two ids, common and jaccard of all pairs of sets (arrays ``w`` of distinct words) that are at least so similar; least is above 0.

    Prefix filtering: in any one order of words, two such sets share a word among the first
    n - ceil(least * n) + 1 of each. The order here is by the number of right sets that hold a word, rarest first, so that the
    commonest are compared last or never; words of no right set come before all and match nothing. Only pairs of
    sizes that allow ``least`` meet, and each is counted once, on whole sets.
    """
    often = right.select(F.explode("w").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("f"))

    def prefixes(df: DataFrame, i: str) -> DataFrame:
        known = df.select(i, F.size("w").alias("n"), F.explode("w").alias("t")).join(often, "t").groupBy(i, "n").agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("k"))
        first = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1 - (F.col("n") - F.size("k"))
        return known.where(first > 0).select(i, F.col("n").alias(f"n_{i}"), F.transform("k", lambda x: x["t"]).alias(f"k_{i}"), first.cast("int").alias("first"))

    a, b = saved(prefixes(left, left_id), "prefixes"), saved(prefixes(right, right_id), "prefixes")
    tip = lambda df, i: df.select(i, f"n_{i}", F.explode(F.slice(f"k_{i}", F.lit(1), F.col("first"))).alias("t"))
    na, nb = F.col(f"n_{left_id}"), F.col(f"n_{right_id}")
    pairs = tip(a, left_id).join(tip(b, right_id), "t").where((F.least(na, nb) >= least * F.greatest(na, nb) - 1e-9)).select(left_id, right_id).distinct()
    both = pairs.join(a.drop("first"), left_id).join(b.drop("first"), right_id)
    both = both.withColumn("common", F.size(F.array_intersect(f"k_{left_id}", f"k_{right_id}")).cast("long"))
    share = F.col("common") / (na + nb - F.col("common"))
    return both.where(share >= least).select(left_id, right_id, "common", share.alias("jaccard"))
