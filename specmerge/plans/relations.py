"""Queries of relational operators: keep and upsert, matching, agreement, reports, publishing, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import capacity, keys
from ..operators import agree, enrich, match, publish, report
from ..operators.view import Down, ranked
from ..profiles import phones
from ..sources.shared import saved
from ..streaming import progress
from .registry import query


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def keep_first(events):
    return match.keep(events, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def keep_last(events):
    return match.keep(events, ["user_id", "event_type"], ["ts", "event_id"], last=True).select("user_id", "event_type", "event_id", "value")


HALF = "2024-01-16"
UPSERT_SQL = """WITH e AS (SELECT *, (ts >= TIMESTAMP '2024-01-16')::INTEGER AS side FROM events)
SELECT user_id, event_type, arg_max(value, (side, event_id)) AS value, arg_min(event_id, (side, event_id)) AS place FROM e GROUP BY ALL"""


def _halves(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = events.select("user_id", "event_type", "value", F.col("event_id").alias("place"), (F.col("ts") < F.lit(HALF).cast("timestamp_ntz")).alias("old"))
    return rows.where("old").drop("old"), rows.where("not old").drop("old")


@query(UPSERT_SQL)
def upsert_position(events):
    previous, fresh = _halves(events)
    return match.upsert(previous, fresh, ["user_id", "event_type"], "place").select("user_id", "event_type", "value", "place")


@query(UPSERT_SQL)
def cumulative_upsert(events):
    """The same by aggregation, as a running table is kept: each batch adds one row per key."""
    previous, fresh = _halves(events)
    state = progress.merge_state(progress.state_of(previous, 0), progress.state_of(fresh, 1))
    return state.select("user_id", "event_type", "value", "place")


@query("""WITH r(p_type, ord) AS (VALUES ('PROMO', 0), ('LARGE', 1), ('SMALL', 2))
SELECT p_partkey, row_number() OVER (ORDER BY ord NULLS LAST, p_retailprice DESC, p_partkey) AS rank FROM part LEFT JOIN r USING (p_type)""")
def rank_priority_order(part):
    ordinal = F.coalesce(F.try_element_at(F.create_map(F.lit("PROMO"), F.lit(0), F.lit("LARGE"), F.lit(1), F.lit("SMALL"), F.lit(2)), F.col("p_type")), F.lit(9))
    return ranked(part.select("p_partkey", "p_type", "p_retailprice"), [ordinal, Down("p_retailprice"), F.col("p_partkey")]).select("p_partkey", "rank")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND year(o_orderdate) = 2001)")
def incremental_anti(customer, orders):
    done = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("2002-01-01").cast("timestamp_ntz")))
    return customer.select("c_custkey").join(done.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


def _sides(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parts as two sources of the same names."""
    rows = part.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_size").alias("name"), "p_name", "p_size", "p_type", "p_brand")
    return rows.where("id % 2 = 0"), rows.where("id % 2 = 1")


SIDES = "WITH s AS (SELECT p_partkey AS id, p_name || ' ' || p_size AS name, p_name, p_size, p_type, p_partkey % 2 AS odd FROM part), l AS (SELECT * FROM s WHERE odd = 0), r AS (SELECT * FROM s WHERE odd = 1)"


@query(f"{SIDES} SELECT name, min(l.id) AS left_id, min(r.id) AS right_id FROM l JOIN r USING (name) GROUP BY name HAVING count(*) = 1")
def unique_match_1to1(part):
    left, right = _sides(part)
    return match.unique_pairs(left.withColumnRenamed("id", "left_id"), right.withColumnRenamed("id", "right_id"), "name", "left_id", "right_id")


def _keyed(df: DataFrame, name: Column, memory: Column | None = None, storage: Column | None = None) -> DataFrame:
    exact = keys.model_key(name)
    out = df.select("id", exact.alias("exact"), capacity.signature(name, memory, storage).alias("signature"), F.col("id").alias("ord"), (capacity.options(name, memory, storage) if memory is not None else F.array(capacity.signature(name))).alias("options"))
    return out.withColumn("fuzzy", keys.fuzzy_key("exact"))


@query(f"""{SIDES}, k AS (SELECT odd, id, replace(p_name, ' ', '') AS key, p_type FROM s),
g AS (SELECT key || p_type AS g, count(*) FILTER (WHERE odd = 0) AS nl, count(*) FILTER (WHERE odd = 1) AS nr, min(id) FILTER (WHERE odd = 0) AS l, min(id) FILTER (WHERE odd = 1) AS r FROM k GROUP BY 1)
SELECT g.l AS left_id, g.r AS right_id FROM g WHERE nl >= 1 AND nr = 1""")
def greedy_match(part):
    """A right row that is alone in its key goes to the first left row; ambiguous ones stay."""
    left, right = (_keyed(x, F.concat("p_name", "p_type")) for x in _sides(part))
    return match.greedy_match(left, right)


@query(f"""{SIDES}, lk AS (SELECT id, replace(lower(p_name || p_type), ' ', '') AS k FROM l), rk AS (SELECT id, replace(lower(p_name || p_type), ' ', '') || CASE WHEN id % 4 = 1 THEN '-x' ELSE '' END AS e FROM r),
f AS (SELECT id, e, replace(e, '-', '') AS k FROM rk), c AS (SELECT k, count(*) AS n, min(id) AS id FROM f WHERE e <> k GROUP BY k)
SELECT lk.id AS left_id, c.id AS right_id FROM lk JOIN c ON lk.k || 'x' = c.k WHERE c.n = 1""")
def fuzzy_match(part):
    """Left rows meet right rows whose fuzzy key differs from their exact key."""
    left, right = _sides(part)
    left = _keyed(left, F.concat("p_name", "p_type", F.lit("x")))
    right = _keyed(right, F.concat(F.col("p_name"), F.col("p_type"), F.when(F.col("id") % 4 == 1, "-x").otherwise("")))
    index = right.where("fuzzy <> exact").groupBy(F.col("fuzzy").alias("exact")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("right_id")).where("n = 1")
    return left.join(index, "exact").select(F.col("id").alias("left_id"), "right_id")


@query(f"""{SIDES}, u AS (SELECT name, min(l.id) AS left_id, min(r.id) AS right_id FROM l JOIN r USING (name) GROUP BY name HAVING count(*) = 1),
a AS (SELECT l.id AS left_id, u.right_id FROM l LEFT JOIN u ON u.left_id = l.id UNION ALL SELECT NULL, r.id FROM r WHERE r.id NOT IN (SELECT right_id FROM u))
SELECT coalesce(left_id, -1) AS left_id, coalesce(right_id, -1) AS right_id, ((left_id IS NOT NULL)::INTEGER + (right_id IS NOT NULL)::INTEGER) AS n_sources FROM a""")
def full_outer_assembly(part):
    left, right = _sides(part)
    pairs = match.unique_pairs(left.withColumnRenamed("id", "left_id"), right.withColumnRenamed("id", "right_id"), "name", "left_id", "right_id").drop("name")
    out = match.assemble(left, right, pairs)
    return out.select(F.coalesce("left_id", F.lit(-1)).alias("left_id"), F.coalesce("right_id", F.lit(-1)).alias("right_id"), "n_sources")


NAMED = "p_name || ' ' || p_type || CASE WHEN p_size % 3 = 0 THEN '(' || (p_size % 4 + 1) || 'GB+256GB)' ELSE '' END"
APPEND = f"""WITH s AS (SELECT p_partkey AS id, replace(lower(p_name || p_type), ' ', '') AS k, CASE WHEN p_size % 3 = 0 THEN p_size % 4 + 1 END AS sig FROM part),
b AS (SELECT * FROM s WHERE id % 2 = 0), e AS (SELECT * FROM s WHERE id % 2 = 1),
m AS (SELECT e.id AS extra_id, count(*) FILTER (WHERE e.sig = b.sig) AS n1, min(b.id) FILTER (WHERE e.sig = b.sig) AS m1, count(*) FILTER (WHERE b.sig IS NULL) AS n3, min(b.id) FILTER (WHERE b.sig IS NULL) AS m3 FROM e JOIN b USING (k) GROUP BY e.id),
r AS (SELECT extra_id, CASE WHEN n1 = 1 THEN m1 WHEN n3 = 1 THEN m3 END AS base_id, CASE WHEN n1 = 1 THEN 'same' WHEN n3 = 1 THEN 'model' END AS rule FROM m)"""


def _base_extra(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = part.select(F.col("p_partkey").alias("id"), F.expr(NAMED).alias("name"))
    rows = saved(_keyed(rows, F.col("name"), F.lit(""), F.lit("")), "keys")  # long expressions, used by every rule
    return rows.where("id % 2 = 0"), rows.where("id % 2 = 1")


@query(f"{APPEND} SELECT * FROM r WHERE rule IS NOT NULL")
def append_three_rules(part):
    return match.append_rules(*_base_extra(part))


@query(f"""{APPEND} SELECT id AS extra_id, k AS exact FROM e WHERE id NOT IN (SELECT extra_id FROM r WHERE rule IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1""")
def unmatched_extras(part):
    base, extra = _base_extra(part)
    return match.unmatched(extra, match.append_rules(base, extra), F.col("exact")).select(F.col("id").alias("extra_id"), "exact")


FIELDS = ["quantity", "discount", "tax"]
PIVOT = """WITH m AS (SELECT l_orderkey, l_returnflag AS f, max(l_quantity) AS quantity, max(l_discount) AS discount, max(l_tax) AS tax FROM lineitem GROUP BY ALL),
v AS (SELECT l_orderkey, count(*) AS n, list((quantity, discount, tax) ORDER BY f) AS v, list(f ORDER BY f) AS names FROM m GROUP BY 1)"""
SAME2 = "(v[1][1] = v[2][1] AND v[1][2] = v[2][2] AND v[1][3] = v[2][3])"


def _sources(lineitem: DataFrame) -> DataFrame:
    per = lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.max("l_quantity").alias("quantity"), F.max("l_discount").alias("discount"), F.max("l_tax").alias("tax"))
    names = F.array(*(F.lit(f) for f in FIELDS))
    cells = lambda s: F.map_from_arrays(names, F.array(*(s[f].cast("string") for f in FIELDS)))
    rows = F.sort_array(F.collect_list(F.struct("l_returnflag", *FIELDS)))
    return per.groupBy("l_orderkey").agg(F.transform(rows, lambda s: F.struct(s["l_returnflag"].alias("name"), cells(s).alias("attrs"))).alias("sources"))


def _equal(field, a, b):
    return F.coalesce(a == b, F.lit(False))


@query(f"{PIVOT} SELECT l_orderkey, CASE WHEN {SAME2} THEN '双源一致' ELSE '双源差异' END AS status FROM v WHERE n = 2")
def agreement_two(lineitem):
    rows = _sources(lineitem).where(F.size("sources") == 2)
    return agree.classify(rows, "l_orderkey", fields=FIELDS, same=_equal).select("l_orderkey", "status")


@query(f"""{PIVOT}, e AS (SELECT l_orderkey, n, (n >= 2 AND {SAME2})::INTEGER + (n = 3 AND v[1][1] = v[3][1] AND v[1][2] = v[3][2] AND v[1][3] = v[3][3])::INTEGER + (n = 3 AND v[2][1] = v[3][1] AND v[2][2] = v[3][2] AND v[2][3] = v[3][3])::INTEGER AS eq FROM v)
SELECT l_orderkey, CASE WHEN n = 1 THEN '单源' WHEN n = 2 THEN CASE eq WHEN 1 THEN '双源一致' ELSE '双源差异' END ELSE CASE eq WHEN 3 THEN '三源一致' WHEN 0 THEN '三源差异' ELSE '双源一致' END END AS status FROM e""")
def agreement_three(lineitem):
    return agree.classify(_sources(lineitem), "l_orderkey", fields=FIELDS, same=_equal).select("l_orderkey", "status")


@query(f"""{PIVOT} SELECT l_orderkey, CASE WHEN v[1][1] = v[2][1] THEN v[1][1]::VARCHAR ELSE names[1] || ': ' || v[1][1] || ' | ' || names[2] || ': ' || v[2][1] END AS quantity FROM v WHERE n = 2 AND names = ['A', 'R']""")
def merged_value(lineitem):
    rows = _sources(lineitem).where((F.size("sources") == 2) & (F.get("sources", F.lit(0))["name"] == "A") & (F.get("sources", F.lit(1))["name"] == "R"))
    a, b = (F.get("sources", F.lit(i))["attrs"]["quantity"] for i in (0, 1))
    return rows.select("l_orderkey", agree.merged_cell(a, b, ["A", "R"], same=lambda x, y: x == y).alias("quantity"))


ORDER_DIFF = """WITH l AS (SELECT o_custkey, max(o_orderstatus) AS s, count(*)::VARCHAR AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
r AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS s, arg_max(day(o_orderdate)::VARCHAR, o_orderkey) AS n FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),
d AS (SELECT l.o_custkey, unnest(['s', 'n']) AS field, unnest([l.s, l.n]) AS left_value, unnest([r.s, r.n]) AS right_value FROM l JOIN r USING (o_custkey))"""


def _order_diff(orders: DataFrame) -> DataFrame:
    left = orders.where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("s"), F.count(F.lit(1)).cast("string").alias("n"))
    right = orders.where("o_orderpriority = '5-LOW'").select("o_custkey", F.col("o_orderstatus").alias("s"), F.dayofmonth("o_orderdate").cast("string").alias("n"), "o_orderkey")
    return report.field_diff(left, right, "o_custkey", ["s", "n"], "o_orderkey")


@query(f"{ORDER_DIFF} SELECT * FROM d WHERE left_value <> right_value")
def field_diff_report(orders):
    return _order_diff(orders)


@query(f"{ORDER_DIFF} SELECT field, count(*) AS n_rows FROM d WHERE left_value <> right_value GROUP BY field")
def diff_rows_count(orders):
    return report.counts(_order_diff(orders), "field", "field")


def _by_digest(documents: DataFrame) -> DataFrame:
    """documents with the digest of each text for the text: groups by text then shuffle digests, not texts."""
    return documents.select("doc_id", "source", "lang", F.length("text").alias("len"), F.sha2("text", 256).alias("text"))


SETS = "WITH t AS (SELECT text, list(DISTINCT source ORDER BY source) AS sources, count(*) AS n_rows, min(doc_id) AS first_id FROM documents GROUP BY text)"


@query("SELECT source, count(*) AS n_rows FROM documents GROUP BY source")
def source_counts(documents):
    return report.counts(documents, F.array("source"), "source", array=True)


@query("SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'good' WHEN quality = 1 THEN 'toxic' WHEN quality = 0 THEN 'bad' ELSE 'unlabelled' END AS status, count(*) AS n_rows FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def status_counts(documents, labels):
    rows = documents.select("doc_id").join(labels, "doc_id", "left")
    status = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "good").when(F.col("quality") == 1, "toxic").when(F.col("quality") == 0, "bad").otherwise("unlabelled")
    return report.counts(rows, status, "status")


@query(f"{SETS} SELECT array_to_string(sources, '+') AS combo, count(*) AS n_rows FROM t GROUP BY 1")
def source_combos(documents):
    return report.combos(report.source_sets(_by_digest(documents), ["text"], "source"), F.col("sources"))


@query(f"{SETS} SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(sources) > 1) AS n_multi, count(*) FILTER (WHERE len(sources) = 1) AS n_single, round(n_multi * 100.0 / count(*), 2) AS multi_rate, round(n_single * 100.0 / count(*), 2) AS single_rate FROM t")
def multi_single_rate(documents):
    return report.multi_single(report.source_sets(_by_digest(documents), ["text"], "source"), F.col("n_sources"))


@query("""WITH f AS (SELECT text, lang, count(DISTINCT source) AS n FROM documents GROUP BY ALL), b AS (SELECT lang, length(text) AS len, count(DISTINCT source) AS nb FROM documents GROUP BY ALL)
SELECT CASE WHEN n > 1 THEN 'several' WHEN nb > 1 THEN 'gap' ELSE 'only' END AS cause, count(*) AS n_rows FROM f JOIN b ON f.lang = b.lang AND length(f.text) = b.len GROUP BY 1""")
def identity_cause_split(documents):
    """Texts that one source has: their base, here language and length, may have others."""
    rows = _by_digest(documents)
    full = rows.groupBy("text", "lang", "len").agg(F.count_distinct("source").alias("n"))
    base = rows.select("lang", "len", "source").distinct().groupBy("lang", "len").agg(F.count(F.lit(1)).alias("nb"))
    cause = F.when(F.col("n") > 1, "several").when(F.col("nb") > 1, "gap").otherwise("only")
    return report.counts(full.join(base, ["lang", "len"]), cause, "cause")


@query(f"{SETS}, l AS (SELECT unnest(sources) AS source, len(sources) = 1 AS alone FROM t) SELECT source, count(*) AS n_covered, count(*) FILTER (WHERE alone) AS n_alone, round(n_alone * 100.0 / n_covered, 2) AS single_rate FROM l GROUP BY source")
def per_source_single_rate(documents):
    return report.per_source_rates(report.source_sets(_by_digest(documents), ["text"], "source"))


@query("SELECT field, count(*) AS n_rows FROM (SELECT unnest(CASE p_size % 4 WHEN 0 THEN ['屏幕'] WHEN 1 THEN ['屏幕', '电池'] WHEN 2 THEN ['摄像头参数', '内存'] ELSE [] END) AS field FROM part) GROUP BY field")
def diff_field_counts(part):
    said = F.expr("case p_size % 4 when 0 then '屏幕: A=1; B=2' when 1 then '屏幕: A=x；y; B=z；电池: A=1; B=2' when 2 then '摄像头参数: A=视频: 4K；前置视频: 2K; B=-；内存: A=8; B=9' else '-' end")
    return report.diff_field_counts(part.select(said.alias("text")), "text")


@query("""WITH s AS (SELECT l_partkey, list(DISTINCT l_quantity) FILTER (WHERE l_returnflag = 'R') AS r, list(DISTINCT l_quantity) FILTER (WHERE l_returnflag = 'A') AS a FROM lineitem GROUP BY 1)
SELECT signal, count(*) AS n_rows FROM (SELECT CASE WHEN len(list_intersect(r, a)) > 0 THEN 'mergeable' WHEN r IS NOT NULL AND a IS NOT NULL THEN 'conflict' ELSE 'none' END AS signal FROM s) GROUP BY signal""")
def conflict_signals(lineitem):
    pick = lambda f: F.collect_set(F.when(F.col("l_returnflag") == f, F.col("l_quantity")))
    sets = lineitem.groupBy("l_partkey").agg(pick("R").alias("r"), pick("A").alias("a"))
    return report.counts(sets, F.coalesce(report.signals(F.col("r"), F.col("a")), F.lit("none")), "signal")


@query("""WITH f AS (SELECT p_name, p_size, min(p_brand) AS brand FROM part GROUP BY ALL HAVING count(DISTINCT p_brand) = 1), b AS (SELECT p_name, count(DISTINCT p_brand) AS n_base_sources FROM part GROUP BY 1)
SELECT p_size, p_name, n_base_sources FROM f JOIN b USING (p_name) WHERE n_base_sources > 1""")
def merge_gap(part):
    return report.merge_gap(part, ["p_size"], "p_name", "p_brand")


@query("SELECT c_nationkey, count(*) AS n_rows FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top_single(customer):
    return report.top(report.counts(customer, "c_nationkey", "c_nationkey"), [F.desc("n_rows"), F.asc("c_nationkey")], 20)


@query("SELECT p_brand AS brand, count(*) AS n_rows FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def brand_top10(part):
    return report.top(report.counts(part, F.coalesce("p_brand", F.lit("未知")), "brand"), [F.desc("n_rows"), F.asc("brand")], 10)


OLD = "(SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT' AND year(o_orderdate) = 2001)"


def _candidate(orders: DataFrame) -> DataFrame:
    return orders.where((F.col("o_orderpriority") != "1-URGENT") & (F.year("o_orderdate") == 2001)).select(F.col("o_custkey").alias("c_custkey")).distinct()


@query(f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {OLD})")
def superset_missing(customer, orders):
    return publish.missing_keys(customer, _candidate(orders), "c_custkey")


@query(f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {OLD})")
def preserve_baseline(customer, orders):
    """Customers as a baseline with one key each: those that the candidate lacks stay."""
    as_rows = lambda df: df.select(F.col("c_custkey").alias("id"), F.array(F.concat(F.lit("id:"), F.col("c_custkey").cast("string"))).alias("keys"), F.concat(F.lit("spu:"), F.col("c_custkey").cast("string")).alias("config"), F.lit(1).alias("n_sources"), F.col("c_custkey").alias("ord"))
    return publish.preserve(as_rows(customer), as_rows(_candidate(orders))).select(F.col("id").alias("c_custkey"))


@query("""WITH k AS (SELECT o_orderkey AS id, o_custkey % 200 AS a, extract(doy FROM o_orderdate) AS b, o_totalprice AS p FROM orders WHERE o_orderpriority <> '1-URGENT'),
c AS (SELECT DISTINCT o_custkey % 200 AS a, extract(doy FROM o_orderdate) AS b FROM orders WHERE o_orderpriority = '1-URGENT'),
e AS (SELECT id, p, 'a' || a AS key FROM k WHERE a NOT IN (SELECT a FROM c WHERE a % 3 = 0) UNION ALL SELECT id, p, 'b' || b FROM k WHERE b NOT IN (SELECT b FROM c WHERE b % 3 = 0))
SELECT DISTINCT arg_max(id, (p, -id)) AS o_orderkey FROM e GROUP BY key""")
def preserve_shared_keys(orders):
    """Orders as a baseline whose rows share two kinds of keys, by price; urgent ones are the candidate that covers some."""
    kinds = [F.concat(F.lit("a"), (F.col("o_custkey") % 200).cast("string")), F.concat(F.lit("b"), F.dayofyear("o_orderdate").cast("string"))]
    rows = orders.select(F.col("o_orderkey").alias("id"), F.array(*kinds).alias("keys"), F.col("o_orderkey").cast("string").alias("config"), F.col("o_totalprice").alias("n_sources"), F.col("o_orderkey").alias("ord"), "o_orderpriority")
    urgent = rows.where("o_orderpriority = '1-URGENT'")
    known = urgent.withColumn("keys", F.filter("keys", lambda k: F.substr(k, F.lit(2)).cast("int") % 3 == 0))
    return publish.preserve(rows.where("o_orderpriority <> '1-URGENT'"), known).select(F.col("id").alias("o_orderkey"))


@query("""WITH s AS (SELECT p_partkey AS id, p_name AS f, p_size % 3 AS sig, p_brand AS e FROM part WHERE p_size % 3 < 2),
l AS (SELECT *, row_number() OVER (PARTITION BY f, sig ORDER BY e, id) AS k FROM s WHERE id % 5 > 0),
r AS (SELECT f, sig, min(id) AS id, count(*) AS n FROM s WHERE id % 5 = 0 GROUP BY ALL)
SELECT l.id AS left_id, r.id AS right_id FROM l JOIN r USING (f, sig) WHERE n = 1 AND k = 1""")
def greedy_contention(part):
    """Left rows contend for the right row that is alone in its fuzzy key and signature: the first in order of exact key and place has it."""
    rows = part.where("p_size % 3 < 2").select(F.col("p_partkey").alias("id"), F.concat("p_name", F.lit("#"), "p_brand").alias("exact"), F.col("p_name").alias("fuzzy"), F.array((F.col("p_size") % 3).cast("string")).alias("signature"), F.col("p_partkey").alias("ord"))
    return match.greedy_match(rows.where("id % 5 > 0"), rows.where("id % 5 = 0").withColumn("exact", F.concat("exact", F.lit("-"))))


@query(f"""WITH c AS (SELECT min(c_custkey) AS id, c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM {OLD}) GROUP BY c_nationkey),
l AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {OLD}))
SELECT id, count(*) AS n_attached, min(c_custkey) AS first_attached FROM l JOIN c USING (c_nationkey) GROUP BY id""")
def coverage_anti(customer, orders):
    as_rows = lambda df: df.select(F.col("c_custkey").alias("id"), F.array(F.concat(F.lit("id:"), F.col("c_custkey").cast("string"))).alias("keys"), F.col("c_nationkey").alias("config"), F.col("c_custkey").alias("ord"))
    candidate = customer.join(_candidate(orders), "c_custkey", "left_semi")
    out = publish.attach_by_config(as_rows(customer), as_rows(candidate))
    return out.select("id", F.size("attached").cast("long").alias("n_attached"), F.array_min(F.transform("attached", lambda x: x.cast("long"))).alias("first_attached"))


@query("""WITH k AS (SELECT c_mktsegment, arg_min(c_name, c_custkey) AS hit FROM customer WHERE c_nationkey < 5 GROUP BY 1)
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_name ELSE coalesce(hit, '-') END AS answer, c_nationkey % 2 = 0 AS known_before, c_nationkey % 2 = 1 AND hit IS NULL AS pending FROM customer LEFT JOIN k USING (c_mktsegment)""")
def cache_join(customer):
    cache = customer.where("c_nationkey < 5").groupBy("c_mktsegment").agg(F.min_by("c_name", "c_custkey").alias("answer"))
    rows = customer.select("c_custkey", "c_mktsegment", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).otherwise("-").alias("answer"))
    return enrich.with_cache(rows, cache, "c_mktsegment", "answer").select("c_custkey", "answer", "known_before", "pending")


@query("""WITH q AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, count(*) AS times FROM conversations WHERE role = 'assistant' AND turn <= 2 GROUP BY 1), j AS (SELECT q.conv_id AS asked, times FROM q FULL JOIN a USING (conv_id))
SELECT count(*) FILTER (WHERE times IS NULL) AS n_missing, count(*) FILTER (WHERE asked IS NULL) AS n_foreign, count(*) FILTER (WHERE times > 1) AS n_repeated, n_missing + n_foreign + n_repeated = 0 AS valid FROM j""")
def plan_response_apply(conversations):
    asked, answered = conversations.where("role = 'user'"), conversations.where("role = 'assistant' and turn <= 2")
    return enrich.exact_cover(asked, answered, "conv_id")


@query("""WITH f AS (SELECT p_brand, p_type, p_name, min(p_partkey) AS o, count(*) AS n FROM part GROUP BY ALL),
g AS (SELECT p_brand, p_type, sum(n)::BIGINT AS n_rows, array_to_string(list(p_name ORDER BY o)[1:8], '|') AS samples FROM f GROUP BY ALL)
SELECT p_partkey, n_rows, samples AS samples_answer FROM part JOIN g USING (p_brand, p_type)""")
def soc_group_propagate(part):
    asked = enrich.requests(part, ["p_brand", "p_type"], "p_name", "p_partkey").withColumn("samples", F.array_join("samples", "|"))
    out = enrich.propagate(part.join(asked.select("p_brand", "p_type", "n_rows"), ["p_brand", "p_type"]), asked, ["p_brand", "p_type"], "samples")
    return out.select("p_partkey", "n_rows", "samples_answer")


@query("""SELECT source, lang, count(*) AS n_rows, count(DISTINCT text) AS n_texts FROM documents GROUP BY ALL ORDER BY n_rows DESC, source, lang LIMIT 30""")
def series_sources(documents):
    groups = _by_digest(documents).groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("text").alias("n_texts"))
    return report.top(groups, [F.desc("n_rows"), F.asc("source"), F.asc("lang")], 30)


@query("WITH r AS (SELECT text, source || CASE WHEN lang = 'en' THEN '+x' ELSE '' END AS raw FROM documents), k AS (SELECT text, count(DISTINCT raw) AS n FROM r GROUP BY 1) SELECT count(*) AS n_keys, count(*) FILTER (WHERE n = 1) AS n_single, count(*) FILTER (WHERE n > 1) AS n_multi FROM k")
def raw_source_singles(documents):
    """Distinct raw source texts are counted, so that a lone A+B is a single."""
    raw = _by_digest(documents).select("text", F.concat("source", F.when(F.col("lang") == "en", "+x").otherwise("")).alias("raw"))
    n = raw.groupBy("text").agg(F.count_distinct("raw").alias("n"))
    return n.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n") == 1).alias("n_single"), F.count_if(F.col("n") > 1).alias("n_multi"))


@query(f"""{PIVOT} SELECT count(*) AS n_rows, count(*) FILTER (WHERE n = 2 AND NOT {SAME2}) AS n_differ, count(*) FILTER (WHERE n = 1) AS n_single FROM v WHERE n <= 2""")
def discrepancy_counts(lineitem):
    status = agree.classify(_sources(lineitem).where(F.size("sources") <= 2), "l_orderkey", fields=FIELDS, same=_equal)
    return report.flags(status, {"n_differ": F.col("status").contains("差异"), "n_single": F.col("status") == phones.STATUS["single"]})


@query("""WITH g AS (SELECT l_orderkey, list(l_shipdate::DATE::VARCHAR || CASE WHEN l_quantity > 25 THEN ' 8英寸' ELSE '' END) AS v FROM lineitem GROUP BY 1)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(list_filter(v, lambda x: contains(x, '英寸'))) > 0 AND len(list_filter(v, lambda x: NOT contains(x, '英寸'))) > 0) AS n_size FROM g""")
def missing_side_patterns(lineitem):
    said = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.when(F.col("l_quantity") > 25, " 8英寸").otherwise(""))
    sides = lineitem.groupBy("l_orderkey").agg(F.collect_list(said).alias("v"))
    return report.flags(sides, {"n_size": report.some_but_not_all(F.col("v"), "[0-9]+英寸")})


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE quality = 1) AS n_good, count(*) FILTER (WHERE toxic = 1) AS n_toxic, round(n_good * 100.0 / n_rows, 2) AS good_rate FROM labels")
def flag_summary(labels):
    out = report.flags(labels, {"n_good": F.col("quality") == 1, "n_toxic": F.col("toxic") == 1})
    return out.withColumn("good_rate", F.round(F.col("n_good") * 100.0 / F.col("n_rows"), 2))


@query("""WITH u AS (SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS good, count(*) FILTER (WHERE event_type = 'error') AS bad FROM events GROUP BY 1)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE good > bad) AS n_usable, sum(good)::BIGINT AS total_good, sum(bad)::BIGINT AS total_bad, round(sum(good) * 100.0 / (sum(good) + sum(bad)), 1) AS rate FROM u""")
def user_success_rate(events):
    error = F.col("event_type") == "error"
    return report.success_rate(events.groupBy("user_id").agg(F.count_if(~error).alias("good"), F.count_if(error).alias("bad")), "good", "bad")


@query("""SELECT page_id, coalesce(nullif(regexp_extract(trim(url), '^([a-zA-Z][a-zA-Z0-9+.-]*)?://([^/?#]+)'), '') || '/***', '<invalid-url>') AS shown, base64(encode(url)) AS coded, url AS decoded FROM pages""")
def url_redaction(pages):
    from ..functions.text import decode_base64, encode_base64, redact_url

    return pages.select("page_id", redact_url("url").alias("shown"), encode_base64("url").alias("coded"), decode_base64(encode_base64("url")).alias("decoded"))


@query("SELECT r_regionkey AS id, r_name AS name, 'region' AS kind, -1 AS parent FROM region UNION ALL SELECT n_nationkey, n_name, 'nation', n_regionkey FROM nation UNION ALL SELECT c_custkey, c_name, 'customer', c_nationkey FROM customer")
def ragged_union(region, nation, customer):
    a = region.select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name"), F.lit("region").alias("kind"))
    b = nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.lit("nation").alias("kind"), F.col("n_regionkey").alias("parent"))
    c = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"), F.col("c_nationkey").alias("parent"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c).fillna({"parent": -1})


@query("""WITH e AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 2 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 0 END AS side, '{"k": ' || (event_id % 3) || '}' AS p FROM events),
s AS (SELECT user_id, side, list_sort(list_distinct(list(event_type))) AS kinds, count(*) AS total, arg_max(event_type, event_id) AS kind, min(event_id) AS page, count(*) FILTER (WHERE event_type = 'error') AS errors FROM e GROUP BY ALL),
l AS (SELECT user_id, count(*) AS n_types FROM (SELECT DISTINCT user_id, unnest(kinds) FROM s) GROUP BY 1)
SELECT user_id, n_types, max(total) AS total, arg_min(kind, side) AS kind, CASE WHEN count(*) = 1 OR count(DISTINCT kinds) = 1 THEN min(page) END AS page, bool_and(errors > 0) AS done, min(side) AS near FROM s JOIN l USING (user_id) GROUP BY user_id, n_types""")
def progress_merge(events):
    """Three slices of the events as three progress states of each user; the types are the plan."""
    side = F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), 2).when(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(0)
    states = events.groupBy("user_id", side.alias("side")).agg(
        F.array_sort(F.collect_set("event_type")).alias("kinds"),
        F.count(F.lit(1)).alias("total"),
        F.max_by("event_type", "event_id").alias("kind"),
        F.min("event_id").alias("page"),
        (F.count_if(F.col("event_type") == "error") > 0).alias("done"),
    )
    states = states.withColumn("plan", F.col("kinds")).withColumn("near", F.col("side"))
    out = progress.merge_sides(states, ["user_id"], "side", lists=["kinds"], totals=["total"], cursor=["page"], plan="plan", done="done")
    return out.select("user_id", F.size("kinds").cast("long").alias("n_types"), "total", "kind", "page", "done", "near")


@query("""WITH d AS (SELECT user_id, ts::DATE::VARCHAR AS day, event_id, event_type = 'error' AS bad FROM events)
SELECT user_id, coalesce(min({'day': day, 'event_id': event_id}) FILTER (WHERE bad), max({'day': day, 'event_id': event_id})).day AS day,
       coalesce(min({'day': day, 'event_id': event_id}) FILTER (WHERE bad), max({'day': day, 'event_id': event_id})).event_id AS event_id,
       count(*) FILTER (WHERE bad) > 0 AS again, count(*) FILTER (WHERE bad) AS n_failed FROM d GROUP BY 1""")
def failure_cursor(events):
    rows = events.select("user_id", F.to_date("ts").cast("string").alias("day"), "event_id", (F.col("event_type") == "error").alias("bad"))
    return progress.cursors(rows, ["user_id"], ["day", "event_id"], F.col("bad"))


@query("""WITH p AS (SELECT user_id, dayofmonth(ts) AS page, count(*) FILTER (WHERE event_type <> 'view') AS n FROM events GROUP BY ALL),
b AS (SELECT *, coalesce(sum(n) OVER w, 0) AS before, coalesce(min(n) OVER w, 1) AS least FROM p WHERE page <= 20 WINDOW w AS (PARTITION BY user_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, page, n FROM b WHERE n > 0 AND least > 0 AND before < 15""")
def scan_pages(events):
    pages = events.groupBy("user_id", F.dayofmonth("ts").alias("page")).agg(F.count_if(F.col("event_type") != "view").alias("n"))
    return progress.scanned(pages, ["user_id"], "page", "n", wanted=5, most_pages=20)


@query("""WITH f AS (SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL)
SELECT user_id, day, n AS n_attempts, CASE WHEN n >= 3 THEN 'retry-exhausted' ELSE 'retry' END AS state FROM f""")
def retry_state(events):
    return progress.retry_states(events.where("event_type = 'error'").select("user_id", F.to_date("ts").cast("string").alias("day")), ["user_id", "day"])


@query("SELECT source, arg_max(doc_id, (n_chars, doc_id)) AS doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0 GROUP BY source")
def newest_valid(documents, labels):
    valid = documents.join(labels.where("quality = 1 and toxic = 0"), "doc_id", "left_semi")
    return valid.groupBy("source").agg(F.max_by("doc_id", F.struct("n_chars", "doc_id")).alias("doc_id"))


@query("SELECT event_id, hour(ts) * 60 + minute(ts) BETWEEN 480 AND 750 OR hour(ts) * 60 + minute(ts) BETWEEN 780 AND 1320 AS open FROM events")
def crawl_window(events):
    from ..functions.dates import in_window

    return events.select("event_id", (in_window("ts", "08:00", "12:30") | in_window("ts", "13:00", "22:00")).alias("open"))


@query("SELECT event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE value > 5 AND user_id <> 0 GROUP BY 1")
def artifact_candidates(events):
    valid = events.where((F.col("value") > 5) & (F.col("user_id") != 0))
    return match.keep(valid, ["event_type"], ["ts", "event_id"], last=True).select("event_type", "event_id")
