"""Queries of scalar operators: cleaning, numbers, keys, capacities, dates."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import capacity, dates, equality, keys, text
from ..operators import guards, match, normalize
from ..profiles import phones
from .registry import query

AS_OF = datetime.date(2000, 6, 30)
WS = r"[ \t\n\r]+"
NAME = "p_name || '(' || p_size || 'GB+256GB)'"
#: Invented tables for the query catalogue.
BRANDS = {"Brand#1": "One", "brand#2": "Two", "Brand#3": "Three"}
PATTERNS = [("Red", ["red"]), ("Hot", ["hot "]), ("Ring", ["ring"]), ("Small", ["small", "tiny"])]
HEADERS = {"PROMO": "promotion", "STANDARD": "normal", "ECON": "cheap", "MEDIUM SIZE": "middle"}


@query(r"SELECT doc_id, CASE WHEN c = '' THEN '-' ELSE c END AS clean FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(replace(text, '纠错', ''), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS c FROM documents)")
def clean_value_docs(documents):
    return documents.select("doc_id", text.clean_value("text").alias("clean"))


RESIDUE_SQL = "text"
for _p, _r in phones.RESIDUE:
    RESIDUE_SQL = f"regexp_replace({RESIDUE_SQL}, '{_p}', '{_r}', 'g')"


@query(f"SELECT doc_id, {RESIDUE_SQL} AS stripped FROM (SELECT doc_id, '更多' || source || '手机>|a，|' || replace(text, '.', '手机性能排行>|') AS text FROM documents)")
def residue_strip(documents):
    noisy = F.concat(F.lit("更多"), "source", F.lit("手机>|a，|"), F.replace("text", F.lit("."), F.lit("手机性能排行>|")))
    return documents.select("doc_id", text.strip_residue(noisy).alias("stripped"))


@query("SELECT p_partkey, try_cast(nullif(regexp_extract(p_brand, '([0-9]+(\\.[0-9]+)?)', 1), '') AS DOUBLE) AS n FROM part")
def first_number(part):
    return part.select("p_partkey", text.first_number("p_brand").alias("n"))


@query(r"SELECT o_orderkey, array_to_string(list_transform(regexp_extract_all(strftime(o_orderdate, '%Y年%m月%d日') || ' ' || o_orderpriority, '[0-9]+(\.[0-9]+)?'), lambda x: CAST(x AS DOUBLE)::BIGINT::VARCHAR), '|') AS found FROM orders")
def parse_numbers_list(orders):
    said = F.concat(F.date_format("o_orderdate", "yyyy年MM月dd日"), F.lit(" "), "o_orderpriority")
    return orders.select("o_orderkey", F.array_join(F.transform(text.numbers(said), lambda x: x.cast("long").cast("string")), "|").alias("found"))


PRICE = "CASE WHEN o_orderstatus = 'F' THEN '￥' || printf('%.2f', o_totalprice) WHEN o_orderstatus = 'O' THEN printf('%.2f', o_totalprice) || '元起' ELSE ' ¥1,' || printf('%.2f', o_totalprice) || ' ' END"


@query(f"SELECT o_orderkey, CASE WHEN regexp_full_match(p, '[0-9]+(\\.[0-9]+)?') THEN p ELSE '' END AS price FROM (SELECT o_orderkey, regexp_replace(trim({PRICE}), '[￥¥,]', '', 'g') AS p FROM orders)")
def price_normalize(orders):
    return orders.select("o_orderkey", text.price(F.expr(PRICE)).alias("price"))


@query("""SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN 'One' WHEN p_brand = 'Brand#3' THEN 'Three' WHEN lower(p_brand) = 'brand#2' THEN 'Two'
  WHEN contains(lower(p_brand), '#1') THEN 'teens' WHEN contains(lower(p_brand), 'brand') THEN 'brand' ELSE '' END AS brand FROM part""")
def brand_alias(part):
    return part.select("p_partkey", keys.normalize_brand("p_brand", BRANDS, [("teens", ["#1"]), ("brand", ["brand"])]).alias("brand"))


@query("""SELECT p_partkey, CASE WHEN contains(p_name, 'red') THEN 'Red' WHEN contains(p_name, 'hot ') THEN 'Hot' WHEN contains(p_name, 'ring') THEN 'Ring'
  WHEN contains(p_name, 'small') OR contains(p_name, 'tiny') THEN 'Small' ELSE '' END AS brand FROM part""")
def brand_derive_ordered(part):
    return part.select("p_partkey", keys.brand_of("p_name", PATTERNS).alias("brand"))


@query("""WITH m(ord, k, v) AS (VALUES (1, 'PROMO', 'promotion'), (2, 'STANDARD', 'normal'), (3, 'ECON', 'cheap'), (4, 'MEDIUM SIZE', 'middle')),
h AS (SELECT DISTINCT p_type FROM part), f AS (SELECT p_type, arg_min(v, ord) AS v FROM h JOIN m ON contains(p_type, k) OR contains(k, p_type) GROUP BY p_type)
SELECT p_type, coalesce(v, p_type) AS header, count(*) AS n_rows FROM part LEFT JOIN f USING (p_type) GROUP BY ALL""")
def header_map_fallback(part):
    return part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_rows")).select("p_type", normalize.map_header("p_type", HEADERS).alias("header"), "n_rows")


@query("""SELECT c_custkey AS id, unnest(['c_name', 'c_mktsegment', 'c_nationkey']) AS field, unnest([c_name, c_mktsegment, c_nationkey::VARCHAR]) AS value FROM customer
UNION ALL SELECT p_partkey, unnest(['p_name', 'p_brand', 'p_type']), unnest([p_name, p_brand, p_type]) FROM part""")
def unpivot_facts(customer, part):
    a = normalize.unpivot(customer.withColumnRenamed("c_custkey", "id"), ["id"], ["c_name", "c_mktsegment", "c_nationkey"])
    return a.unionAll(normalize.unpivot(part.withColumnRenamed("p_partkey", "id"), ["id"], ["p_name", "p_brand", "p_type"]))


@query("""WITH f AS (SELECT l_orderkey, l_returnflag, min((l_linenumber, l_partkey, l_suppkey)) AS o FROM lineitem GROUP BY ALL)
SELECT l_orderkey, string_agg(l_returnflag, '|' ORDER BY o) AS flags FROM f GROUP BY l_orderkey""")
def ordered_fold(lineitem):
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")))
    return lineitem.groupBy("l_orderkey").agg(text.distinct_join(F.transform(lines, lambda x: x["l_returnflag"])).alias("flags"))


@query("SELECT source, arg_max(doc_id, (length(text), -doc_id)) AS doc_id, max(length(text)) AS n_chars FROM documents GROUP BY source")
def longer_wins(documents):
    return documents.groupBy("source").agg(F.max_by("doc_id", F.struct(F.length("text"), -F.col("doc_id"))).alias("doc_id"), F.max(F.length("text")).cast("long").alias("n_chars"))


@query(f"""WITH n AS (SELECT p_partkey, lower({NAME}) AS n FROM part),
k AS (SELECT p_partkey, regexp_replace(regexp_replace(n, '[（(]([0-9]+\\s*([gt]b)?\\s*[+/]+\\s*[0-9]+\\s*[gt]b?|[0-9]+\\s*[gt]b?)[)）]', '', 'g'), '\\s+', '', 'g') AS k FROM n)
SELECT p_partkey, k AS model_key, replace(replace(k, '.', ''), '-', '') AS fuzzy_key FROM k""")
def model_key(part):
    keyed = part.select("p_partkey", keys.model_key(F.expr(NAME)).alias("model_key"))
    return keyed.withColumn("fuzzy_key", keys.fuzzy_key("model_key"))


CAPACITY = "CASE p_size % 3 WHEN 0 THEN p_name || '(' || p_size || 'GB+1TB)' WHEN 1 THEN p_name || ' (' || p_size || 'GB)' ELSE p_name || ' ' || p_size || 'TB' END"


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_size || ',1024' WHEN 1 THEN p_size::VARCHAR ELSE (p_size * 1024)::VARCHAR END AS signature FROM part")
def capacity_signature(part):
    return part.select("p_partkey", F.array_join(capacity.signature(F.expr(CAPACITY)).cast("array<string>"), ",").alias("signature"))


@query("""WITH s AS (SELECT l_orderkey, list(DISTINCT l_quantity) FILTER (WHERE l_returnflag = 'R') AS r, list(DISTINCT l_quantity) FILTER (WHERE l_returnflag = 'N') AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, len(list_intersect(r, n)) > 0 AS overlap FROM s WHERE r IS NOT NULL AND n IS NOT NULL""")
def option_sets_overlap(lineitem):
    pick = lambda f: F.collect_set(F.when(F.col("l_returnflag") == f, F.col("l_quantity")))
    sets = lineitem.groupBy("l_orderkey").agg(pick("R").alias("r"), pick("N").alias("n")).where((F.size("r") > 0) & (F.size("n") > 0))
    return sets.select("l_orderkey", F.arrays_overlap("r", "n").alias("overlap"))


@query("SELECT p_partkey, 'spu:' || p_brand || '|' || replace(p_name, ' ', '') || '|' || left(p_size::VARCHAR, 4) || '|' || left(regexp_replace(p_retailprice::DECIMAL(12,2)::VARCHAR, '[^0-9]', '', 'g'), 4) AS spu FROM part")
def spu_config_key(part):
    return part.select("p_partkey", keys.spu_key("p_brand", keys.model_key("p_name"), F.col("p_size").cast("string"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("spu"))


@query("SELECT o_orderkey, unnest(list_distinct(['id:' || o_orderkey, 'id:' || o_custkey])) AS key FROM orders")
def identity_keys_explode(orders):
    own = [F.col("o_orderkey").cast("string")]
    return orders.select("o_orderkey", F.explode(keys.identity_keys(own, keys.related_ids(F.col("o_custkey").cast("string")), [])).alias("key"))


SOC = [(r"(small|tiny)\s*(r[a-z]+)", "S-"), (r"(hot|red)\s*([a-z]+)", "H-"), (r"(ring|rod)(s)?", "")]


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'ring|rod') THEN regexp_extract(p_name, '(ring|rod)', 1) WHEN regexp_matches(p_name, '(hot|red)\\s*[a-z]+') THEN 'H-' || regexp_extract(p_name, '(hot|red)\\s*([a-z]+)', 2)
  WHEN regexp_matches(p_name, '(small|tiny)\\s*r[a-z]+') THEN 'S-' || regexp_extract(p_name, '(small|tiny)\\s*(r[a-z]+)', 2) ELSE 'none' END AS soc FROM part""")
def soc_last_match(part):
    return part.select("p_partkey", keys.extract_soc("p_name", SOC, "none").alias("soc"))


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') THEN 'colour' WHEN contains(lower(p_name), 'small') OR contains(lower(p_name), 'large') THEN 'size' ELSE 'other' END AS class FROM part""")
def keyword_classify(part):
    return part.select("p_partkey", text.keyword_class("p_name", [("colour", ["red", "blue"]), ("size", ["small", "large"])], "other").alias("class"))


DATE = "CASE o_orderstatus WHEN 'F' THEN date_format(o_orderdate, 'yyyy年MM月dd日') WHEN 'O' THEN date_format(o_orderdate, 'yyyy年M月') ELSE concat('约', date_format(o_orderdate, 'yyyy')) END"


@query("""SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, CASE WHEN o_orderstatus <> 'P' THEN month(o_orderdate) ELSE 0 END::INTEGER AS m, CASE WHEN o_orderstatus = 'F' THEN day(o_orderdate) ELSE 0 END::INTEGER AS d FROM orders""")
def partial_date_parse(orders):
    return orders.select("o_orderkey", dates.partial_date(F.expr(DATE)).alias("p")).select("o_orderkey", *(F.coalesce(f"p.{c}", F.lit(0)).alias(c) for c in "ymd"))


FUTURE = "CASE o_orderstatus WHEN 'F' THEN o_orderdate::DATE > DATE '2000-06-30' WHEN 'O' THEN year(o_orderdate) * 12 + month(o_orderdate) > 2000 * 12 + 6 ELSE year(o_orderdate) > 2000 END"


@query(f"SELECT o_orderkey, {FUTURE} AS future FROM orders")
def future_guard(orders):
    return orders.select("o_orderkey", dates.is_future(F.expr(DATE), AS_OF).alias("future"))


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE NOT ({FUTURE}) AND year(o_orderdate) >= 1996 AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)")
def publish_guard(orders, customer):
    skip = customer.where("c_acctbal < 0").select("c_custkey")
    rows = orders.withColumn("released", F.expr(DATE)).withColumn("owner", F.col("o_custkey").cast("string"))
    return guards.guard_rows(rows, as_of=AS_OF, dates=["released"], ids="owner", skip=skip).select("o_orderkey", "o_custkey")


@query("""SELECT doc_id, (lang = 'en')::INTEGER + (n_chars >= 500)::INTEGER + coalesce(quality = 1, false)::INTEGER + coalesce(toxic = 0, false)::INTEGER AS score,
  lang IS NOT NULL AND (lang = 'en')::INTEGER + (n_chars >= 500)::INTEGER + coalesce(quality = 1, false)::INTEGER + coalesce(toxic = 0, false)::INTEGER >= 3 AS valid
FROM documents LEFT JOIN labels USING (doc_id)""")
def valid_record_score(documents, labels):
    rows = documents.join(labels, "doc_id", "left")
    some = [F.col("lang") == "en", F.col("n_chars") >= 500, F.col("quality") == 1, F.col("toxic") == 0]
    return rows.select("doc_id", guards.score(some).alias("score"), guards.valid_record([F.col("lang").isNotNull()], some, 3).alias("valid"))


@query("""SELECT *, floor(least(n_text, n_label, n_long) * 100 / n_rows)::BIGINT AS percent FROM (
  SELECT count(*) AS n_rows, count(*) FILTER (WHERE trim(text) NOT IN ('', '-')) AS n_text, count(quality) AS n_label, count(*) FILTER (WHERE n_chars > 100) AS n_long FROM documents LEFT JOIN labels USING (doc_id))""")
def dataset_quality(documents, labels):
    fields = {"text": text.has_value("text"), "label": F.col("quality").isNotNull(), "long": F.col("n_chars") > 100}
    return guards.dataset_quality(documents.join(labels, "doc_id", "left"), fields)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(l_extendedprice - l_quantity * 1000) / greatest(l_extendedprice, l_quantity * 1000) <= 0.01 AS close FROM lineitem")
def equality_tolerance(lineitem):
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", equality.close_numbers("l_extendedprice", F.col("l_quantity") * 1000).alias("close"))


@query(r"""WITH d AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '')) AS w FROM documents),
b AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '')) AS w FROM benchmark),
p AS (SELECT doc_id, item_id, count(*) AS common FROM (SELECT doc_id, unnest(w) AS t FROM d) JOIN (SELECT item_id, unnest(w) AS t FROM b) USING (t) GROUP BY ALL)
SELECT doc_id, item_id, common, round(common / (len(d.w) + len(b.w) - common), 6) AS jaccard FROM p JOIN d USING (doc_id) JOIN b USING (item_id) WHERE common / (len(d.w) + len(b.w) - common) >= 0.2""")
def jaccard_tokens(documents, benchmark):
    """Pairs meet on a shared word of their prefixes."""
    side = lambda df, i: df.select(i, F.array_distinct(F.array_remove(F.split("text", WS), "")).alias("w"))
    pairs = match.similar_sets(side(documents, "doc_id"), side(benchmark, "item_id"), "doc_id", "item_id", 0.2)
    return pairs.withColumn("jaccard", F.round("jaccard", 6))


@query(r"SELECT doc_id, trim(regexp_replace(s, '\s*[、,，/|•>；;]+\s*', '|', 'g'), ' |') AS spec FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS s FROM documents)")
def spec_separators(documents):
    return documents.select("doc_id", text.clean_spec_value("内存", "text").alias("spec"))


@query("""WITH e AS (SELECT c_custkey, unnest(['NFC功能', 'NFC', '机身颜色']) AS k, unnest([c_mktsegment, c_nationkey || '|' || c_mktsegment, c_name]) AS v FROM customer)
SELECT c_custkey, c_mktsegment || '|' || c_nationkey AS nfc, c_name AS colour FROM customer""")
def alias_fold(customer):
    attrs = F.map_from_arrays(F.array(F.lit("NFC功能"), F.lit("NFC"), F.lit("机身颜色")), F.array(F.col("c_mktsegment"), F.concat_ws("|", F.col("c_nationkey").cast("string"), "c_mktsegment"), F.col("c_name")))
    folded = customer.select("c_custkey", normalize.fold_aliases(attrs).alias("a"))
    return folded.select("c_custkey", F.col("a")["NFC"].alias("nfc"), F.col("a")["手机颜色"].alias("colour"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_size || ' x ' || (p_size + 1) || ' x ' || (p_partkey % 9 + 1) || ' mm' END AS size,
  CASE WHEN p_size % 5 = 0 THEN p_size || ' mm' WHEN p_size % 2 = 1 THEN (p_size + 1) || ' mm' ELSE '' END AS width FROM part""")
def dims_compose(part):
    text_of = lambda c: c.cast("string")
    size = normalize.body_size(F.expr("if(p_size % 2 = 0, p_name, '-')"), text_of(F.col("p_size")), text_of(F.col("p_size") + 1), text_of(F.col("p_partkey") % 9 + 1))
    rows = part.select("p_partkey", "p_size", size.alias("size"))
    return rows.select("p_partkey", "size", normalize.body_width(F.expr("if(p_size % 5 = 0, cast(p_size as string), null)"), F.col("size")).alias("width"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '0.' || (p_size % 9) || 'x' WHEN 1 THEN '1倍' ELSE '' END AS zoom FROM part")
def ultrawide_style_extract(part):
    said = F.expr("case p_size % 3 when 0 then concat('超广角镜头 ', '0.', p_size % 9, ' x') when 1 then concat('1 倍, ', p_name, ' 超广角') else p_name end")
    return part.select("p_partkey", normalize.ultrawide_zoom(said).alias("zoom"))


@query("SELECT p_partkey AS id, 'part' AS kind, lower(p_brand) || '|' || p_name AS identity FROM part UNION ALL SELECT c_custkey, 'customer', lower(c_name) || '|' || lower(c_mktsegment) FROM customer")
def kind_identity(part, customer):
    a = part.select(F.col("p_partkey").alias("id"), F.lit("part").alias("kind"), keys.kind_identity(["p_brand", F.lit(" "), "p_name"], ["p_name"]).alias("identity"))
    return a.unionAll(customer.select("c_custkey", F.lit("customer"), keys.kind_identity(["c_name", "c_mktsegment"], ["c_name"])))


@query("""WITH s AS (SELECT text, string_agg(DISTINCT source, '+' ORDER BY source) AS joined, count(DISTINCT source) AS n FROM documents GROUP BY text)
SELECT md5(text) AS id, n AS n_plus, n AS n_tokens, (contains(joined, 'src0'))::BIGINT + (contains(joined, 'src1'))::BIGINT AS n_known FROM s""")
def source_token_count(documents):
    sets = documents.select(F.md5("text").alias("id"), "source").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("source")), "+").alias("joined"))
    return sets.select(
        "id",
        keys.source_count("joined").cast("long").alias("n_plus"),
        F.size(keys.tokens("joined", r"[,，+、|/]")).cast("long").alias("n_tokens"),
        F.size(keys.known_sources("joined", ["src0", "src1"])).cast("long").alias("n_known"),
    )


@query("""SELECT p_partkey, p_name AS base, CASE WHEN p_size % 2 = 0 THEN 1980 + p_size ELSE 0 END AS y_view, 1980 + p_size AS y_verify FROM part""")
def base_name_year(part):
    name = F.expr("concat(p_name, ' (', p_size, ')（版）')")
    said = F.expr("concat(if(p_size % 2 = 0, 'x', ''), 1980 + p_size, if(p_size % 2 = 0, 'y', '0'))")
    return part.select("p_partkey", keys.base_name(name).alias("base"), F.coalesce(dates.release_year(said, "view"), F.lit(0)).alias("y_view"), dates.release_year(said, "verify").alias("y_verify"))


@query("""SELECT a, b, count(*) AS n_rows FROM (SELECT CASE WHEN contains(p_name, 'red') THEN 'Red' WHEN contains(p_name, 'hot ') THEN 'Hot' WHEN contains(p_name, 'ring') THEN 'Ring' WHEN contains(p_name, 'small') OR contains(p_name, 'tiny') THEN 'Small' ELSE '' END AS a,
  CASE WHEN contains(p_name, 'ring') THEN 'Ring' WHEN contains(p_name, 'red') THEN 'Red' ELSE '' END AS b FROM part) WHERE a <> b GROUP BY ALL""")
def brand_dialects(part):
    rows = part.select(keys.brand_of("p_name", PATTERNS).alias("a"), keys.brand_of("p_name", [("Ring", ["ring"]), ("Red", ["red"])]).alias("b"))
    return rows.where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_rows"))


CELL = "CASE p_size % 8 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '-' WHEN 3 THEN '--' WHEN 4 THEN 'N/A' WHEN 5 THEN '无' WHEN 6 THEN '0.0' ELSE p_name END"


@query("SELECT p_partkey, p_size % 8 IN (0, 1, 2) AS missing, p_size % 8 IN (0, 1, 2, 3, 4, 5) AS unusable, p_size % 8 IN (3, 4, 7) AS positive, p_size % 8 IN (4, 5, 6, 7) AS filled FROM part")
def missing_predicates(part):
    cell = F.expr(CELL)
    return part.select("p_partkey", text.is_missing(cell).alias("missing"), text.is_validation_missing(cell).alias("unusable"), text.has_positive_value(cell).alias("positive"), text.has_value(cell).alias("filled"))


@query("SELECT p_partkey FROM part WHERE (p_type <> 'PROMO' OR p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')) AND 1980 + p_size >= 1996")
def scope_filter(part):
    rows = guards.scope(part, F.col("p_type"), F.col("p_brand"), "PROMO", ["Brand#1", "Brand#2", "Brand#3"])
    return rows.where(dates.release_year((F.lit(1980) + F.col("p_size")).cast("string"), "verify") >= 1996).select("p_partkey")


@query("SELECT o_orderkey, year(o_orderdate)::INTEGER AS y FROM orders WHERE o_orderstatus <> 'P' AND year(o_orderdate) >= 1998")
def admission_year(orders):
    said = F.expr("if(o_orderstatus = 'P', '待定', date_format(o_orderdate, 'yyyy年M月'))")
    return orders.select("o_orderkey", dates.release_year(said, "publish").alias("y")).where("y >= 1998")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN true ELSE day(o_orderdate) <= 9 AND year(o_orderdate) >= 2000 END AS same FROM orders""")
def validation_equal(orders):
    a = F.expr("date_format(o_orderdate, 'yyyy年MM月')")
    b = F.expr("case o_orderstatus when 'F' then date_format(o_orderdate, 'yyyy年MM月dd日') when 'O' then date_format(o_orderdate, 'yyyy-MM') else concat(date_format(o_orderdate, 'yyyy年'), if(day(o_orderdate) <= 9, '', if(month(o_orderdate) = 1, '02月', '01月'))) end")
    return orders.select("o_orderkey", equality.same_value("上市时间", a, b).alias("same"))


@query("SELECT p_partkey, p_size % 4 < 3 AS same FROM part")
def lenient_equal(part):
    a = F.expr("case p_size % 4 when 0 then p_name when 1 then '￥3,999' when 2 then '2026年03月01日' else 'IMX882 with a long tail of words' end")
    b = F.expr("case p_size % 4 when 0 then upper(replace(p_name, ' ', '  ')) when 1 then '3999.00 元' when 2 then '2026-03' else 'LYT600' end")
    return part.select("p_partkey", equality.lenient_same(a, b).alias("same"))
