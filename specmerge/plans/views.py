"""Queries of views, sources and sinks: filters, sorts, groups, pages, exports and HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators import report, view
from ..operators.view import Condition, Down, QuerySpec, ranked
from ..sources import html
from ..streaming import progress
from .registry import query


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring') OR contains(lower(p_type), 'ring') OR contains(p_size::VARCHAR, 'ring')")
def search_any_column(part):
    return part.where(view.any_column(["p_name", "p_brand", "p_type", "p_size"], "RING", names=False)).select("p_partkey")


UNITS = "concat(p_size, if(p_type = 'PROMO', 'TB', 'GB'))"


@query("SELECT p_partkey, p_size * CASE WHEN p_type = 'PROMO' THEN 1024 ELSE 1 END AS gb FROM part WHERE p_size * CASE WHEN p_type = 'PROMO' THEN 1024 ELSE 1 END BETWEEN 20 AND 20480")
def range_filter_units(part):
    rows = part.withColumn("storage", F.expr(UNITS))
    spec = QuerySpec(conditions=(Condition("storage", fields=("storage",), least=20, most=20480, tera=True),))
    return view.filtered(rows, spec).select("p_partkey", (F.col("p_size") * F.when(F.col("p_type") == "PROMO", 1024).otherwise(1)).alias("gb"))


@query("SELECT event_id FROM events WHERE event_type = 'error' OR contains(props, '7')")
def feature_filter(events):
    cells = {"event_type": F.when(F.col("event_type") == "error", "支持").otherwise("无"), "props": F.col("props")}
    return events.where(view.feature_test(cells, Condition("x", "feature", fields=("event_type",), keywords=("7",)))).select("event_id")


@query("SELECT p_partkey, contains(lower(p_name), 'ring') AS has, coalesce(n >= 12, false) AS at_least, coalesce(n <= 12, false) AS at_most, coalesce(n = 12, false) AS equal FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN p_size END AS n FROM part)")
def column_filter_ops(part):
    cell = F.expr("if(p_size % 2 = 0, concat('x', p_size), p_name)")
    ops = {"at_least": ("gte", "12"), "at_most": ("lte", "12"), "equal": ("equals", "12")}
    return part.select("p_partkey", view.column_test(F.col("p_name"), "contains", "RING").alias("has"), *(view.column_test(cell, *o).alias(k) for k, o in ops.items()))


@query("""WITH t AS (SELECT text, count(DISTINCT source) AS n, min(doc_id) AS first_id FROM documents GROUP BY text) SELECT first_id, n, row_number() OVER (ORDER BY n DESC, first_id) AS rank FROM t""")
def default_source_sort(documents):
    rows = documents.select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    sets = rows.groupBy("digest").agg(F.count_distinct("source").alias("n"), F.min("doc_id").alias("first_id")).drop("digest")
    return ranked(sets, [Down("n"), F.col("first_id")])


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN contains(o_orderpriority, 'LOW') THEN 0 WHEN contains(o_orderpriority, 'HIGH') THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey) AS rank FROM orders""")
def multi_level_custom_sort(orders):
    place = F.when(F.col("o_orderpriority").contains("LOW"), 0).when(F.col("o_orderpriority").contains("HIGH"), 1).otherwise(2)
    return ranked(orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), [place, Down("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "rank")


REP = "SELECT p_name, count(*) AS n_rows, arg_min(p_partkey, (p_retailprice, p_partkey)) AS rep_id, min(p_retailprice) AS rep_price FROM part GROUP BY p_name"


@query(REP)
def group_representative(part):
    return view.representatives(part, ["p_name"], "p_retailprice", "p_partkey")


@query(f"SELECT * FROM ({REP}) ORDER BY rep_price, p_name LIMIT 24")
def top_groups(part):
    return report.top(view.representatives(part, ["p_name"], "p_retailprice", "p_partkey"), [F.asc("rep_price"), F.asc("p_name")], 24)


@query("SELECT DISTINCT 'nation' AS facet, n_name AS value FROM nation UNION ALL SELECT DISTINCT 'brand', p_brand FROM part UNION ALL SELECT DISTINCT 'base', p_name FROM part")
def facet_values(nation, part):
    base = part.select(keys.base_name(F.concat("p_name", F.lit("（"), "p_size", F.lit("）"))).alias("base"))
    parts = [("nation", view.facet(nation, "n_name")), ("brand", view.facet(part, "p_brand")), ("base", view.facet(base, "base"))]
    out = [df.select(F.lit(name).alias("facet"), "value") for name, df in parts]
    return out[0].unionAll(out[1]).unionAll(out[2])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def page_slice(orders):
    """The third page of fifty."""
    return view.page(orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, 50)


@query("SELECT unnest(['mark', 'p_name', 'empty']) AS \"column\", unnest([true, true, false]) AS all_positive, unnest([(SELECT count(*) FILTER (WHERE p_size % 2 = 0) FROM part), (SELECT count(*) FROM part), 0]) AS n_filled UNION ALL SELECT 'mixed', false, count(*) FROM part")
def uniform_column_drop(part):
    rows = part.select("p_name", F.expr("if(p_size % 2 = 0, '支持', '-')").alias("mark"), F.expr("if(p_partkey % 2 = 0, '支持', '无')").alias("mixed"), F.lit("").alias("empty"))
    return view.uniform_columns(rows, ["mark", "p_name", "empty", "mixed"])


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE lang = 'en') AS n_en, count(*) FILTER (WHERE source = 'src0') AS n_hot, count(*) FILTER (WHERE n_chars > 5000) AS n_long FROM documents")
def kpi_counters(documents):
    return report.flags(documents, {"n_en": F.col("lang") == "en", "n_hot": F.col("source") == "src0", "n_long": F.col("n_chars") > 5000})


@query("""SELECT doc_id, doc_id || ',' || source || ',' || CASE WHEN regexp_matches(text, '[",\n\r]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END AS line FROM documents""")
def csv_escape_rows(documents):
    return documents.select("doc_id", text.csv_line(["doc_id", "source", "text"]).alias("line"))


LINKS = r"""regexp_extract_all(html, '<a href="([^"]*)"', 1)"""


@query(f"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len({LINKS}) AS n_links, array_to_string(list_sort(list_distinct({LINKS})), '|') AS links FROM pages""")
def html_title_links(pages):
    links = html.links("html")
    return pages.select("page_id", html.title("html").alias("title"), F.size(links).cast("long").alias("n_links"), F.array_join(F.array_sort(F.array_distinct(links)), "|").alias("links"))


@query(r"SELECT host, count(*) AS n_pages, count(*) FILTER (WHERE ends_with(regexp_extract(url, '^[^?#]*'), '.html')) AS n_html FROM (SELECT url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages) GROUP BY host")
def html_host(pages):
    host = text.url_host("url")
    return pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(text.allowed_url("url", host, ".html")).alias("n_html"))


@query(f"""WITH m AS (SELECT page_id, sha256(array_to_string(list_sort({LINKS}), ',')) AS mark FROM pages WHERE len({LINKS}) > 0), f AS (SELECT mark, min(page_id) AS known_page FROM m GROUP BY mark)
SELECT page_id, known_page FROM m JOIN f USING (mark) WHERE page_id <> known_page""")
def page_fingerprint_replay(pages):
    rows = pages.select(F.lit("all").alias("grp"), "page_id", html.links("html").alias("ids"))
    return progress.replayed_pages(rows, "grp", "page_id", "ids").select("page_id", "known_page")


@query(f"""WITH l AS (SELECT page_id, unnest({LINKS}) AS link, generate_subscripts({LINKS}, 1) AS pos FROM pages), f AS (SELECT page_id, link, min(pos) AS pos FROM l GROUP BY ALL)
SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM f""")
def link_rank(pages):
    return html.first_ranks(pages.select("page_id", html.links("html").alias("links")), "page_id", "links").select("page_id", F.col("item").alias("link"), "rank")


@query("""WITH p AS (SELECT p_partkey, p_brand, p_name, p_size, CASE WHEN p_size % 5 > 0 THEN 1990 + p_size % 10 END AS y FROM part), n AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT p_partkey, n, y >= 1994 IS TRUE AS in_view, (y IS NULL OR y >= 1994) AS in_publish FROM p JOIN n ON l_partkey = p_partkey WHERE p_brand <> 'Brand#1' AND contains(lower(p_name), 'r') AND p_size BETWEEN 5 AND 45""")
def filter_pipeline(part, lineitem):
    """A whole view query, with both rules for rows without a year."""
    n = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = part.select("p_partkey", "p_brand", "p_name", "p_size", F.expr("if(p_size % 5 > 0, 1990 + p_size % 10, null)").alias("y"))
    spec = QuerySpec(conditions=(Condition("size", fields=("p_size",), least=5, most=45),), columns=(("p_name", "contains", "R"),))
    rows = view.filtered(rows.where("p_brand <> 'Brand#1'"), spec).join(n, "p_partkey")
    return rows.select("p_partkey", "n", F.coalesce(F.col("y") >= 1994, F.lit(False)).alias("in_view"), (F.col("y").isNull() | (F.col("y") >= 1994)).alias("in_publish"))


@query("SELECT p_partkey, row_number() OVER (ORDER BY lower(p_brand), replace(p_name, ' ', ''), p_size, p_partkey) AS rank FROM part")
def publish_order(part):
    rows = part.select("p_partkey", F.lower("p_brand").alias("brand"), keys.model_key("p_name").alias("key"), "p_size")
    return ranked(rows, [F.col("brand"), F.col("key"), F.col("p_size"), F.col("p_partkey")]).select("p_partkey", "rank")


@query("SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rank FROM events ORDER BY 2 LIMIT 50")
def last_50(events):
    """The limit comes first: only fifty rows are numbered."""
    last = events.orderBy(F.desc("ts"), F.desc("event_id")).limit(50).select("event_id", "ts")
    return ranked(last, [Down("ts"), Down("event_id")]).select("event_id", "rank")
