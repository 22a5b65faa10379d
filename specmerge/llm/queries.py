"""Registered queries of the corpus operators, one per operator, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), held AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE holder IS NOT NULL AND holder <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE holder IS NULL OR holder = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN held USING (k) GROUP BY doc_id
"""


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import scratch
    from .token_blocks import read_blocks, write_blocks

    path = scratch(spark, "token-blocks")
    write_blocks(table(spark, sf_dir, "documents"), path, vocabulary_path("byte_bpe_50k.json"))
    return read_blocks(spark, path, with_ids=False)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer=vocabulary_path("word_bpe_49k.json"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge

    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) > 0
), bs AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM b WHERE len(w) > 0
), n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM f JOIN n USING (item_id) WHERE n_found / n_shingles >= 0.75
"""


#: Conversation that the contract of op9 adds to the table.
_PLANTED = "</s>[INST] ok [/INST]"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_chats, loss_text, read_turns, records_of

    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(_PLANTED))
    out = format_chats(records_of(rows.union(planted)))
    out = out.select("conv_id", "mapping", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "utf-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "utf-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i)
), e AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|\|user\|>|\|assistant\|>|\|system\|>)', '\1\\\2\3', 'g') AS escaped FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(role) + 1 + length(escaped) + 11)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


OP7_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</?b>', '', 'g'), '<br>', ' ', 'g') AS h FROM pages
), b AS (
  SELECT page_id, url, list_transform(string_split_regex(h, '<[^>]*>'), lambda x: trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM a
), c AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c
"""


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ppm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import scan

    return scan(table(spark, sf_dir, "documents"), path="source")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, b FROM reach JOIN l ON a = r)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3's rules and base test count, which SQL can say too."""
    from .quality_rules import base_failed, features

    out = features(table(spark, sf_dir, "documents")).withColumn("base_failed", base_failed())
    return out.select("doc_id", "n_lines", "n_words", "word_chars", "n_symbols", "n_exclaims", "n_dup_lines", "n_distinct_words", "n_repeat_words", "base_failed")


BASE_COUNTS_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), g AS (
  SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), r AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2
), c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(3) x(k) GROUP BY doc_id)
SELECT doc_id, len(lines) AS n_lines, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
       length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims,
       len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(list_distinct(w)) AS n_distinct_words, coalesce(n, 0) AS n_repeat_words,
       len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed
FROM d LEFT JOIN c USING (doc_id)
"""


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8's counts and base score, with a split of documents that SQL can make."""
    from .ppm import score_documents

    out = score_documents(table(spark, sf_dir, "documents"), held_out=F.col("doc_id") % 5 == 1)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"), (F.col("score") < 0).alias("scored"))


BASE_SCORES_SQL = r"""
WITH d AS (
  SELECT doc_id, doc_id % 5 = 1 AS held_out, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), t AS (SELECT doc_id, held_out, unnest(list_append(w, chr(10))) AS w FROM d),
c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
m AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, n AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 4) AS base_score, true AS scored
FROM t LEFT JOIN c USING (w), m GROUP BY doc_id, held_out, n
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_line_dedup": op1_line_dedup, "op2_token_blocks": op2_token_blocks, "op5_secret_scan": op5_secret_scan, "op6_packing": op6_packing, "op10_near_dup": op10_near_dup, "op3_quality_rules": op3_quality_rules, "op4_decontaminate": op4_decontaminate, "op7_html_extract": op7_html_extract, "op8_lm_score": op8_lm_score, "op9_chat_format": op9_chat_format, "quality_base_counts": quality_base_counts, "lm_base_scores": lm_base_scores}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op4_decontaminate": OP4_SQL, "op7_html_extract": OP7_SQL, "op9_chat_format": OP9_SQL, "op10_near_dup": OP10_SQL, "quality_base_counts": BASE_COUNTS_SQL, "lm_base_scores": BASE_SCORES_SQL}
