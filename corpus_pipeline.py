"""Training-data pipeline: documents to packed token windows.

quality rules -> line dedup -> MinHash near-dedup -> benchmark decontamination -> packing. Each stage works on
all that the one before kept, is written as Parquet and read again. All stages but the last return the
columns of documents; the last returns the pieces of the packed windows with their token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specmerge.llm.common import saved, table
from specmerge.llm.decontaminate import drop_contaminated
from specmerge.llm.line_dedup import dedup_lines
from specmerge.llm.near_dup import keep_one
from specmerge.llm.packing import pack
from specmerge.llm.quality_rules import keep_good
from specmerge.llm.queries import vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted rules find good."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least three of them share, but for the last one that holds the line."""
    out = dedup_lines(docs, counts=False)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 4096 tokens, each with its ids."""
    return pack(docs, tokenizer=vocabulary_path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

#: SQL can express neither the estimated rules nor the packing; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
