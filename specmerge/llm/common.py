"""Helpers that all corpus operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import importable, saved, scratch, shared_dir

__all__ = ["ASCII_SPACE", "ASCII_UPPER", "BROADCAST_BYTES", "WORD_SPLIT", "ascii_lower", "bounded_batches", "fresh", "only_ids", "same_id", "saved", "scratch", "shared_dir", "slices", "table", "words"]

#: Fixed value: the white space that separates words and is trimmed from lines.
ASCII_SPACE = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
#: Most rows and bytes of a batch that a Python worker gets.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
#: Largest table, in bytes, that any operator broadcasts after measuring it.
BROADCAST_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let workers import this package, and get at most BATCH_ROWS rows, and BATCH_BYTES, at a time; smaller settings of the session stay.

    Both are settings of the session, read when a query runs. Spark's own, ten thousand rows, are hundreds of
    megabytes of long documents for each worker and the buffers that feed it.
    """
    importable(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = _number(spark.conf.get(key))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def _number(text: str) -> int:
    """Bytes or rows of a setting."""
    digits, unit = text.rstrip("bB").rstrip("kKmMgG"), text.rstrip("bB")[-1:].lower()
    return int(digits) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(unit, 1)


def slices(batches, rows: int = 500):
    """The batches in parts of at most rows: a worker makes Python objects of one part at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def words(col):
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), WORD_SPLIT), lambda w: w != "")


def fresh(df: DataFrame, name: str) -> str:
    """name, or name with as many underscores behind it as it takes to be no column of df, in any case."""
    names = {c.lower() for c in df.columns}
    while name.lower() in names:
        name += "_"
    return name


def only_ids(docs: DataFrame, ids: DataFrame, *, keep: bool) -> DataFrame:
    """The rows of docs whose doc_id, as a number, is in the column doc_id of ids (keep), or those whose isn't; nulls equal."""
    own = fresh(docs, "__id")
    ids = ids.select(F.col("doc_id").alias(own)).distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids[own]), "left_semi" if keep else "left_anti")


def same_id(left, right):
    """Null-safe equality, so that rows without an id are kept by joins."""
    return left.eqNullSafe(right)
