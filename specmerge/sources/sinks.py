"""Writers: CSV for spreadsheets, JSON for browsers, folders that appear whole or not at all."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import csv_line
from .shared import scratch


def field_order(rows: DataFrame, attrs: str, fixed: Sequence[str], ord_col: str | None = None, rest: str = "seen") -> list[str]:
    """fixed, then the other keys of a map column, as first seen by ord_col or sorted. Keys are aggregated; there are as many as headers."""
    order = [F.col(ord_col)] if ord_col else [F.lit(0)]
    keys = rows.select(*(o.alias(f"o{i}") for i, o in enumerate(order)), F.posexplode(F.map_keys(attrs)).alias("pos", "key"))
    first = keys.groupBy("key").agg(F.min(F.struct("o0", "pos")).alias("at"))
    names = [r.key for r in first.orderBy("key" if rest == "sorted" else "at", "key").collect()]
    return [*fixed, *(n for n in names if n not in fixed)]


def flat(rows: DataFrame, attrs: str, fields: Sequence[str], missing: str) -> DataFrame:
    """A column per field of a map column; missing for cells that are null or empty."""
    cell = lambda f: F.try_element_at(F.col(attrs), F.lit(f))
    return rows.select(*(F.when(cell(f).isNull() | (cell(f) == ""), missing).otherwise(cell(f)).alias(f) for f in fields))


def csv_lines(df: DataFrame, line: str = "line") -> DataFrame:
    return df.select(csv_line(list(df.columns)).alias(line))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files in a folder, as many as tasks; for one file with a byte-order mark see export_csv."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', encoding="UTF-8")


def export_csv(df: DataFrame, file: str) -> int:
    """One file with a byte-order mark, put in place when whole; returns its rows. Tasks write the parts, which are then joined."""
    head = "\ufeff" + ",".join(_quoted(c) for c in df.columns) + "\r\n"
    return _joined(csv_lines(df), file, head, "\r\n", "")


def _quoted(x: str) -> str:
    return '"' + x.replace('"', '""') + '"' if any(c in x for c in '",\n\r') else x


def export_json(df: DataFrame, file: str) -> int:
    """One JSON array, an object per line, non-ASCII kept; written as export_csv does."""
    lines = df.select(F.concat(F.lit(","), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).alias("line"))
    return _joined(lines, file, "[", "\n", "]\n", skip=1)


def _joined(lines: DataFrame, file: str, head: str, sep: str, tail: str, skip: int = 0) -> int:
    """Write lines in parallel and join the parts, in order, between head and tail, without the first skip bytes; returns the number of lines."""
    spark, seen, parts = lines.sparkSession, Observation(), scratch(lines.sparkSession, "export")
    lines.observe(seen, F.count(F.lit(1)).alias("n")).write.option("lineSep", sep).text(parts)
    jvm, fs, folder = _store(parts)

    def copy(out) -> None:
        left = skip
        for x in sorted(x.getPath().toString() for x in fs.listStatus(folder)):
            if x.rpartition("/")[2].startswith("part-"):
                part = fs.open(jvm.org.apache.hadoop.fs.Path(x))
                if left and fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(x)).getLen():
                    part.seek(left)
                    left = 0
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
                part.close()

    _put(file, [head.encode(), copy, tail.encode()])
    fs.delete(folder, True)
    return seen.get["n"]


def _store(path: str):
    """The JVM, the file system of a path and the path, whatever store it is in."""
    spark = SparkSession.active()
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _put(file: str, parts: Iterable[bytes | Callable]) -> None:
    """Write beside the file, flush to the store, then take its place; bytes are written, functions get the stream."""
    jvm, fs, temp = _store(f"{file}.{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(file)
    try:
        out = fs.create(temp, True)
        for x in parts:
            x(out) if callable(x) else out.write(bytearray(x))
        out.hsync()
        out.close()
        over = SparkSession.active().sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri()).rename(fs.makeQualified(temp), fs.makeQualified(target), over)
    except BaseException:
        fs.delete(temp, False)
        raise


def put_file(file: str, parts: Iterable[str]) -> None:
    """One small file, whole or not at all."""
    _put(file, [x.encode("utf-8") for x in parts])


def put_record(folder: str, record: dict, key: str = "id") -> str:
    """One file per record, named by its id."""
    name = str(record[key])
    if not name or "/" in name or name.startswith("."):
        raise ValueError(f"not a file name: {name!r}")
    put_file(path := os.path.join(folder, f"{name}.json"), [json.dumps(record, ensure_ascii=False, indent=2)])
    return path


def swap_folder(staged: str, target: str) -> None:
    """Put a staged folder in place of target; the old one comes back if that fails."""
    jvm, fs, new = _store(staged)
    place, old = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(f"{target}.{uuid.uuid4().hex}")
    if not fs.exists(new):
        raise FileNotFoundError(staged)
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"{target} can't be moved")
    try:
        if not fs.rename(new, place):
            raise OSError(f"{staged} can't be moved")
    except BaseException:
        if had:
            fs.rename(old, place)
        raise
    if had:
        fs.delete(old, True)


def write_if_any(df: DataFrame, file: str) -> bool:
    """Write a CSV only if there are rows."""
    if df.isEmpty():
        return False
    export_csv(df, file)
    return True
