"""Readers of JSON records, folders, archives and CSV.

A record is a row (file, row_ord, attrs) with attrs a map in the file's key order. Paths go through Spark's readers; only the
strict and archive readers, which need the bytes as they are, read single files on the driver or as binary
rows.
"""

from __future__ import annotations

import datetime
import io
import json
import re
import zipfile
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ATTRS = "array<map<string,string>>"
ENVELOPES = ("items", "data", "records")
RECORD = "file string, row_ord int, attrs map<string,string>"


def rows_of(c: Column) -> Column:
    """Records of a JSON text: a list, a list in an envelope, or one object."""
    text = F.trim(c)
    inside = F.coalesce(*(F.from_json(F.get_json_object(text, f"$.{k}"), ATTRS) for k in ENVELOPES))
    single = F.array(F.from_json(text, "map<string,string>"))
    return F.when(text.startswith("["), F.from_json(text, ATTRS)).otherwise(F.coalesce(inside, F.when(text.startswith("{"), single)))


def read_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Records of JSON files; a path without files gives none, and a file that isn't JSON gives none."""
    try:
        files = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], RECORD)
    return files.select("file", F.posexplode(rows_of(F.col("value"))).alias("row_ord", "attrs")).where("attrs is not null")


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """Records of files that must be lists of objects; anything else fails the query."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    parsed = F.when(F.trim("value").startswith("["), F.from_json("value", ATTRS))
    bad = parsed.isNull() | F.exists(parsed, lambda x: x.isNull())
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not a list of objects: "), "file")).cast(ATTRS)).otherwise(parsed)
    return files.select("file", F.posexplode(checked).alias("row_ord", "attrs"))


def strict_json(text: str) -> Any:
    """JSON without repeated keys, NaN, Infinity and numbers that become infinite; ValueError otherwise."""

    def pairs(items):
        out = dict(items)
        if len(out) != len(items):
            raise ValueError("repeated key")
        return out

    def number(x: str) -> float:
        value = float(x)
        if value in (float("inf"), float("-inf")):
            raise ValueError(f"number out of range: {x}")
        return value

    def constant(x: str):
        raise ValueError(f"not a JSON number: {x}")

    return json.loads(text, object_pairs_hook=pairs, parse_constant=constant, parse_float=number)


def data_files(names: Sequence[str], skip: Sequence[str] = ("progress", "manifest")) -> list[str]:
    """names without bookkeeping files, unless nothing else is there."""
    left = [n for n in names if not any(s in n.rsplit("/", 1)[-1] for s in skip)]
    return left or list(names)


def newest(files: Sequence[tuple[str, float]]) -> str | None:
    """Path of the latest of (path, time), by the date in its name if all have one."""
    files = [(n, t) for n, t in files if n in set(data_files([n for n, _ in files]))]
    dated = [(re.findall(r"20[0-9]{6}", n.rsplit("/", 1)[-1]), t, n) for n, t in files]
    if not files:
        return None
    if all(d for d, _, _ in dated):
        return max((d[-1], t, n) for d, t, n in dated)[2]
    return max((t, n) for n, t in files)[1]


def load_order(path: Column) -> Column:
    """Order of data files: by the last date in the name, plain names after numbered ones, then the name."""
    name = F.regexp_extract(path, "[^/]*$", 0)
    dates = F.regexp_extract_all(name, F.lit("[0-9]{8}"), 0)
    return F.struct(F.coalesce(F.try_element_at(dates, F.lit(-1)), F.lit("")).alias("date"), (~name.rlike("^[0-9]+_")).alias("plain"), name.alias("name"))


def dedupe(records: DataFrame, latest: bool = False, ids: Sequence[str] = ("手机ID", "id", "型号", "name")) -> DataFrame:
    """One record of each id, the first, or with latest the last at the first's place; records without an id all stay."""
    at = lambda k: F.nullif(F.regexp_replace(F.lower(F.try_element_at("attrs", F.lit(k))), r"(?U)\s+", ""), F.lit(""))
    key = F.coalesce(*(at(k) for k in ids))
    rows = records.withColumn("__key", key).withColumn("__ord", F.struct(load_order(F.col("file")).alias("f"), "row_ord"))
    w = Window.partitionBy("__key")
    rows = rows.withColumn("place", F.min("__ord").over(w)).withColumn("__n", F.row_number().over(w.orderBy(F.desc("__ord") if latest else F.asc("__ord"))))
    kept = rows.where("__key is null or __n = 1")
    return kept.withColumn("place", F.when(F.col("__key").isNull(), F.col("__ord")).otherwise(F.col("place"))).drop("__key", "__ord", "__n")


def read_latest(spark: SparkSession, manifest: str, key: str = "latest", fallback: Sequence[dict[str, str]] = ()) -> DataFrame:
    """Records of the file that a manifest names, beside it; the fallback rows if either can't be read."""
    try:
        row = spark.read.text(manifest, wholetext=True).select(F.get_json_object("value", f"$.{key}").alias("name")).first()
    except AnalysisException:
        row = None
    out = read_records(spark, f"{manifest.rsplit('/', 1)[0]}/{row.name}") if row and row.name else spark.createDataFrame([], RECORD)
    if out.isEmpty() and fallback:
        texts = spark.createDataFrame([(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(fallback)], "row_ord int, value string")
        return texts.select(F.lit("").alias("file"), "row_ord", F.from_json("value", "map<string,string>").alias("attrs"))
    return out


def skip_ids(spark: SparkSession, path: str, key: str = "skip_phone_ids") -> DataFrame:
    """id of a list file; no file, or none that can be read, is an empty list."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "id string")
    return text.select(F.explode(F.from_json(F.get_json_object("value", f"$.{key}"), "array<string>")).alias("id")).select(F.trim("id").alias("id")).where("id <> ''").distinct()


def csv_rows(spark: SparkSession, path: str) -> int:
    """Records of a CSV file with a header; line breaks in quotes don't count."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"').count()


#: Limits of an archive.
ARCHIVE = {"bytes": 50 << 20, "members": 2000, "member_bytes": 2 << 20, "total_bytes": 100 << 20}


def archive_records(data: bytes, valid: Callable[[str, dict], bool], limits: dict[str, int] = ARCHIVE) -> list[dict]:
    """Records of a zip of one-record JSON files; ValueError if any member isn't as it must be: nothing of it is used then."""
    if len(data) > limits["bytes"]:
        raise ValueError("archive too large")
    out, seen, total = [], set(), 0
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        members = [m for m in z.infolist() if not m.is_dir()]
        if len(members) > limits["members"]:
            raise ValueError("too many members")
        for m in members:
            parts = m.filename.replace("\\", "/").split("/")
            total += m.file_size
            if m.filename.startswith("/") or ".." in parts or ":" in parts[0] or m.file_size > limits["member_bytes"] or total > limits["total_bytes"]:
                raise ValueError(f"member not allowed: {m.filename}")
            name = parts[-1].removesuffix(".json")
            if name in seen or not parts[-1].endswith(".json"):
                raise ValueError(f"member repeated or not JSON: {m.filename}")
            seen.add(name)
            record = strict_json(z.read(m).decode("utf-8"))
            if not isinstance(record, dict) or not valid(name, record):
                raise ValueError(f"record not valid: {m.filename}")
            out.append(record)
    return out


def first_valid(artifacts: Sequence[dict], load: Callable[[dict], list[dict]], *, prefix: str, branch: str, run: str, now: datetime.datetime) -> list[dict] | None:
    """Records of the newest artifact that is whole; those that aren't are passed over, errors of transport are not."""
    fit = [a for a in artifacts if a["name"].startswith(prefix) and not a.get("expired") and a.get("branch") == branch and str(a.get("run")) != run and a["created_at"] <= now]
    for a in sorted(fit, key=lambda a: a["created_at"], reverse=True):
        try:
            return load(a)
        except (ValueError, zipfile.BadZipFile):
            continue
    return None
