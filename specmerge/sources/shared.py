"""The folder that driver and executors share, tables written there to end a lineage, and the package's place."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the session; a temporary one only where it names none and all runs on this machine."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("on a cluster, set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="specmerge-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


#: Paths that this process made, for clean().
_MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clean(spark: SparkSession) -> int:
    """Delete the scratch tables that this process made, and return how many; DataFrames that read them are void then."""
    jvm, n = spark.sparkContext._jvm, 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n


def saved(df: DataFrame, name: str, *, small: bool = False) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, lost executors lose nothing.

    small: rows are few for the tasks that make them; they are put in at most two files a core. Each file costs
    two more processes where a store is a local folder, and a request or more elsewhere.
    """
    path = scratch(df.sparkSession, name)
    (df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism) if small else df).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder they start in.

    On machines that don't have it there, it must be installed or sent with --py-files.
    """
    environment = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
