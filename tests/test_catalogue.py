"""Every registered query with SQL equals it on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = os.environ.get("SPECMERGE_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
Q, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


@pytest.mark.parametrize("name", [n for n in Q if n in SQL])
def test_query_equals_sql(spark, duck, name):
    df = Q[name](spark, DIR)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    rel = duck.execute(SQL[name])
    cols = [d[0] for d in rel.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(Q)


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A session started elsewhere, without PYTHONPATH."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", e.queries()["validation_equal"](spark, {DIR!r}).collect()[:1])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "rows" in out.stdout, out.stderr[-2000:]
