from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if v != v else float(f"{v:.10g}")
    if hasattr(v, "as_tuple"):
        return float(f"{float(v):.10g}")
    if isinstance(v, list):
        return tuple(map(normal, v))
    return v


def same_rows(df, relation) -> bool:
    from collections import Counter

    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    at = [relation.columns.index(c) for c in columns]
    got = Counter(tuple(normal(r[c]) for c in columns) for r in df.collect())
    want = Counter(tuple(normal(r[k]) for k in at) for r in relation.fetchall())
    return got == want
