import glob
import os
import sys
from collections import Counter

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.fixture(scope="session")
def same_rows():
    """Rows of a DataFrame and of a SQL result as equal bags, columns by name."""

    def check(df, relation):
        names = sorted(df.columns)
        assert names == sorted(relation.columns)
        a = Counter(tuple(r[c] for c in names) for r in df.collect())
        at = [relation.columns.index(c) for c in names]
        b = Counter(tuple(r[i] for i in at) for r in relation.fetchall())
        assert a == b

    return check
