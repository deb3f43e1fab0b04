import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sluice.session import DEFAULT_CONF

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.driver.memory", "8g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from sluice.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)          # the configured shared folder; a temp one only if unset
    yield s
    s.stop()


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="sluice-test-")


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
