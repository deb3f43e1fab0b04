"""One-pass Silver, frequent keys by sketch, hash-tree diff, missing flushes."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import rows as normal
from sluice.operators import audit, dedup, skew
from sluice.sources.telemetry import ORDER_COLUMNS, load_telemetry

KEY = ["event_id"]
TIME = "ingestion_timestamp"


@pytest.fixture(scope="module")
def t(spark):
    return load_telemetry(spark, SF001)


@pytest.mark.parametrize("filter_bytes", [64 << 20, 4096, 0])
def test_written_silver_equals_dedup(spark, t, tmp_root, filter_bytes):
    holed = t.withColumn("event_id", F.when(F.col("event_id") % 90 != 0, F.col("event_id")))
    got = dedup.write_bounded(holed, f"{tmp_root}/s", KEY, ORDER_COLUMNS, TIME, partition_by=["event_date"], filter_bytes=filter_bytes)
    want = dedup.dedup_bounded(holed, KEY, ORDER_COLUMNS, TIME)
    assert normal(got.toPandas()) == normal(want.select(*got.columns).toPandas())
    assert normal(dedup.read_bounded(spark, f"{tmp_root}/s").select(*got.columns).toPandas()) == normal(got.toPandas())
    states = {r[0]: r[1] for r in spark.read.parquet(f"{tmp_root}/s").groupBy("_state").count().collect()}
    if filter_bytes:
        assert states["single"] > 900                   # these met in no shuffle
        assert states["copy"] < 80
    n = got.count()
    again = dedup.write_bounded(holed, f"{tmp_root}/s", KEY, ORDER_COLUMNS, TIME, partition_by=["event_date"])
    assert again.count() == n


def test_filter_misses_no_repeated_key(spark):
    rnd = random.Random(4)
    keys = [rnd.choice([i, i, i % 50]) for i in range(20000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    found = dedup.repeated_keys_filter(df, ["k"])
    flagged = dedup.may_repeat(df, ["k"], found, "again").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("again").alias("every"), F.bool_or("again").alias("any")).collect()
    assert all(r.every for r in flagged if r.n > 1)
    single = [r for r in flagged if r.n == 1]
    assert sum(r.any for r in single) < 0.1 * len(single)


def test_empty_tables(spark, t, tmp_root):
    got = dedup.write_bounded(t.limit(0), f"{tmp_root}/e", KEY, ORDER_COLUMNS, TIME)
    assert got.count() == 0 and got.columns == t.columns
    assert skew.frequent_keys(t.limit(0), ["game_id"], 0.1).count() == 0
    assert audit.tree_diff(t.limit(0), t.limit(0), "event_date", KEY).count() == 0


def test_frequent_keys_equal_exact_counts(spark):
    rnd = random.Random(8)
    values = [None] * 900 + [7] * 3000 + [rnd.randrange(10 ** 6) for _ in range(6000)] + [x for x in range(40) for _ in range(x)]
    rnd.shuffle(values)
    df = spark.createDataFrame([(v, "a" if v == 7 else "b") for v in values], "k long, s string").repartition(7)
    for share in (0.25, 0.05, 0.003, 0.001):
        got = {r.k: r.n_rows for r in skew.frequent_keys(df, ["k"], share).collect()}
        want = {k: n for k in set(values) if (n := values.count(k) if k is None or k < 100 else 1) >= share * len(values)}
        assert got == want
    assert {(r.k, r.s) for r in skew.frequent_keys(df, ["k", "s"], 0.2).collect()} == {(7, "a")}
    with pytest.raises(ValueError):
        skew.frequent_keys(df, ["k"], 1e-9)


def test_tree_diff_equals_table_diff(spark, t):
    e = F.col("event_id")
    other = (t.where(e % 97 != 0).withColumn("event_type", F.when(e % 120 == 7, F.lit("x")).otherwise(F.col("event_type")))
             .unionByName(t.where(e % 333 == 1))
             .unionByName(t.limit(3).withColumn("event_date", F.lit(None).cast("date"))))
    want = normal(audit.table_diff(t, other).toPandas())
    for n in (1, 64):
        assert normal(audit.tree_diff(t, other, "event_date", KEY, n_buckets=n).toPandas()) == want
    trees = [audit.hash_tree(x, "event_date", KEY) for x in (t, other)]
    assert normal(audit.tree_diff(t, other, "event_date", KEY, a_tree=trees[0], b_tree=trees[1]).toPandas()) == want
    per = {r.event_date: r for r in audit.partition_diff(*trees, "event_date").collect()}
    changed = {r.event_date for r in audit.table_diff(t, other).select("event_date").distinct().collect()}
    assert {d for d, r in per.items() if not r.is_equal} == changed
    roots = audit.tree_roots(trees[0], "event_date").agg(F.sum("n_rows")).first()[0]
    assert roots == t.count()


def test_missing_intervals(spark):
    t0 = datetime(2024, 1, 1)
    grid = [("a", t0 + timedelta(minutes=5 * i)) for i in range(12)] + [(None, t0), (None, t0 + timedelta(minutes=5)), ("c", t0)]
    gone = {("a", 0), ("a", 1), ("a", 5), ("a", 9), ("a", 10), ("a", 11), (None, 1)}
    there = [(p, at) for p, at in grid if (p, int((at - t0).seconds / 300)) not in gone] + [("zz", t0), ("c", t0)]
    schema = "producer string, at timestamp_ntz"
    got = audit.missing_intervals(spark.createDataFrame(grid, schema), spark.createDataFrame(there, schema), ["producer"], "at")
    minutes = [((r.producer or "-"), (r.first_missing - t0).seconds // 300, (r.last_missing - t0).seconds // 300, r.n_missing)
               for r in got.collect()]
    assert sorted(minutes) == [("-", 1, 1, 1), ("a", 0, 1, 2), ("a", 5, 5, 1), ("a", 9, 11, 3)]
