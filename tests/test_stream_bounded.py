"""Keyed streaming dedup: equal to the batch operator, no row lost, state that ends."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sluice.operators import audit, dedup
from sluice.sources.telemetry import COLUMNS, ORDER_COLUMNS, START_DATE, load_telemetry
from sluice.streaming import bounded

KEY = ["event_id"]
TIME = "ingestion_timestamp"


@pytest.fixture(scope="module")
def t(spark):
    return load_telemetry(spark, SF001)


def drain(spark, root, schema, delay, max_files=None, lifetime=144):
    """Split what has landed, and deduplicate the rows on time."""
    bounded.split_by_clock(spark.readStream.schema(schema).parquet(f"{root}/landing/*"), f"{root}/bronze",
                           f"{root}/ckpt-split", TIME, delay)
    rows = bounded.on_time_stream(spark, f"{root}/bronze", schema, max_files)
    return bounded.run_keyed_dedup(rows, f"{root}/out", f"{root}/ckpt-dedup", KEY, ORDER_COLUMNS, TIME,
                                   lifetime_hours=lifetime, delay_hours=delay)


def result(spark, root, schema):
    return bounded.read_deduplicated(spark, f"{root}/out", schema, KEY, ORDER_COLUMNS, TIME).select(*schema.fieldNames())


def test_in_order_with_late_rows_and_ending_state(spark, t, tmp_root):
    parts = t.withColumn("drop", F.floor(F.datediff("event_date", F.lit(START_DATE)) / 6).cast("int"))
    dropped = 0
    for d in range(5):
        parts.where(F.col("drop") == d).drop("drop").write.parquet(f"{tmp_root}/landing/drop={d}")
        account = drain(spark, tmp_root, t.schema, 24, max_files=1)
        dropped += account.dropped
    assert dropped == 0
    late = bounded.read_late(spark, f"{tmp_root}/bronze", t.schema)
    accounts = bounded.read_accounts(spark, f"{tmp_root}/bronze").collect()
    assert len(accounts) == 5 and sum(a.n_rows for a in accounts) == t.count()
    assert sum(a.n_late for a in accounts) == late.count() > 0
    on_time = bounded.read_split(spark, f"{tmp_root}/bronze", t.schema).where(~F.col(bounded.LATE)).select(*COLUMNS)
    assert audit.table_diff(on_time.unionByName(late.select(*COLUMNS)), t.select(*COLUMNS)).count() == 0
    want = dedup.dedup_bounded(on_time, KEY, ORDER_COLUMNS, TIME)
    assert audit.table_diff(result(spark, tmp_root, t.schema).select(*COLUMNS), want.select(*COLUMNS)).count() == 0
    # Timers have ended the state of most keys.
    assert 0 < account.state_rows < t.select("event_id").distinct().count() / 2


def test_random_copies_any_order_and_types(spark, tmp_root):
    rnd = random.Random(5)
    t0 = datetime(2024, 3, 1)
    rows = []
    for _ in range(400):
        at = t0 + timedelta(hours=rnd.randrange(0, 400), microseconds=rnd.choice([0, 1, 999999]))
        rows.append((rnd.choice([None, *range(40)]), rnd.choice([None, 1, 2, 10]), rnd.choice([at, at, at, None]),
                     rnd.choice([None, 0.1, float("nan"), -0.5, 1e300]), Decimal(rnd.randrange(99)) / 10,
                     rnd.choice(["é", "z", "", None]), rnd.choice([b"\x00\xff", b"", None]), rnd.random() < 0.5, at.date()))
    schema = ("event_id long, source_sequence_number long, ingestion_timestamp timestamp_ntz, x double, d decimal(9,1), "
              "s string, b binary, f boolean, day date")
    df = spark.createDataFrame(rows, schema)
    for i in range(6):                                    # dealt at random: batches are in no order of time
        df.where(F.pmod(F.xxhash64(*df.columns), F.lit(6)) == i).coalesce(1).write.parquet(f"{tmp_root}/landing/p={i}")
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_root}/landing/*")
    bounded.split_by_clock(src, f"{tmp_root}/bronze", f"{tmp_root}/c1", TIME, 500)
    rows_on_time = bounded.on_time_stream(spark, f"{tmp_root}/bronze", df.schema, 1)
    account = bounded.run_keyed_dedup(rows_on_time, f"{tmp_root}/out", f"{tmp_root}/c2", KEY, ORDER_COLUMNS, TIME, delay_hours=500)
    assert account.dropped == 0 and account.batches >= 6 and account.rows == len(rows)
    want = dedup.dedup_bounded(df, KEY, ORDER_COLUMNS, TIME)
    texts = [sorted(repr(tuple(r)) for r in x.select(*df.columns).collect()) for x in (result(spark, tmp_root, df.schema), want)]
    assert texts[0] == texts[1]


def test_state_machine_against_all_orders():
    """Any order of arrival within the delay gives the rows of the batch operator."""
    hour = bounded.HOUR
    places = [(1, "whole")]
    rnd = random.Random(3)
    for _ in range(300):
        times = sorted(rnd.sample(range(200), rnd.randrange(1, 7)))
        rows = [[str(t * hour), str(rnd.randrange(50)), str(i)] for i, t in enumerate(times)]
        first = times[0]
        inside = [r for r, t in zip(rows, times) if t <= first + 72]
        want = sorted([max(inside, key=lambda r: int(r[1]))[1:2]] + [r[1:2] for r, t in zip(rows, times) if t > first + 72])
        order = rows[:]
        rnd.shuffle(order)
        state = bounded.KeyState(0, places, 72 * hour)
        best, outside = None, []
        newest = 0
        for i, r in enumerate(order):
            # the watermark trails everything still to come
            watermark = min(int(x[0]) for x in order[i:]) if i else 0
            newest = max(newest, int(r[0]))
            for row, is_inside in state.take([r], watermark):
                if is_inside:
                    best = row
                else:
                    outside.append(row)
        got = sorted([best[1:2]] + [r[1:2] for r in outside])
        assert got == want


def test_replayed_batch_and_empty_stream(spark, t, tmp_root):
    schema = t.schema
    (p := __import__("pathlib").Path(tmp_root, "landing", "p=0")).mkdir(parents=True)
    src = spark.readStream.schema(schema).parquet(f"{tmp_root}/landing/*")
    bounded.split_by_clock(src, f"{tmp_root}/bronze", f"{tmp_root}/c1", TIME, 24)
    rows = bounded.on_time_stream(spark, f"{tmp_root}/bronze", schema)
    bounded.run_keyed_dedup(rows, f"{tmp_root}/out", f"{tmp_root}/c2", KEY, ORDER_COLUMNS, TIME, delay_hours=24)
    assert result(spark, tmp_root, schema).count() == 0
    assert bounded.read_late(spark, f"{tmp_root}/bronze", schema).count() == 0


def test_keys_share_a_state_value_but_not_a_timer(spark, tmp_root):
    """One bucket for all keys: the state of key 1 has ended by the time its next
    row comes, that of key 2 has not, in the same value."""
    schema = "event_id long, source_sequence_number long, ingestion_timestamp timestamp_ntz"
    t0 = datetime(2024, 3, 1)
    drops = [[(1, 0), (2, 100), *((k, 100) for k in range(10, 60))], [(3, 200)], [(4, 210)], [(5, 220)], [(1, 215), (2, 201)]]
    for i, drop in enumerate(drops):
        df = spark.createDataFrame([(k, i, t0 + timedelta(hours=h)) for k, h in drop], schema)
        df.coalesce(1).write.parquet(f"{tmp_root}/landing/p={i}")
        bounded.split_by_clock(spark.readStream.schema(df.schema).parquet(f"{tmp_root}/landing/*"), f"{tmp_root}/bronze",
                               f"{tmp_root}/c1", TIME, 24)
        rows = bounded.on_time_stream(spark, f"{tmp_root}/bronze", df.schema, 1)
        account = bounded.run_keyed_dedup(rows, f"{tmp_root}/out", f"{tmp_root}/c2", KEY, ORDER_COLUMNS, TIME,
                                          lifetime_hours=144, delay_hours=24, buckets=1)
        assert account.state_rows == 1 and account.dropped == 0
    out = bounded.read_deduplicated(spark, f"{tmp_root}/out", df.schema, KEY, ORDER_COLUMNS, TIME, keep_first_seen=True)
    hours = (F.unix_timestamp("_first_seen") - F.unix_timestamp(F.lit(t0))) / 3600
    got = {(r[0], r[1]): r[2] for r in out.select("event_id", "source_sequence_number", hours).collect()}
    assert len(got) == 57
    assert (got[1, 0], got[1, 4]) == (0, 215)          # a window of its own
    assert (got[2, 0], got[2, 4]) == (100, 100)        # outside the window that is still known


def test_rows_that_no_text_holds_are_refused(spark):
    df = spark.createDataFrame([(1, [1], datetime(2024, 1, 1), datetime(2024, 1, 1))],
                               "event_id long, a array<int>, ingestion_timestamp timestamp_ntz, _clock timestamp_ntz")
    with pytest.raises(TypeError, match="column a"):
        bounded.dedup_updates(df, KEY, [TIME], TIME)
