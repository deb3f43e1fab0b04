"""Rows, values and columns that must survive: NULL keys, replays, columns on
one side only, NULL partitions, late rows, uncommitted batches."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF001
from sluice.operators import audit, dedup, ingest, maintain
from sluice.sources.contract import contract_from_dict
from sluice.sources.landing import write_landing
from sluice.sources.telemetry import load_telemetry, player_events_contract_dict
from sluice.streaming import incremental, late

ORDER = ["source_sequence_number", "ingestion_timestamp"]


@pytest.fixture(scope="module")
def t(spark):
    return load_telemetry(spark, SF001)


def contract(root, **more):
    return contract_from_dict(player_events_contract_dict(root) | more)


def window_form(df):
    """Bounded dedup by windows: NULL keys are one key."""
    from pyspark.sql import Window

    by = Window.partitionBy("event_id")
    inside = F.col("ingestion_timestamp") <= F.expr("first + INTERVAL 72 HOURS")
    best = Window.partitionBy("event_id", "inside").orderBy(*[F.desc(c) for c in ORDER])
    tagged = df.withColumn("first", F.min("ingestion_timestamp").over(by)).withColumn("inside", inside)
    return tagged.withColumn("nth", F.row_number().over(best)).where("not inside or nth = 1").drop(
        "first", "inside", "nth")


def test_null_keys_stay_in_dedup_census_and_index(spark, t):
    holed = t.withColumn("event_id", F.when(F.col("event_id") % 50 != 0, F.col("event_id")))
    got = dedup.dedup_bounded(holed, ["event_id"], ORDER, "ingestion_timestamp")
    want = window_form(holed)
    assert got.where("event_id is null").count() == want.where("event_id is null").count() > 0
    assert got.count() == want.count()
    census = dedup.duplicate_census(holed, ["event_id"], "source_sequence_number", "ingestion_timestamp")
    assert census.agg(F.sum("n_rows")).first()[0] == holed.count() - holed.select("event_id").distinct().count()
    indexed = dedup.sequence_index(
        t.withColumn("producer_id", F.nullif("producer_id", F.lit(1))), ["producer_id"], ["event_id"])
    assert indexed.count() == t.count()
    top = indexed.groupBy("producer_id").agg(F.max("sequence_index").alias("m"), F.count("*").alias("n"))
    assert top.where("m <> n - 1").count() == 0


def test_copies_outside_the_window_are_all_kept(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(1, 1, t0), (1, 2, t0 + timedelta(hours=1)), (1, 9, t0 + timedelta(hours=80)), (1, 9, t0 + timedelta(hours=80)),
            (None, 1, t0), (None, 1, None), (2, None, t0)]
    df = spark.createDataFrame(rows, "event_id long, source_sequence_number long, ingestion_timestamp timestamp_ntz")
    got = dedup.dedup_bounded(df, ["event_id"], ORDER, "ingestion_timestamp").collect()
    assert sorted((r[0] or 0, r[1] or 0) for r in got) == [(0, 1), (1, 2), (1, 9), (1, 9), (2, 0)]
    assert dedup.dedup_bounded(df.limit(0), ["event_id"], ORDER, "ingestion_timestamp").count() == 0


def test_replayed_batch_changes_nothing(spark, t, tmp_root):
    c = contract(tmp_root)
    newest = t.agg(F.max("event_date")).first()[0]
    silver = f"{tmp_root}/silver"
    kw = dict(open_days=3650, as_of=newest)
    half = F.col("event_id") % 2 == 0
    ingest.reprocess_open_partitions(spark, silver, t.where(half), c, merge_id="q-0", **kw)
    ingest.reprocess_open_partitions(spark, silver, t, c, merge_id="q-1", **kw)
    once = spark.read.parquet(silver).select(*t.columns)
    once = once.checkpoint()
    ingest.reprocess_open_partitions(spark, silver, t, c, merge_id="q-1", **kw)
    twice = spark.read.parquet(silver).select(*t.columns)
    assert audit.table_diff(once, twice).count() == 0
    again = spark.read.parquet(silver).where(F.col("_merge_id") == "q-1").count()
    assert again > 0


def test_merge_keeps_columns_of_either_side_and_null_partitions(spark, t, tmp_root):
    c = contract(tmp_root)
    silver = f"{tmp_root}/silver"
    first = t.withColumn("client_region", F.lit("r1"))
    kw = dict(open_days=3650, as_of=t.agg(F.max("event_date")).first()[0])
    ingest.reprocess_open_partitions(spark, silver, first, c, **kw)
    before = spark.read.parquet(silver).where("client_region is not null").count()
    nulls = t.limit(5).withColumn("event_date", F.lit(None).cast("date"))
    side = ingest.reprocess_open_partitions(spark, silver, t.unionByName(nulls).withColumn("extra", F.lit(1)), c, **kw)
    assert side.where("event_date is null").count() == 5
    after = ingest.read_if_there(spark, silver)
    assert {"client_region", "extra"} <= set(after.columns)
    assert after.count() >= before
    assert after.where("client_region is null and extra is null").count() == 0


def test_only_absence_reads_as_absent(spark, tmp_root):
    assert ingest.read_if_there(spark, f"{tmp_root}/nothing") is None
    (p := __import__("pathlib").Path(tmp_root, "broken")).mkdir()
    (p / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception) as e:
        ingest.read_if_there(spark, str(p))
    assert not (isinstance(e.value, AnalysisException) and e.value.getCondition() in ingest.ABSENT)


def test_uncommitted_batches_and_evolved_columns(spark, t, tmp_root):
    c = contract(tmp_root, read_options={"mergeSchema": "true"})
    landing = f"{tmp_root}/landing/player_events"
    write_landing(t.where("event_id < 300"), landing, ["event_date"], 1)
    incremental.ingest_incremental(spark, c, landing_root=f"{tmp_root}/landing")
    (t.where("event_id >= 300").withColumn("client_region", F.lit("x")).write.mode("append")
     .partitionBy("event_date").parquet(landing))
    res = incremental.ingest_incremental(spark, c, landing_root=f"{tmp_root}/landing", max_files_per_trigger=1)
    assert res.rows_added == t.where("event_id >= 300").count() 
    progress = incremental.read_progress(spark, c.bronze_path).where(F.col("run_id") == res.run_id)
    assert progress.agg(F.sum("rows_added")).first()[0] == res.rows_added and progress.count() == res.n_batches > 1
    bronze = incremental.read_bronze(spark, c.bronze_path)
    assert bronze.where("client_region = 'x'").count() == res.rows_added
    bronze.limit(3).write.partitionBy("event_date").parquet(f"{c.bronze_path}/ingest_run=crashed/ingest_batch=0")
    assert incremental.read_bronze(spark, c.bronze_path).count() == t.count()
    with pytest.raises(maintain.CompactionError):
        maintain.compact(spark, c.bronze_path, "event_date")


def test_flush_counts_over_many_batches_lose_nothing(spark, t, tmp_root):
    newer = F.col("event_date") >= F.lit(date(2024, 1, 15))       # the older half lands after the newer one
    write_landing(t.where(newer), f"{tmp_root}/landing", ["event_date"], 2, ["event_id", "ingestion_timestamp"])
    time.sleep(1.5)
    t.where(~newer).write.mode("append").partitionBy("event_date").parquet(f"{tmp_root}/landing")
    schema = spark.read.parquet(f"{tmp_root}/landing").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 5).parquet(f"{tmp_root}/landing")
    late.count_flush_windows(stream, f"{tmp_root}/out", f"{tmp_root}/ckpt", "ingestion_timestamp", ["producer_id"])
    got = late.read_flush_windows(spark, f"{tmp_root}/out", ["producer_id"])
    assert got.agg(F.sum("n_rows")).first()[0] == t.count()
    assert got.agg(F.sum("n_late")).first()[0] > 0


def test_rows_without_a_time_have_a_route_of_their_own(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), None), (None, None)],
                               "event_timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz")
    assert {r.route for r in audit.route_late(df, "event_timestamp", "ingestion_timestamp").collect()} == {"no_time"}


def test_zorder_on_times_dates_and_text(spark, tmp_root):
    df = spark.range(4000).select(
        F.concat(F.lit("n"), F.lpad((F.col("id") * 7919 % 4000).cast("string"), 5, "0")).alias("name"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 104729 % 4000).cast("int"))).alias("at"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 300).cast("int")).alias("day"))
    out = maintain.zorder(df, ["name", "at", "day"], 8, bits=4)
    assert out.count() == 4000
    maintain.zorder(df, ["name", "at"], 16, bits=4).write.parquet(f"{tmp_root}/z")
    per = spark.read.parquet(f"{tmp_root}/z").groupBy(F.col("_metadata.file_path")).agg(
        F.min("name").alias("a"), F.max("name").alias("b"))
    assert per.where("b < 'n02500' or a > 'n01500'").count() > 0
    with pytest.raises(ValueError):
        maintain.zorder_key(df, ["name"] * 9, bits=8)


def test_blob_pointer_of_rows_without_content(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "zz")], "id long, text string")
    store = rows.where("id = 1").select(F.sha2("text", 256).alias("sha256"), F.lit("p").alias("blob_path"))
    got = {r.id: r.blob_path for r in audit.attach_blob_pointer(rows, "text", store).collect()}
    assert got == {1: "p", 2: None, 3: None}


def test_refine_twice_gives_the_same_tables(spark, t, tmp_root):
    from sluice.operators.refine import refine

    holed = t.withColumn("event_id", F.nullif("event_id", F.lit(7)))
    c = contract(tmp_root)
    first = refine(spark, c, holed)
    assert first.rejects == holed.where("event_id is null").count() > 0
    assert first.rejects + first.clean == t.count()
    tables = {k: spark.read.parquet(p).checkpoint() for k, p in first.tables.items()}
    second = refine(spark, c, holed)
    for k, p in second.tables.items():
        assert audit.table_diff(tables[k], spark.read.parquet(p)).count() == 0
