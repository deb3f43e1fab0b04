"""Compaction of incremental Bronze: single files, across batches, ingest going on."""

from __future__ import annotations

from pyspark.sql import functions as F

import pytest

from conftest import SF001
from sluice.operators import audit, bronze_compaction
from sluice.sources.contract import contract_from_dict
from sluice.sources.landing import write_landing
from sluice.sources.telemetry import COLUMNS, load_telemetry, player_events_contract_dict
from sluice.streaming import incremental


@pytest.fixture(scope="module")
def t(spark):
    return load_telemetry(spark, SF001)


def test_small_files_only_and_ingest_goes_on(spark, t, tmp_root):
    c = contract_from_dict(player_events_contract_dict(tmp_root))
    landing = f"{tmp_root}/landing/player_events"
    old = F.col("event_date") < F.lit("2024-01-07").cast("date")
    kw = dict(landing_root=f"{tmp_root}/landing")
    for i in range(3):                                   # three files per date, in three runs
        part = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("event_id") % 5 % 2 + 1)
        (t.where(old & (part == i)).coalesce(1).write.mode("append").partitionBy("event_date").parquet(landing))
        incremental.ingest_incremental(spark, c, **kw)
    before = bronze_compaction.live_files(spark, c.bronze_path).checkpoint()
    sizes = sorted(r.size_bytes for r in before.collect())
    small = sizes[len(sizes) * 3 // 4] + 1               # the largest quarter counts as large
    large = {r.path for r in before.where(F.col("size_bytes") >= small).collect()}
    report = bronze_compaction.compact_bronze(spark, c.bronze_path, target_bytes=1 << 20, small_bytes=small).collect()
    after = {r.path for r in bronze_compaction.live_files(spark, c.bronze_path).collect()}
    assert large and large <= after                      # untouched
    assert sum(r.files_replaced for r in report) > 0
    assert sum(r.files_after for r in report) == len(after) < len(sizes)
    bronze = incremental.read_bronze(spark, c.bronze_path)
    assert audit.table_diff(bronze.select(*COLUMNS), t.where(old).select(*COLUMNS)).count() == 0
    # nothing is read again, new files are, and a lost checkpoint doubles nothing
    assert incremental.ingest_incremental(spark, c, **kw).no_new_files
    t.where(~old).write.mode("append").partitionBy("event_date").parquet(landing)
    assert incremental.ingest_incremental(spark, c, **kw).rows_added == t.where(~old).count()
    lost = incremental.ingest_incremental(spark, c, checkpoint=f"{tmp_root}/lost", **kw)
    assert lost.rows_added == 0 and lost.rows_read == lost.total_rows == t.count()
    again = bronze_compaction.compact_bronze(spark, c.bronze_path, target_bytes=1 << 30)
    assert {r.files_after for r in again.collect()} == {1}
    bronze = incremental.read_bronze(spark, c.bronze_path)
    assert audit.table_diff(bronze.select(*COLUMNS), t.select(*COLUMNS)).count() == 0
    third = bronze_compaction.compact_bronze(spark, c.bronze_path, target_bytes=1 << 30).collect()
    assert sum(r.files_replaced for r in third) == 0


def test_uncommitted_compaction_is_not_seen(spark, t, tmp_root):
    c = contract_from_dict(player_events_contract_dict(tmp_root))
    write_landing(t, f"{tmp_root}/landing/player_events", ["event_date"], 2, ["event_id", "ingestion_timestamp"])
    incremental.ingest_incremental(spark, c, landing_root=f"{tmp_root}/landing", max_files_per_trigger=9)
    bronze = incremental.read_bronze(spark, c.bronze_path)
    (bronze.limit(50).withColumn("ingest_batch", F.lit(0)).write.partitionBy("ingest_batch", "event_date")
     .parquet(f"{c.bronze_path}/ingest_run=compaction-crashed"))
    assert incremental.read_bronze(spark, c.bronze_path).count() == t.count()
    assert not any("crashed" in r.path for r in bronze_compaction.live_files(spark, c.bronze_path).collect())


def test_bins_by_running_size(spark):
    files = spark.createDataFrame([(f"p{i:02d}", s, "d=1") for i, s in enumerate([40, 70, 90, 500, 10, 30, 99])] +
                                  [("q0", 20, "d=2"), ("r0", 5, ""), ("r1", 5, "")], "path string, size_bytes long, partition string")
    got = {r.path: (r.partition, r.bin) for r in bronze_compaction.plan_bins(files, 200, 100).collect()}
    assert got == {"p00": ("d=1", 0), "p01": ("d=1", 0), "p02": ("d=1", 0), "p04": ("d=1", 1), "p05": ("d=1", 1),
                   "p06": ("d=1", 1), "r0": ("", 0), "r1": ("", 0)}
    assert bronze_compaction.plan_bins(files, 50, 30).count() == 2          # r0 and r1; bins of one file stay


def test_history_in_other_buckets_is_not_read(spark, t, tmp_root):
    from sluice.operators.lineage import add_lineage

    t.write.partitionBy("event_date").parquet(f"{tmp_root}/src")
    writer = incremental._batch_writer(f"{tmp_root}/bronze", ("event_date",))
    batch = add_lineage(spark.read.parquet(f"{tmp_root}/src"), "player_events", "r1")
    writer(batch, 0)
    one = batch.select("_source_file").first()[0]
    bucket = spark.range(1).select(incremental.bucket_of(F.lit(one))).first()[0]
    history = incremental.read_registry(spark, f"{tmp_root}/bronze", [bucket])
    assert one in {r._source_file for r in history.collect()}
    assert {r.bucket for r in history.collect()} == {bucket}
    assert incremental.read_registry(spark, f"{tmp_root}/bronze", [999]) is None
    writer(batch.where(F.col("_source_file") == one), 1)
    progress = {r.ingest_batch: (r.rows_read, r.rows_added) for r in incremental.read_progress(spark, f"{tmp_root}/bronze").collect()}
    assert progress[0] == (1014, 1014) and progress[1][0] > 0 and progress[1][1] == 0
