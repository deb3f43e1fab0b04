import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sluice.operators import audit, ingest
from sluice.operators.lineage import LINEAGE_COLUMNS, RUN_COLUMNS
from sluice.sources.contract import contract_from_dict
from sluice.sources.landing import write_landing
from sluice.sources.telemetry import COLUMNS, load_telemetry, player_events_contract_dict
from sluice.streaming import incremental, late


@pytest.fixture(scope="module")
def t(spark):
    return load_telemetry(spark, SF001)


def contract(root):
    raw = player_events_contract_dict(root)
    return contract_from_dict(raw)


def stable(df):
    return [c for c in df.columns if c not in RUN_COLUMNS]


def test_full_refresh_twice_same_rows_and_fingerprint(spark, t, tmp_root):
    write_landing(t, f"{tmp_root}/landing/player_events", ["event_date"], 3, ["event_id", "ingestion_timestamp"])
    c = contract(tmp_root)
    r1 = ingest.ingest_full_refresh(spark, c, landing_root=f"{tmp_root}/landing")
    b1 = spark.read.parquet(r1.path)
    f1 = audit.table_fingerprint(b1, sorted(stable(b1))).first()
    r2 = ingest.ingest_full_refresh(spark, c, landing_root=f"{tmp_root}/landing")
    b2 = spark.read.parquet(r2.path)
    assert r1.rows == r2.rows == 1014
    assert r1.run_id != r2.run_id
    assert audit.table_fingerprint(b2, sorted(stable(b2))).first() == f1
    assert set(LINEAGE_COLUMNS) <= set(b2.columns)
    assert b2.select("_batch_id").distinct().count() == 1
    assert b2.where(~F.col("_source_file").contains("event_date=")).count() == 0


def test_csv_source_with_reader_options(spark, tmp_root):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    df.write.option("header", "true").csv(f"{tmp_root}/landing/csvsrc")
    c = contract_from_dict({"name": "csvsrc", "format": "csv", "landing_path": "csvsrc",
                            "bronze_path": f"{tmp_root}/bronze/csvsrc", "checkpoint_path": f"{tmp_root}/ck",
                            "read_options": {"header": "true", "inferSchema": "true"}})
    r = ingest.ingest_full_refresh(spark, c, landing_root=f"{tmp_root}/landing")
    assert r.rows == 2
    assert "id" in spark.read.parquet(r.path).columns


def test_incremental_exactly_once(spark, t, tmp_root):
    landing = f"{tmp_root}/landing/player_events"
    last = t.agg(F.max("event_date")).first()[0]
    write_landing(t.where(F.col("event_date") < F.lit(last)), landing, ["event_date"], 2, ["event_id"])
    c = contract(tmp_root)
    kw = dict(landing_root=f"{tmp_root}/landing")
    first = incremental.ingest_incremental(spark, c, max_files_per_trigger=10, **kw)
    held_back = t.where(F.col("event_date") == F.lit(last)).count()
    assert first.n_batches > 1
    assert first.total_rows == 1014 - held_back
    rerun = incremental.ingest_incremental(spark, c, **kw)
    assert rerun.no_new_files and rerun.total_rows == first.total_rows
    t.where(F.col("event_date") == F.lit(last)).write.mode("append").partitionBy("event_date").parquet(landing)
    third = incremental.ingest_incremental(spark, c, **kw)
    assert third.total_rows - rerun.total_rows == held_back
    assert third.rows_added == held_back
    lost = incremental.ingest_incremental(spark, c, checkpoint=f"{tmp_root}/ck_lost", **kw)
    assert lost.total_rows == 1014          # lost checkpoint: registry prevents doubling
    assert lost.rows_read == 1014 and lost.rows_added == 0
    bronze = incremental.read_bronze(spark, c.bronze_path)
    assert audit.table_diff(bronze.select(*COLUMNS), t.select(*COLUMNS)).count() == 0


def test_replayed_batch_overwrites_itself(spark, t, tmp_root):
    """A batch replayed after a crash (same query id, same batch id)
    overwrites its own directory and registry entry: no duplicates."""
    from sluice.operators.lineage import add_lineage
    t.write.parquet(f"{tmp_root}/src")
    batch = add_lineage(spark.read.parquet(f"{tmp_root}/src"), "player_events", "r1")
    writer = incremental._batch_writer(f"{tmp_root}/bronze", ("event_date",), 1000)
    writer(batch, 0)
    writer(batch, 0)
    assert incremental.read_bronze(spark, f"{tmp_root}/bronze").count() == 1014
    writer(batch, 1)          # same files in a new batch: filtered by the registry
    assert incremental.read_bronze(spark, f"{tmp_root}/bronze").count() == 1014


def test_schema_log_and_changes(spark, t, tmp_root):
    landing = f"{tmp_root}/landing/player_events"
    write_landing(t, landing, ["event_date"], 1, ["event_id"])
    c = contract(tmp_root)
    a = incremental.ingest_incremental(spark, c, landing_root=f"{tmp_root}/landing")
    t.withColumn("extra", F.lit(1)).write.mode("append").partitionBy("event_date").parquet(landing)
    b = incremental.ingest_incremental(spark, c.__class__(**{**c.__dict__, "read_options": {"mergeSchema": "true"}}),
                                       landing_root=f"{tmp_root}/landing")
    ch = {r.field: r.status for r in incremental.schema_changes(spark, c.checkpoint_path, a.run_id, b.run_id).collect()}
    assert ch["extra"] == "added" and ch["event_id"] == "same"


def test_reprocess_open_partitions(spark, t, tmp_root):
    c = contract(tmp_root)
    path = f"{tmp_root}/bronze_open"
    base = t.where("source_sequence_number < 1000")          # no corrections yet
    ingest.write_table(base, path, ["event_date"])
    corr = t.where("source_sequence_number >= 1000")
    closed = ingest.reprocess_open_partitions(spark, path, corr, c, open_days=3)
    after = spark.read.parquet(path)
    newest = after.agg(F.max("event_date")).first()[0]
    n_open_corr = corr.where(F.col("event_date") > F.date_sub(F.lit(newest), 3)).count()
    assert closed.count() == corr.count() - n_open_corr
    # open partitions now hold the correction instead of the original
    assert after.where("source_sequence_number >= 1000").count() == n_open_corr


def test_stream_watermark_drops_too_late_rows(spark, tmp_root):
    src = f"{tmp_root}/s"
    a = spark.createDataFrame([(1, "2024-01-10 00:00:00"), (2, "2024-01-10 00:01:00")], "k long, ts string") \
        .select("k", F.to_timestamp_ntz("ts").alias("ts"))
    a.write.parquet(f"{src}/p1")
    stale = spark.createDataFrame([(3, "2024-01-01 00:00:00")], "k long, ts string") \
        .select("k", F.to_timestamp_ntz("ts").alias("ts"))
    stream = spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    counts = late.flush_window_counts(stream, "ts", [], 5, "1 hour")
    q = late.run_update_query
    os.makedirs(f"{src}/p2", exist_ok=True)
    q(counts, f"{tmp_root}/out", f"{tmp_root}/ck")
    stale.write.parquet(f"{src}/p2", mode="overwrite")
    q(counts, f"{tmp_root}/out", f"{tmp_root}/ck")
    got = late.read_latest(spark, f"{tmp_root}/out", ["flush_start"]).collect()
    assert sum(r.n_rows for r in got) == 2          # the 9-days-late row was dropped


def test_cli_runs_contract_folder(spark, t, tmp_root):
    import shutil
    from sluice import run
    write_landing(t, f"{tmp_root}/landing/player_events", ["event_date"], 2, ["event_id"])
    os.makedirs(f"{tmp_root}/contracts")
    shutil.copy(os.path.join(os.path.dirname(__file__), "..", "contracts", "player_events.yaml"),
                f"{tmp_root}/contracts/")
    assert run.main(["--contracts", f"{tmp_root}/contracts", "--landing-root", f"{tmp_root}/landing",
                     "--root", tmp_root]) == 0
    assert spark.read.parquet(f"{tmp_root}/bronze/player_events").count() == 1014
