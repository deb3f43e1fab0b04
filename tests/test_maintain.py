from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sluice.operators import audit, maintain
from sluice.sources import scan
from sluice.sources.landing import write_flush_layout
from sluice.sources.telemetry import load_telemetry


@pytest.fixture(scope="module")
def flush_tree(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="sluice-flush-")
    t = load_telemetry(spark, SF001)
    write_flush_layout(t, f"{root}/landing", minutes=5)
    return f"{root}/landing", t


def test_five_minute_flush_layout_file_count(spark, flush_tree):
    path, t = flush_tree
    inv = scan.file_inventory(spark, path, "event_date")
    assert inv.count() == 1001          # FIXTURES: flush cells at sf0.001
    assert "content" not in inv.columns
    stats = audit.file_stats(inv).first()
    assert stats.n_files == 1001 and stats.n_small_files == 1001
    assert stats.predicted_scan_tasks == audit.predicted_tasks(stats.total_bytes, 1001)


def test_inventory_lists_a_deep_tree_with_one_job(spark, tmp_root):
    for x in (f"d={d}/p={p}/f={f}" for d in range(3) for p in range(2) for f in range(40)):
        (at := Path(tmp_root, x)).mkdir(parents=True)
        (at / "a.parquet").write_bytes(b"x")
    key = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(key)
    spark.sparkContext.setJobGroup(tmp_root, "listing")
    try:
        inv = scan.file_inventory(spark, tmp_root, "d")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(tmp_root)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1 and spark.conf.get(key) == before
    assert {r.d: r.n for r in inv.groupBy("d").agg(F.count("path").alias("n")).collect()} == {"0": 80, "1": 80, "2": 80}


def test_compact_snapshot_one_file_per_date_same_fingerprint(spark, flush_tree, tmp_root):
    path, _ = flush_tree
    m = maintain.compact(spark, path, "event_date", dst=f"{tmp_root}/snap", target_file_bytes=64 << 20)
    rows = m.collect()
    assert len(rows) == 30 and all(r.files_after == 1 for r in rows)
    assert sum(r.files_before for r in rows) == 1001
    a = spark.read.parquet(path)
    b = spark.read.parquet(f"{tmp_root}/snap")
    cols = sorted(a.columns)
    assert audit.table_fingerprint(a, cols).first() == audit.table_fingerprint(b.select(*cols), cols).first()


def test_compact_in_place_only_dirty_partitions(spark, tmp_root):
    df = spark.range(0, 400).select(F.col("id"), (F.col("id") % 4).alias("p"))
    # p=0 gets many small files, the others a single file each
    df.where("p = 0").repartition(8).write.partitionBy("p").parquet(f"{tmp_root}/tbl")
    df.where("p <> 0").coalesce(1).write.mode("append").partitionBy("p").parquet(f"{tmp_root}/tbl")
    before = {r.p: r.n_files for r in audit.file_stats(
        scan.file_inventory(spark, f"{tmp_root}/tbl", "p"), ["p"]).collect()}
    inv_before = {r.path for r in scan.file_inventory(spark, f"{tmp_root}/tbl", "p").where("p <> '0'").collect()}
    m = {r.p: r for r in maintain.compact(spark, f"{tmp_root}/tbl", "p", target_file_bytes=64 << 20).collect()}
    assert before["0"] == 8 and m["0"].files_after == 1 and m["0"].compacted
    assert not m["1"].compacted
    inv_after = {r.path for r in scan.file_inventory(spark, f"{tmp_root}/tbl", "p").where("p <> '0'").collect()}
    assert inv_before == inv_after      # untouched partitions keep their files
    assert spark.read.parquet(f"{tmp_root}/tbl").count() == 400


def test_zorder_narrows_file_spans(spark, tmp_root):
    df = spark.range(0, 20000).select(
        (F.col("id") % 997).alias("a"), ((F.col("id") * 7919) % 1009).alias("b"), "id")
    df.repartition(64).write.parquet(f"{tmp_root}/plain")
    # 64 files = 6 interleaved bits = 3 per column: each column's range is
    # cut in 8 slices, so per-file spans shrink about 8x.
    maintain.zorder(df, ["a", "b"], num_files=64, bits=6).write.parquet(f"{tmp_root}/z")

    def mean_span(p):
        s = maintain.file_column_spans(spark, p, ["a", "b"])
        return s.agg(F.avg("a_span"), F.avg("b_span")).first()
    pa, pb = mean_span(f"{tmp_root}/plain")
    za, zb = mean_span(f"{tmp_root}/z")
    assert za < pa / 4 and zb < pb / 4
    assert spark.read.parquet(f"{tmp_root}/z").count() == 20000


def test_optimize_source_zorders_within_partitions(spark, tmp_root):
    from sluice.operators.ingest import write_table
    from sluice.sources.contract import contract_from_dict
    df = spark.range(0, 8000).select((F.col("id") % 4).alias("p"), (F.col("id") % 997).alias("a"),
                                     ((F.col("id") * 7919) % 1009).alias("b"))
    write_table(df.repartition(16), f"{tmp_root}/b", ["p"], rebalance=False)
    c = contract_from_dict({"name": "s", "format": "parquet", "landing_path": "s",
                            "bronze_path": f"{tmp_root}/b", "checkpoint_path": f"{tmp_root}/c",
                            "partition_by": ["p"], "zorder_by": ["a", "b"]})
    m = maintain.optimize_source(spark, c, f"{tmp_root}/z", target_file_bytes=8 << 10, bits=5)
    rows = m.collect()
    assert len(rows) == 4 and sum(r.files_before for r in rows) >= 4
    z = spark.read.parquet(f"{tmp_root}/z")
    assert z.count() == 8000
    # every file holds one partition value only
    per_file = z.groupBy(F.col("_metadata.file_path")).agg(F.count_distinct("p").alias("n"))
    assert per_file.where("n > 1").count() == 0


def test_compact_in_place_with_escaped_partition_values(spark, tmp_root):
    df = spark.range(0, 200).select("id", F.when(F.col("id") % 2 == 0, F.lit("a b:c+d"))
                                    .otherwise(F.lit("plain")).alias("p"))
    df.repartition(6).write.partitionBy("p").parquet(f"{tmp_root}/t")
    inv = scan.file_inventory(spark, f"{tmp_root}/t", "p")
    assert {r.p for r in inv.select("p").distinct().collect()} == {"a b:c+d", "plain"}
    m = {r.p: r for r in maintain.compact(spark, f"{tmp_root}/t", "p", target_file_bytes=64 << 20).collect()}
    assert m["a b:c+d"].compacted and m["a b:c+d"].files_after == 1
    assert spark.read.parquet(f"{tmp_root}/t").count() == 200


def test_optimize_source_sorts_little_in_a_task(spark, tmp_root):
    """Rows of long, alike texts: small files, but much to sort."""
    from sluice.operators.ingest import write_table
    from sluice.sources.contract import contract_from_dict
    df = spark.range(0, 4000).select(F.lit(1).alias("p"), (F.col("id") % 97).alias("a"), F.repeat(F.lit("x"), 1000).alias("s"),
                                     F.array(F.lit("y")).alias("l"))
    write_table(df, f"{tmp_root}/b", ["p"])
    assert 4_000_000 < maintain.sorted_bytes(spark.read.parquet(f"{tmp_root}/b")) < 6_000_000
    c = contract_from_dict({"name": "s", "format": "parquet", "landing_path": "l", "bronze_path": f"{tmp_root}/b",
                            "checkpoint_path": "c", "schema": [{"name": "a", "type": "long"}],
                            "partition_by": ["p"], "zorder_by": ["a"]})
    m = maintain.optimize_source(spark, c, f"{tmp_root}/z", task_bytes=1 << 20).collect()
    assert len(m) == 1 and m[0].bytes_before < 1 << 20 and 4 <= m[0].files_after <= 6
    assert spark.read.parquet(f"{tmp_root}/z").count() == 4000
    maintain.optimize_source(spark, c, f"{tmp_root}/one")
    assert scan.file_inventory(spark, f"{tmp_root}/one").count() == 1


def test_zorder_splits_a_hot_value_across_files(spark, tmp_root):
    df = spark.range(0, 8000).select(F.lit(3).alias("a"), F.lit(4).alias("b"), "id").repartition(4)
    maintain.zorder(df, ["a", "b"], num_files=4, bits=4).write.parquet(f"{tmp_root}/z")
    files = spark.read.parquet(f"{tmp_root}/z").select(F.col("_metadata.file_path")).distinct().count()
    assert files > 1 and spark.read.parquet(f"{tmp_root}/z").count() == 8000
