"""Compaction of the incremental Bronze table, file by file.

Files lie in a directory per run and micro-batch. A plan packs the small live
files of each table partition into bins of the target size, across those
directories; a bin of one file is left alone, and so is every file that isn't
small. Only the planned files are read. Each bin becomes one file in a directory
of the compaction's own, checked against what it replaces; one row per replaced
file, written as a single file, then makes the new files visible and the old
ones invisible at once (:func:`sluice.streaming.incremental.read_bronze`). The
registry of ingested files and the progress stay as they are, so ingest goes on
as before. As there is no transaction log, replaced files stay in storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.operators.maintain import _verify
from sluice.streaming.incremental import COMPACTIONS_DIR, DIRECTORIES, only_live

BROADCAST_BYTES = 8 << 20


def live_files(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Path, size, directories and partition (the path's part with the partition
    values, as written) of every file that readers see. Contents aren't read."""
    root = bronze_path.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size_bytes")))
    inside = r"ingest_run=([^/]+)/ingest_batch=([^/]+)/(?:(.*)/)?[^/]+$"
    parsed = files.select(
        "path", "size_bytes", F.regexp_extract("path", inside, 1).alias("ingest_run"),
        F.regexp_extract("path", inside, 2).cast("long").alias("ingest_batch"),
        F.regexp_extract("path", inside, 3).alias("partition"))
    return only_live(parsed, spark, root, "path")


def plan_bins(files: DataFrame, target_bytes: int, small_bytes: int) -> DataFrame:
    """Path, partition and bin of the small files that are packed with others:
    by running size inside their partition, in the order of their paths."""
    before = Window.partitionBy("partition").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    small = files.where(F.col("size_bytes") < small_bytes)
    binned = small.withColumn("bin", F.floor(F.coalesce(F.sum("size_bytes").over(before), F.lit(0)) / target_bytes))
    several = Window.partitionBy("partition", "bin")
    return (binned.withColumn("_n", F.count(F.lit(1)).over(several)).where(F.col("_n") > 1)
            .select("path", "size_bytes", "partition", "bin"))


def _by_partition(files: DataFrame, suffix: str) -> DataFrame:
    return files.groupBy("partition").agg(F.count(F.lit(1)).alias(f"files_{suffix}"),
                                          F.sum("size_bytes").alias(f"bytes_{suffix}"))


def compact_bronze(spark: SparkSession, bronze_path: str, target_bytes: int = 1 << 30,
                   small_bytes: int | None = None) -> DataFrame:
    """Rewrite the small files of an incremental Bronze table. Per partition:
    live files and bytes before and after, and how many files were replaced."""
    root = bronze_path.rstrip("/")
    small_bytes = small_bytes or target_bytes // 2
    # Listings are checkpointed: what they describe is about to change.
    files = live_files(spark, root).checkpoint(eager=True)
    plan = plan_bins(files, target_bytes, small_bytes).checkpoint(eager=True)
    bins = plan.select("partition", "bin").distinct().count()
    if bins:
        run = f"compaction-{uuid.uuid4().hex[:12]}"
        names = [d.split("=", 1)[0] for d in plan.first()["partition"].split("/") if d]
        size = plan.agg(F.sum(F.octet_length("path"))).first()[0]
        chosen = plan.select(F.col("path").alias("_file"), F.col("bin").alias("_bin"))
        # Large files are pruned by their size when the table is listed.
        rows = (spark.read.option("mergeSchema", "true").parquet(root).drop(*DIRECTORIES)
                .withColumn("_file", F.col("_metadata.file_path"))
                .where(F.col("_metadata.file_size") < small_bytes)
                .join(F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen, "_file").drop("_file"))
        target = f"{root}/ingest_run={run}"
        out = rows.withColumnRenamed("_bin", "ingest_batch")
        (out.repartition(bins, *names, "ingest_batch").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("ingest_batch", *names).parquet(target))
        written = spark.read.schema(out.schema).parquet(target)
        _verify(rows.drop("_bin"), written.drop("ingest_batch"))
        (plan.select(F.col("path").alias("replaced_file"), F.col("bin").alias("ingest_batch")).repartition(1)
         .write.mode("overwrite").parquet(f"{root}/{COMPACTIONS_DIR}/ingest_run={run}"))
    replaced = plan.groupBy("partition").agg(F.count(F.lit(1)).alias("files_replaced"))
    after = live_files(spark, root)
    return (_by_partition(files, "before").join(_by_partition(after, "after"), "partition", "left")
            .join(replaced, "partition", "left").na.fill(0, ["files_replaced"])
            .select("partition", "files_before", "files_after", "files_replaced", "bytes_before", "bytes_after"))
