"""Writing landing trees (what a producer drops into a landing folder):
several files per date partition, or the producer's flush-split layout of
one file per (date, producer, 5-minute flush of ingestion time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import floor_minutes, minute_stamp


FILES_PER_TASK = 256


def write_landing(df: DataFrame, path: str, partition_by: list[str], files_per_partition: int = 3,
                  spread_cols: list[str] | None = None, fmt: str = "parquet",
                  num_tasks: int | None = None) -> None:
    """Several files in every partition directory: rows get one of
    ``files_per_partition`` buckets from a hash of ``spread_cols`` and are
    rebalanced on (partition values, bucket). AQE merges small cells into
    one task and splits a hot cell over several tasks (advisory size), so a
    partition holding a third of the data is still written in parallel.
    ``num_tasks`` instead fixes the task count (one task per cell)."""
    spread_cols = spread_cols or [c for c in df.columns if c not in partition_by][:1]
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in spread_cols]), F.lit(files_per_partition))
    keyed = df.withColumn("_bucket", bucket)
    keyed = (keyed.repartition(num_tasks, *partition_by, "_bucket") if num_tasks
             else keyed.hint("rebalance", *partition_by, "_bucket"))
    (keyed.drop("_bucket").write.mode("overwrite").format(fmt)
     .partitionBy(*partition_by).save(path))


def write_flush_layout(df: DataFrame, path: str, date_col: str = "event_date",
                       producer_col: str = "producer_id", time_col: str = "ingestion_timestamp",
                       minutes: int = 5, num_tasks: int | None = None) -> None:
    """One file per (date, producer, flush window): the small-files layout.
    Tasks move their files to the final place themselves; the driver would move
    them one by one. A write that fails may so leave some of its files behind."""
    flush = minute_stamp(floor_minutes(F.col(time_col), minutes))
    out = df.withColumn("flush", flush)
    # An explicit task count, from the number of files: AQE must not coalesce
    # this shuffle into one task, since the cost here is per file, not per byte.
    if not num_tasks:
        files = out.agg(F.approx_count_distinct(F.struct(date_col, producer_col, "flush"))).first()[0]
        num_tasks = max(8, df.sparkSession.sparkContext.defaultParallelism * 2, files // FILES_PER_TASK)
    n = num_tasks
    (out.repartition(n, date_col, producer_col, "flush").write.mode("overwrite")
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy(date_col, producer_col, "flush").parquet(path))
