"""Late data on streams: event-time watermarks, tumbling flush windows and
bounded deduplication.

Watermarks need a TIMESTAMP column; the fixtures' NTZ columns are converted
zone-free first (and converted back for output)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.time import add_hours, floor_minutes, instant_to_ntz, ntz_to_instant
from sluice.operators.ingest import read_if_there


def with_event_watermark(stream: DataFrame, time_col: str, delay: str = "72 hours",
                         as_col: str = "_wm_time") -> DataFrame:
    return stream.withColumn(as_col, ntz_to_instant(F.col(time_col))).withWatermark(as_col, delay)


def flush_window_counts(stream: DataFrame, time_col: str, group_cols: list[str],
                        minutes: int = 5, delay: str = "72 hours") -> DataFrame:
    """Tumbling ``minutes`` windows of ``time_col`` per group with a
    watermark: rows later than ``delay`` behind the newest time seen are
    dropped from the aggregation, and state for closed windows is freed."""
    s = with_event_watermark(stream, time_col, delay)
    return (s.groupBy(F.window("_wm_time", f"{int(minutes)} minutes").alias("w"), *group_cols)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(instant_to_ntz(F.col("w.start")).alias("flush_start"), *group_cols, "n_rows"))


def dedup_within_watermark(stream: DataFrame, keys: list[str], time_col: str,
                           delay: str = "72 hours") -> DataFrame:
    """Drop copies of a key that arrive while the key's first copy is still
    within the watermark delay. Keeps the *first* copy seen, so it removes
    retries; corrections need the batch bounded dedup (ordered survivor)."""
    s = with_event_watermark(stream, time_col, delay)
    return s.dropDuplicatesWithinWatermark(keys).drop("_wm_time")


def run_update_query(agg: DataFrame, path: str, checkpoint: str) -> None:
    """Materialise an update-mode aggregation: every micro-batch appends its
    updated rows tagged with the batch id; :func:`read_latest` keeps the
    last update per key. Drains available input, then stops."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/sink_batch={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, path: str, key_cols: list[str]) -> DataFrame:
    t = spark.read.parquet(path)
    value_cols = [c for c in t.columns if c not in key_cols and c != "sink_batch"]
    best = t.groupBy(*key_cols).agg(F.max_by(F.struct(*value_cols), F.col("sink_batch")).alias("_v"))
    return best.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def count_flush_windows(stream: DataFrame, path: str, checkpoint: str, time_col: str, group_cols: list[str],
                        minutes: int = 5, delay_hours: int = 72) -> None:
    """Window counts of a stream that lose no row: every micro-batch adds its
    own counts, in a directory of its own (a replay replaces it). Rows more
    than ``delay_hours`` behind the newest time of earlier batches, and rows
    without a time, are counted apart, as ``late`` (the side table): their
    windows are closed. :func:`read_flush_windows` adds both up."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = read_if_there(spark, f"{path}/newest", "newest timestamp_ntz, sink_batch long")
        newest = None if marks is None else marks.where(F.col("sink_batch") < batch_id).agg(F.max("newest")).first()[0]
        batch.agg(F.max(time_col).alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/sink_batch={batch_id}")
        t = F.col(time_col)
        behind = F.lit(False) if newest is None else add_hours(t, delay_hours) < F.lit(newest)
        (batch.groupBy(floor_minutes(t, minutes).alias("flush_start"), *group_cols,
                       F.coalesce(behind, F.lit(True)).alias("late"))
         .agg(F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(f"{path}/counts/sink_batch={batch_id}"))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_flush_windows(spark: SparkSession, path: str, group_cols: list[str]) -> DataFrame:
    """Counts per window and group, late rows added back (``n_late`` of them)."""
    t = spark.read.parquet(f"{path}/counts")
    return t.groupBy("flush_start", *group_cols).agg(
        F.sum("n_rows").alias("n_rows"), F.sum(F.when(F.col("late"), F.col("n_rows")).otherwise(0)).alias("n_late"))


def run_append_query(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Drain a stateless or watermarked-append stream into Parquet via
    foreachBatch (batch-addressed directories, replay-safe). Read it back
    with ``spark.read.parquet(path).drop("sink_batch")``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/sink_batch={batch_id}")

    q = (stream.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
