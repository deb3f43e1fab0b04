"""Incremental Bronze ingest with file-level exactly-once behaviour.

A file-source stream (``availableNow``: drain what is there, then stop)
feeds ``foreachBatch``. Each micro-batch is written to its own directory
``<bronze>/ingest_run=<query id>/ingest_batch=<batch id>/`` with overwrite,
without the files that other committed batches have already ingested. Then come
its files into the registry, and last its progress row, which commits it:

* ``<bronze>/_registry/bucket=<b>/ingest_run=/ingest_batch=``: the files, by a
  hash of their path. A micro-batch reads only the buckets of its own files, and
  looks its (few) files up in them with a broadcast: the history isn't shuffled.
* ``<bronze>/_progress/ingest_run=/ingest_batch=``: rows read and added, files.
  What a run added and what the table holds are sums over these rows; Bronze
  itself isn't counted.

What that gives:

* crash before the progress row: the batch isn't visible; it is replayed with
  the same id and overwrites its own directory -> no duplicates;
* rerun with nothing new: no batch runs, nothing is added;
* checkpoint lost: a new query id, but every file of a committed batch
  is filtered out -> no doubling (the reference silently doubles);
* Spark's own Parquet streaming sink is avoided: with a lost checkpoint
  its ``_spark_metadata`` log makes it drop new data silently.

A file's identity is its path: a rewritten file under the same path is
not read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.ingest import read_if_there
from sluice.operators.lineage import add_lineage, new_run_id
from sluice.sources.contract import SourceContract
from sluice.sources.scan import landing_location, read_source

REGISTRY_DIR = "_registry"
PROGRESS_DIR = "_progress"
COMPACTIONS_DIR = "_compactions"
SCHEMA_LOG_DIR = "_schema_log"
REGISTRY_BUCKETS = 256
BROADCAST_BYTES = 8 << 20      # files whose paths are longer in all are joined by shuffle

REGISTRY_SCHEMA = "_source_file string, n_rows long, bucket int, ingest_run string, ingest_batch long"
PROGRESS_SCHEMA = ("run_id string, rows_read long, rows_added long, n_files long, "
                   "ingest_run string, ingest_batch long")
COMPACTIONS_SCHEMA = "replaced_file string, ingest_batch long, ingest_run string"


@dataclass
class IncrementalResult:
    source: str
    run_id: str
    n_batches: int = 0
    rows_read: int = 0      # rows the stream read (files already ingested included)
    rows_added: int = 0     # growth of the Bronze table in this run
    total_rows: int = 0

    @property
    def no_new_files(self) -> bool:
        return self.rows_read == 0


def bucket_of(path: Column) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(REGISTRY_BUCKETS)).cast("int")


def read_registry(spark: SparkSession, bronze_path: str, buckets: list[int] | None = None) -> DataFrame | None:
    """Files of all batches, also of those not committed; only the directories
    of ``buckets`` are listed if given."""
    root = f"{bronze_path.rstrip('/')}/{REGISTRY_DIR}"
    path = root if buckets is None else f"{root}/bucket={{{','.join(map(str, buckets))}}}"
    return read_if_there(spark, path, REGISTRY_SCHEMA, basePath=root)


def read_progress(spark: SparkSession, bronze_path: str) -> DataFrame | None:
    """One row per committed micro-batch: run id, rows read and added, files."""
    return read_if_there(spark, f"{bronze_path.rstrip('/')}/{PROGRESS_DIR}", PROGRESS_SCHEMA)


def read_compactions(spark: SparkSession, bronze_path: str) -> DataFrame | None:
    """Files that a compaction has replaced, with the directory (run and bin) of
    the file that took their place."""
    return read_if_there(spark, f"{bronze_path.rstrip('/')}/{COMPACTIONS_DIR}", COMPACTIONS_SCHEMA)


DIRECTORIES = ["ingest_run", "ingest_batch"]


def only_live(files: DataFrame, spark: SparkSession, bronze_path: str, path_col: str) -> DataFrame:
    """Rows of ``files`` (with the directory columns and a file path) that lie in
    a committed directory and in no file that a compaction has replaced."""
    committed, compacted = read_progress(spark, bronze_path), read_compactions(spark, bronze_path)
    if committed is None:
        return files.limit(0)
    live = committed.select(*DIRECTORIES)
    if compacted is None:
        return files.join(live.distinct(), DIRECTORIES, "left_semi")
    live = live.unionByName(compacted.select(*DIRECTORIES)).distinct()
    replaced = compacted.select(F.col("replaced_file").alias(path_col))
    return files.join(live, DIRECTORIES, "left_semi").join(replaced, path_col, "left_anti")


def read_bronze(spark: SparkSession, bronze_path: str, schema: T.StructType | None = None) -> DataFrame:
    """The incremental Bronze table: every committed batch directory, compacted
    files instead of those they replaced, without the directory columns.
    Without ``schema`` the files' schemas are merged, so a column that came
    later shows, NULL in earlier rows. Give ``schema`` (the stream's) so a
    table whose batches were all empty still reads."""
    root = bronze_path.rstrip("/")
    if schema is not None:
        table = spark.read.schema(T.StructType(list(schema.fields) + [
            T.StructField("ingest_run", T.StringType()), T.StructField("ingest_batch", T.LongType())])).parquet(root)
    else:
        table = spark.read.option("mergeSchema", "true").parquet(root)
    table = table.withColumn("_bronze_file", F.col("_metadata.file_path"))
    return only_live(table, spark, root, "_bronze_file").drop(*DIRECTORIES, "_bronze_file")


def _log_schema(spark: SparkSession, checkpoint: str, run_id: str, schema: T.StructType) -> None:
    rows = [(run_id, i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    (spark.createDataFrame(rows, "run_id string, position int, field string, type string")
     .coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/{SCHEMA_LOG_DIR}/run_id={run_id}"))


def schema_changes(spark: SparkSession, checkpoint: str, run_a: str, run_b: str) -> DataFrame:
    """Field-by-field comparison of the schemas two runs inferred:
    status ``same`` / ``added`` / ``removed`` / ``changed``."""
    log = spark.read.parquet(f"{checkpoint}/{SCHEMA_LOG_DIR}")
    a = log.where(F.col("run_id") == run_a).select("field", F.col("type").alias("type_a"))
    b = log.where(F.col("run_id") == run_b).select("field", F.col("type").alias("type_b"))
    j = a.join(b, "field", "full_outer")
    status = (F.when(F.col("type_a").isNull(), "added").when(F.col("type_b").isNull(), "removed")
              .when(F.col("type_a") == F.col("type_b"), "same").otherwise("changed"))
    return j.withColumn("status", status)


def _already_ingested(spark: SparkSession, root: str, files: DataFrame, buckets: list[int], run: str, batch_id: int,
                      broadcast_bytes: int) -> DataFrame | None:
    """Those of the ``files`` that another committed batch has ingested; None
    if there is no history in their buckets. Not larger than ``files``."""
    history, committed = read_registry(spark, root, buckets) if buckets else None, read_progress(spark, root)
    if history is None or committed is None:
        return None
    mine = (F.col("ingest_run") == run) & (F.col("ingest_batch") == batch_id)
    others = (history.where(F.col("bucket").isin(buckets) & ~mine)
              .join(committed.select(*DIRECTORIES), DIRECTORIES, "left_semi").select("_source_file"))
    size = files.agg(F.sum(F.octet_length("_source_file"))).first()[0] or 0
    own = files.select("_source_file")
    if size > broadcast_bytes:
        return others.join(own, "_source_file", "left_semi").distinct()
    return F.broadcast(others.join(F.broadcast(own), "_source_file", "left_semi").distinct())


def _batch_writer(bronze_path: str, partition_by: tuple[str, ...], broadcast_bytes: int = BROADCAST_BYTES,
                  run_id: str | None = None):
    root = bronze_path.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        qid = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "adhoc"
        # Rows per file: counted from the files' footers, no column is read.
        files = (batch.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n_rows"))
                 .withColumn("bucket", bucket_of(F.col("_source_file"))).checkpoint(eager=True))
        buckets = sorted(r[0] for r in files.select("bucket").distinct().collect())      # at most REGISTRY_BUCKETS
        seen = _already_ingested(spark, root, files, buckets, qid, batch_id, broadcast_bytes)
        new = batch if seen is None else batch.join(seen, "_source_file", "left_anti")
        added = files if seen is None else files.join(seen, "_source_file", "left_anti")
        out = new.hint("rebalance", *partition_by) if partition_by else new
        written = Observation()
        w = (out.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
             .option("partitionOverwriteMode", "static"))
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{root}/ingest_run={qid}/ingest_batch={batch_id}")
        here = {"ingest_run": F.lit(qid), "ingest_batch": F.lit(batch_id)}
        (added.withColumns(here).repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", *here).parquet(f"{root}/{REGISTRY_DIR}"))
        (files.agg(F.lit(run_id or qid).alias("run_id"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows_read"),
                   F.lit(written.get["rows"]).cast("long").alias("rows_added"), F.count(F.lit(1)).alias("n_files"))
         .coalesce(1).write.mode("overwrite")
         .parquet(f"{root}/{PROGRESS_DIR}/ingest_run={qid}/ingest_batch={batch_id}"))

    return write_batch


def ingest_incremental(spark: SparkSession, contract: SourceContract,
                       landing_root: str | None = None, bronze_path: str | None = None,
                       checkpoint: str | None = None,
                       max_files_per_trigger: int | None = None) -> IncrementalResult:
    """Drain the landing folder's unseen files into Bronze and stop."""
    bronze = (bronze_path or contract.bronze_path).rstrip("/")
    ckpt = (checkpoint or contract.checkpoint_path).rstrip("/")
    run_id = new_run_id()
    # OSS file streams need an explicit schema: infer it with a static read
    # of the landing folder (partition columns included) and log it per run.
    schema = read_source(spark, contract, landing_root).schema
    _log_schema(spark, ckpt, run_id, schema)
    reader = (spark.readStream.format(contract.format).options(**contract.read_options)
              .schema(schema))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(landing_location(contract, landing_root))
    (add_lineage(stream, contract.name, run_id).writeStream
     .foreachBatch(_batch_writer(bronze, contract.partition_by, run_id=run_id))
     .option("checkpointLocation", f"{ckpt}/stream")
     .trigger(availableNow=True).start().awaitTermination())
    result = IncrementalResult(contract.name, run_id)
    progress = read_progress(spark, bronze)
    if progress is not None:
        mine = F.col("run_id") == run_id
        row = progress.agg(F.count_if(mine).alias("batches"), F.sum("rows_added").alias("total"),
                           *[F.coalesce(F.sum(F.when(mine, F.col(c))), F.lit(0)).alias(c)
                             for c in ("rows_read", "rows_added")]).first()
        result.n_batches, result.total_rows = row["batches"], row["total"]
        result.rows_read, result.rows_added = row["rows_read"], row["rows_added"]
    return result


def ingest_silver_stream(spark: SparkSession, stream: DataFrame, contract: SourceContract,
                         silver_path: str, side_path: str, checkpoint: str, open_days: int = 3,
                         time_col: str = "ingestion_timestamp", as_of=None) -> None:
    """Streaming bounded dedup that honours corrections: every micro-batch
    is merged into the open partitions it touches with the ordered,
    windowed dedup (``reprocess_open_partitions``), under its own name, so a
    replayed batch changes nothing; rows for closed partitions are appended
    to ``side_path`` under their batch id. See there for ``as_of``."""
    from sluice.operators.ingest import reprocess_open_partitions

    def merge(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "adhoc"
        closed = reprocess_open_partitions(batch.sparkSession, silver_path, batch, contract,
                                           open_days, time_col, f"{query}-{batch_id}", as_of)
        closed.write.mode("overwrite").parquet(f"{side_path}/side_batch={batch_id}")

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
