"""Bronze ingest (batch): read a source by its contract, stamp lineage,
write a partitioned Parquet table, count what was written. Plus the
open-partition reprocess that rewrites only recent partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.time import add_hours
from sluice.operators.dedup import dedup_bounded
from sluice.operators.lineage import add_lineage, new_run_id
from sluice.sources.contract import SourceContract
from sluice.sources.scan import file_inventory, read_source


@dataclass(frozen=True)
class IngestResult:
    source: str
    run_id: str
    path: str
    rows: int


def bronze_frame(spark: SparkSession, contract: SourceContract, landing_root: str | None = None,
                 run_id: str | None = None) -> DataFrame:
    """Lazy Bronze rows for a source: landing scan + lineage columns."""
    raw = read_source(spark, contract, landing_root)
    return add_lineage(raw, contract.name, run_id or new_run_id())


def write_table(df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = (),
                mode: str = "overwrite", dynamic: bool = False, rebalance: bool = True) -> None:
    """Partitioned Parquet write.

    ``rebalance`` adds a REBALANCE on the partition columns: AQE then sizes
    write tasks by ``advisoryPartitionSizeInBytes`` and splits a hot
    partition value over several tasks, so each task writes few, well-sized
    files instead of every task writing a small file into every partition.
    ``dynamic`` overwrites only the partitions present in ``df``."""
    out = df.hint("rebalance", *partition_by) if (rebalance and partition_by) else df
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def ingest_full_refresh(spark: SparkSession, contract: SourceContract,
                        landing_root: str | None = None, bronze_path: str | None = None,
                        rebalance: bool = True) -> IngestResult:
    """Replace the Bronze table (rows and schema) with the current landing
    contents, then count the *written* table (not the lazy input)."""
    run_id = new_run_id()
    path = bronze_path or contract.bronze_path
    df = bronze_frame(spark, contract, landing_root, run_id)
    write_table(df, path, contract.partition_by, "overwrite", dynamic=False, rebalance=rebalance)
    rows = spark.read.parquet(path).count()
    return IngestResult(contract.name, run_id, path, rows)


def ingest_all(spark: SparkSession, contracts: list[SourceContract],
               landing_root: str | None = None) -> list[IngestResult]:
    """Ingest every source in name order. Contracts are validated objects
    already, so a broken one has failed before the first write."""
    return [ingest_full_refresh(spark, c, landing_root)
            for c in sorted(contracts, key=lambda c: c.name)]


#: Conditions under which a table is absent; any other failure is raised.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_there(spark: SparkSession, path: str, schema=None, **options) -> DataFrame | None:
    """The Parquet table at ``path``, its files' schemas merged (or with
    ``schema``, reading no file), or None where there is none yet."""
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    try:
        return reader.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


MERGE_ID = "_merge_id"


def reprocess_open_partitions(spark: SparkSession, table_path: str, batch: DataFrame,
                              contract: SourceContract, open_days: int = 3,
                              time_col: str = "ingestion_timestamp", merge_id: str | None = None,
                              as_of=None) -> DataFrame:
    """Merge a new batch into the open (most recent ``open_days``) date
    partitions it touches, re-running bounded dedup over those partitions
    only, and rewrite just them (dynamic partition overwrite).

    Returns the batch rows that belong to closed partitions or have no
    partition value; the caller routes them to a side table instead of
    reopening history.

    ``as_of`` is the newest date, from which open partitions count; then the
    first batch obeys the horizon like the others, and the result doesn't
    depend on the order of batches. Without it, the newest date of table and
    batch counts, and the first batch makes the table.

    ``merge_id`` names the batch. A batch that is merged again under its name
    (a replay) gives the same table: rows it left outside the window, which
    are kept on purpose, are taken out before they come again; inside the
    window the dedup itself is idempotent.

    The table keeps ``_first_seen`` per row (earliest arrival of its key),
    so a key whose first copy was deduplicated away in an earlier run keeps
    its window. All copies of a key share the event time, hence the
    partition, so re-deduplicating one partition is exact. Columns that only
    the table or only the batch has are kept, NULL on the other side.

    The merged rows are checkpointed to the shared checkpoint folder before
    the overwrite, so the write never reads the files it replaces and a
    failed commit can be redone from the checkpoint."""
    part = contract.partition_by[0]
    keys, order = list(contract.dedup_key), list(contract.order_by)
    window_h = contract.dedup_window_hours or 72
    if merge_id is not None:
        batch = batch.withColumn(MERGE_ID, F.lit(merge_id))
    existing = read_if_there(spark, table_path)
    if existing is None and as_of is None:     # first run: the table is the batch, deduplicated
        dated = batch.where(F.col(part).isNotNull())
        merged = dedup_bounded(dated, keys, order, time_col, window_h, keep_first_seen=True)
        write_table(merged, table_path, contract.partition_by, "overwrite", dynamic=True)
        return batch.where(F.col(part).isNull())
    if as_of is None:
        # One scalar (the newest partition) decides the open horizon. The table's
        # newest partition comes from its file listing (values are in the paths),
        # so no data row is read for it.
        listed = (file_inventory(spark, table_path, part)
                  .agg(F.max(F.col(part).cast("date"))).first()[0])
        in_batch = batch.agg(F.max(F.col(part).cast("date"))).first()[0]
        as_of = max((d for d in (listed, in_batch) if d is not None), default=None)
    horizon = F.date_sub(F.lit(as_of), open_days - 1)
    is_open = F.coalesce(F.col(part) >= horizon, F.lit(False))
    open_rows, closed_rows = batch.where(is_open), batch.where(~is_open)
    if existing is None:
        rows = open_rows
    else:
        touched = open_rows.select(part).distinct()
        current = (existing.where(F.col(part) >= horizon)          # static partition pruning
                   .join(touched, part, "left_semi"))              # only partitions the batch touches
        if "_first_seen" not in current.columns:
            current = current.withColumn("_first_seen", F.col(time_col))
        if merge_id is not None and MERGE_ID in current.columns:
            outside = F.col(time_col) > add_hours(F.col("_first_seen"), window_h)
            current = current.where(~F.coalesce((F.col(MERGE_ID) == merge_id) & outside, F.lit(False)))
        rows = current.unionByName(open_rows, allowMissingColumns=True)
    merged = dedup_bounded(rows, keys, order, time_col, window_h, keep_first_seen=True)
    staged = merged.checkpoint(eager=True)
    write_table(staged, table_path, contract.partition_by, "overwrite", dynamic=True)
    return closed_rows
