"""Table maintenance without a transaction log: partition-bounded
compaction (bin-packing small files) and Z-order clustering.

Compaction never crosses a partition (files are written per partition
value) and is verified: the rewritten data must have the same row count
and order-independent fingerprint as the input before it is reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.time import ntz_to_instant
from sluice.operators.audit import file_stats, table_fingerprint
from sluice.session import session_conf
from sluice.sources.scan import LISTING, file_inventory


class CompactionError(RuntimeError):
    """The compacted data does not match its input."""


def partition_file_stats(spark: SparkSession, path: str, part_col: str) -> DataFrame:
    inv = file_inventory(spark, path, part_col)
    return file_stats(inv, [part_col])


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders under a table's path, from one file's path."""
    one = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("p")).first()
    inside = one["p"].split(path.rstrip("/").rsplit("/", 1)[-1], 1)[-1] if one else ""
    return [x.split("=", 1)[0] for x in inside.split("/") if "=" in x]


def _verify(a: DataFrame, b: DataFrame) -> None:
    cols = sorted(a.columns)
    if sorted(b.columns) != cols:
        raise CompactionError(f"columns changed by compaction: {sorted(b.columns)} != {cols}")
    fa, fb = table_fingerprint(a, cols).first(), table_fingerprint(b.select(*cols), cols).first()
    if fa != fb:
        raise CompactionError(f"fingerprint changed by compaction: {fa} != {fb}")


def compact(spark: SparkSession, src: str, part_col: str, dst: str | None = None,
            target_file_bytes: int = 1 << 30, small_file_bytes: int | None = None,
            min_files: int = 2) -> DataFrame:
    """Bin-pack small files, never across partitions.

    * ``dst`` given: write a compacted snapshot of the whole table there;
      ``src`` is untouched and the caller switches readers after the check.
    * ``dst`` None: rewrite in place only the partitions with at least
      ``min_files`` small files; the others are not touched. The chosen
      partitions are checkpointed first, so the overwrite never reads the
      files it replaces.

    Files are packed by a REBALANCE on the partition column with AQE's
    advisory size set to ``target_file_bytes``: a large partition is split
    into several right-sized files, small ones are merged. Returns per
    partition: files and bytes before and after."""
    small_file_bytes = small_file_bytes or target_file_bytes // 2
    if dst is None:
        other = [c for c in partition_columns(spark, src) if c != part_col]
        if other:
            raise CompactionError(f"{src} has partition folders of {other} too; compacting it in place by "
                                  f"{part_col} would mix two layouts. Give dst for a snapshot.")
    before = partition_file_stats(spark, src, part_col).select(
        part_col, F.col("n_files").alias("files_before"),
        F.col("total_bytes").alias("bytes_before"),
        F.col("n_small_files").alias("_small"))
    # Materialise the "before" listing (one row per partition) now: the
    # rewrite below replaces the files it describes.
    before = before.checkpoint(eager=True)
    with session_conf(spark, **LISTING):
        table = spark.read.parquet(src)
    if dst is None:
        # Few rows (one per partition): the list of partitions to rewrite.
        dirty = [r[0] for r in before.where(F.col("_small") >= min_files).select(part_col).collect()]
        if not dirty:
            return before.select(part_col, "files_before", "bytes_before",
                                 F.col("files_before").alias("files_after"),
                                 F.col("bytes_before").alias("bytes_after"),
                                 F.lit(False).alias("compacted"))
        picked = table.where(F.col(part_col).cast("string").isin(dirty))
        staged = picked.checkpoint(eager=True)
        _verify(picked, staged)
        with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=target_file_bytes):
            (staged.hint("rebalance", part_col).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(src))
        _verify(staged, spark.read.parquet(src).where(F.col(part_col).cast("string").isin(dirty)))
        target, compacted = src, F.col("_small") >= min_files
    else:
        with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=target_file_bytes):
            (table.hint("rebalance", part_col).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy(part_col).parquet(dst))
        _verify(table, spark.read.parquet(dst))
        target, compacted = dst, F.lit(True)
    after = partition_file_stats(spark, target, part_col).select(
        part_col, F.col("n_files").alias("files_after"), F.col("total_bytes").alias("bytes_after"))
    return (before.join(after, part_col, "full_outer")
            .select(part_col, "files_before", "bytes_before", "files_after", "bytes_after",
                    compacted.alias("compacted")))


def range_bucket(col: Column, bounds: list) -> Column:
    """Bucket id = number of sorted ``bounds`` strictly below the value,
    as a balanced CASE tree: log2(len(bounds)) comparisons per row, all in
    generated code (NULL sorts into bucket 0)."""

    def tree(lo: int, hi: int) -> Column:
        # bounds[lo:hi] undecided; the answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo).cast("long")
        mid = (lo + hi) // 2
        return F.when(col > F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return F.coalesce(tree(0, len(bounds)), F.lit(0).cast("long"))


def interleave_bits(buckets: list[Column], bits: int) -> Column:
    """Z-value: bit i of column j goes to position i * k + j (k columns)."""
    k = len(buckets)
    if k * bits > 63:
        raise ValueError(f"{k} columns of {bits} bits don't fit a 64-bit key; use fewer bits")
    z = F.lit(0).cast("long")
    for i in range(bits):
        for j, b in enumerate(buckets):
            bit = F.shiftright(b, i).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, i * k + j))
    return z


def order_number(df: DataFrame, col: str) -> Column:
    """A number that sorts like the column: itself, days or microseconds of
    dates and times, the first six bytes of text and binary values."""
    kind = df.schema[col].dataType
    c = F.col(col)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        first = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(ntz_to_instant(c)).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("double")


def zorder_key(df: DataFrame, cols: list[str], bits: int = 8, rel_error: float = 0.001) -> DataFrame:
    """Add ``_zorder``: bit-interleaved range buckets of ``cols``. Bucket
    bounds are approximate quantiles (one distributed aggregate; the
    result is 2^bits - 1 values per column)."""
    if not cols:
        raise ValueError("zorder needs at least one column")
    n = 1 << bits
    probs = [i / n for i in range(1, n)]
    numbers = [order_number(df, c) for c in cols]
    quant = df.select(*[x.alias(f"_q{i}") for i, x in enumerate(numbers)]).stat.approxQuantile(
        [f"_q{i}" for i in range(len(cols))], probs, rel_error)
    buckets = []
    for c, q in zip(numbers, quant):
        bounds = sorted(set(q))
        # A column with few distinct values has fewer buckets than 2^bits:
        # stretch its ids over the whole range so its high bits still split.
        b = range_bucket(c, bounds)
        buckets.append(F.floor(b * F.lit(n) / F.lit(len(bounds) + 1)).cast("long"))
    return df.withColumn("_zorder", interleave_bits(buckets, bits))


def zorder(df: DataFrame, cols: list[str], num_files: int, bits: int = 8) -> DataFrame:
    """Cluster rows so that files hold narrow ranges of every ``cols``
    column: range-partition on the Z-value and sort inside partitions.
    Write the result with ``partitionBy`` as usual; Parquet min/max
    statistics then let filtered scans skip files."""
    keyed = _with_tie(zorder_key(df, cols, bits), df.columns)
    return (keyed.repartitionByRange(num_files, "_zorder", "_tie")
            .sortWithinPartitions("_zorder", "_tie").drop("_zorder", "_tie"))


def _with_tie(df: DataFrame, cols: list[str]) -> DataFrame:
    """Tiebreaker for range partitioning: rows sharing one Z-value (a hot
    value) still split across files."""
    return df.withColumn("_tie", F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in cols]))


def file_column_spans(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """Per data file: min/max of each column and its span (max - min).
    Mean span over files is the clustering measure Z-order improves."""
    t = spark.read.parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    per = t.groupBy("_file").agg(*aggs)
    return per.withColumns({f"{c}_span": F.col(f"{c}_max") - F.col(f"{c}_min") for c in cols})


#: Bytes of rows, as a sort holds them, that one task of a Z-order is given.
TASK_BYTES = 256 << 20


def sorted_bytes(df: DataFrame) -> int:
    """About how many bytes all rows take in a sort: a word per column and what
    texts, binary and nested values hold. Parquet files tell little of that:
    encoded, a row may take a twentieth of it."""
    sizes = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.octet_length(c))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            sizes.append(F.octet_length(F.to_json(F.struct(c))))
    words = 8 * (len(df.columns) + 6)               # header, Z-value, tie and the sort's pointers
    row = F.lit(words).cast("long")
    for x in sizes:
        row = row + F.coalesce(x, F.lit(0)) + 8
    return int(df.agg(F.sum(row)).first()[0] or 0)


def optimize_source(spark: SparkSession, contract, dst: str, target_file_bytes: int = 1 << 30, bits: int = 8,
                    task_bytes: int = TASK_BYTES) -> DataFrame:
    """Per-contract maintenance of a Bronze table into snapshot ``dst``:
    Z-order by ``contract.zorder_by`` when declared (clustering inside each
    partition; files never cross partitions), otherwise bin-packing
    compaction. A Z-order deals the rows to as many tasks as files of
    ``target_file_bytes`` need, and to more where a task would have to sort more
    than ``task_bytes`` of rows; files are then smaller. Returns per-partition files and bytes before and after; the
    row count and fingerprint are verified equal before returning."""
    src = contract.bronze_path
    part = contract.partition_by[0] if contract.partition_by else None
    if not contract.zorder_by:
        if part is None:
            raise ValueError("compaction needs a partition column")
        return compact(spark, src, part, dst=dst, target_file_bytes=target_file_bytes)
    table = spark.read.parquet(src)
    inv = file_inventory(spark, src, part)
    total = inv.agg(F.sum("size_bytes")).first()[0] or 0
    n_files = max(1, -(-int(total) // int(target_file_bytes)), -(-sorted_bytes(table) // int(task_bytes)))
    keyed = _with_tie(zorder_key(table, list(contract.zorder_by), bits), table.columns)
    order = ([part] if part else []) + ["_zorder", "_tie"]
    out = (keyed.repartitionByRange(n_files, *order).sortWithinPartitions(*order)
           .drop("_zorder", "_tie"))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(part) if part else w).parquet(dst)
    _verify(table, spark.read.parquet(dst))
    group = [part] if part else []
    before = file_stats(inv, group).select(*group, F.col("n_files").alias("files_before"),
                                           F.col("total_bytes").alias("bytes_before"))
    after = file_stats(file_inventory(spark, dst, part), group).select(
        *group, F.col("n_files").alias("files_after"), F.col("total_bytes").alias("bytes_after"))
    if group:
        return before.join(after, group, "full_outer")
    # unpartitioned: two one-row aggregates side by side as scalar subqueries
    return before.select("*", after.select("files_after").scalar().alias("files_after"),
                         after.select("bytes_after").scalar().alias("bytes_after"))
