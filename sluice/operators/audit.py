"""Audits of the seeded defects and of table layout: key skew, lateness,
drift, partition balance, completeness, file statistics, blobs,
fingerprints and diffs. All are aggregates; only tiny results reach the
driver, and only when a caller asks for them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.hashing import fingerprint_aggs, sha256_hex
from sluice.functions.json import json_keys
from sluice.functions.time import floor_minutes, seconds_between


def key_shares(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, share of all rows, and whether the key holds the
    largest share (NULL keys form a group, as in SQL GROUP BY). The total is
    a scalar subquery (one extra count) instead of a ``sum() over ()``
    window, which would pull every group into one task."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    top = counts.agg(F.max("n_rows")).scalar()
    return counts.select(key, "n_rows", (F.col("n_rows") / total).alias("share"),
                         (F.col("n_rows") == top).alias("is_hottest"))


def late_rate(df: DataFrame, event_col: str, ingest_col: str,
              threshold_s: int = 300) -> DataFrame:
    """One row: late rows (ingestion - event > threshold, whole seconds),
    all rows, and their ratio (NULL on an empty table)."""
    lag = seconds_between(F.col(event_col), F.col(ingest_col))
    return df.agg(F.sum(F.when(lag > threshold_s, 1).otherwise(0)).cast("long").alias("late_rows"),
                  F.count(F.lit(1)).alias("total_rows")) \
             .withColumn("observed", F.try_divide(F.col("late_rows"), F.col("total_rows")))


ROUTES = ("on_time", "late_open", "late_closed", "no_time")


def route_late(df: DataFrame, event_col: str, ingest_col: str, on_time_s: int = 300,
               open_hours: int = 72) -> DataFrame:
    """Tag each row: ``on_time`` (lag <= on_time_s), ``late_open`` (its
    event-date partition is still open: lag <= open_hours) or
    ``late_closed`` (belongs to a closed partition -> side table). A row that
    lacks one of the times is ``no_time`` and stays in the main table."""
    lag = seconds_between(F.col(event_col), F.col(ingest_col))
    route = (F.when(lag <= on_time_s, "on_time")
             .when(lag <= open_hours * 3600, "late_open")
             .when(lag.isNotNull(), "late_closed").otherwise("no_time"))
    return df.withColumn("route", route)


def split_late(df: DataFrame, event_col: str, ingest_col: str, on_time_s: int = 300,
               open_hours: int = 72) -> tuple[DataFrame, DataFrame]:
    """(rows for the main table, rows late for closed partitions -> side
    table). Both come from one routed plan; every row lands in one side."""
    routed = route_late(df, event_col, ingest_col, on_time_s, open_hours)
    closed = F.col("route") == "late_closed"
    return routed.where(~closed).drop("route"), routed.where(closed).drop("route")


def route_counts(df: DataFrame, event_col: str, ingest_col: str, on_time_s: int = 300,
                 open_hours: int = 72) -> DataFrame:
    routed = route_late(df, event_col, ingest_col, on_time_s, open_hours)
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"))


def partition_balance(df: DataFrame, part_col: str) -> DataFrame:
    """Rows per partition value summarised: partitions, min, max, mean rows
    and spread = (max - min) / max in percent."""
    per = df.groupBy(part_col).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.count(F.lit(1)).alias("n_partitions"),
                   F.min("_n").alias("min_rows"), F.max("_n").alias("max_rows"),
                   (F.sum("_n") / F.count(F.lit(1))).alias("mean_rows"),
                   ((F.max("_n") - F.min("_n")) * 100.0 / F.max("_n")).alias("spread_pct"))


def completeness(expected: DataFrame, actual: DataFrame, keys: list[str],
                 expected_col: str = "expected", actual_col: str = "actual") -> DataFrame:
    """Full outer join of two per-partition aggregates; status is
    ``complete``, ``partial``, ``missing`` (expected, none landed) or
    ``unexpected`` (landed, not expected)."""
    j = expected.join(actual, keys, "full_outer")
    e = F.coalesce(F.col(expected_col), F.lit(0))
    a = F.coalesce(F.col(actual_col), F.lit(0))
    status = (F.when(F.col(expected_col).isNull(), "unexpected")
              .when(F.col(actual_col).isNull() | (a == 0), "missing")
              .when(a < e, "partial").when(a > e, "excess").otherwise("complete"))
    return j.select(*keys, e.alias(expected_col), a.alias(actual_col),
                    (e - a).alias("missing_count"), status.alias("status"))


def flush_cells(df: DataFrame, date_col: str, producer_col: str, time_col: str,
                minutes: int = 5) -> DataFrame:
    """The producer's file grid: one cell per (event date, producer,
    ``minutes`` bucket of ingestion time), with its row count."""
    return (df.groupBy(date_col, producer_col, floor_minutes(F.col(time_col), minutes).alias("flush_start"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def drift_census(df: DataFrame, json_col: str, date_col: str) -> DataFrame:
    """Per JSON key: first and last date seen, dates and rows carrying it.
    Keys are extracted in the scan and counted per (key, date) with map-side
    partials, so only (key, date, count) triples are shuffled, never the
    JSON text itself."""
    keyed = df.select(date_col, F.explode(json_keys(F.col(json_col))).alias("json_key"))
    per_day = keyed.groupBy("json_key", date_col).agg(F.count(F.lit(1)).alias("_n"))
    return per_day.groupBy("json_key").agg(
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
        F.count(F.lit(1)).alias("n_dates"), F.sum("_n").cast("long").alias("n_rows"))


def file_stats(inventory: DataFrame, group_cols: list[str] | None = None,
               max_partition_bytes: int = 128 * 1024 * 1024,
               open_cost_bytes: int = 4 * 1024 * 1024,
               small_file_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """Files, bytes, mean file size, small files and the scan tasks Spark
    will plan: each file costs its size plus the open cost, packed into
    splits of ``max_partition_bytes`` (ceil of the packed total)."""
    grp = inventory.groupBy(*(group_cols or []))
    cost = F.col("size_bytes") + F.lit(open_cost_bytes)
    return grp.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("size_bytes").cast("long").alias("total_bytes"),
        (F.sum("size_bytes") / F.count(F.lit(1))).alias("mean_file_bytes"),
        F.count_if(F.col("size_bytes") < small_file_bytes).alias("n_small_files"),
        F.ceil(F.sum(cost) / F.lit(max_partition_bytes)).cast("long").alias("predicted_scan_tasks"))


def blob_integrity(rows: DataFrame, pointer_col: str, blobs: DataFrame,
                   blob_key: str = "sha256") -> DataFrame:
    """Referential check rows -> blobs (many rows to one blob). One row:
    rows with a pointer, distinct blobs referenced, pointers with no blob
    (and the rows holding them), blobs nobody references, blobs stored.

    Pointers are counted per blob first (a blob shared by a third of all
    rows is one row after the map-side partial aggregate), then one full
    outer join against the stored keys and one global aggregate."""
    ptr = (rows.where(F.col(pointer_col).isNotNull()).groupBy(pointer_col)
           .agg(F.count(F.lit(1)).alias("_refs")))
    store = blobs.select(F.col(blob_key).alias(pointer_col)).distinct() \
                 .withColumn("_stored", F.lit(True))
    both = ptr.join(store, pointer_col, "full_outer")
    referenced = F.col("_refs").isNotNull()
    stored = F.col("_stored").isNotNull()
    return both.agg(
        F.coalesce(F.sum("_refs"), F.lit(0)).cast("long").alias("rows_with_pointer"),
        F.count_if(referenced).alias("blobs_referenced"),
        F.count_if(referenced & ~stored).alias("missing_blobs"),
        F.coalesce(F.sum(F.when(~stored, F.col("_refs"))), F.lit(0)).cast("long").alias("rows_missing_blob"),
        F.count_if(stored & ~referenced).alias("orphan_blobs"),
        F.count_if(stored).alias("blobs_stored"))


def attach_blob_pointer(rows: DataFrame, content_col: str, catalog: DataFrame) -> DataFrame:
    """N:1 outer lookup: each row gets the catalog's blob path for its
    content, NULL when the content has no blob."""
    keyed = rows.withColumn("_sha", sha256_hex(F.col(content_col)))
    cat = catalog.select(F.col("sha256").alias("_sha"), "blob_path")
    # Rows without content (often most of them) don't go through the shuffle.
    found = keyed.where(F.col("_sha").isNotNull()).join(cat, "_sha", "left").drop("_sha")
    none = keyed.where(F.col("_sha").isNull()).drop("_sha").withColumn(
        "blob_path", F.lit(None).cast(cat.schema["blob_path"].dataType))
    return found.unionByName(none)


def table_fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order- and file-layout-independent fingerprint (rows, hash sum, xor)."""
    cols = cols or df.columns
    return df.agg(*fingerprint_aggs(cols))


def table_diff(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Multiset difference both ways in one shuffle: rows are counted +1 in
    ``a`` and -1 in ``b`` per distinct row; a non-zero balance is a
    difference. Output: the row, ``side`` (``only_in_a`` / ``only_in_b``)
    and ``n_copies`` (how many more copies that side holds). Empty means
    equal tables. Copies are counted, never replicated, so a row repeated
    millions of times is still one output row."""
    cols = cols or a.columns
    signed = (a.select(*cols, F.lit(1).alias("_d"))
              .unionByName(b.select(*cols, F.lit(-1).alias("_d"))))
    bal = signed.groupBy(*cols).agg(F.sum("_d").alias("_n")).where(F.col("_n") != 0)
    return bal.select(*cols, F.when(F.col("_n") > 0, "only_in_a").otherwise("only_in_b").alias("side"),
                      F.abs("_n").cast("long").alias("n_copies"))


def hash_tree(df: DataFrame, part_col: str, key_cols: list[str], cols: list[str] | None = None,
              n_buckets: int = 256) -> DataFrame:
    """Leaves of a two-level hash tree: a fingerprint per partition value and
    bucket of the key's hash. One aggregate; map tasks send at most a row per
    partition and bucket. Written beside a table, it spares the table's scan in
    later diffs."""
    bucket = F.pmod(F.xxhash64(*key_cols), F.lit(n_buckets)).cast("int")
    return df.groupBy(part_col, bucket.alias("bucket")).agg(*fingerprint_aggs(cols or df.columns))


def tree_roots(leaves: DataFrame, part_col: str) -> DataFrame:
    """The tree's upper level: a fingerprint per partition value."""
    return leaves.groupBy(part_col).agg(
        F.sum("n_rows").alias("n_rows"), F.sum(F.col("hash_sum").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"))


_FINGERPRINT = ["n_rows", "hash_sum", "hash_xor"]


def _unequal(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (NULL equal to NULL) whose fingerprints differ, or that one side lacks."""
    both = a.select(*keys, *_FINGERPRINT, F.lit(1).alias("_side")).unionByName(
        b.select(*keys, *_FINGERPRINT, F.lit(2).alias("_side")))
    seen = both.groupBy(*keys, *_FINGERPRINT).agg(F.count_distinct("_side").alias("_sides"))
    return seen.where(F.col("_sides") < 2).select(*keys).distinct()


def partition_diff(a_tree: DataFrame, b_tree: DataFrame, part_col: str) -> DataFrame:
    """Per partition value, from the trees alone: rows of both sides, buckets
    that differ and whether the partitions are equal."""
    differing = _unequal(a_tree, b_tree, [part_col, "bucket"]).groupBy(part_col).agg(F.count(F.lit(1)).alias("n_differ"))
    rows = (a_tree.select(part_col, F.col("n_rows").alias("rows_a"), F.lit(0).cast("long").alias("rows_b"))
            .unionByName(b_tree.select(part_col, F.lit(0).cast("long").alias("rows_a"), F.col("n_rows").alias("rows_b")))
            .groupBy(part_col).agg(F.sum("rows_a").alias("rows_a"), F.sum("rows_b").alias("rows_b")))
    found = differing.withColumnRenamed(part_col, "_part")
    n = F.coalesce(F.col("n_differ"), F.lit(0))
    return rows.join(found, F.col(part_col).eqNullSafe(F.col("_part")), "left").select(
        part_col, "rows_a", "rows_b", n.alias("buckets_differing"), (n == 0).alias("is_equal"))


def tree_diff(a: DataFrame, b: DataFrame, part_col: str, key_cols: list[str], cols: list[str] | None = None,
              n_buckets: int = 256, a_tree: DataFrame | None = None, b_tree: DataFrame | None = None) -> DataFrame:
    """:func:`table_diff` of two large tables that mostly agree: fingerprints of
    partitions and buckets are compared first, and only rows of differing buckets
    are shuffled; differing partitions reach the scans as a partition filter.
    Trees written beside the tables spare the first scans."""
    cols = cols or a.columns
    a_tree = hash_tree(a, part_col, key_cols, cols, n_buckets) if a_tree is None else a_tree
    b_tree = hash_tree(b, part_col, key_cols, cols, n_buckets) if b_tree is None else b_tree
    differing = _unequal(a_tree, b_tree, [part_col, "bucket"]).checkpoint(eager=True)
    parts = differing.select(part_col).distinct().limit(MAX_FILTER_PARTS + 1).collect()

    def touched(df: DataFrame) -> DataFrame:
        if len(parts) <= MAX_FILTER_PARTS:
            values = [r[0] for r in parts if r[0] is not None]
            hit = F.col(part_col).isin(values) if values else F.lit(False)
            df = df.where(hit | F.col(part_col).isNull() if len(values) < len(parts) else hit)
        bucket = F.pmod(F.xxhash64(*key_cols), F.lit(n_buckets)).cast("int")
        same = differing.select(F.col(part_col).alias("_part"), F.col("bucket").alias("_bucket"))
        keyed = df.withColumn("_b", bucket)
        return keyed.join(same, F.col(part_col).eqNullSafe(F.col("_part")) & (F.col("_b") == F.col("_bucket")),
                          "left_semi").drop("_b")

    return table_diff(touched(a), touched(b), cols)


MAX_FILTER_PARTS = 1000       # partition values written into a scan's filter


def missing_intervals(expected: DataFrame, actual: DataFrame, group_cols: list[str], at_col: str) -> DataFrame:
    """Gaps and islands over a grid of expected files: per group, each stretch of
    expected cells in a row (by ``at_col``) that did not arrive, with its first
    and last cell, the number of cells and of the group's cells. Both inputs have
    one row per cell; cells that arrived but weren't expected play no part."""
    keys = [*group_cols, at_col]
    found = actual.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    cells = expected.select(*keys).distinct().join(found.withColumn("_found", F.lit(True)), same, "left").withColumn(
        "_missing", F.col("_found").isNull())
    nth = F.row_number().over(Window.partitionBy(*group_cols).orderBy(at_col))
    nth_missing = F.row_number().over(Window.partitionBy(*group_cols, "_missing").orderBy(at_col))
    islands = cells.select(*keys, "_missing", (nth - nth_missing).alias("_island")).where("_missing")
    return islands.groupBy(*group_cols, "_island").agg(
        F.min(at_col).alias("first_missing"), F.max(at_col).alias("last_missing"),
        F.count(F.lit(1)).alias("n_missing")).drop("_island")


def predicted_tasks(total_bytes: int, n_files: int, max_partition_bytes: int = 128 << 20,
                    open_cost_bytes: int = 4 << 20) -> int:
    """Driver-side form of the packing estimate, for reports and tests."""
    return math.ceil((total_bytes + n_files * open_cost_bytes) / max_partition_bytes)
