"""Ordered, bounded deduplication and the duplicate census.

Identity is the dedup key (``event_id``); the ordering columns only pick the
survivor. No operator here gathers a whole key group in one task: survivors
are chosen by a combinable aggregate (map-side partials collapse a hot group
to one row per map task), and per-key values that rows need back are joined
on the key, where rows of hot keys (bounded in number) are salted across
many join tasks and only those keys' per-key rows are replicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.time import add_hours
from sluice.operators.skew import hot_keys_from_counts, null_safe_join, salted_join

# Keys holding at least this share of the rows are joined map-side
# (broadcast); there can be at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def sequence_index(df: DataFrame, group_cols: list[str], order_cols: list[str],
                   out_col: str = "sequence_index", num_partitions: int | None = None) -> DataFrame:
    """0-based running index per group in ``order_cols`` order (what
    ``row_number() OVER (PARTITION BY g ORDER BY o) - 1`` gives), computed
    without putting a whole group in one task:

    1. range-partition on (group, order) so a hot group spans many tasks,
       sort inside each partition and number rows by position;
    2. per (partition, group): first position and row count (small table:
       at most partitions + groups rows);
    3. running sum of counts over earlier partitions = each slice's base;
    4. index = base + position - first position.

    The numbered rows are checkpointed (shared checkpoint folder) so both
    passes see the same positions, also after an executor is lost, and the
    data is shuffled once. Rows with a NULL group are a group of their own.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows tied on (group, order) -- e.g. identical copies -- are numbered in
    # any order; a hash of the row and its input partition as the last range
    # key lets even a hot run of ties split across range partitions.
    cols = df.columns
    df = df.withColumn("_tie", F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in cols]))
    keys = [*group_cols, *order_cols, "_tie"]
    ranged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    stats = (ranged.groupBy("_pid", *group_cols)
             .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")))
    before = (Window.partitionBy(*group_cols).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (stats.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .select("_pid", *group_cols, "_first", "_base"))
    joined = null_safe_join(ranged, offsets, ["_pid", *group_cols])
    return (joined.withColumn(out_col, F.col("_base") + F.col("_pos") - F.col("_first"))
            .drop("_pid", "_pos", "_first", "_base", "_tie"))


def _survivor(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the max of (order columns..., remaining columns...).
    The remaining columns only break exact ties, deterministically."""
    others = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + others])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_w"))
    return best.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order_cols + others]) \
               .select(*df.columns)


def dedup_latest(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep one row per key: highest ``order_cols`` (e.g. sequence number,
    then ingestion time as the tiebreak)."""
    return _survivor(df, keys, order_cols)


FIRST_SEEN = "_first_seen"


def first_seen(df: DataFrame, keys: list[str], time_col: str, weight: str | None = None) -> DataFrame:
    """Earliest arrival and row count per key. Rows that carry a
    ``_first_seen`` from an earlier dedup (incremental runs) contribute it
    too, so the window stays anchored at the first copy ever seen, even if
    that copy was dropped. ``weight`` names a column of pre-counted rows."""
    t = F.col(time_col)
    if FIRST_SEEN in df.columns:
        t = F.least(t, F.coalesce(F.col(FIRST_SEEN), t))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*keys).agg(F.min(t).alias(FIRST_SEEN), n.alias("_rows"))


def _tag_first_seen(df: DataFrame, keys: list[str], time_col: str, hot_share: float,
                    weight: str | None = None) -> DataFrame:
    """Rows of ``df`` with their key's ``_first_seen``, in one scan and one
    shuffle join. Rows of hot keys (bounded in number) are salted over a
    number of join tasks proportional to their share, and only those keys'
    per-key rows are replicated (see :func:`salted_join`)."""
    seen = first_seen(df, keys, time_col, weight)
    n = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # each hot key gets ceil(share * n) salts: its slices are about one
    # task's share, and all hot keys together replicate at most ~n rows
    hot = hot_keys_from_counts(seen, "_rows", keys, hot_share, n_tasks=n)
    data = df.drop(FIRST_SEEN)
    return salted_join(data, seen.select(*keys, FIRST_SEEN), keys, n, "inner",
                       salt_by=[c for c in data.columns if c not in keys] or keys, hot=hot)


def _in_window(time_col: str, window_hours: int) -> Column:
    # Rows without a time cannot be shown to be outside the window.
    return F.coalesce(F.col(time_col) <= add_hours(F.col(FIRST_SEEN), window_hours),
                      F.lit(True))


def dedup_bounded(df: DataFrame, keys: list[str], order_cols: list[str], time_col: str,
                  window_hours: int = 72, keep_first_seen: bool = False,
                  hot_share: float = HOT_SHARE) -> DataFrame:
    """Uniqueness only inside ``window_hours`` of a key's first arrival:
    among rows that arrived within the window keep the highest
    ``order_cols``; rows arriving after the window are all kept on purpose.

    ``keep_first_seen`` adds ``_first_seen`` to the output (and it is read
    back from the input when present) so the dedup can be re-run
    incrementally over already deduplicated rows plus new ones. Rows with a
    NULL key are one key's rows.

    The tagged rows are read once: one aggregate keeps, per key, the best row
    inside the window, and each distinct row outside it with its copies."""
    data = df.drop(FIRST_SEEN)
    tagged = _tag_first_seen(df, keys, time_col, hot_share)
    cols = data.columns + ([FIRST_SEEN] if keep_first_seen else [])
    rest = [*order_cols, *[c for c in cols if c not in keys and c not in order_cols]]
    inside, packed = _in_window(time_col, window_hours), F.struct(*[F.col(c) for c in rest])
    best = tagged.groupBy(*keys, F.when(~inside, packed).alias("_outside")).agg(
        F.max(F.when(inside, packed)).alias("_inside"), F.count(F.lit(1)).alias("_copies"))
    copies = F.when(F.col("_outside").isNull(), F.lit(1)).otherwise(F.col("_copies")).cast("int")
    rows = best.select(*keys, F.explode(F.array_repeat(F.coalesce("_outside", "_inside"), copies)).alias("_w"))
    return rows.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest]).select(*cols)


STATE = "_state"
FILTER_BYTES = 64 << 20        # a filter of more bits than this holds isn't broadcast
_BITMAP_BITS = 32_768          # of Spark's bitmap functions
_ROOMY = 16                    # bits of the filter per repeated key


def repeated_keys_filter(df: DataFrame, keys: list[str], filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, int] | None:
    """A set of key hashes that repeat, as (bitmaps by bucket, bits in all).
    A key that occurs twice is in it for certain; one in ``_ROOMY`` of the others,
    at most, is taken for one of them. Only 8-byte hashes are shuffled, once per
    key and map task. None if the repeated keys are too many for a filter of
    ``filter_bytes`` to tell keys apart."""
    hashes = df.select(F.xxhash64(*keys).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = hashes.where(F.col("_n") > 1).select("_h").checkpoint(eager=True)
    n = repeated.count()
    bits = _BITMAP_BITS
    while bits < _ROOMY * n and bits < 8 * filter_bytes:
        bits *= 2
    if bits < 2 * n:
        return None
    place = F.pmod(F.col("_h"), F.lit(bits)) + 1
    bitmaps = repeated.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    return bitmaps, bits


def may_repeat(df: DataFrame, keys: list[str], found: tuple[DataFrame, int] | None, out_col: str) -> DataFrame:
    """Add whether a row's key may be in the filter (always, without one)."""
    if found is None:
        return df.withColumn(out_col, F.lit(True))
    bitmaps, bits = found
    place = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bitmaps), "_bucket", "left")
    return joined.withColumn(out_col, F.coalesce(bit == 1, F.lit(False))).drop("_bucket", "_bits")


def write_bounded(df: DataFrame, path: str, keys: list[str], order_cols: list[str], time_col: str,
                  window_hours: int = 72, partition_by: list[str] | tuple[str, ...] = (),
                  filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows of :func:`dedup_bounded`, written. The input is read twice: once
    for the filter of repeated keys (key columns only), once to write every row,
    those whose key occurs once at their final place, without any shuffle, the
    others aside; these few are then deduplicated and written too. A row that the
    filter takes for a copy by mistake is its own survivor.

    The table has a folder per state (``single``, ``copy``, ``survivor``);
    :func:`read_bounded` reads single rows and survivors."""
    root = path.rstrip("/")
    tagged = may_repeat(df, keys, repeated_keys_filter(df, keys, filter_bytes), "_again")
    states = tagged.withColumn(STATE, F.when(F.col("_again"), "copy").otherwise("single")).drop("_again")
    (states.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(STATE, *partition_by).parquet(root))
    spark = df.sparkSession
    schema = states.schema
    copies = spark.read.schema(schema).parquet(root).where(F.col(STATE) == "copy").drop(STATE)
    survivors = dedup_bounded(copies, keys, order_cols, time_col, window_hours)
    w = survivors.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{root}/{STATE}=survivor")
    return spark.read.schema(schema).parquet(root).where(F.col(STATE) != "copy").select(*df.columns)


def read_bounded(spark, path: str) -> DataFrame:
    """The table that :func:`write_bounded` wrote."""
    return spark.read.parquet(path).where(F.col(STATE) != "copy").drop(STATE)


def duplicate_census(df: DataFrame, keys: list[str], seq_col: str, time_col: str,
                     window_hours: int = 72, hot_share: float = HOT_SHARE) -> DataFrame:
    """Extra copies by flavor, always three rows (flavor, n_rows, n_keys):

    * ``identical``: further copies of an in-window version (same key and
      sequence) -- retries;
    * ``correction``: further in-window versions with another sequence;
    * ``out_of_window``: copies arriving after the window; dedup keeps them.

    Copies with the same key, sequence and time are counted before any
    shuffle of rows, so a key repeated millions of times costs one row."""
    pre = df.groupBy(*keys, seq_col, time_col).agg(F.count(F.lit(1)).alias("_c"))
    tagged = _tag_first_seen(pre, keys, time_col, hot_share, weight="_c").withColumn(
        "_inw", _in_window(time_col, window_hours))
    versions = tagged.groupBy(*keys, seq_col, "_inw").agg(F.sum("_c").alias("_rows"))
    inside = F.col("_inw")
    per_key = versions.groupBy(*keys).agg(
        F.sum(F.when(inside, F.col("_rows") - 1).otherwise(0)).alias("_ident"),
        (F.count_if(inside) - 1).alias("_corr"),
        F.sum(F.when(inside, 0).otherwise(F.col("_rows"))).alias("_late"))
    totals = per_key.agg(*[a for n in ("ident", "corr", "late") for a in (
        F.coalesce(F.sum(f"_{n}"), F.lit(0)).cast("long").alias(f"{n}_rows"),
        F.count_if(F.col(f"_{n}") > 0).alias(f"{n}_keys"))])
    return totals.select(F.expr(
        "stack(3, 'identical', ident_rows, ident_keys, 'correction', corr_rows, corr_keys, "
        "'out_of_window', late_rows, late_keys) AS (flavor, n_rows, n_keys)"))
