"""Join strategies and skew handling: size-checked broadcast, salted joins
and two-phase (salted) aggregation for hot keys.

A salt is a deterministic hash of row values, never ``rand()``, so a
retried task puts every row in the same place again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_path

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")


def written_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def join_small_checked(big: DataFrame, small: DataFrame, on, how: str = "inner",
                       max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast ``small`` only if its bytes, once written, are few enough;
    otherwise leave the choice to Catalyst/AQE (sort-merge, with runtime
    broadcast conversion and skew splitting). It is computed once: the join
    reads what was measured."""
    spark = small.sparkSession
    path = scratch_path(spark, "small-side")
    small.write.parquet(path)
    small = spark.read.schema(small.schema).parquet(path)
    return big.join(F.broadcast(small) if written_bytes(small) <= max_broadcast_bytes else small, on, how)


def join_sources(left: DataFrame, right: DataFrame, on, how: str = "inner",
                 strategy: str = "auto", max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Join two sources with an explicit strategy.

    * ``auto``: Catalyst picks from statistics; AQE re-plans at runtime.
    * ``broadcast``: broadcast ``right`` if it has at most
      ``max_broadcast_bytes``; beyond that fall back to sort-merge.
    * ``merge`` / ``shuffle_hash``: force that shuffle join."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; expected one of {STRATEGIES}")
    if strategy == "broadcast":
        return join_small_checked(left, right, on, how, max_broadcast_bytes)
    if strategy in ("merge", "shuffle_hash"):
        return left.join(right.hint(strategy), on, how)
    return left.join(right, on, how)


def salt_column(cols: list[str], n_salts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n_salts)).cast("int")


def hot_keys(df: DataFrame, keys: list[str], min_share: float) -> DataFrame:
    """Keys holding at least ``min_share`` of all rows. At most
    ``1 / min_share`` keys can qualify, so the result is small by proof."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return hot_keys_from_counts(counts, "_n", keys, min_share)


SKETCH_ERROR = 3.5            # a frequent-items sketch of m counters errs by at most 3.5 / m of the rows
SKETCH_LIMIT = 1_000_000      # counters that Spark's sketch can have


def frequent_keys(df: DataFrame, keys: list[str], min_share: float) -> DataFrame:
    """Keys with at least ``min_share`` of all rows, and their exact number of
    rows (``n_rows``), without shuffling the keys: every map task keeps a
    frequent-items sketch of a bounded number of counters over the keys' hashes,
    the sketches are merged, and only the rows of the (few) candidates are
    counted exactly. A key above the share can't be missing: the sketch has
    enough counters that its error is below a quarter of the share. NULL is a
    key like others."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    counters = 1 << max(8, math.ceil(math.log2(4 * SKETCH_ERROR / min_share)))
    if counters > SKETCH_LIMIT:
        raise ValueError(f"a share of {min_share} needs a sketch of more than {SKETCH_LIMIT} counters; use hot_keys")
    hashed = F.xxhash64(*keys)
    row = df.agg(F.call_function("approx_top_k", hashed, F.lit(counters), F.lit(counters)).alias("top"),
                 F.count(F.lit(1)).alias("n")).select(
        "n", F.transform(F.filter("top", lambda x: x["count"] >= F.col("n") * F.lit(min_share / 2)),
                         lambda x: x["item"]).alias("items")).first()
    items = row["items"] or []                       # at most 2 / min_share
    exact = df.where(hashed.isin(items) if items else F.lit(False)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return exact.where(F.col("n_rows") >= F.lit(min_share) * F.lit(row["n"]))


def null_safe_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the key columns come
    once, from ``big``."""
    right = small.withColumnsRenamed({k: f"_small_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_small_{k}")) for k in keys]
    return big.join(right, same, how).drop(*[f"_small_{k}" for k in keys])


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], n_salts: int,
                how: str = "inner", salt_by: list[str] | None = None,
                hot: DataFrame | None = None) -> DataFrame:
    """Equi-join (NULL keys equal each other) where some keys of ``big`` may
    hold a large share of rows.

    Rows of hot keys get salt = hash(``salt_by`` columns) mod the key's salt
    count; the ``small`` rows of those keys are replicated once per salt
    value; the join runs on (keys, salt), so a hot key is spread over that
    many tasks. ``hot`` (bounded, e.g. :func:`hot_keys`) limits salting and
    replication to the hot keys; an optional ``_salts`` column in it gives
    each hot key its own salt count (else ``n_salts``). Without ``hot``
    every key is salted ``n_salts`` ways. Result equals the plain join
    (inner or left with ``big`` on the left)."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("salted_join keeps big on the left: inner/left/semi/anti only")
    salt_by = salt_by or [c for c in big.columns if c not in keys] or keys
    # The input partition id is mixed into the hash so that identical copies
    # of a row (a hot group may be all copies) still spread over the salts;
    # any assignment is correct because ``small`` carries every salt value.
    h = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in salt_by])
    if hot is None:
        big_s = big.withColumn("_salt", F.pmod(h, F.lit(n_salts)).cast("int"))
        small_s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))))
    else:
        salts = F.col("_salts") if "_salts" in hot.columns else F.lit(n_salts)
        flag = F.broadcast(hot.select(*keys, salts.cast("int").alias("_k")))
        big_s = (null_safe_join(big, flag, keys, "left")
                 .withColumn("_salt", F.when(F.col("_k") > 1, F.pmod(h, F.col("_k")))
                             .otherwise(F.lit(0)).cast("int"))
                 .drop("_k"))
        small_s = (null_safe_join(small, flag, keys, "left")
                   .withColumn("_salt", F.explode(F.sequence(F.lit(0),
                                                             F.coalesce(F.col("_k"), F.lit(1)) - 1)))
                   .drop("_k"))
    return null_safe_join(big_s, small_s, [*keys, "_salt"], how).drop("_salt")


def two_phase_aggregate(df: DataFrame, keys: list[str], salt: Column,
                        partial: dict[str, Column], final: dict[str, Column]) -> DataFrame:
    """Aggregate by (keys, salt) first, then by keys. ``final`` expressions
    combine the ``partial`` columns (e.g. sum of counts, min of mins). For an
    exact distinct count salt by a hash of the distinct column: the salted
    slices are then disjoint and their distinct counts add up."""
    first = (df.withColumn("_salt", salt).groupBy(*keys, "_salt")
             .agg(*[c.alias(n) for n, c in partial.items()]))
    return first.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])


def join_hot_split(big: DataFrame, per_key: DataFrame, keys: list[str],
                   hot: DataFrame) -> DataFrame:
    """Inner equi-join of ``big`` with ``per_key`` (one row per key) where
    ``hot`` lists keys that may hold a large share of ``big`` and is bounded
    by construction (e.g. :func:`hot_keys`). Rows of hot keys join a
    broadcast copy of their ``per_key`` rows inside the map task, so a hot
    key is never gathered in one shuffle partition; all other rows take a
    shuffle join. Equal to ``big.join(per_key, keys)``."""
    hk = F.broadcast(hot.select(*keys))
    per_hot = per_key.join(hk, keys, "left_semi")          # at most |hot| rows
    hot_rows = big.join(F.broadcast(per_hot), keys, "inner")
    cold_rows = big.join(hk, keys, "left_anti").join(per_key, keys, "inner")
    return hot_rows.unionByName(cold_rows)


def hot_keys_from_counts(counts: DataFrame, count_col: str, keys: list[str],
                         min_share: float, n_tasks: int | None = None) -> DataFrame:
    """Hot keys from a per-key count table: at most ``1 / min_share`` rows.
    With ``n_tasks``, each key also gets ``_salts`` = ceil(share * n_tasks):
    enough salts for a slice of about one task's share, and the salts of all
    hot keys add up to at most ``n_tasks`` + the number of hot keys."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    total = counts.agg(F.sum(count_col)).scalar()
    hot = counts.where(F.col(count_col) >= total * F.lit(min_share))
    if n_tasks is None:
        return hot.select(*keys)
    return hot.select(*keys, F.greatest(F.lit(1), F.ceil(F.col(count_col) * F.lit(n_tasks) / total))
                      .cast("int").alias("_salts"))
