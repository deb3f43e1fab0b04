"""Content hashes and order-independent table fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def row_hash(cols: list[str]) -> Column:
    """64-bit hash of a row's values; NULL-safe and order-sensitive in columns."""
    return F.xxhash64(*[F.col(c) for c in cols])


def fingerprint_aggs(cols: list[str]) -> list[Column]:
    """Aggregates whose values do not depend on row or file order: row count,
    the exact sum of row hashes (DECIMAL(38,0) so it never overflows) and
    their XOR. Equal tables give equal triples; a one-row change moves both
    hash aggregates. Each is a combinable aggregate (map-side partials)."""
    h = row_hash(cols)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor(h).alias("hash_xor"),
    ]
