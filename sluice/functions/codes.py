"""Dictionary decode: small integer code -> string, as a pure expression.

A closed vocabulary is a literal array, so decoding needs no join and no
broadcast; it runs inside whole-stage codegen at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabularies of the reference's telemetry producer, in its order.
EVENT_TYPES = ["login", "logout", "purchase", "match_start", "match_end"]
EXCEPTIONS = ["NullPointerException", "TimeoutException", "OutOfMemoryError"]
DEVICES = ["PS5", "PS4"]
NETWORK_TYPES = ["wifi", "ethernet", "cellular"]


def decode(code: Column, vocabulary: list[str]) -> Column:
    """``vocabulary[code]`` (0-based); out-of-range or NULL codes give NULL."""
    arr = F.array(*[F.lit(v) for v in vocabulary])
    idx = code.cast("int")
    return F.when((idx >= 0) & (idx < len(vocabulary)), F.element_at(arr, idx + 1))


def encode(value: Column, vocabulary: list[str]) -> Column:
    """Inverse of :func:`decode`: 0-based position, NULL when absent."""
    arr = F.array(*[F.lit(v) for v in vocabulary])
    pos = F.array_position(arr, value)
    return F.when(pos > 0, (pos - 1).cast("int"))
