"""Minimax contiguous partition into shards, with DataFrame functions only.

Equal texts form one atomic group. Groups stand in the order of a 60-bit hash
of their text (so copies are neighbours) and are cut into contiguous shards
whose largest size is the smallest possible: a binary search over the shard
capacity with a greedy feasibility check.

The order is never collected. The driver searches over a bounded summary of
it: the sizes of hash ranges. A range of one group is atomic, any other is
open. Taking open ranges as divisible gives a lower bound of the capacity,
taking them as atomic an upper bound; while they differ, the ranges where a cut
may fall are split further by one distributed aggregate (a few hundred ranges
at a time, whatever the input). The result is the exact optimum.

Nulls: a text without value has size 0 + ``overhead``, and all of them form
one group. Empty tables give no rows. Repeated rows each get a slot of their
own. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import gapless, materialise

KEY_BITS = 60
FIRST_BITS = 14      # ranges of the first summary: 2^14
MORE_BITS = 7        # parts into which an open range is split: 2^7


class _Summary:
    """Sizes of the hash ranges in order: ``ends`` are running totals,
    ``atomic[i]`` tells whether range i holds a single group."""

    def __init__(self, nodes: list[tuple[int, int, int, bool]]):
        self.nodes = sorted(nodes, key=lambda n: n[0] << n[1])
        self.sizes = [n[2] for n in self.nodes]
        self.atomic = [n[3] for n in self.nodes]
        self.ends, total = [], 0
        for s in self.sizes:
            total += s
            self.ends.append(total)
        self.total = total

    def reach(self, at: int, capacity: int, divide: bool) -> int:
        """The furthest position a shard that starts at ``at`` can end."""
        to = at + capacity
        if to >= self.total:
            return self.total
        i = bisect_right(self.ends, to)          # the range that holds `to`
        start = self.ends[i - 1] if i else 0
        if divide and not self.atomic[i]:
            return to
        return max(at, start)

    def walk(self, capacity: int, shards: int, divide: bool) -> list[int]:
        out, at = [], 0
        for _ in range(shards):
            at = self.reach(at, capacity, divide)
            out.append(at)
        return out

    def smallest(self, shards: int, divide: bool) -> int:
        lo, hi = -(-self.total // shards), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.walk(mid, shards, divide)[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def open_within(self, ranges: list[tuple[int, int]]) -> set[int]:
        found = set()
        for a, b in ranges:
            for i in range(bisect_right(self.ends, a - 1), min(len(self.ends), bisect_left(self.ends, b) + 1)):
                if not self.atomic[i]:
                    found.add(i)
        return found

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Inner cuts near the ideal ones under the optimal capacity: not beyond
        what greedy shards reach from the left, nor short of what the rest
        can hold from the right."""
        bounds = [0, *self.ends]
        least, at = [self.total], self.total
        for _ in range(shards - 1):              # greedy from the right
            at = bounds[bisect_left(bounds, at - capacity)] if at > capacity else 0
            least.append(at)
        least = least[::-1]                      # least[k]: smallest end of shard k
        cuts, at = [], 0
        for k in range(shards - 1):
            most = self.reach(at, capacity, False)
            ideal = (k + 1) * self.total // shards
            i = bisect_left(bounds, ideal)
            near = min(bounds[max(0, i - 1):i + 1], key=lambda x: abs(x - ideal))
            at = min(max(near, least[k], at), most)
            cuts.append(at)
        return cuts


def _ranges(groups: DataFrame, shift: int) -> list[tuple[int, int, int, bool]]:
    """(prefix, shift, size, atomic) of the ranges of 2^shift keys."""
    rows = (groups.groupBy(F.shiftright("key", shift).alias("prefix"))
            .agg(F.sum("size").alias("size"), (F.min("key") == F.max("key")).alias("atomic")).collect())
    return [(r["prefix"], shift, r["size"], r["atomic"]) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest possible largest shard, and the first keys of shards 1 to
    ``shards - 1``. ``groups`` has key (a long of ``KEY_BITS`` bits) and size."""
    nodes = _ranges(groups, KEY_BITS - FIRST_BITS)
    while True:
        s = _Summary(nodes)
        large = {i for i, n in enumerate(s.nodes) if not n[3] and n[2] * 8 * shards > s.total}
        if large:
            split = large
        else:
            low, high = s.smallest(shards, True), s.smallest(shards, False)
            if low == high:
                break
            split = s.open_within(list(zip(s.walk(low, shards, False), s.walk(high, shards, True))))
        by_shift = defaultdict(list)
        for i in split:
            by_shift[s.nodes[i][1]].append(s.nodes[i][0])
        nodes = [n for i, n in enumerate(s.nodes) if i not in split]
        for shift, prefixes in by_shift.items():
            nodes += _ranges(groups.where(F.shiftright("key", shift).isin(prefixes)),
                             max(0, shift - MORE_BITS))
    first = {end: (s.nodes[i + 1][0] << s.nodes[i + 1][1]) if i + 1 < len(s.nodes) else 1 << KEY_BITS
             for i, end in enumerate(s.ends)} | {0: 0}
    return high, [first[c] for c in s.even_cuts(high, shards)] if s.nodes else []


def shard_documents(docs: DataFrame, shards: int = 24, overhead: int = 8, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: the id, size (UTF-8 bytes plus ``overhead``),
    text_crc32 (null for a null text), shard and a slot without gaps in it."""
    text = F.col(text_col)
    key = F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + overhead).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(key, F.lit(0)).alias("key")), "shard-rows")
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    _, cuts = minimax_cuts(groups, shards)
    shard = sum(((F.col("key") >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return gapless(rows.withColumn("shard", shard), ["shard"], ["doc_id", "key"], "slot",
                   rows.count() // max(1, shards)).drop("key")
