"""Packing documents into windows by best-fit decreasing.

A document is its ids and an end id. One longer than a window is first cut into
full windows; only what is left over, and shorter documents, are packed, whole:
the longest first, each into the open window with the least room that holds it.
A segment tree indexed by remaining capacity finds that room in logarithmic time.

Where a piece goes depends on its length and on the rooms of open windows only,
and both are at most ``CAPACITY``. So the placing runs over the number of pieces
of each length: all windows with the tightest room take as many pieces of a
length as fit, together, as they would one by one. The outcome is a plan of
runs: from its number among those of its length, a piece's window and offset
follow.

Pieces are numbered without being moved. The task that cuts them counts those of
each length and writes them with their place in its own count; the counts per
length and task then give every task's first number, and a piece looks up the
sum. No length meets in one task, and the driver sees the histogram only.

Nulls: a null text is empty, a piece of the end id alone; null ids are kept.
Repeated rows are packed each, empty tables give no rows, other columns are
ignored. Very long texts are encoded whole, in one task, and cut.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import tokens
from sluice.llm.common import checked_broadcast, materialise, ship

WORD_BPE = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 1
ROWS = 500           # texts that are Python objects at once


class Rooms:
    """Open windows by remaining capacity. A node of the tree has the number of
    windows whose room lies in its half of its parent's range; the windows of a
    room are kept as ranges of numbers."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open = [0] * (4 * (capacity + 1))
        self.ranges: dict[int, list[list[int]]] = {}

    def _count(self, room: int, change: int) -> None:
        node, low, high = 1, 0, self.capacity
        self.open[node] += change
        while low < high:
            middle = (low + high) // 2
            if room <= middle:
                node, high = 2 * node, middle
            else:
                node, low = 2 * node + 1, middle + 1
            self.open[node] += change

    def tightest(self, need: int, node: int = 1, low: int = 0, high: int | None = None) -> int | None:
        """The least room of at least ``need`` with an open window."""
        high = self.capacity if high is None else high
        if high < need or not self.open[node]:
            return None
        if low == high:
            return low
        middle = (low + high) // 2
        left = self.tightest(need, 2 * node, low, middle)
        return left if left is not None else self.tightest(need, 2 * node + 1, middle + 1, high)

    def put(self, room: int, first: int, windows: int) -> None:
        self.ranges.setdefault(room, []).append([first, windows])
        self._count(room, windows)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """(first, number) of up to ``most`` windows of this room, in a row."""
        some = self.ranges[room][-1]
        first, windows = some[0], min(most, some[1])
        some[0] += windows
        some[1] -= windows
        if not some[1]:
            self.ranges[room].pop()
        self._count(room, -windows)
        return first, windows


def place_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first number, first window, pieces a window, offset): pieces
    of a length from that number on go into windows from that one on, up to the
    length's next row."""
    rooms, plan, opened = Rooms(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        number, left = 0, histogram[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                windows = -(-left // (capacity // length))
                rooms.put(capacity, opened, windows)
                opened += windows
                continue
            each = min(room // length, left)
            first, windows = rooms.take(room, left // each)
            plan.append((length, number, first, each, capacity - room))
            rooms.put(room - each * length, first, windows)
            number += windows * each
            left -= windows * each
    return np.array(plan, dtype=np.int64).reshape(-1, 5)


def cut(batches, path: str, capacity: int):
    """mapInArrow over (doc_id, text, task): the pieces, their length's number
    of pieces in this task before them."""
    import pyarrow as pa

    ids_of = tokens.memo(tokens.WordIds, path)
    end, step = END_ID.to_bytes(4, "little"), 4 * capacity
    before: Counter = Counter()
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            row, start, length, crc, total, nth = [], [], [], [], [], []
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for i, ids in enumerate(ids_of.encode(texts)):
                ids += end
                for place in range(0, len(ids), step):
                    piece = ids[place:place + step]
                    n = len(piece) // 4
                    row.append(i)
                    start.append(place // 4)
                    length.append(n)
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids) // 4)
                    nth.append(before[n])
                    before[n] += 1
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), *[pa.array(c, pa.int64()) for c in (start, length, crc, total)],
                 batch.column(2).take(taken), pa.array(nth, pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"])


_KEPT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def look_up(batches, plan: np.ndarray, span: int):
    """mapInArrow over numbered pieces: their window and offset by the plan."""
    import pyarrow as pa

    rows = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    keys = rows[:, 0] * span + rows[:, 1]
    for batch in batches:
        length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
        run = rows[np.searchsorted(keys, length * span + number, side="right") - 1]
        inside = number - run[:, 1]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in _KEPT], pa.array(run[:, 2] + inside // run[:, 3]),
             pa.array(run[:, 4] + inside % run[:, 3] * length)], names=[*_KEPT, "sequence_id", "offset"])


def pack_windows(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset. ``tokenizer`` is the path of a word-wise vocabulary
    file that every executor has."""
    ship(docs.sparkSession)
    path = tokenizer or tokens.default_path(WORD_BPE)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.spark_partition_id().alias("task"))
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"
    longs = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    # Written: a piece's task and number stay what they are, whatever is lost.
    pieces = materialise(rows.mapInArrow(partial(cut, path=path, capacity=capacity),
                                         f"{kind}, {longs}, task int, nth bigint"), "window-pieces")
    counts = materialise(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "window-counts")
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}         # <= capacity rows
    plan = place_lengths(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("length").alias("of_length"), F.col("task").alias("of_task"),
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    same = (F.col("length") == F.col("of_length")) & (F.col("task") == F.col("of_task"))
    numbered = pieces.join(checked_broadcast(bases, 48), same).withColumn("number", F.col("base") + F.col("nth"))
    span = 1 + max(histogram.values(), default=0)
    return numbered.select(*_KEPT, "number").mapInArrow(
        partial(look_up, plan=plan, span=span), f"{kind}, {longs}, sequence_id bigint, offset bigint")
