"""Best-fit decreasing packing of token pieces into sequences.

All that best-fit decreasing looks at is the length of a piece and the room
left in open sequences, both at most ``CAPACITY``. So the order of placements
is worked out over the histogram of lengths (at most ``CAPACITY`` numbers,
whatever the input): a segment tree over remaining capacities finds the
tightest one that still has an open sequence in logarithmic time, and all
pieces of a length and all sequences with the same room move together. The
result is a plan of runs: the pieces i to j of length l go into sequences from
s on, k to each, at an offset. Pieces get their number among those of their
length by Spark (counts per bucket, then a window) and look themselves up in
the plan; no piece is placed on the driver, and no length meets in one task.

Nulls: a null text is empty, a piece of the one id 0; null ids are kept. Empty
tables give no rows, repeated rows are packed each, other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import tokens
from sluice.llm.common import gapless, materialise, ship

WORD_BPE = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
ROWS = 500           # texts that are Python objects at once


class OpenBins:
    """Segment tree over remaining capacities 0..capacity: which of them have
    open bins, and the numbers of those bins as runs [first, count]."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.runs: dict[int, list[list[int]]] = {}

    def add(self, room: int, first: int, n: int) -> None:
        self.runs.setdefault(room, []).append([first, n])
        self._change(room, n)

    def _change(self, room: int, n: int) -> None:
        i = self.leaves + room
        while i:
            self.count[i] += n
            i //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest room >= need that has an open bin."""
        i = self.leaves + need
        if self.count[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` bins of the last run with this room."""
        run = self.runs[room][-1]
        n = min(most, run[1])
        first = run[0]
        run[0] += n
        run[1] -= n
        if not run[1]:
            self.runs[room].pop()
        self._change(room, -n)
        return first, n


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first piece, first bin, pieces per bin, offset) of each run of
    placements, for ``histogram`` of lengths, by decreasing length."""
    bins, plan, opened = OpenBins(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, piece = histogram[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                per = capacity // length
                n = -(-left // per)
                bins.add(capacity, opened, n)
                opened += n
                room = capacity
            # A bin just used is the tightest one again for as long as another piece fits into it.
            per = room // length
            full, rest = divmod(left, per)
            if full:
                first, n = bins.take(room, full)
                plan.append((length, piece, first, per, capacity - room))
                bins.add(room - per * length, first, n)
                piece += n * per
                left -= n * per
            elif rest:
                first, _ = bins.take(room, 1)
                plan.append((length, piece, first, rest, capacity - room))
                bins.add(room - rest * length, first, 1)
                piece += rest
                left = 0
    return plan


def cut_pieces(batches, path: str, capacity: int):
    """mapInArrow over (doc_id, text): the pieces of each document."""
    import pyarrow as pa

    ids_of = tokens.memo(tokens.WordIds, path)
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = 4 * capacity
    for whole in batches:
        for first in range(0, whole.num_rows, ROWS):
            batch = whole.slice(first, ROWS)
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            row, piece, start, length, crc = [], [], [], [], []
            for i, data in enumerate(ids_of.encode(texts)):
                data += end
                for p, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    row.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])


def place(batches, plan: np.ndarray):
    """mapInArrow: look the pieces up in the plan by (length, number)."""
    import pyarrow as pa

    span = 1 << 40
    keys = plan[:, 0] * span + plan[:, 1]
    order = np.argsort(keys)
    keys, rows = keys[order], plan[order]
    for batch in batches:
        length = batch.column("length").to_numpy()
        nth = batch.column("nth").to_numpy()
        run = rows[np.searchsorted(keys, length * span + nth, side="right") - 1]
        inside = nth - run[:, 1]
        columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(run[:, 2] + inside // run[:, 3]),
             pa.array(run[:, 4] + inside % run[:, 3] * length)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. ``tokenizer`` is the path of a word-wise vocabulary file."""
    ship(docs.sparkSession)
    path = tokenizer or tokens.default_path(WORD_BPE)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = materialise(rows.mapInArrow(
        partial(cut_pieces, path=path, capacity=capacity),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}   # <= capacity rows
    plan = np.array(best_fit_plan(histogram, capacity) or [(0, 0, 0, 1, 0)], dtype=np.int64)
    numbered = gapless(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "nth",
                       max(histogram.values(), default=0))
    return numbered.mapInArrow(
        partial(place, plan=plan),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
