"""Packing into windows: the plan against best-fit decreasing piece by piece,
the pieces against the library's own ids."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from llm.fixtures import doc_rows, documents
from sluice.llm import tokens, windows
from sluice.llm.common import table
from sluice.llm.queries import QUERIES


def one_by_one(lengths, capacity):
    """Fills of the windows by plain best-fit decreasing."""
    fills = []
    for n in sorted(lengths, reverse=True):
        room, i = min(((capacity - f, i) for i, f in enumerate(fills) if capacity - f >= n), default=(None, None))
        if i is None:
            fills.append(n)
        else:
            fills[i] += n
    return sorted(fills)


def placed(histogram, capacity):
    """(window, offset, length) of every piece by the plan."""
    plan = windows.place_lengths(histogram, capacity)
    out = []
    for length, n in histogram.items():
        rows = sorted(r.tolist() for r in plan if r[0] == length)
        for i in range(n):
            _, first, window, each, offset = [r for r in rows if r[1] <= i][-1]
            out.append((window + (i - first) // each, offset + (i - first) % each * length, length))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([16, 64, 100])
    lengths = [min(capacity, max(1, int(rnd.paretovariate(0.7) * rnd.choice([1, 4, 20])))) for _ in range(rnd.choice([3, 60, 500]))]
    spots = defaultdict(list)
    for window, offset, length in placed(Counter(lengths), capacity):
        spots[window].append((offset, length))
    for pieces in spots.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sum(n for _, n in p) for p in spots.values()) == one_by_one(lengths, capacity)


def test_tightest_room():
    rooms = windows.Rooms(20)
    assert rooms.tightest(1) is None
    for room, n in ((7, 2), (12, 1), (0, 5), (20, 1)):
        rooms.put(room, 10 * room, n)
    assert [rooms.tightest(n) for n in (0, 1, 7, 8, 13, 20)] == [0, 7, 7, 12, 20, 20]
    assert rooms.take(7, 9) == (70, 2) and rooms.tightest(3) == 12


def check(got, rows, capacity):
    """Every id of every row in one piece, windows gapless, sums right."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokens.default_path(windows.WORD_BPE))
    want = Counter()
    for i, text in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, windows.END_ID]
        for at in range(0, len(ids), capacity):
            part = ids[at:at + capacity]
            want[i, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    spots = defaultdict(list)
    for r in got:
        spots[r.sequence_id].append((r.offset, r.length))
    for pieces in spots.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return [sum(n for _, n in p) for p in spots.values()]


def test_odd_rows_small_windows(spark):
    docs = documents(spark).withColumns({"task": F.lit(1), "nth": F.lit(2), "number": F.lit(3), "base": F.lit(4)})
    rows = [(i, t) for i, t, *_ in doc_rows()]
    for capacity in (7, 64, 2048):
        fills = check(windows.pack_windows(docs.repartition(5), capacity).collect(), rows, capacity)
        lengths = []
        for i, t in rows:
            n = sum(r.length for r in windows.pack_windows(documents(spark, [(i, t, "", "", 0)]), 1 << 20).collect()) \
                if capacity == 7 else None
            lengths += [capacity] * (n // capacity) + ([n % capacity] if n % capacity else []) if n else []
        if lengths:
            assert sorted(fills) == one_by_one(lengths, capacity)
    assert windows.pack_windows(documents(spark, [])).count() == 0


def test_query_keeps_every_id_and_pads_little(spark):
    docs = table(spark, SF001, "documents")
    got = QUERIES["op12_best_fit_windows"](spark, SF001).collect()
    fills = check(got, [tuple(r) for r in docs.select("doc_id", "text").collect()], windows.CAPACITY)
    assert len(fills) <= -(-sum(fills) // windows.CAPACITY) + 1


def test_plan_of_many_pieces_is_small():
    rnd = np.random.default_rng(2)
    histogram = Counter(np.minimum(2048, rnd.lognormal(6, 1.2, 200_000).astype(int) + 1).tolist())
    big = {k: 10_000 * v for k, v in histogram.items()}
    plan = windows.place_lengths(big)
    assert len(plan) < 20_000
    used = plan[:, 2].max()
    assert used * 2048 <= 1.001 * sum(k * v for k, v in big.items()) + 2048
