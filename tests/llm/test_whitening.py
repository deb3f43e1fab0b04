"""Embedding whitening against plain numpy on exact sums."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(seed=3, n=300, dim=7):
    rng = np.random.default_rng(seed)
    m = (rng.normal(size=(n, dim)) * np.linspace(3, 0.2, dim)) @ rng.normal(size=(dim, dim)) + 1
    m[40:140] = m[40]                                  # a third of the rows are one vector
    m[150:160] = m[150] + rng.random((10, dim)) * 1e-6  # different numbers, mostly the same x
    rows = [(i, [float(v) for v in np.float32(line)], 1) for i, line in enumerate(m)]
    bad = [None, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), []]
    rows += [(1000 + i, v, 1) for i, v in enumerate(bad)]
    return rows + [(None, rows[0][1], None), (5, rows[5][1], 2), (5, rows[5][1], 2)]


def plain(rows, weights="one"):
    """n, sums, vectors x by row number, projected by numpy's eigenvectors."""
    x = {i: tuple(math.floor(256 * c) for c in v) for i, (_, v, _) in enumerate(rows)
         if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = list(x.values()) if weights == "counts" else sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array(fit, dtype=float) - np.array([s / n for s in sums])
    value, vector = np.linalg.eigh(m.T @ m / n)
    return x, n, sums, value[::-1], vector[:, ::-1]


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_equals_numpy(spark, weights):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"dim": F.lit(1), "x": F.lit(2), "copies": F.lit(3), "z": F.lit(4)})
    x, n, sums, value, vector = plain(rows, weights)
    got = whitening.whiten(df.repartition(5), weights=weights).collect()
    assert len(got) == 4 * len(x)
    per: dict = {}
    for r in got:
        per.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    ids = {}
    for i, v in x.items():
        ids.setdefault(rows[i][0], []).append(v)
    for vec_id, vectors in ids.items():
        for c in range(1, 5):
            mine = per.pop((vec_id, c))
            assert len(mine) == len(vectors)
            v = vectors[0]
            want = (np.array(v) - np.array([s / n for s in sums])) @ vector[:, c - 1] / math.sqrt(value[c - 1])
            for r in mine:
                assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(v, sums))
                assert r.deviation_exact == str(r.deviation)
                assert abs(abs(r.whitened) - abs(want)) < 1e-9
                if abs(want) > 1e-6:
                    assert signs.setdefault(c, r.whitened * want > 0) == (r.whitened * want > 0)
                assert abs(r.explained - value[c - 1] / value.sum()) < 1e-9
                assert r.identity_error < 1e-9
    assert not per


def test_spaces_without_variance_and_by_length(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0, 2.0, 3.0], 1), (3, [0.5, 4.0], 1), (4, [1.5, 4.0], 1), (5, [9.0], 1), (6, [8.0], 1)]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sorted(got) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (4, 1), (4, 2), (5, 1), (6, 1)]
    assert got[1, 1].whitened is None and got[1, 1].explained is None and got[1, 1].identity_error is None
    assert got[1, 1].n == 1 and got[1, 1].deviation == 0
    assert abs(got[3, 1].whitened) == pytest.approx(1) and got[3, 2].whitened is None
    assert got[3, 1].explained == pytest.approx(1) and got[3, 1].identity_error < 1e-12
    assert got[5, 1].whitened == -got[6, 1].whitened


def test_empty_and_all_invalid(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id >= 1000")).count() == 0


def test_numbers_and_packing():
    m = np.array([[0.0, -0.0, -1e-9, 0.999], [1e300, -1e300, 200.0, -1.0], [129.0, 0.0, 0.0, -129.0]])
    x = whitening.whole_numbers(m)
    assert x.tolist() == [[0, 0, -1, 255], [2 ** 63 - 1, -2 ** 63, 51200, -256], [33024, 0, 0, -33024]]
    assert [len(b) for b in whitening.packed(x)] == [8, 32, 16]
    import pyarrow as pa
    back = whitening.unpacked(pa.array(whitening.packed(x), pa.binary()), np.array([4, 4, 4]))[4]
    assert sorted(zip(back[0].tolist(), back[1].tolist())) == list(enumerate(x.tolist()))


def test_exact_sums_and_deviations():
    rnd = random.Random(1)
    for top in (300, 2 ** 40, 2 ** 63 - 1):
        x = np.array([[rnd.randrange(-top, top) for _ in range(5)] for _ in range(40)], dtype=np.int64)
        w = np.array([rnd.randrange(1, 2 ** 33) for _ in range(40)])
        sums = [sum(int(a) * int(b) for a, b in zip(w, col)) for col in x.T]
        assert whitening.exact_sums(x, w) == sums
        n = int(w.sum())
        assert whitening.squared_deviations(x, n, sums) == [
            sum((n * int(v) - s) ** 2 for v, s in zip(line, sums)) for line in x]


def test_large_components_take_part(spark):
    rows = [(i, [float(np.float32(v)) for v in (3e38 if i == 0 else i, i * i)], 1) for i in range(8)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 16
    assert all(r.deviation is None for r in got if r.vec_id == 0)
