"""Near-duplicate vectors and exact top-k against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.fixtures import cosine, linked_components
from sluice.llm import embedding_dedup, topk_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, n=260, dim=12):
    rnd = random.Random(seed)
    rows, centres = [], [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(9)]
    for i in range(n):
        c = rnd.choice(centres)
        noise = rnd.choice([0.0, 0.02, 0.1, 0.25])
        rows.append((i, [float(np.float32(x + rnd.gauss(0, noise))) for x in c], rnd.choice([0, 1, 1, 1])))
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [None] + [1.0] * (dim - 1), [float("inf")] * dim, [1.0] * 3, [2.0] * 3,
           [1.0] * dim, [1.0] * dim]
    rows += [(1000 + 50 * i, v, 1) for i, v in enumerate(odd)]
    return rows + [(2000, rows[0][1], None), (2050, rows[0][1], rows[0][2])]


def fine(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def test_dedup_equals_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"pivot": F.lit(1), "rep": F.lit(2), "tile": F.lit(3)})
    able = [fine(v) and any(v) and label is not None for _, v, label in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if able[a] and able[b]
             and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1])
             and cosine(rows[a][1], rows[b][1]) >= 0.98]
    lowest = linked_components(len(rows), pairs)
    links = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    want = {r[0]: (int(links[i]), rows[lowest[i]][0], rows[lowest[i]][0] == r[0]) for i, r in enumerate(rows)}
    for tile in (1024, 16):
        got = embedding_dedup.near_duplicate_vectors(df, tile=tile).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want and len(got) == len(rows)
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("dim", [3, 64, 1500])
def test_quantisation_bound_holds(dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(60, dim)) * rng.choice([1e-3, 1, 1e6], size=(60, 1))
    y = x + rng.normal(size=(60, dim)) * np.abs(x).mean(axis=1, keepdims=True) * rng.choice([0.01, 0.2, 0.25], size=(60, 1))
    ux, uy = embedding_dedup._unit(x), embedding_dedup._unit(y)
    (cx, sx, nx, ex), (cy, sy, ny, ey) = embedding_dedup.quantise(ux), embedding_dedup.quantise(uy)
    about = (cx.astype(float) @ cy.astype(float).T) * sx[:, None] * sy
    bound = ex[:, None] * ny + nx[:, None] * ey + ex[:, None] * ey
    assert (np.abs(ux @ uy.T - about) <= bound + 1e-12).all()
    i, j = embedding_dedup.linked(x, y, 0.98)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(z.tolist() for z in np.nonzero(ux @ uy.T >= 0.98))))


def test_top_k_equals_brute_force(spark):
    rows = vectors(seed=4) + [(None, [1.0] * 12, 1), (50, vectors(seed=4)[50][1], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit(1), "score": F.lit(2)})
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and fine(v)]
    want = []
    for q in sorted({i for i, _ in ints if i % 50 == 0}):
        score = {}
        for v in (v for i, v in ints if i == q):
            for i, x in ints:
                if i != q and len(x) == len(v):
                    s = sum(a * b for a, b in zip(v, x))
                    score[i] = max(s, score.get(i, s))
        best = sorted(score.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
        want += [(q, n + 1, i, s) for n, (i, s) in enumerate(best)]
    for block in (1024, 8):
        got = topk_search.top_k(df, block=block, pivots=6)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk_search.top_k(df.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    rows = [(i, [float(np.float32(i * 1000.0)), 70000.0 + i, -3.0], 1) for i in range(0, 120, 5)]
    got = topk_search.top_k(spark.createDataFrame(rows, SCHEMA), block=4, pivots=3).collect()
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows]
    want = []
    for q, v in ints:
        if q % 50 == 0:
            best = sorted(((sum(a * b for a, b in zip(v, x)), -i) for i, x in ints if i != q), reverse=True)[:5]
            want += [(q, n + 1, -i, s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
