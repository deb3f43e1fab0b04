"""Exact top-k by integer inner product through a pivot-distance index.

Components become floor(256 * x). With M the largest norm, a vector x gets one
more coordinate sqrt(M^2 - |x|^2) and a query q gets 0; then

    |q - x|^2 = |q|^2 + M^2 - 2 q.x

so the highest products are the nearest vectors. Pivots (a bounded sample of
the vectors) get 0 too, which keeps their squared distances integers. Every
vector is keyed by (nearest pivot, distance to it); the keys are sorted and cut
into blocks: annuli around a pivot. A query starts in the annulus that holds
itself, which gives a first k-th best score. It then visits only annuli, and in
them only the sorted run of distances, that the triangle inequality
|d(q,p) - d(p,x)| <= d(q,x) allows to reach that score. So the result is exact.

Nulls: vectors that are null, empty, or hold null or non-finite components, and
rows without an id take no part; nor do vectors whose products might not fit a
long (of d dimensions: with a component beyond 2^22 / sqrt(d), 524,288 for 64).
Vectors meet only those of their own length. A query doesn't meet rows of its
own id; an id given twice is one candidate, with its best score. Empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialise, ship
from sluice.llm.vectors import blob, unblob, valid_matrix

TOP = 5
EVERY = 50
SCALE = 256
PIVOTS = 32
BLOCK = 1024
QUERY_BATCH = 512
LARGEST2 = 1 << 60      # of the dimension times a squared component
NEVER = -(1 << 62)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer products; through floats where those are exact."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    if most < 1 << 52:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x @ y.T


def _integers(batches):
    import pyarrow as pa

    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        for dim, (rows, m) in valid_matrix(batch.column("embedding")).items():
            v = np.floor(SCALE * m)
            fine = np.abs(v).max(axis=1) <= np.sqrt(LARGEST2 / dim)
            v = v[fine].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows[fine]].astype(np.int64)), pa.array(np.full(len(v), dim, dtype=np.int32)),
                 pa.array(np.einsum("ij,ij->i", v, v)),
                 pa.array([blob(r.astype("<i4")) for r in v], pa.binary())],
                names=["vec_id", "dim", "norm2", "vector"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<i4").reshape(len(column), -1).astype(np.int64)


def _keys(batches, pivots: dict[int, np.ndarray], top2: int):
    """Nearest pivot and distance to it."""
    import pandas as pd

    for rows in batches:
        for dim, g in rows.groupby("dim", sort=False):
            p = pivots[dim]
            p2 = np.einsum("ij,ij->i", p, p)
            d2 = p2 + top2 - 2 * products(_matrix(g["vector"].to_list()), p)
            yield pd.DataFrame({"vec_id": g["vec_id"], "dim": g["dim"], "norm2": g["norm2"], "vector": g["vector"],
                                "pivot": d2.argmin(axis=1).astype(np.int32),
                                "distance": np.sqrt(d2.min(axis=1).astype(np.float64))})


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the k highest in each row, ties to the smaller id;
    scores of NEVER don't count. A row keeps all that tie with its k-th."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        i, j = np.nonzero((scores >= least[:, None]) & (scores > NEVER))
    else:
        i, j = np.nonzero(scores > NEVER)
    order = np.lexsort((ids[j], -scores[i, j], i))
    i, j = i[order], j[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    i, j = i[nth < k], j[nth < k]
    return i, ids[j], scores[i, j]


def _blocks(batches, size: int):
    """Runs of sorted keys of one pivot, at most ``size`` long."""
    import pandas as pd
    from pyspark import TaskContext

    rest, n, part = None, 0, TaskContext.get().partitionId()

    def block(g):
        nonlocal n
        n += 1
        return {"block": (part << 32) + n, "dim": g["dim"].iat[0], "pivot": g["pivot"].iat[0],
                "low": g["distance"].iat[0], "high": g["distance"].iat[-1], "n": len(g),
                "ids": blob(g["vec_id"].to_numpy("<i8")), "distances": blob(g["distance"].to_numpy("<f8")),
                "norms": blob(g["norm2"].to_numpy("<i8")), "matrix": b"".join(g["vector"])}

    for rows in batches:
        rows = rows if rest is None else pd.concat([rest, rows])
        runs = [g for _, g in rows.groupby(["dim", "pivot"], sort=False)]
        for run in runs[:-1]:
            yield pd.DataFrame([block(run.iloc[i:i + size]) for i in range(0, len(run), size)])
        whole = len(runs[-1]) // size * size if runs else 0
        if whole:
            yield pd.DataFrame([block(runs[-1].iloc[i:i + size]) for i in range(0, whole, size)])
        rest = runs[-1].iloc[whole:] if runs else None
    if rest is not None and len(rest):
        yield pd.DataFrame([block(rest)])


def _home(batches, k: int, every: int):
    """The queries of each block with the best of that block."""
    import pandas as pd

    for blocks in batches:
        for r in blocks.itertuples(index=False):
            ids, norms = unblob(r.ids, "<i8"), unblob(r.norms, "<i8")
            own = np.flatnonzero(ids % every == 0)
            if not len(own):
                continue
            m = unblob(r.matrix, "<i4", len(ids)).astype(np.int64)
            s = products(m[own], m)
            s[ids[own][:, None] == ids] = NEVER
            i, found, score = best(s, ids, k)
            first, last = np.searchsorted(i, np.arange(len(own))), np.searchsorted(i, np.arange(len(own)), "right")
            yield pd.DataFrame({
                "query_id": ids[own], "dim": r.dim, "norm2": norms[own], "home": r.block, "pivot": r.pivot,
                "distance": unblob(r.distances, "<f8")[own],
                "vector": [blob(v.astype("<i4")) for v in m[own]],
                "least": [int(score[b - 1]) if b - a >= k and len(set(found[a:b].tolist())) >= k else NEVER
                          for a, b in zip(first, last)],
                "found": [found[a:b].tolist() for a, b in zip(first, last)],
                "scores": [score[a:b].tolist() for a, b in zip(first, last)]})


def _query_batches(batches, pivots: dict[int, np.ndarray], top2: int, size: int):
    """Queries in batches, with the span of their distances to each pivot and
    the farthest that a better vector can be."""
    import pandas as pd
    from pyspark import TaskContext

    n, part = 0, TaskContext.get().partitionId()
    for rows in batches:
        for dim, g in rows.groupby("dim", sort=False):
            p = pivots[dim]
            for at in range(0, len(g), size):
                q = g.iloc[at:at + size]
                m, n2 = _matrix(q["vector"].to_list()), q["norm2"].to_numpy(np.int64)
                d2 = n2[:, None] + np.einsum("ij,ij->i", p, p) - 2 * products(m, p)
                d = np.sqrt(d2.astype(np.float64))
                least = q["least"].to_numpy(np.int64)
                reach = np.where(least == NEVER, np.inf,
                                 np.sqrt(np.maximum(0, n2 + top2 - 2.0 * least)) * (1 + 1e-9) + 1e-6)
                n += 1
                yield pd.DataFrame([{
                    "batch": (part << 32) + n, "dim": dim, "near": (d - reach[:, None]).min(axis=0).tolist(),
                    "far": (d + reach[:, None]).max(axis=0).tolist(), "ids": blob(q["query_id"].to_numpy("<i8")),
                    "homes": blob(q["home"].to_numpy("<i8")), "least": blob(least), "reach": blob(reach),
                    "to_pivots": blob(d), "matrix": blob(m.astype("<i4"))}])


def _visit(batches, k: int):
    """Each (query batch, annulus): the best of the run that each query may need."""
    import pandas as pd

    for pairs in batches:
        for r in pairs.itertuples(index=False):
            q_ids, ids, distances = unblob(r.q_ids, "<i8"), unblob(r.ids, "<i8"), unblob(r.distances, "<f8")
            d = unblob(r.to_pivots, "<f8", len(q_ids))[:, r.pivot]
            reach, least = unblob(r.reach, "<f8"), unblob(r.least, "<i8")
            first = np.searchsorted(distances, d - reach, "left")
            last = np.searchsorted(distances, d + reach, "right")
            use = np.flatnonzero((first < last) & (unblob(r.homes, "<i8") != r.block))
            if not len(use):
                continue
            a, b = first[use].min(), last[use].max()
            q = unblob(r.q_matrix, "<i4", len(q_ids))[use].astype(np.int64)
            x = unblob(r.matrix, "<i4", len(ids))[a:b].astype(np.int64)
            s = products(q, x)
            s[(s < least[use][:, None]) | (q_ids[use][:, None] == ids[a:b])] = NEVER
            i, found, score = best(s, ids[a:b], k)
            if len(i):
                yield pd.DataFrame({"query_id": q_ids[use][i], "vec_id": found, "score": score})


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, pivots: int = PIVOTS, block: int = BLOCK,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by
    ``every``, its k highest integer inner products with rows of other ids."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding"))
    ints = materialise(rows.where("vec_id is not null").mapInArrow(
        _integers, "vec_id bigint, dim int, norm2 bigint, vector binary"), "integer-vectors")
    top2 = ints.agg(F.max("norm2")).first()[0] or 0
    centres = {}
    for dim in [r["dim"] for r in ints.select("dim").distinct().collect()]:     # a few lengths
        got = ints.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots)
        centres[dim] = _matrix([bytes(r["vector"]) for r in got.select("vector").collect()])
    keyed = ints.mapInPandas(partial(_keys, pivots=centres, top2=top2),
                             "vec_id bigint, dim int, norm2 bigint, vector binary, pivot int, distance double")
    order = ["dim", "pivot", "distance", "vec_id"]
    blocks = materialise(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
            partial(_blocks, size=block),
            "block bigint, dim int, pivot int, low double, high double, n int, ids binary, distances binary, "
            "norms binary, matrix binary"), "annuli")
    home = materialise(blocks.mapInPandas(
        partial(_home, k=k, every=every),
        "query_id bigint, dim int, norm2 bigint, home bigint, pivot int, distance double, vector binary, "
        "least bigint, found array<bigint>, scores array<bigint>"), "home")
    by = ["dim", "pivot", "distance", "query_id"]
    queries = materialise(
        home.select(*by, "norm2", "home", "vector", "least").repartitionByRange(*by).sortWithinPartitions(*by)
        .mapInPandas(partial(_query_batches, pivots=centres, top2=top2, size=QUERY_BATCH),
                     "batch bigint, dim int, near array<double>, far array<double>, ids binary, homes binary, "
                     "least binary, reach binary, to_pivots binary, matrix binary"), "query-batches")
    about = blocks.select("block", F.col("dim").alias("d"), "pivot", "low", "high")
    pairs = queries.select("batch", "dim", "near", "far").join(
        about, (F.col("dim") == F.col("d"))
        & (F.col("high") >= F.element_at("near", F.col("pivot") + 1))
        & (F.col("low") <= F.element_at("far", F.col("pivot") + 1))).select("batch", "block", "pivot")
    q = queries.select(F.col("batch").alias("b"), F.col("ids").alias("q_ids"), "homes", "least", "reach",
                       "to_pivots", F.col("matrix").alias("q_matrix"))
    x = blocks.select(F.col("block").alias("x"), "ids", "distances", "matrix")
    seen = (pairs.join(x, F.col("block") == F.col("x")).join(q, F.col("batch") == F.col("b"))
            .drop("x", "b").mapInPandas(partial(_visit, k=k), "query_id bigint, vec_id bigint, score bigint"))
    first = home.select("query_id", F.explode(F.arrays_zip("found", "scores")).alias("z")).select(
        "query_id", F.col("z.found").alias("vec_id"), F.col("z.scores").alias("score"))
    both = first.union(seen).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
