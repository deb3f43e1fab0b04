"""Near-duplicate vectors by int8 quantised tile products.

Equal vectors of a label form one class, so copies never make pairs. Classes
are sorted by nearest pivot and angle to it and cut into tiles. Two tiles of a
label meet unless, for some pivot, all angles of one differ from all of the
other by more than the angle of the threshold (triangle inequality). Where
they meet, vectors are quantised to int8, multiplied as integers, and only
pairs whose product plus the error bound reaches the threshold are computed
anew in double precision. With unit vectors x = x' + e (x' the quantised one),

    |x.y - x'.y'| <= |e_x| |y'| + |x'| |e_y| + |e_x| |e_y|

and the norms are each vector's own. A meeting returns the number of links of
its vectors and stars that span its links, not the links.

Nulls: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of
different length neither. Null ids are kept, link with nothing and are their
own component (null). Rows repeated with the same id count as copies of each
other. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, ship
from sluice.llm.components import components, stars
from sluice.llm.vectors import blob, unblob, valid_matrix

THRESHOLD = 0.98
PIVOTS = 32
TILE = 1024


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the quantised vectors and of the errors
    (rounded up)."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    up = 1 + 1e-9
    norm = np.sqrt(np.einsum("ij,ij->i", back, back)) * up
    error = np.sqrt(np.einsum("ij,ij->i", unit - back, unit - back)) * up + 1e-12
    return codes, scale, norm, error


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs with cosine >= threshold."""
    ux, uy = _unit(x), _unit(y)
    cx, sx, nx, ex = quantise(ux)
    cy, sy, ny, ey = quantise(uy)
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64     # products of codes are exact
    about = (cx.astype(kind) @ cy.astype(kind).T).astype(np.float64) * sx[:, None] * sy
    about += ex[:, None] * ny + nx[:, None] * ey + ex[:, None] * ey
    i, j = np.nonzero(about >= threshold - 1e-9)
    keep = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 100_000):
        p, q = i[at:at + 100_000], j[at:at + 100_000]
        keep[at:at + 100_000] = np.einsum("ij,ij->i", ux[p], uy[q]) >= threshold
    return i[keep], j[keep]


def _keys(batches, pivots: dict[int, np.ndarray]):
    import pyarrow as pa

    for batch in batches:
        pivot = np.full(batch.num_rows, -1, dtype=np.int32)
        angle = np.zeros(batch.num_rows)
        dims = np.zeros(batch.num_rows, dtype=np.int32)
        fine = np.zeros(batch.num_rows, dtype=bool)
        for dim, (rows, m) in valid_matrix(batch.column("embedding")).items():
            nonzero = np.abs(m).max(axis=1) > 0
            rows, m = rows[nonzero], m[nonzero]
            if not len(rows):
                continue
            cos = _unit(m) @ pivots[dim].T if dim in pivots else np.ones((len(m), 1))
            pivot[rows] = cos.argmax(axis=1)
            angle[rows] = np.arccos(np.clip(cos.max(axis=1), -1, 1))
            dims[rows], fine[rows] = dim, True
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(dims), pa.array(pivot), pa.array(angle)],
            names=[*batch.schema.names, "dim", "pivot", "angle"]).filter(pa.array(fine))


def _tiles(batches, pivots: dict[int, np.ndarray], size: int):
    """Runs of sorted classes of one label and dimension, at most ``size``."""
    import pandas as pd
    from pyspark import TaskContext

    rest, n, part = None, 0, TaskContext.get().partitionId()

    def tile(rows):
        nonlocal n
        n += 1
        m = np.stack(rows["embedding"].to_list()).astype(np.float64)
        dim = m.shape[1]
        angles = np.arccos(np.clip(_unit(m) @ pivots[dim].T, -1, 1)) if dim in pivots else np.zeros((len(m), 1))
        return {"tile": (part << 32) + n, "label": rows["label"].iat[0], "dim": dim, "n": len(rows),
                "low": angles.min(axis=0).tolist(), "high": angles.max(axis=0).tolist(),
                "reps": blob(rows["rep"].to_numpy(np.int64)), "copies": blob(rows["copies"].to_numpy(np.int64)),
                "matrix": blob(m)}

    for rows in batches:
        rows = rows if rest is None else pd.concat([rest, rows])
        runs = [g for _, g in rows.groupby(["label", "dim"], sort=False)]
        for k, run in enumerate(runs):
            last = k == len(runs) - 1
            whole = len(run) // size * size if last else len(run)
            if whole:
                yield pd.DataFrame([tile(run.iloc[i:i + size]) for i in range(0, whole, size)])
            if last:
                rest = run.iloc[whole:]
    if rest is not None and len(rest):
        yield pd.DataFrame([tile(rest)])


def _meet(batches, threshold: float):
    """Each pair of tiles -> (a, links, null) and (a, null, b) rows."""
    import pandas as pd

    for pairs in batches:
        for r in pairs.itertuples(index=False):
            ra, rb = unblob(r.reps, "<i8"), unblob(r.reps_r, "<i8")
            ca, cb = unblob(r.copies, "<i8"), unblob(r.copies_r, "<i8")
            i, j = linked(unblob(r.matrix, "<f8", len(ra)), unblob(r.matrix_r, "<f8", len(rb)), threshold)
            if r.tile == r.tile_r:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            links_a = np.bincount(i, weights=cb[j], minlength=len(ra)).astype(np.int64)
            links_b = np.bincount(j, weights=ca[i], minlength=len(rb)).astype(np.int64)
            node = np.concatenate([ra[links_a > 0], rb[links_b > 0]])
            links = np.concatenate([links_a[links_a > 0], links_b[links_b > 0]])
            u, v = stars(ra[i], rb[j])
            yield pd.DataFrame({"a": np.concatenate([node, u]),
                                "b": pd.array(np.concatenate([np.zeros_like(node), v]), dtype="int64"),
                                "links": np.concatenate([links, np.zeros_like(u)])})


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS,
                           tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row. Positive thresholds."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"),
                          F.col(label_col).alias("label"))
    rows = rows.withColumns({"k1": F.xxhash64("label", "embedding"), "k2": F.xxhash64("embedding", "label")})
    able = rows.where("label is not null and vec_id is not null and size(embedding) > 0")
    classes = able.groupBy("label", "k1", "k2").agg(
        F.min("vec_id").cast("bigint").alias("rep"), F.count(F.lit(1)).alias("copies"),
        F.any_value("embedding").alias("embedding"))
    sample = able.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).select("embedding").toPandas()
    by_dim: dict[int, list] = {}
    for v in sample["embedding"]:
        v = np.array([np.nan if x is None else x for x in v], dtype=np.float64)
        if np.isfinite(v).all() and np.abs(v).max() > 0 and len(by_dim.setdefault(len(v), [])) < pivots:
            by_dim[len(v)].append(v)
    unit = {d: _unit(np.stack(v)) for d, v in by_dim.items() if v}
    keyed = materialise(classes.mapInArrow(
        partial(_keys, pivots=unit), _ddl(classes) + ", dim int, pivot int, angle double"), "vector-classes")
    label = classes.schema["label"].dataType.simpleString()
    tiles = materialise(
        keyed.repartitionByRange("label", "dim", "pivot", "angle", "rep")
        .sortWithinPartitions("label", "dim", "pivot", "angle", "rep")
        .mapInPandas(partial(_tiles, pivots=unit, size=tile),
                     f"tile bigint, label {label}, dim int, n int, low array<double>, high array<double>, "
                     "reps binary, copies binary, matrix binary"), "tiles")
    about = tiles.select("tile", "label", "dim", "low", "high")
    other = about.select(*[F.col(c).alias(f"{c}_r") for c in about.columns])
    apart = float(np.arccos(threshold) + 1e-6)
    far = F.exists(F.arrays_zip("low", "high", "low_r", "high_r"),
                   lambda z: (z["low"] - z["high_r"] > apart) | (z["low_r"] - z["high"] > apart))
    pairs = about.join(other, (F.col("label") == F.col("label_r")) & (F.col("dim") == F.col("dim_r"))
                       & (F.col("tile") <= F.col("tile_r"))).where(~far).select("tile", "tile_r")
    left = tiles.select(F.col("tile").alias("t"), "reps", "copies", "matrix")
    right = tiles.select(F.col("tile").alias("t_r"), *[F.col(c).alias(f"{c}_r") for c in ("reps", "copies", "matrix")])
    met = materialise(
        pairs.join(left, F.col("tile") == F.col("t")).join(right, F.col("tile_r") == F.col("t_r"))
        .select("tile", "tile_r", "reps", "copies", "matrix", "reps_r", "copies_r", "matrix_r")
        .mapInPandas(partial(_meet, threshold=threshold), "a bigint, b bigint, links bigint"), "links")
    links = met.where("links > 0").groupBy("a").agg(F.sum("links").alias("links"))
    comps = components(met.where("links = 0"))
    known = (keyed.select("k1", "k2", "rep", "copies").join(links, F.col("rep") == F.col("a"), "left")
             .join(comps, F.col("rep") == F.col("node"), "left")
             .select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "rep", "component",
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    out = rows.select("vec_id", "k1", "k2", "label").join(
        known, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & F.col("vec_id").isNotNull()
        & F.col("label").isNotNull(), "left")
    comp = F.coalesce("component", "rep", F.col("vec_id").cast("bigint"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), comp.alias("component_id"),
                      (F.col("vec_id") == comp).alias("kept"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
