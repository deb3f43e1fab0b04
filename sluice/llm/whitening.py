"""Embedding whitening with weighted multiplicities.

Every component c of a vector becomes the whole number x = floor(256 * c). Rows
with identical x are grouped; the fit reads each distinct x once, weighted by
its number of rows or by one. Two passes over the distinct vectors give the
exact sums per dimension and then the weighted covariance, each batch centred
by the mean before it is multiplied (one matrix product a batch). Its eigenvectors of the greatest
eigenvalues whiten each distinct vector once, and the result is joined back to
the rows. Vectors that hold a large share of the rows are salted in that join.

Only matrices of a vector's length reach the driver: its square for the
covariance, whatever the rows. Tasks send their sums by matrix row, and these
are added where Spark shuffled them to.

Vectors that are null or hold null or non-finite components take no part;
neither have vectors without components any whitened ones. A product beyond the
range of a long is its end. Vectors of another length are another space, with a
fit of its own. Null ids are kept, repeated rows come once each, an empty table
gives no rows, other columns are ignored. Components without variance (an
eigenvalue not above 1e-12 of the greatest) have a null ``whitened`` and don't
count in ``identity_error``, which is null if there is no other. The exact
``deviation`` is null where it exceeds a long; ``deviation_exact`` has its
decimal digits always.
"""

from __future__ import annotations

from collections import defaultdict
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import checked_broadcast, materialise, ship
from sluice.llm.vectors import valid_matrix
from sluice.operators.skew import hot_keys_from_counts, salted_join

SCALE = 256
COMPONENTS = 4
HOT_SHARE = 0.001        # vectors with this share of the rows are salted; at most 1000
WIDTHS = ("<i2", "<i4", "<i8")
#: The range of a long.
LOW, HIGH = -2 ** 63, 2 ** 63 - 1


def whole_numbers(m: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * component) as longs."""
    x = np.floor(scale * m)
    inside = (x >= LOW) & (x < 2.0 ** 63)
    return np.where(inside, np.where(inside, x, 0).astype(np.int64), np.where(x < 0, LOW, HIGH))


def packed(x: np.ndarray) -> list[bytes]:
    """Each row's numbers in the fewest bytes that hold all of them, so that
    equal rows have equal bytes."""
    out: list = [None] * len(x)
    need = np.zeros(len(x), dtype=int)
    for w in WIDTHS[:-1]:
        limits = np.iinfo(w)
        need += ((x < limits.min) | (x > limits.max)).any(axis=1)
    for i, w in enumerate(WIDTHS):
        rows = np.flatnonzero(need == i)
        for r, line in zip(rows.tolist(), x[rows].astype(w)):
            out[r] = line.tobytes()
    return out


def unpacked(column, dim: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """dimension -> (row numbers, long matrix) of packed vectors."""
    data = column.to_pylist()
    sizes = np.array([len(b) for b in data], dtype=np.int64)
    parts = defaultdict(list)
    for d in np.unique(dim).tolist():
        for w in WIDTHS:
            rows = np.flatnonzero((dim == d) & (sizes == d * np.dtype(w).itemsize))
            if len(rows):
                m = np.frombuffer(b"".join([data[r] for r in rows.tolist()]), dtype=w).reshape(-1, d)
                parts[d].append((rows, m.astype(np.int64)))
    return {d: (np.concatenate([r for r, _ in p]), np.concatenate([m for _, m in p])) for d, p in parts.items()}


def _keys(batches, scale: int):
    """mapInArrow over (vec_id, embedding): vec_id, dim, x of the valid ones."""
    import pyarrow as pa

    for batch in batches:
        for dim, (rows, m) in valid_matrix(batch.column(1)).items():
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dim), pa.int32()),
                 pa.array(packed(whole_numbers(m, scale)), pa.binary())], names=["vec_id", "dim", "x"])


def exact_sums(x: np.ndarray, weight: np.ndarray) -> list[int]:
    """Weighted sum of each column, as exact whole numbers."""
    largest = max(abs(int(x.min())), abs(int(x.max())))
    if largest * int(weight.sum()) < 2 ** 62:
        return (weight @ x).tolist()
    return (weight.astype(object) @ x.astype(object)).tolist()


def _batches_by_dim(batches):
    """(dim, row numbers, long matrix, weights, batch) of batches of distinct
    vectors (dim, x, weight)."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        weights = batch.column("weight").to_numpy()
        for dim, (rows, x) in unpacked(batch.column("x"), dims).items():
            yield dim, rows, x, weights[rows], batch


def _count(batches):
    """mapInArrow over (dim, x, weight): per dim the weights and the sums, a row
    per place, of this task."""
    import pyarrow as pa
    from decimal import Decimal

    total, sums = defaultdict(int), {}
    for dim, _, x, weight, _ in _batches_by_dim(batches):
        total[dim] += int(weight.sum())
        own = exact_sums(x, weight)
        sums[dim] = [a + b for a, b in zip(sums[dim], own)] if dim in sums else own
    for dim, s in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
             pa.array([total[dim]] * dim, pa.int64()), pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))],
            names=["dim", "place", "weight", "total"])


def _products(batches, means: dict):
    """mapInArrow over (dim, x, weight): per dim the rows of this task's
    weighted product of centred vectors."""
    import pyarrow as pa

    sums: dict[int, np.ndarray] = {}
    for dim, _, x, weight, _ in _batches_by_dim(batches):
        centred = x - means[dim]
        own = (centred * weight[:, None]).T @ centred
        sums[dim] = sums[dim] + own if dim in sums else own
    for dim, m in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
             pa.array(list(m), pa.list_(pa.float64()))], names=["dim", "place", "products"])


def _added(batches):
    """mapInArrow over (dim, place, products), all of a place in one task: their sum."""
    import pyarrow as pa

    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        lines = batch.column(2)
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            line = lines[i].values.to_numpy()
            sums[key] = sums[key] + line if key in sums else line.copy()
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in sums], pa.int32()), pa.array([p for _, p in sums], pa.int32()),
             pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["dim", "place", "products"])


def directions(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues by falling size, their share of the trace, and for each a
    column that projects and scales to variance 1 (NaN without variance). The
    sign makes each vector's largest entry positive."""
    value, vector = np.linalg.eigh((covariance + covariance.T) / 2)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    vector = vector * np.where(vector[np.abs(vector).argmax(axis=0), range(len(value))] < 0, -1.0, 1.0)
    fine = value > 1e-12 * max(float(value[0]), 0.0)
    trace = float(np.trace(covariance))
    share = value / trace if trace > 0 else np.full(len(value), np.nan)
    return value, share, vector / np.where(fine, np.sqrt(np.where(fine, value, 1.0)), np.nan)


def squared_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over the dimensions of (n * x - sum)^2 of each row, expanded
    into n^2 x.x - 2 n x.S + S.S."""
    square = sum(s * s for s in sums)
    largest = max(abs(int(x.min())), abs(int(x.max())), 1)
    if largest * largest * x.shape[1] < 2 ** 62 and largest * x.shape[1] < 2 ** 31 and max(map(abs, sums)) < 2 ** 61:
        low = np.array([s & 0x7FFFFFFF for s in sums], dtype=np.int64)
        high = np.array([s >> 31 for s in sums], dtype=np.int64)
        own = np.einsum("ij,ij->i", x, x).tolist()
        with_low, with_high = (x @ low).tolist(), (x @ high).tolist()
        return [n * n * a - 2 * n * (b + (c << 31)) + square for a, b, c in zip(own, with_low, with_high)]
    return [sum((n * v - s) ** 2 for v, s in zip(line, sums)) for line in x.tolist()]


def _whiten(batches, model: dict):
    """mapInArrow over (dim, x, weight): the same with the deviation and the
    whitened components."""
    import pyarrow as pa

    for dim, rows, x, weight, batch in _batches_by_dim(batches):
        n, sums, mean, turn = model[dim]
        z = (x - mean) @ turn
        exact = squared_deviations(x, n, sums)
        flat = pa.array(z.reshape(-1), pa.float64(), from_pandas=True)         # NaN: null
        ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(x), dim), pa.int32()), batch.column("x").take(pa.array(rows)),
             pa.array(weight, pa.int64()), batch.column("copies").take(pa.array(rows)),
             pa.array([v if v <= HIGH else None for v in exact], pa.int64()),
             pa.array([str(v) for v in exact], pa.string()),
             pa.ListArray.from_arrays(pa.array(ends), flat)],
            names=["dim", "x", "weight", "copies", "deviation", "deviation_exact", "z"])


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, dict]:
    """dim -> n, exact sums, mean, eigenvalues' shares and projection, of
    ``distinct`` (dim, x, weight)."""
    spark = distinct.sparkSession
    rows = distinct.select("dim", "x", "weight")
    totals = (rows.mapInArrow(_count, "dim int, place int, weight bigint, total decimal(38,0)")
              .groupBy("dim", "place").agg(F.sum("weight").alias("n"), F.sum("total").alias("total")).collect())
    model: dict[int, dict] = {}
    for r in sorted(totals, key=lambda r: (r["dim"], r["place"])):               # a row per dimension
        own = model.setdefault(r["dim"], {"n": r["n"], "sums": []})
        own["sums"].append(int(r["total"]))
    for own in model.values():
        n = own["n"]
        own["mean"] = np.array([s // n + (s % n) / n for s in own["sums"]])
    means = spark.sparkContext.broadcast({d: m["mean"] for d, m in model.items()})   # a number per dimension
    shape = "dim int, place int, products array<double>"
    lines = (rows.mapInArrow(lambda b: _products(b, means.value), shape)
             .repartition("dim", "place").mapInArrow(_added, shape))
    square = {d: np.zeros((d, d)) for d in model}
    for r in lines.toLocalIterator():                                              # a row per dimension
        square[r["dim"]][r["place"]] = r["products"]
    for d, own in model.items():
        own["value"], own["share"], own["turn"] = directions(square[d] / own["n"], components)
    return model


def identity_errors(whitened: DataFrame, components: int) -> dict[int, float | None]:
    """dim -> largest absolute entry of the whitened components' covariance
    minus the identity, over components with variance. Centred by the mean
    before multiplying."""
    w, z = F.col("weight"), [F.get("z", F.lit(c)) for c in range(components)]
    means = {r["dim"]: r for r in whitened.groupBy("dim").agg(
        *[(F.sum(w * z[c]) / F.sum(w)).alias(f"m{c}") for c in range(components)]).collect()}
    if not means:
        return {}
    rows = whitened.sparkSession.createDataFrame(
        [(d, [r[f"m{c}"] for c in range(components)]) for d, r in means.items()], "dim int, m array<double>")
    joined = whitened.join(checked_broadcast(rows, 16 + 8 * components), "dim")
    off = [z[c] - F.get("m", F.lit(c)) for c in range(components)]
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    covariance = joined.groupBy("dim").agg(
        *[(F.sum(w * off[a] * off[b]) / F.sum(w)).alias(f"c{a}_{b}") for a, b in pairs]).collect()
    out: dict[int, float | None] = {}
    for r in covariance:
        errors = [abs(r[f"c{a}_{b}"] - (a == b)) for a, b in pairs if r[f"c{a}_{b}"] is not None]
        out[r["dim"]] = max(errors, default=None)
    return out


def whiten(embeddings: DataFrame, components: int = COMPONENTS, weights: str = "one", scale: int = SCALE,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per valid row and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error, deviation_exact.
    ``weights``: "one" fits each distinct vector once, "counts" as often as it
    has rows."""
    if weights not in ("one", "counts"):
        raise ValueError(f"weights are 'one' or 'counts', not {weights!r}")
    spark = embeddings.sparkSession
    ship(spark)
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    keyed = materialise(rows.mapInArrow(partial(_keys, scale=scale), f"vec_id {kind}, dim int, x binary"),
                        "whitening-rows")
    distinct = materialise(
        keyed.groupBy("dim", "x").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("weight", F.col("copies") if weights == "counts" else F.lit(1).cast("bigint")), "whitening-distinct")
    model = fit(distinct, components)
    shared = spark.sparkContext.broadcast(                                         # a few numbers per dimension
        {d: (m["n"], m["sums"], m["mean"], m["turn"]) for d, m in model.items()})
    whitened = materialise(distinct.mapInArrow(
        lambda b: _whiten(b, shared.value),
        "dim int, x binary, weight bigint, copies bigint, deviation bigint, deviation_exact string, z array<double>"),
        "whitening-whitened")
    errors = identity_errors(whitened, components)
    figures = spark.createDataFrame(
        [(d, c + 1, m["n"], None if np.isnan(m["share"][c]) else float(m["share"][c]), errors.get(d))
         for d, m in model.items() for c in range(len(m["share"]))],
        "dim int, component int, n bigint, explained double, identity_error double")
    tasks = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys_from_counts(whitened.select("dim", "x", "copies"), "copies", ["dim", "x"], HOT_SHARE, n_tasks=tasks)
    back = salted_join(keyed, whitened.drop("weight", "copies"), ["dim", "x"], tasks, "inner", salt_by=["vec_id"], hot=hot)
    each = back.select("vec_id", "dim", "deviation", "deviation_exact", F.posexplode("z").alias("at", "whitened"))
    return (each.withColumn("component", F.col("at") + 1)
            .join(checked_broadcast(figures, 64), ["dim", "component"])
            .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                    "deviation_exact"))
