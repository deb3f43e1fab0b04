"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; every step is a min aggregate (combined map-side), an
equi-join that AQE can split where a node has very many edges, and a distinct.
Before that, each partition contracts its own edges to stars, which takes out
most of the path length. Each round is written to the shared checkpoint
folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, ship


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) of the graph a-b."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)      # hook the roots, so that whole trees move
        np.minimum.at(new, label[y], least)
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _contract(batches):
    import pyarrow as pa

    a, b = [], []
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        if sum(map(len, a)) > 1_000_000:         # keep memory bounded
            x, y = stars(np.concatenate(a), np.concatenate(b))
            a, b = [x], [y]
            if len(x) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(x)], names=["lo", "hi"])
                a, b = [], []
    if a:
        x, y = stars(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(x)], names=["lo", "hi"])


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
        edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("m", "u").alias("m"))
    return _ordered(both.join(least, F.col("u") == F.col("c")).where("v > u"), "v", "m")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "c")
    moved = edges.join(least, F.col("hi") == F.col("c")).select(F.col("lo").alias("v"), "m")
    return _ordered(moved.union(least.select(F.col("c").alias("v"), "m")), "v", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes that have an edge to another one; the
    component is its smallest node. Ids are longs."""
    ship(edges.sparkSession)
    plain = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where("a <> b")
    e = materialise(_ordered(plain.mapInArrow(_contract, "lo bigint, hi bigint"), "lo", "hi"), "edges")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())

    before = mark(e)
    while before[0]:
        e = materialise(_small_star(_large_star(e)), "edges")
        now = mark(e)
        if now == before:
            break
        before = now
    least = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(least)
