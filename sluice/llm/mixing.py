"""Mixing sources to target weights.

Words are summed per source; each source's target is its share by weight, at
most ``most`` times its size, the excess shared anew by weight among the rest.
A document is emitted floor(rate) times, and once more with the probability of
the rate's fraction: a Bernoulli draw seeded by the hash of its id. Of
``SEEDS`` such draws, each source takes the one whose words come nearest to
its target, so that a few long documents don't carry a small source away.

Nulls: a null text has size 0; null sources are one source, the last one; null
ids share one draw. A source without words has target 0 and no copies. Empty
tables give no rows. Repeated rows are drawn alike. ``mix`` keeps the columns
of the input; its own names end in two underscores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import WORD, checked_broadcast, materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEEDS = 16


def word_count(col):
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("bigint")


def draws(id_col: str):
    """``SEEDS`` uniform numbers in [0, 1) from md5 of the id."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    out = []
    for i in range(SEEDS // 4):
        digest = F.md5(F.concat(text, F.lit(f":{i}")).cast("binary"))
        out += [F.conv(F.substring(digest, 1 + 8 * j, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
                for j in range(4)]
    return out


def _weighted(sources: DataFrame, weights: tuple) -> DataFrame:
    """Sources in code-point order, null last, with the repeating weights. The
    order is dealt to range partitions; only their counts meet."""
    dealt = materialise(sources.repartitionByRange(F.col("source").asc_nulls_last())
                        .withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    nth = F.col("before") + F.row_number().over(inside) - 1
    return materialise(dealt.join(offsets, "part").select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                     (nth % len(weights) + 1).cast("int")).alias("weight")), "mix-weights")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size -> the same with target (words) and rate."""
    s = _weighted(sources, weights)
    cap = (F.col("source_size") * most).cast("double")
    total, weight = s.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * (total or 0) / weight if weight else 0.0    # words for a weight of 1
    while True:
        over = F.col("weight") * level > cap
        full, free = s.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        new = (share * (total or 0) - (full or 0.0)) / free if free else level
        if new <= level:
            break
        level = new
    target = F.least(cap, F.col("weight") * level)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return s.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def rates(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sized`` has id, source and size. One row per source: source_size,
    target, rate and the draw to use."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = materialise(targets(per_source, weights, share, most), "mix-targets")
    u = draws("id")
    joined = _with_rates(sized, t)
    takes = joined.groupBy(F.col("source__r").alias("source")).agg(
        *[F.sum(F.col("size") * _copies(u[i])).alias(f"d{i}") for i in range(SEEDS)])
    best = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"d{i}") - F.col("target")).alias("gap"), F.lit(i).alias("draw"))
        for i in range(SEEDS)]))["draw"]
    return materialise(
        t.join(takes.withColumnRenamed("source", "source__t"), F.col("source").eqNullSafe(F.col("source__t")))
        .select("source", "source_size", "target", "rate", best.alias("draw")), "mix-rates")


def _copies(u):
    whole = F.floor("rate")
    return (whole + (u < F.col("rate") - whole).cast("int")).cast("bigint")


def _with_rates(df: DataFrame, per_source: DataFrame) -> DataFrame:
    widest = per_source.agg(F.max(F.octet_length("source"))).first()[0] or 0
    right = per_source.withColumnRenamed("source", "source__r")
    return df.join(checked_broadcast(right, 64 + widest), F.col("source").eqNullSafe(F.col("source__r")))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             **how) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row."""
    sized = materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                    word_count(F.col(text_col)).alias("size")), "mix-sizes")
    u = F.element_at(F.array(*draws("id")), F.col("draw") + 1)
    return _with_rates(sized, rates(sized, **how)).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", _copies(u).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **how) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the mix takes it,
    with the columns of ``docs``."""
    sized = materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                    word_count(F.col(text_col)).alias("size")), "mix-sizes")
    r = rates(sized, **how).select(F.col("source").alias("source__r"), F.col("rate").alias("rate__"),
                                   F.col("draw").alias("draw__"))
    widest = r.agg(F.max(F.octet_length("source__r"))).first()[0] or 0
    u = F.element_at(F.array(*draws(id_col)), F.col("draw__") + 1)
    whole = F.floor("rate__")
    copies = whole.cast("int") + (u < F.col("rate__") - whole).cast("int")
    joined = docs.join(checked_broadcast(r, 64 + widest), F.col(source_col).eqNullSafe(F.col("source__r")))
    return joined.withColumn("copy__", F.explode(F.array_repeat(F.lit(0), copies))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
