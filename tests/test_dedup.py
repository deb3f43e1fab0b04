import pytest
from pyspark.sql import functions as F

from conftest import SF01
from sluice.operators import dedup
from sluice.sources.telemetry import ORDER_COLUMNS, load_telemetry, read_events, telemetry_base


@pytest.fixture(scope="module")
def t(spark):
    return load_telemetry(spark, SF01)


def test_bounded_dedup_keeps_corrections_escapes_and_originals(t):
    out = dedup.dedup_bounded(t, ["event_id"], ORDER_COLUMNS, "ingestion_timestamp", 72)
    lag_h = F.timestamp_diff("HOUR", "event_timestamp", "ingestion_timestamp")
    corr = out.where(F.col("source_sequence_number") >= F.floor(F.col("event_id") / 3) + 1000).count()
    escape = out.where(lag_h >= 72).count()
    assert (out.count(), corr, escape) == (10010, 34, 10)
    # identity is event_id: every event survives, escapes add one copy each
    assert out.select("event_id").distinct().count() == 10000


def test_naive_producer_sequence_key_merges_unrelated_events(t):
    """H1: (producer, sequence) is not an identity; at sf0.01 it merges
    events in 24 groups although the row count happens to be equal."""
    naive = dedup.dedup_latest(t, ["producer_id", "source_sequence_number"], ["ingestion_timestamp"])
    right = dedup.dedup_bounded(t, ["event_id"], ORDER_COLUMNS, "ingestion_timestamp", 72)
    assert naive.count() == right.count() == 10010
    mixing = (t.groupBy("producer_id", "source_sequence_number")
              .agg(F.count_distinct("event_id").alias("n")).where("n > 1").count())
    assert mixing == 24
    # Same row count, different rows: a correction has another key than its
    # original, so it never supersedes it, and every one of the 34 corrected
    # events keeps its stale original under the naive key.
    kept = ["event_id", "source_sequence_number"]
    stale = naive.select(*kept).exceptAll(right.select(*kept))
    assert stale.count() == 34


def test_latest_picks_highest_sequence_then_latest_ingestion(t):
    out = dedup.dedup_latest(t, ["event_id"], ORDER_COLUMNS)
    assert out.count() == 10000
    r = out.where("event_id = 5").first()          # corrected event
    assert r.event_type == "match_end" and r.source_sequence_number == 1 + 1000
    r = out.where("event_id = 3").first()          # escaped copy: later ingestion wins
    base = t.where("event_id = 3").agg(F.max("ingestion_timestamp")).first()[0]
    assert r.ingestion_timestamp == base


def test_sequence_index_equals_row_number(spark):
    base = telemetry_base(read_events(spark, SF01)).select("event_id", "producer_id")
    out = dedup.sequence_index(base, ["producer_id"], ["event_id"], "seq", num_partitions=7)
    bad = out.where(F.col("seq") != F.floor(F.col("event_id") / 3)).count()
    assert out.count() == 10000 and bad == 0


def test_sequence_index_hot_group_spans_partitions(spark):
    # one group holds everything: the index is still exact
    df = spark.range(0, 5000).select(F.lit(1).alias("g"), (F.col("id") * 7).alias("o"))
    out = dedup.sequence_index(df, ["g"], ["o"], "i", num_partitions=6)
    assert out.where(F.col("i") * 7 != F.col("o")).count() == 0
    assert out.select(F.max("i")).first()[0] == 4999


def test_census_flavors(t):
    got = {r.flavor: (r.n_rows, r.n_keys) for r in
           dedup.duplicate_census(t, ["event_id"], "source_sequence_number", "ingestion_timestamp", 72).collect()}
    assert got == {"identical": (90, 90), "correction": (34, 34), "out_of_window": (10, 10)}


def test_hot_duplicate_group_uses_partial_aggregation(spark):
    """A third of all rows are copies of one key: the survivor is chosen by a
    partial (map-side) aggregate, not a window over the whole group."""
    hot = spark.range(0, 3000).select(F.lit(0).alias("k"), F.col("id").alias("seq"))
    rest = spark.range(1, 6001).select(F.col("id").alias("k"), F.col("id").alias("seq"))
    df = hot.unionByName(rest)
    out = dedup.dedup_latest(df, ["k"], ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan
    assert out.count() == 6001 and out.where("k = 0").first().seq == 2999


def test_incremental_bounded_dedup_keeps_first_arrival_anchor(spark, tmp_path):
    """orig (t0) -> correction (t0+1h) -> copy of orig arriving t0+73h, in
    three runs. The correction replaces the original, but the late copy is
    still judged against t0 (carried as _first_seen) and is kept, as the
    one-shot dedup of all three rows does."""
    from sluice.operators.ingest import reprocess_open_partitions
    from sluice.sources.contract import contract_from_dict
    from sluice.sources.telemetry import player_events_contract_dict
    c = contract_from_dict(player_events_contract_dict(str(tmp_path)))
    schema = "event_id long, source_sequence_number long, ingestion_timestamp timestamp_ntz, event_date date"
    mk = lambda seq, ts: spark.createDataFrame([(1, seq, ts, ts.date())], schema)
    import datetime as dt
    t0 = dt.datetime(2024, 1, 10, 12, 0, 0)
    rows = [mk(1, t0), mk(1001, t0 + dt.timedelta(hours=1)), mk(1, t0 + dt.timedelta(hours=73))]
    rows[2] = rows[2].withColumn("event_date", F.lit(t0.date()))
    path = str(tmp_path / "silver")
    for r in rows:
        reprocess_open_partitions(spark, path, r, c, open_days=3650)
    got = sorted((r.source_sequence_number, r.ingestion_timestamp)
                 for r in spark.read.parquet(path).collect())
    one_shot = dedup.dedup_bounded(rows[0].unionByName(rows[1]).unionByName(rows[2]), ["event_id"],
                                   ORDER_COLUMNS, "ingestion_timestamp", 72)
    want = sorted((r.source_sequence_number, r.ingestion_timestamp) for r in one_shot.collect())
    assert got == want == [(1, t0 + dt.timedelta(hours=73)), (1001, t0 + dt.timedelta(hours=1))]


def test_bounded_dedup_hot_key_joins_map_side(spark):
    """One event id holds a third of the rows. Its rows are salted over all
    join tasks (the hot-key table is bounded and broadcast to flag them);
    the join itself is a shuffle join on (key, salt). Broadcast of the full
    per-key table is disabled, so the spreading comes from the salt."""
    hot = spark.range(0, 30000).select(F.lit(0).cast("long").alias("event_id"),
                                       F.col("id").alias("source_sequence_number"),
                                       F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ingestion_timestamp"))
    rest = spark.range(1, 60001).select(F.col("id").alias("event_id"),
                                        F.col("id").alias("source_sequence_number"),
                                        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ingestion_timestamp"))
    df = hot.unionByName(rest).repartition(16)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = dedup.dedup_bounded(df, ["event_id"], ["source_sequence_number", "ingestion_timestamp"],
                                  "ingestion_timestamp", 72)
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # hot key: arrivals span 30000 s < 72 h, so one survivor; the others are unique
    assert len(rows) == 60001
    assert [r for r in rows if r.event_id == 0][0].source_sequence_number == 29999
    assert "BroadcastHashJoin" in final and "SortMergeJoin" in final and "_salt" in final
    assert "Window" not in final


def test_sequence_index_without_broadcast(spark):
    df = spark.range(0, 3000).select((F.col("id") % 50).alias("g"), F.col("id").alias("o"))
    # offsets are joined without a hint (AQE may still broadcast them at runtime)
    out = dedup.sequence_index(df, ["g"], ["o"], "i", num_partitions=5)
    assert out.where(F.col("i") != F.floor(F.col("o") / 50)).count() == 0


def test_identical_hot_copies_spread_over_salts(spark):
    """A hot key whose rows are all byte-identical copies still spreads over
    several join tasks, and the dedup result is exact."""
    from sluice.operators import skew
    ts = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    hot = spark.range(0, 20000).select(F.lit(0).cast("long").alias("event_id"),
                                       F.lit(7).cast("long").alias("source_sequence_number"),
                                       ts.alias("ingestion_timestamp"))
    rest = spark.range(1, 20001).select(F.col("id").alias("event_id"), F.col("id").alias("source_sequence_number"),
                                        ts.alias("ingestion_timestamp"))
    df = hot.unionByName(rest).repartition(8)
    per = df.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    joined = skew.salted_join(df, per, ["event_id"], 8,
                              hot=skew.hot_keys(df, ["event_id"], 0.1))
    # the salt of the hot key's rows takes several values
    salts = (df.where("event_id = 0").select(
        F.pmod(F.xxhash64(F.spark_partition_id(), "source_sequence_number", "ingestion_timestamp"),
               F.lit(8)).alias("s")).distinct().count())
    assert salts > 1
    assert joined.count() == 40000
    out = dedup.dedup_bounded(df, ["event_id"], ["source_sequence_number", "ingestion_timestamp"],
                              "ingestion_timestamp", 72)
    assert out.count() == 20001


def test_sequence_index_hot_run_of_ties_is_split_and_exact(spark):
    df = spark.range(0, 6000).select(F.lit(1).alias("g"), F.lit(5).alias("o"), F.lit("x").alias("v")) \
        .repartition(6)
    out = dedup.sequence_index(df, ["g"], ["o"], "i", num_partitions=6)
    idx = sorted(r.i for r in out.select("i").collect())
    assert idx == list(range(6000))
    per_part = out.groupBy(F.spark_partition_id().alias("p")).count().count()
    assert per_part > 1
