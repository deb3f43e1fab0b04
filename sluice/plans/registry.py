"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the driver's tables (or data Spark derives from them). Results are
passed through :func:`present` so they compare across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.codes import DEVICES, EVENT_TYPES, NETWORK_TYPES, decode
from sluice.functions.compare import round_cents
from sluice.functions.json import json_key, json_object_text
from sluice.functions.time import floor_minutes, iso_timestamp_sql, minute_stamp, ntz_to_instant
from sluice.operators import audit, bronze_compaction, conformance, dedup, gold, ingest, maintain, quality, skew
from sluice.plans.present import present
from sluice.session import scratch_path
from sluice.sources import scan
from sluice.sources.contract import contract_from_dict
from sluice.sources.landing import write_flush_layout, write_landing
from sluice.sources.telemetry import (COLUMNS as TCOLUMNS, DEDUP_WINDOW_H, DRIFT_BOUNDARY,
                                      ORDER_COLUMNS, START_DATE, load_telemetry,
                                      player_events_contract_dict, read_events, telemetry_base)
from sluice.streaming import bounded, incremental, late

KEY = ["event_id"]
N_SALTS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _t(spark, sf_dir) -> DataFrame:
    return load_telemetry(spark, sf_dir)


def _boundary():
    return F.lit(DRIFT_BOUNDARY)


def drift_before_boundary(spark, sf_dir):
    t = _t(spark, sf_dir)
    has_key = json_key(F.col("metadata"), "network_type").isNotNull()
    return t.agg(F.count_if((F.col("event_date") < _boundary()) & has_key).alias("observed"),
                 F.count_if(has_key).alias("rows_with_key"))


def hot_key_share(spark, sf_dir):
    return audit.key_shares(_t(spark, sf_dir), "game_id")


def late_arrival_rate(spark, sf_dir):
    return audit.late_rate(_t(spark, sf_dir), "event_timestamp", "ingestion_timestamp", 300)


def quality_report(spark, sf_dir):
    contract = contract_from_dict(player_events_contract_dict())
    return quality.evaluate_rules(_t(spark, sf_dir), list(contract.aggregate_rules), view="bronze")


QUARANTINE_RULES = [{"column": "player_id", "rule": "not_null"},
                    {"column": "event_id", "rule": "not_null"},
                    {"column": "event_timestamp", "rule": "not_null"}]


def _quarantine_input(spark, sf_dir):
    from sluice.sources.contract import RowRule
    t = _t(spark, sf_dir).withColumn("player_id", F.nullif(F.col("player_id"), F.lit(5)))
    rules = [RowRule(r["column"], r["rule"]) for r in QUARANTINE_RULES]
    return quality.quarantine(t, rules)


def quarantine_rejects(spark, sf_dir):
    _, rejects = _quarantine_input(spark, sf_dir)
    return present(rejects.withColumn("_reasons", F.array_join("_reasons", ",")))


def quarantine_clean(spark, sf_dir):
    clean, _ = _quarantine_input(spark, sf_dir)
    return present(clean)


def producer_sequence(spark, sf_dir):
    base = telemetry_base(read_events(spark, sf_dir)).select("event_id", "producer_id")
    return dedup.sequence_index(base, ["producer_id"], ["event_id"], "sequence_index")


def dedup_latest(spark, sf_dir):
    return present(dedup.dedup_latest(_t(spark, sf_dir), KEY, ORDER_COLUMNS))


def dedup_bounded(spark, sf_dir):
    return present(dedup.dedup_bounded(_t(spark, sf_dir), KEY, ORDER_COLUMNS,
                                       "ingestion_timestamp", DEDUP_WINDOW_H))


def duplicate_census(spark, sf_dir):
    return dedup.duplicate_census(_t(spark, sf_dir), KEY, "source_sequence_number",
                                  "ingestion_timestamp", DEDUP_WINDOW_H)


def flush_bucket_layout(spark, sf_dir):
    cells = audit.flush_cells(_t(spark, sf_dir), "event_date", "producer_id",
                              "ingestion_timestamp", 5)
    return present(cells.withColumn("flush_stamp", minute_stamp(F.col("flush_start"))))


def drift_key_census(spark, sf_dir):
    return present(audit.drift_census(_t(spark, sf_dir), "metadata", "event_date"))


def late_routing(spark, sf_dir):
    return audit.route_counts(_t(spark, sf_dir), "event_timestamp", "ingestion_timestamp", 300, 72)


def partition_balance(spark, sf_dir):
    return audit.partition_balance(_t(spark, sf_dir), "event_date")


def landing_completeness(spark, sf_dir):
    expected = (read_events(spark, sf_dir).groupBy(F.to_date("ts").alias("event_date"))
                .agg(F.count(F.lit(1)).alias("expected")))
    actual = (_t(spark, sf_dir).groupBy("event_date")
              .agg(F.count_distinct("event_id").alias("actual")))
    return present(audit.completeness(expected, actual, ["event_date"]))


def salted_group_count(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = skew.two_phase_aggregate(
        t, ["game_id"], skew.salt_column(["player_id"], N_SALTS),
        partial={"_n": F.count(F.lit(1)), "_p": F.count_distinct("player_id"),
                 "_f": F.min("event_timestamp"), "_l": F.max("event_timestamp")},
        final={"n_rows": F.sum("_n"), "n_players": F.sum("_p"),
               "first_event": F.min("_f"), "last_event": F.max("_l")})
    return present(out)


def _game_dimension(t: DataFrame) -> DataFrame:
    return t.groupBy("game_id").agg(F.count_distinct("player_id").alias("game_players"),
                                    F.count(F.lit(1)).alias("game_rows"))


def salted_join(spark, sf_dir):
    t = _t(spark, sf_dir)
    big = t.select("event_id", "source_sequence_number", "ingestion_timestamp", "game_id")
    hot = skew.frequent_keys(t, ["game_id"], 0.25).select("game_id")       # at most 4 keys by construction
    out = skew.salted_join(big, _game_dimension(t), ["game_id"], N_SALTS,
                           salt_by=["event_id", "source_sequence_number", "ingestion_timestamp"],
                           hot=hot)
    return present(out)


def join_sources(spark, sf_dir):
    t = _t(spark, sf_dir)
    activity = t.groupBy(F.col("player_id").alias("o_custkey")).agg(
        F.count(F.lit(1)).alias("player_events"), F.min("event_timestamp").alias("first_event"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    out = skew.join_sources(orders, activity, ["o_custkey"], "inner", strategy="broadcast")
    return present(out)


def exact_sample(spark, sf_dir, n: int = 100, seed: int = 42):
    t = _t(spark, sf_dir).select("event_id", "source_sequence_number", "ingestion_timestamp")
    text = F.concat_ws("|", F.lit(str(seed)), "event_id", "source_sequence_number",
                       iso_timestamp("ingestion_timestamp"))
    return present(t.orderBy(F.sha2(text, 256), *t.columns).limit(n))


def dictionary_decode(spark, sf_dir):
    e = read_events(spark, sf_dir)
    eid = F.col("event_id")
    return e.select("event_id",
                    decode(eid % len(EVENT_TYPES), EVENT_TYPES).alias("event_type_name"),
                    decode(eid % len(DEVICES), DEVICES).alias("device"),
                    decode(eid % len(NETWORK_TYPES), NETWORK_TYPES).alias("network_type"))


def json_build(spark, sf_dir):
    e = read_events(spark, sf_dir)
    eid = F.col("event_id")
    after = F.col("ts") >= F.expr(f"TIMESTAMP_NTZ'{DRIFT_BOUNDARY.isoformat()} 00:00:00'")
    meta = json_object_text([
        ("device", decode(eid % len(DEVICES), DEVICES)),
        ("app_version", F.when(after, F.lit("1.3.0")).otherwise(F.lit("1.2.0"))),
        ("network_type", F.when(after, decode(eid % len(NETWORK_TYPES), NETWORK_TYPES))),
    ])
    return e.select("event_id", meta.alias("metadata"))


def union_with_duplicates(spark, sf_dir):
    return present(load_telemetry(spark, sf_dir, with_kind=True))


def _documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


def blob_catalog(spark, sf_dir):
    return scan.blob_catalog(_documents(spark, sf_dir), "text")


def blob_integrity(spark, sf_dir):
    docs = _documents(spark, sf_dir).select(F.sha2("text", 256).alias("pointer"))
    contents = (_documents(spark, sf_dir).select("text")
                .unionByName(_table(spark, sf_dir, "benchmark").select("text")))
    store = scan.blob_catalog(contents, "text")
    return audit.blob_integrity(docs, "pointer", store, "sha256")


def contract_conformance(spark, sf_dir):
    contract = contract_from_dict(player_events_contract_dict())
    return conformance.conformance_report(_t(spark, sf_dir), contract)


def silver_metadata(spark, sf_dir):
    t = _t(spark, sf_dir).select("event_id", "event_date", "metadata")
    return present(conformance.silver_projection(t))


def _silver(spark, sf_dir):
    """The written Silver table: rows whose key occurs once bypass the shuffle."""
    return dedup.write_bounded(_t(spark, sf_dir), scratch_path(spark, "silver-table"), KEY, ORDER_COLUMNS,
                               "ingestion_timestamp", DEDUP_WINDOW_H)


def silver_written(spark, sf_dir):
    return present(_silver(spark, sf_dir))


def gold_daily_events(spark, sf_dir):
    return present(gold.daily_events(_silver(spark, sf_dir)))


def gold_daily_rates(spark, sf_dir):
    return present(gold.daily_rates(_silver(spark, sf_dir)))


def gold_player_activity(spark, sf_dir):
    return present(gold.player_activity(_silver(spark, sf_dir)))


def table_diff(spark, sf_dir):
    t = _t(spark, sf_dir)
    latest = dedup.dedup_latest(t, KEY, ORDER_COLUMNS)
    return present(audit.table_diff(_silver(spark, sf_dir), latest))


def hot_keys(spark, sf_dir):
    """Keys with a twentieth of the rows or more, from merged sketches."""
    return skew.frequent_keys(_t(spark, sf_dir), ["game_id", "event_type"], 0.05)


def _two_versions(spark, sf_dir):
    """The telemetry, written, and a version in which on four dates rows are
    missing, changed or doubled."""
    root = scratch_path(spark, "versions")
    t = _t(spark, sf_dir)
    day, e = F.dayofmonth("event_date"), F.col("event_id")
    copies = F.when((day == 5) & (e % 50 == 0), 0).when((day == 17) & (e % 40 == 1), 2).otherwise(1)
    changed = (t.withColumn("event_type", F.when((day == 11) & (e % 30 == 2), F.lit("altered")).otherwise(F.col("event_type")))
               .withColumn("stack_trace", F.when((day == 23) & (e % 25 == 3), F.lit("?")).otherwise(F.col("stack_trace")))
               .withColumn("_copies", copies).select(*t.columns, F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_c"))
               .drop("_c"))
    ingest.write_table(t, f"{root}/a", ["event_date"])
    ingest.write_table(changed, f"{root}/b", ["event_date"])
    return [spark.read.parquet(f"{root}/{x}").select(*t.columns) for x in "ab"]


def tree_diff(spark, sf_dir):
    a, b = _two_versions(spark, sf_dir)
    return present(audit.tree_diff(a, b, "event_date", KEY))


def partition_diff(spark, sf_dir):
    a, b = _two_versions(spark, sf_dir)
    trees = [audit.hash_tree(x, "event_date", KEY) for x in (a, b)]
    return present(audit.partition_diff(*trees, "event_date").drop("buckets_differing"))


def table_fingerprint(spark, sf_dir):
    """Rows, and sum and xor of the first 48 bits of each row's sha256: the
    same in any order and file layout, and in any engine."""
    t = _t(spark, sf_dir)
    text = F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in (
        F.col("event_id").cast("string"), F.col("player_id").cast("string"),
        F.col("source_sequence_number").cast("string"), iso_timestamp("ingestion_timestamp"), F.col("metadata"))])
    return t.select(F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint").alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"))


def iso_timestamp(col: str):
    return F.expr(iso_timestamp_sql(col))


# Expectations of the seeded defects (manifest values; the dedup and crash
# tolerances are design choices, the manifest gives none).
DEFECT_EXPECTATIONS = [
    ("skew", "hot_game_share", 0.37, 0.02),
    ("late_arrivals", "late_rate", 0.025, 0.005),
    ("duplicates", "duplicate_rate", 0.01, 0.005),
    ("schema_drift", "first_drift_day", 15.0, 0.0),
    ("schema_drift", "drift_rows_before_boundary", 0.0, 0.0),
    ("crashes", "crash_rate", 0.005, 0.001),
    ("small_files", "flush_files_per_partition", None, None),
]


def defect_conformance(spark, sf_dir):
    """Flagship: one row per seeded defect, expected vs observed.

    One scan: GROUPING SETS computes, in one aggregation, rows per game
    (skew), one row per event id (duplicates), one row per flush cell
    (small files) and the global conditional counts (lateness, crashes,
    drift); a second, global aggregate reads the metrics off those sets."""
    t = _t(spark, sf_dir)
    from sluice.functions.time import floor_minutes, seconds_between
    has_key = json_key(F.col("metadata"), "network_type").isNotNull()
    lag = seconds_between(F.col("event_timestamp"), F.col("ingestion_timestamp"))
    keyed = t.select("game_id", "event_date", "producer_id", "event_id",
                     floor_minutes(F.col("ingestion_timestamp"), 5).alias("_flush"),
                     (lag > 300).alias("_late"), (F.col("event_type") == "crash").alias("_crash"),
                     has_key.alias("_key"))
    cols = ["game_id", "event_date", "producer_id", "_flush", "event_id"]
    sets = {"game": ["game_id"], "cell": ["event_date", "producer_id", "_flush"],
            "event": ["event_id"], "all": []}
    gid = {k: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in v)
           for k, v in sets.items()}
    g = keyed.groupingSets(list(sets.values()), *cols).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("_n"),
        F.count_if("_late").alias("_late"), F.count_if("_crash").alias("_crash"),
        F.min(F.when(F.col("_key"), F.col("event_date"))).alias("_first_drift"),
        F.count_if(F.col("_key") & (F.col("event_date") < _boundary())).alias("_before"))
    on = {k: F.col("_gid") == v for k, v in gid.items()}
    s = g.agg(
        F.max(F.when(on["all"], F.col("_n"))).alias("rows"),
        F.max(F.when(on["all"], F.col("_late"))).alias("late"),
        F.max(F.when(on["all"], F.col("_crash"))).alias("crash"),
        F.max(F.when(on["all"], F.col("_before"))).alias("before"),
        F.min(F.when(on["all"], F.col("_first_drift"))).alias("first_drift"),
        F.count_if(on["event"]).alias("events"),
        F.max(F.when(on["game"], F.col("_n"))).alias("top_game"),
        F.count_if(on["cell"]).alias("cells"),
        F.count_distinct(F.when(on["cell"], F.col("event_date"))).alias("dates"))
    observed = {
        "hot_game_share": F.try_divide(F.col("top_game"), F.col("rows")),
        "late_rate": F.try_divide(F.col("late"), F.col("rows")),
        "duplicate_rate": F.try_divide(F.col("rows") - F.col("events"), F.col("events")),
        "first_drift_day": F.datediff(F.col("first_drift"), F.lit(START_DATE)).cast("double"),
        "drift_rows_before_boundary": F.col("before").cast("double"),
        "crash_rate": F.try_divide(F.col("crash"), F.col("events")),
        "flush_files_per_partition": F.try_divide(F.col("cells"), F.col("dates")),
    }
    rows = []
    for defect, metric, exp, tol in DEFECT_EXPECTATIONS:
        obs = observed[metric].cast("double")
        passed = (F.abs(obs - F.lit(exp)) <= F.lit(tol)) if exp is not None else F.lit(None)
        rows.append(F.struct(F.lit(defect).alias("defect"), F.lit(metric).alias("metric"),
                             F.lit(exp).cast("double").alias("expected"),
                             F.lit(tol).cast("double").alias("tolerance"),
                             obs.alias("observed"), passed.cast("boolean").alias("passed")))
    return s.select(F.inline(F.array(*rows)))


def first_partitions(spark, sf_dir, k: int = 5):
    """The first ``k`` partition values in order (distinct + top-k)."""
    return present(_t(spark, sf_dir).select("event_date").distinct().orderBy("event_date").limit(k))


def late_closed_rows(spark, sf_dir):
    """Side table: rows that arrived after their partition closed."""
    _, side = audit.split_late(_t(spark, sf_dir), "event_timestamp", "ingestion_timestamp", 300, 72)
    return present(side)


def document_blob_pointers(spark, sf_dir):
    """Each document gets the blob path of its text when the blob store
    (benchmark passages) holds those exact bytes, NULL otherwise."""
    store = scan.blob_catalog(_table(spark, sf_dir, "benchmark"), "text")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return audit.attach_blob_pointer(docs, "text", store).select("doc_id", "blob_path")


QUERIES = {
    "defect_conformance": defect_conformance,
    "drift_before_boundary": drift_before_boundary,
    "hot_key_share": hot_key_share,
    "late_arrival_rate": late_arrival_rate,
    "quality_report": quality_report,
    "quarantine_rejects": quarantine_rejects,
    "quarantine_clean": quarantine_clean,
    "producer_sequence": producer_sequence,
    "dedup_latest": dedup_latest,
    "dedup_bounded": dedup_bounded,
    "duplicate_census": duplicate_census,
    "flush_bucket_layout": flush_bucket_layout,
    "drift_key_census": drift_key_census,
    "late_routing": late_routing,
    "partition_balance": partition_balance,
    "landing_completeness": landing_completeness,
    "salted_group_count": salted_group_count,
    "salted_join": salted_join,
    "join_sources": join_sources,
    "exact_sample": exact_sample,
    "dictionary_decode": dictionary_decode,
    "json_build": json_build,
    "union_with_duplicates": union_with_duplicates,
    "blob_catalog": blob_catalog,
    "blob_integrity": blob_integrity,
    "contract_conformance": contract_conformance,
    "silver_metadata": silver_metadata,
    "gold_daily_events": gold_daily_events,
    "gold_daily_rates": gold_daily_rates,
    "gold_player_activity": gold_player_activity,
    "silver_written": silver_written,
    "hot_keys": hot_keys,
    "table_diff": table_diff,
    "tree_diff": tree_diff,
    "partition_diff": partition_diff,
    "table_fingerprint": table_fingerprint,
    "first_partitions": first_partitions,
    "late_closed_rows": late_closed_rows,
    "document_blob_pointers": document_blob_pointers,
}


# --- Queries that write and read back tables (landing -> Bronze, streams,
# compaction). Each works in a fresh folder under the session's shared
# checkpoint root (spark.checkpoint.dir).


def _landing_contract(root: str, name: str = "player_events", partition_by=("event_date",)):
    raw = player_events_contract_dict(root)
    raw.update({"name": name, "landing_path": name, "partition_by": list(partition_by),
                "bronze_path": f"{root}/bronze/{name}", "checkpoint_path": f"{root}/checkpoints/{name}"})
    return contract_from_dict(raw)


def _bronze_view(bronze: DataFrame) -> DataFrame:
    """Bronze rows without the per-run columns, plus the partition folder
    each row was read from (parsed from its lineage file path)."""
    return present(bronze.select(*TCOLUMNS, "_source_name",
                                 F.regexp_extract("_source_file", "event_date=([^/]+)", 1)
                                 .alias("source_partition")))


def bronze_full_refresh(spark, sf_dir):
    root = scratch_path(spark, "full")
    write_landing(_t(spark, sf_dir), f"{root}/landing/player_events", ["event_date"], 3,
                  spread_cols=["event_id", "source_sequence_number", "ingestion_timestamp"])
    contract = _landing_contract(root)
    res = ingest.ingest_full_refresh(spark, contract, landing_root=f"{root}/landing")
    return _bronze_view(spark.read.parquet(res.path))


def _incremental_runs(spark, sf_dir, compacted: bool = False):
    """Held-back date, several micro-batches, a no-op rerun, the held-back
    date landing later, and a lost checkpoint; the table is compacted in
    between if asked to. The contract, and the runs' results."""
    root = scratch_path(spark, "incr")
    t = _t(spark, sf_dir)
    last = t.agg(F.max("event_date")).first()[0]
    landing = f"{root}/landing/player_events"
    spread = ["event_id", "source_sequence_number", "ingestion_timestamp"]
    write_landing(t.where(F.col("event_date") < F.lit(last)), landing, ["event_date"], 2, spread, num_tasks=32)
    contract = _landing_contract(root)
    kw = dict(landing_root=f"{root}/landing")
    runs = [incremental.ingest_incremental(spark, contract, max_files_per_trigger=16, **kw)]
    if compacted:
        bronze_compaction.compact_bronze(spark, contract.bronze_path)
    runs.append(incremental.ingest_incremental(spark, contract, **kw))          # nothing new
    (t.where(F.col("event_date") == F.lit(last)).write.mode("append")
     .partitionBy("event_date").parquet(landing))                               # late partition
    runs.append(incremental.ingest_incremental(spark, contract, **kw))
    if compacted:
        bronze_compaction.compact_bronze(spark, contract.bronze_path)
    runs.append(incremental.ingest_incremental(spark, contract, checkpoint=f"{root}/checkpoints/lost", **kw))
    return contract, runs


def bronze_incremental(spark, sf_dir):
    """After all these runs, Bronze holds every landed row exactly once."""
    contract, _ = _incremental_runs(spark, sf_dir)
    return _bronze_view(incremental.read_bronze(spark, contract.bronze_path))


def ingest_progress(spark, sf_dir):
    """Rows that each run read and added, from the progress that its
    micro-batches left (a run without one has read nothing), and the rows of
    the table that bear its id."""
    contract, runs = _incremental_runs(spark, sf_dir)
    numbered = spark.createDataFrame([(i + 1, r.run_id) for i, r in enumerate(runs)], "run int, run_id string")
    stamped = incremental.read_bronze(spark, contract.bronze_path).groupBy(F.col("_batch_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("rows_stamped"))
    progress = incremental.read_progress(spark, contract.bronze_path).groupBy("run_id").agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_added").alias("rows_added"))
    return numbered.join(progress, "run_id", "left").join(stamped, "run_id", "left").na.fill(0).select(
        "run", "rows_read", "rows_added", "rows_stamped")


def bronze_compacted(spark, sf_dir):
    """The same runs over a table that is compacted twice in between."""
    contract, _ = _incremental_runs(spark, sf_dir, compacted=True)
    return _bronze_view(incremental.read_bronze(spark, contract.bronze_path))


def bronze_compacted_files(spark, sf_dir):
    """Rows and live files per partition of the compacted table."""
    contract, _ = _incremental_runs(spark, sf_dir, compacted=True)
    files = bronze_compaction.live_files(spark, contract.bronze_path).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n_files"))
    rows = incremental.read_bronze(spark, contract.bronze_path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"))
    part = F.concat(F.lit("event_date="), F.col("event_date").cast("string"))
    return present(rows.join(files, files["partition"] == part).select("event_date", "n_rows", "n_files"))


def bronze_second_source(spark, sf_dir):
    """A second source with another schema, onboarded by contract alone."""
    root = scratch_path(spark, "orders")
    orders = _table(spark, sf_dir, "orders")
    write_landing(orders, f"{root}/landing/orders", ["o_orderpriority"], 2, ["o_orderkey"])
    raw = {"name": "orders", "format": "parquet", "landing_path": "orders",
           "bronze_path": f"{root}/bronze/orders", "checkpoint_path": f"{root}/checkpoints/orders",
           "partition_by": ["o_orderpriority"],
           "schema": [{"name": "o_orderkey", "type": "long"}, {"name": "o_custkey", "type": "long"},
                      {"name": "o_totalprice", "type": "double"}],
           "dedup_key": ["o_orderkey"],
           "quality_rules": [{"column": "o_orderkey", "rule": "not_null"}]}
    res = ingest.ingest_full_refresh(spark, contract_from_dict(raw), landing_root=f"{root}/landing")
    b = spark.read.parquet(res.path)
    return present(b.select(*orders.columns, "_source_name"))


FLUSH_MINUTES = 5             # how often a producer flushes


def _flush_landing(spark, sf_dir, rows: DataFrame | None = None) -> str:
    """A landing tree as the producers leave it: a file per date, producer and flush."""
    path = f"{scratch_path(spark, 'flush')}/landing"
    write_flush_layout(_t(spark, sf_dir) if rows is None else rows, path, minutes=FLUSH_MINUTES)
    return path


def landing_gaps(spark, sf_dir):
    """Stretches of flushes that never arrived: every producer leaves out three
    flushes in a row of each hundred and twenty. Expected is a file per cell of
    the events' grid; found is what the landing tree lists."""
    t = _t(spark, sf_dir)
    cells = audit.flush_cells(t, "event_date", "producer_id", "ingestion_timestamp", FLUSH_MINUTES)
    flush = floor_minutes(F.col("ingestion_timestamp"), FLUSH_MINUTES)
    number = F.floor(F.unix_micros(ntz_to_instant(flush)) / F.lit(FLUSH_MINUTES * 60_000_000))
    left_out = F.floor(number / 3) % 40 == F.col("producer_id")
    inventory = scan.file_inventory(spark, _flush_landing(spark, sf_dir, t.where(~left_out)), "flush")
    found = inventory.select(F.to_date(F.regexp_extract("path", "event_date=([^/]+)", 1)).alias("event_date"),
                             F.regexp_extract("path", "producer_id=([^/]+)", 1).cast("long").alias("producer_id"), "flush")
    expected = cells.select("event_date", "producer_id", minute_stamp(F.col("flush_start")).alias("flush"))
    return present(audit.missing_intervals(expected, found, ["event_date", "producer_id"], "flush"))


def landing_file_counts(spark, sf_dir):
    """Files and small files per date partition of the producer's flush-split
    landing tree."""
    inv = scan.file_inventory(spark, _flush_landing(spark, sf_dir), "event_date")
    return audit.file_stats(inv, ["event_date"]).select("event_date", "n_files", "n_small_files")


def small_files_audit(spark, sf_dir):
    """Files, bytes, small files and predicted scan tasks of the flush-split
    landing tree (sizes depend on the Parquet writer: no SQL oracle)."""
    inv = scan.file_inventory(spark, _flush_landing(spark, sf_dir), "event_date")
    return audit.file_stats(inv)


def compact(spark, sf_dir):
    src = _flush_landing(spark, sf_dir)
    dst = scratch_path(spark, "compacted")
    m = maintain.compact(spark, src, "event_date", dst=dst, target_file_bytes=128 << 20)
    return m.select("event_date", "files_before", "files_after", "compacted")


def _stream_landing(spark, sf_dir, files_per_batch: int | None = None):
    root = scratch_path(spark, "stream")
    t = _t(spark, sf_dir)
    write_landing(t, f"{root}/landing", ["event_date"], 2,
                  ["event_id", "source_sequence_number", "ingestion_timestamp"])
    schema = spark.read.parquet(f"{root}/landing").schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return root, reader.parquet(f"{root}/landing")


#: The landing tree's files come in any order: a row may be as late as the tree is long.
DISORDER_HOURS = 40 * 24


def stream_dedup(spark, sf_dir):
    """The bounded deduplication by keyed state: files in no order, five per
    micro-batch, all columns, corrections and copies outside the window."""
    root, stream = _stream_landing(spark, sf_dir, files_per_batch=5)
    schema = stream.schema
    bounded.split_by_clock(stream, f"{root}/bronze", f"{root}/ckpt-split", "ingestion_timestamp", DISORDER_HOURS)
    rows = bounded.on_time_stream(spark, f"{root}/bronze", schema, max_files=20)
    bounded.run_keyed_dedup(rows, f"{root}/out", f"{root}/ckpt-dedup", KEY, ORDER_COLUMNS, "ingestion_timestamp",
                            DEDUP_WINDOW_H, delay_hours=DISORDER_HOURS)
    out = bounded.read_deduplicated(spark, f"{root}/out", schema, KEY, ORDER_COLUMNS, "ingestion_timestamp")
    return present(out.select(*TCOLUMNS))


DROP_DAYS = 5


def stream_late_split(spark, sf_dir):
    """Five dates land at a time, in order, a micro-batch each. Rows more than
    a day behind the newest time of earlier micro-batches are late and go to
    the side table: the accounts of each micro-batch and what was written."""
    root = scratch_path(spark, "late")
    t = _t(spark, sf_dir).withColumn("drop", F.floor(F.datediff("event_date", F.lit(START_DATE)) / DROP_DAYS).cast("int"))
    schema = t.drop("drop").schema
    drops = sorted(r[0] for r in t.select("drop").distinct().collect())
    for d in drops:
        t.where(F.col("drop") == d).drop("drop").write.parquet(f"{root}/landing/drop={d}")
        bounded.split_by_clock(spark.readStream.schema(schema).parquet(f"{root}/landing/*"), f"{root}/bronze",
                               f"{root}/ckpt", "ingestion_timestamp", 24)
    rows = bounded.read_split(spark, f"{root}/bronze", schema).groupBy("sink_batch").agg(
        F.count_if(~F.col(bounded.LATE)).alias("written_on_time"), F.count_if(F.col(bounded.LATE)).alias("written_late"))
    return bounded.read_accounts(spark, f"{root}/bronze").join(rows, "sink_batch").select(
        F.col("sink_batch").alias("micro_batch"), "n_rows", "n_late", "written_on_time", "written_late")


def stream_flush_counts(spark, sf_dir):
    """Flush windows of a stream drained in many micro-batches, late rows
    (a side count) added back: equal to the batch count."""
    root, stream = _stream_landing(spark, sf_dir, files_per_batch=5)
    late.count_flush_windows(stream, f"{root}/out", f"{root}/ckpt", "ingestion_timestamp", ["producer_id"], 5, 72)
    return present(late.read_flush_windows(spark, f"{root}/out", ["producer_id"]).drop("n_late"))


def zorder_layout(spark, sf_dir):
    """Mean per-file span of (player_id, ingestion time) before and after
    Z-order clustering of the telemetry into the same number of files.
    File layout dependent: checked by tests, no SQL oracle."""
    root = scratch_path(spark, "zorder")
    t = _t(spark, sf_dir).withColumn("ingest_s", F.unix_micros(ntz_to_instant(F.col("ingestion_timestamp"))))
    n_files = 16
    t.repartition(n_files).write.parquet(f"{root}/plain")
    maintain.zorder(t, ["player_id", "ingest_s"], n_files, bits=6).write.parquet(f"{root}/z")
    out = None
    for layout in ("plain", "z"):
        s = maintain.file_column_spans(spark, f"{root}/{layout}", ["player_id", "ingest_s"])
        row = s.agg(F.lit(layout).alias("layout"), F.count(F.lit(1)).alias("n_files"),
                    F.avg("player_id_span").alias("mean_player_span"),
                    F.avg("ingest_s_span").alias("mean_ingest_span_us"))
        out = row if out is None else out.unionByName(row)
    return out


def stream_silver(spark, sf_dir):
    """Streaming Silver with corrections. Five dates land at a time; a second
    delivery brings some of their rows after the others. Every delivery is a
    micro-batch, merged into the open partitions (the newest three dates that
    have landed so far) with the ordered bounded dedup; rows of closed
    partitions go to the side table. Both come back, marked by ``side``."""
    root = scratch_path(spark, "silver")
    day = F.datediff("event_date", F.lit(START_DATE))
    second = (F.col("event_id") % 300 == 5) & (F.col("event_type") == "match_end")
    t = _t(spark, sf_dir).withColumn("drop", (F.floor(day / DROP_DAYS) * 2 + second.cast("int")).cast("int"))
    schema = t.drop("drop").schema
    contract = _landing_contract(root)
    for d in sorted(r[0] for r in t.select("drop").distinct().collect()):
        t.where(F.col("drop") == d).drop("drop").write.parquet(f"{root}/landing/drop={d}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/landing/*")
        incremental.ingest_silver_stream(spark, stream, contract, f"{root}/silver", f"{root}/side", f"{root}/ckpt", open_days=3)
    silver = spark.read.parquet(f"{root}/silver").select(*TCOLUMNS, F.lit(False).alias("side"))
    side = spark.read.schema(silver.drop("side").schema).parquet(f"{root}/side").select(
        *TCOLUMNS, F.lit(True).alias("side"))
    return present(silver.unionByName(side))


def _refined(spark, sf_dir):
    """The tables that a contract run writes over the telemetry, in which the
    player 5 is unknown; the contract wants a player."""
    from sluice.operators.refine import refine

    root = scratch_path(spark, "refined")
    raw = player_events_contract_dict(root)
    raw["quality_rules"] = [*raw["quality_rules"], {"column": "player_id", "rule": "not_null"}]
    bronze = _t(spark, sf_dir).withColumn("player_id", F.nullif(F.col("player_id"), F.lit(5)))
    return refine(spark, contract_from_dict(raw), bronze, root).tables


def refined_rejects(spark, sf_dir):
    _, rejects = quality.read_quarantined(spark, _refined(spark, sf_dir)["checked"])
    return present(rejects.select(*TCOLUMNS, F.array_join("_reasons", ",").alias("_reasons")))


def refined_silver(spark, sf_dir):
    return present(dedup.read_bounded(spark, _refined(spark, sf_dir)["silver"]).select(*TCOLUMNS))


def refined_daily_events(spark, sf_dir):
    return present(spark.read.parquet(_refined(spark, sf_dir)["daily_events"]))


def refined_daily_rates(spark, sf_dir):
    return present(spark.read.parquet(_refined(spark, sf_dir)["daily_rates"]))


def refined_player_activity(spark, sf_dir):
    return present(spark.read.parquet(_refined(spark, sf_dir)["player_activity"]))


def refined_duplicate_rates(spark, sf_dir):
    return present(spark.read.parquet(_refined(spark, sf_dir)["duplicate_rates"]))


def schema_evolution(spark, sf_dir):
    """Two incremental runs over the same landing folder; between them a
    producer starts writing an extra column. Each run logs the schema it
    inferred; the comparison shows every field ``same`` and the new one
    ``added`` (schema-on-read with ``mergeSchema``), with the number of
    values that the Bronze table shows of it."""
    root = scratch_path(spark, "schema")
    t = _t(spark, sf_dir)
    last = t.agg(F.max("event_date")).first()[0]
    landing = f"{root}/landing/player_events"
    write_landing(t.where(F.col("event_date") < F.lit(last)), landing, ["event_date"], 2,
                  ["event_id", "source_sequence_number", "ingestion_timestamp"])
    contract = _landing_contract(root)
    merged = contract_from_dict({**player_events_contract_dict(root), "name": "player_events",
                                 "read_options": {"mergeSchema": "true"},
                                 "bronze_path": contract.bronze_path,
                                 "checkpoint_path": contract.checkpoint_path})
    kw = dict(landing_root=f"{root}/landing")
    first = incremental.ingest_incremental(spark, merged, **kw)
    (t.where(F.col("event_date") == F.lit(last))
     .withColumn("client_region", F.concat(F.lit("r"), (F.col("player_id") % 4).cast("string")))
     .write.mode("append").partitionBy("event_date").parquet(landing))
    second = incremental.ingest_incremental(spark, merged, **kw)
    changes = incremental.schema_changes(spark, merged.checkpoint_path, first.run_id, second.run_id)
    bronze = incremental.read_bronze(spark, merged.bronze_path)
    filled = bronze.agg(*[F.count(c).alias(c) for c in [*TCOLUMNS, "client_region"]]).select(
        F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in [*TCOLUMNS, "client_region"]]),
                                    F.array(*[F.col(c) for c in [*TCOLUMNS, "client_region"]]))).alias("field", "n_values"))
    return changes.join(filled, "field").select("field", "status", "n_values")


def order_cents(spark, sf_dir):
    """Three halves of an order's price, rounded to cents half to even."""
    halves = (F.round(F.col("o_totalprice") * 100).cast("bigint") * 15).cast("decimal(20,3)") / F.lit(1000).cast("decimal(4,0)")
    exact = halves.cast("decimal(20,3)")
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", (round_cents(exact) * 100).cast("bigint").alias("cents"))


def quality_text(spark, sf_dir):
    """The report that a contract run prints; a failed hard rule would raise."""
    rows = quality.enforce(quality_report(spark, sf_dir))
    return spark.createDataFrame([(line,) for line in quality.format_report(rows).splitlines()], "line string")


def _orders_contract(root: str, folder: str = "orders"):
    return contract_from_dict({
        "name": "orders", "format": "parquet", "landing_path": folder, "bronze_path": f"{root}/bronze/orders",
        "checkpoint_path": f"{root}/checkpoints/orders", "partition_by": ["o_orderpriority"]})


def ingest_every_source(spark, sf_dir):
    """Rows that an ingest of all contracts wrote, and the files of the tables:
    none has more than a few per partition, by a rule over the file list."""
    root = scratch_path(spark, "all")
    write_landing(_table(spark, sf_dir, "orders"), f"{root}/landing/orders", ["o_orderpriority"], 2, ["o_orderkey"])
    write_landing(_t(spark, sf_dir), f"{root}/landing/player_events", ["event_date"], 2, ["event_id"])
    parts = {"orders": "o_orderpriority", "player_events": "event_date"}
    done = ingest.ingest_all(spark, [_landing_contract(root), _orders_contract(root)], f"{root}/landing")
    rule = contract_from_dict({
        "name": "files", "format": "parquet", "landing_path": "x", "bronze_path": "x", "checkpoint_path": "x",
        "quality_rules": [{"name": "small_files", "severity": "hard", "assert": {"op": "le", "value": 4},
                           "query": "SELECT max(n) AS observed FROM (SELECT count(*) AS n FROM bronze_files GROUP BY part)"}]})
    rows = []
    for r in done:
        files = scan.file_inventory(spark, r.path, parts[r.source]).withColumnRenamed(parts[r.source], "part")
        report = quality.enforce(quality.evaluate_rules(spark.read.parquet(r.path), list(rule.aggregate_rules),
                                                        extra_views={"bronze_files": files}))
        rows.append((r.source, r.rows, files.select("part").distinct().count(), report[0]["flag"]))
    return spark.createDataFrame(rows, "source string, n_rows bigint, n_partitions bigint, small_files string")


def table_by_name(spark, sf_dir):
    """Bronze of the orders, registered in the catalog and read by its name."""
    root = scratch_path(spark, "named")
    write_landing(_table(spark, sf_dir, "orders"), f"{root}/landing/orders", ["o_orderpriority"], 2, ["o_orderkey"])
    done = ingest.ingest_full_refresh(spark, _orders_contract(root), landing_root=f"{root}/landing")
    name = "orders_" + root.rsplit("-", 1)[-1]
    spark.catalog.createTable(name, done.path, "parquet")
    spark.catalog.recoverPartitions(name)
    by_name = scan.register_view(scan.read_table(spark, name), f"{name}_view")
    return by_name.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))


def binary_blob_scan(spark, sf_dir):
    """Catalog of blob files: texts of 64 shelves, a file each."""
    root = scratch_path(spark, "blobs")
    shelf = F.pmod(F.col("doc_id"), F.lit(64)).cast("int")
    texts = _documents(spark, sf_dir).where("text is not null").select("doc_id", "text", shelf.alias("shelf"))
    (texts.repartition(64, "shelf").sortWithinPartitions("shelf", "doc_id").drop("doc_id")
     .write.partitionBy("shelf").text(root))
    return scan.binary_blobs(spark, root, "*.txt").select(
        F.regexp_extract("path", "shelf=([0-9]+)", 1).cast("int").alias("shelf"), "n_bytes", "sha256")


def optimized_bronze(spark, sf_dir):
    """Bronze after its contract's Z-order: the same rows, clustered."""
    root = scratch_path(spark, "zorder-bronze")
    write_landing(_t(spark, sf_dir), f"{root}/landing/player_events", ["event_date"], 2, ["event_id"])
    raw = {**player_events_contract_dict(root), "zorder_by": ["player_id", "ingestion_timestamp"]}
    contract = contract_from_dict(raw)
    ingest.ingest_full_refresh(spark, contract, landing_root=f"{root}/landing")
    maintain.optimize_source(spark, contract, f"{root}/optimized", bits=4)
    return _bronze_view(spark.read.parquet(f"{root}/optimized"))


def _drifted(spark, sf_dir):
    """Three deliveries of a source whose columns drift: narrow numbers and no
    stack trace, then as declared, then player ids as text, some of them no
    numbers. Their schemas by delivery, and their rows, widened."""
    root = scratch_path(spark, "drift")
    t = _t(spark, sf_dir).select("event_id", "player_id", "source_sequence_number", "stack_trace", "event_date")
    day = F.dayofmonth("event_date")
    text = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("p-"), F.col("player_id"))).otherwise(F.col("player_id").cast("string"))
    t.where(day <= 10).withColumns({"player_id": F.col("player_id").cast("int"),
                                    "source_sequence_number": F.col("source_sequence_number").cast("int")}) \
        .drop("stack_trace").write.parquet(f"{root}/1")
    t.where((day > 10) & (day <= 20)).write.parquet(f"{root}/2")
    t.where(day > 20).withColumn("player_id", text).write.parquet(f"{root}/3")
    groups = [[f"{root}/{i}"] for i in (1, 2, 3)]
    schemas = {str(i + 1): spark.read.parquet(*g).schema for i, g in enumerate(groups)}
    return schemas, conformance.read_drifted(spark, groups)


def type_drift(spark, sf_dir):
    schemas, _ = _drifted(spark, sf_dir)
    return spark.createDataFrame(conformance.type_drift(schemas), "field string, types string, widened string, status string")


def drift_rescue(spark, sf_dir):
    """The drifted rows by the contract's types; a value that doesn't fit is NULL
    in its column and kept beside."""
    _, rows = _drifted(spark, sf_dir)
    out = conformance.conform_rescued(rows, contract_from_dict(player_events_contract_dict()))
    return present(out.select("event_id", "player_id", "source_sequence_number", "stack_trace", "metadata", "event_date",
                              F.col(conformance.RESCUED).alias("rescued")))


def json_round_trip(spark, sf_dir):
    """Texts with quotes, backslashes and line breaks through JSON text and back."""
    d = _documents(spark, sf_dir)
    odd = F.concat(F.lit('"\\\n\t'), F.col("text"))
    built = json_object_text([("source", F.col("source")), ("text", odd)])
    back = F.from_json(built, "source string, text string")
    return d.select("doc_id", back["source"].alias("source"), F.sha2(back["text"], 256).alias("text_sha"))


QUERIES.update({
    "order_cents": order_cents,
    "quality_text": quality_text,
    "ingest_every_source": ingest_every_source,
    "table_by_name": table_by_name,
    "binary_blob_scan": binary_blob_scan,
    "optimized_bronze": optimized_bronze,
    "type_drift": type_drift,
    "drift_rescue": drift_rescue,
    "json_round_trip": json_round_trip,
    "ingest_progress": ingest_progress,
    "bronze_compacted": bronze_compacted,
    "bronze_compacted_files": bronze_compacted_files,
    "landing_gaps": landing_gaps,
    "stream_late_split": stream_late_split,
    "refined_rejects": refined_rejects,
    "refined_silver": refined_silver,
    "refined_daily_events": refined_daily_events,
    "refined_daily_rates": refined_daily_rates,
    "refined_player_activity": refined_player_activity,
    "refined_duplicate_rates": refined_duplicate_rates,
    "schema_evolution": schema_evolution,
    "stream_silver": stream_silver,
    "zorder_layout": zorder_layout,
    "bronze_full_refresh": bronze_full_refresh,
    "bronze_incremental": bronze_incremental,
    "bronze_second_source": bronze_second_source,
    "landing_file_counts": landing_file_counts,
    "small_files_audit": small_files_audit,
    "compact": compact,
    "stream_dedup": stream_dedup,
    "stream_flush_counts": stream_flush_counts,
})
