"""Derived telemetry view: the driver's ``events`` table projected into the
shape of the reference's ``player_events`` source, with its defects seeded
by integer arithmetic so Spark and DuckDB agree exactly.

One scan of ``events``: each row generates 1..4 copies (original, retry,
correction, out-of-window escape) through a Generate node inside the scan
stage, instead of a four-way UNION that would read the table four times.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.codes import EXCEPTIONS

# Fixed values of the derived view (FIXTURES.md section 6).
START_DATE = dt.date(2024, 1, 1)
DRIFT_DAY = 15
DRIFT_BOUNDARY = START_DATE + dt.timedelta(days=DRIFT_DAY)  # 2024-01-16
HOT_GAME_PERCENT = 37
LATE_MODULUS, LATE_RESIDUE = 40, 7
NORMAL_DELAY_S = 300
LATE_SPAN_S = 258900
ESCAPE_SHIFT_H = 73
CORRECTION_SEQ_SHIFT = 1000
DEDUP_WINDOW_H = 72
META_BEFORE = '{"device": "PS5", "app_version": "1.2.0"}'
META_AFTER = '{"device": "PS5", "app_version": "1.3.0", "network_type": "wifi"}'

COLUMNS = ["event_id", "player_id", "game_id", "event_type", "event_timestamp",
           "ingestion_timestamp", "producer_id", "source_sequence_number", "metadata",
           "stack_trace", "event_date"]
ORDER_COLUMNS = ["source_sequence_number", "ingestion_timestamp"]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _base_exprs() -> list[str]:
    """The per-event projection as SQL expressions (parsed in the JVM: a
    few Py4J calls instead of one per column-expression node)."""
    b = f"TIMESTAMP_NTZ'{DRIFT_BOUNDARY.isoformat()} 00:00:00'"
    excs = ", ".join(f"'{e}'" for e in EXCEPTIONS)
    delay = (f"CASE WHEN event_id % {LATE_MODULUS} = {LATE_RESIDUE} "
             f"THEN {NORMAL_DELAY_S} + (event_id * 104729) % {LATE_SPAN_S} "
             f"ELSE (event_id * 7919) % {NORMAL_DELAY_S} END")
    return [
        "event_id",
        "1 + event_id % 19 AS player_id",
        f"CASE WHEN event_id % 100 < {HOT_GAME_PERCENT} THEN CAST(1 AS BIGINT) "
        "ELSE 2 + event_id % 3 END AS game_id",
        "CASE WHEN event_id % 200 = 0 THEN 'crash' ELSE event_type END AS event_type",
        "ts AS event_timestamp",
        f"ts + make_dt_interval(0, 0, 0, {delay}) AS ingestion_timestamp",
        "1 + event_id % 3 AS producer_id",
        "CAST(floor(event_id / 3) AS BIGINT) AS source_sequence_number",
        f"CASE WHEN ts >= {b} THEN '{META_AFTER}' ELSE '{META_BEFORE}' END AS metadata",
        f"CASE WHEN event_id % 200 = 0 THEN concat(element_at(array({excs}), "
        "CAST(event_id % 3 + 1 AS INT)), ': crash in frame update') END AS stack_trace",
        "to_date(ts) AS event_date",
    ]


def telemetry_base(events: DataFrame) -> DataFrame:
    """One row per event: the seeded skew, lateness, drift and crash defects."""
    return events.selectExpr(*_base_exprs())


def telemetry(events: DataFrame, with_kind: bool = False) -> DataFrame:
    """All copies: ``orig`` for every event, ``retry`` (byte-identical),
    ``corr`` (new type, sequence + 1000) and ``escape`` (arrives 73 h later).
    ``kind`` is ground truth for tests only; operators never read it."""
    kinds = ("explode(array_compact(array('orig', "
             "CASE WHEN event_id % 100 = 3 AND event_id % 1000 <> 3 THEN 'retry' END, "
             "CASE WHEN event_id % 300 = 5 THEN 'corr' END, "
             "CASE WHEN event_id % 1000 = 3 THEN 'escape' END))) AS kind")
    out = telemetry_base(events).selectExpr("*", kinds).selectExpr(
        "event_id", "player_id", "game_id",
        "CASE WHEN kind = 'corr' THEN 'match_end' ELSE event_type END AS event_type",
        "event_timestamp",
        f"CASE WHEN kind = 'escape' THEN ingestion_timestamp + INTERVAL {ESCAPE_SHIFT_H} HOURS "
        "ELSE ingestion_timestamp END AS ingestion_timestamp",
        "producer_id",
        f"source_sequence_number + CASE WHEN kind = 'corr' THEN {CORRECTION_SEQ_SHIFT} ELSE 0 END "
        "AS source_sequence_number",
        "metadata", "stack_trace", "event_date", "kind")
    return out if with_kind else out.drop("kind")


def load_telemetry(spark: SparkSession, sf_dir: str, with_kind: bool = False) -> DataFrame:
    return telemetry(read_events(spark, sf_dir), with_kind=with_kind)


def player_events_contract_dict(root: str = "") -> dict:
    """The player_events source contract re-expressed for the derived view.
    The drift boundary is a parameter (start + drift day), not a literal."""
    b = DRIFT_BOUNDARY.isoformat()
    return {
        "name": "player_events",
        "format": "parquet",
        "landing_path": "player_events",
        "bronze_path": f"{root or '/tables'}/bronze/player_events",
        "checkpoint_path": f"{root or '/tables'}/checkpoints/player_events",
        "partition_by": ["event_date"],
        "schema": [
            {"name": "event_id", "type": "long"},
            {"name": "player_id", "type": "long"},
            {"name": "game_id", "type": "long"},
            {"name": "event_type", "type": "string"},
            {"name": "event_timestamp", "type": "timestamp"},
            {"name": "ingestion_timestamp", "type": "timestamp"},
            {"name": "producer_id", "type": "long"},
            {"name": "source_sequence_number", "type": "long"},
            {"name": "metadata", "type": "string"},
            {"name": "stack_trace", "type": "string"},
        ],
        "dedup_key": ["event_id"],
        "order_by": ["source_sequence_number", "ingestion_timestamp"],
        "dedup_window_hours": DEDUP_WINDOW_H,
        "quality_rules": [
            {"column": "event_id", "rule": "not_null"},
            {"column": "event_timestamp", "rule": "not_null"},
            {"name": "schema_drift_before_boundary", "severity": "hard",
             "metric": (f"count_if(event_date < DATE'{b}' "
                        "AND get_json_object(metadata, '$.network_type') IS NOT NULL)"),
             "assert": {"op": "eq", "value": 0}},
            {"name": "hot_game_share", "severity": "soft",
             "per": "game_id", "metric": "max({n}) / sum({n})",
             "expected": 0.37, "tolerance": 0.02},
            {"name": "late_arrival_rate", "severity": "soft",
             "metric": ("count_if(timestampdiff(SECOND, event_timestamp, ingestion_timestamp) > 300) "
                        "/ nullif(count(*), 0)"),
             "expected": 0.025, "tolerance": 0.01},
            {"name": "duplicate_rate", "severity": "soft",
             "per": "event_id", "metric": "(sum({n}) - count({n})) / sum({n})",
             "expected": 0.01, "tolerance": 0.005},
            {"name": "producers", "severity": "hard", "per": "producer_id", "metric": "count({n})",
             "assert": {"op": "ge", "value": 3}},
            {"name": "crash_rate", "severity": "hard",
             "metric": "count_if(event_type = 'crash') / nullif(count(*), 0)",
             "assert": {"op": "le", "value": 0.02}},
        ],
    }
