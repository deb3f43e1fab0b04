"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables ``events``, ``orders``, ``documents``, ``benchmark`` ... are views in
the oracle session. The derived telemetry view is written out as a CTE with
the plain UNION ALL form; dates and timestamps are rendered as ISO text, as
the Spark side does.
"""

from __future__ import annotations


def TS(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def D(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


_BASE = """
base AS (
  SELECT event_id,
         1 + event_id % 19 AS player_id,
         CAST(CASE WHEN event_id % 100 < 37 THEN 1 ELSE 2 + event_id % 3 END AS BIGINT) AS game_id,
         CASE WHEN event_id % 200 = 0 THEN 'crash' ELSE event_type END AS event_type,
         ts AS event_timestamp,
         ts + to_seconds(CASE WHEN event_id % 40 = 7 THEN 300 + (event_id * 104729) % 258900
                              ELSE (event_id * 7919) % 300 END) AS ingestion_timestamp,
         1 + event_id % 3 AS producer_id,
         CAST(floor(event_id / 3) AS BIGINT) AS source_sequence_number,
         CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00'
              THEN '{"device": "PS5", "app_version": "1.3.0", "network_type": "wifi"}'
              ELSE '{"device": "PS5", "app_version": "1.2.0"}' END AS metadata,
         CASE WHEN event_id % 200 = 0
              THEN ['NullPointerException', 'TimeoutException', 'OutOfMemoryError'][event_id % 3 + 1]
                   || ': crash in frame update' END AS stack_trace,
         CAST(ts AS DATE) AS event_date
  FROM events
),
telemetry_k AS (
  SELECT *, 'orig' AS kind FROM base
  UNION ALL
  SELECT *, 'retry' FROM base WHERE event_id % 100 = 3 AND event_id % 1000 <> 3
  UNION ALL
  SELECT event_id, player_id, game_id, 'match_end', event_timestamp, ingestion_timestamp, producer_id,
         source_sequence_number + 1000, metadata, stack_trace, event_date, 'corr'
  FROM base WHERE event_id % 300 = 5
  UNION ALL
  SELECT event_id, player_id, game_id, event_type, event_timestamp,
         ingestion_timestamp + INTERVAL 73 HOUR, producer_id, source_sequence_number, metadata,
         stack_trace, event_date, 'escape'
  FROM base WHERE event_id % 1000 = 3
),
telemetry AS (SELECT * EXCLUDE (kind) FROM telemetry_k)"""

TCOLS = ["event_id", "player_id", "game_id", "event_type", "event_timestamp",
         "ingestion_timestamp", "producer_id", "source_sequence_number", "metadata",
         "stack_trace", "event_date"]


def present_cols(prefix: str = "") -> str:
    out = []
    for c in TCOLS:
        x = f"{prefix}{c}"
        if c in ("event_timestamp", "ingestion_timestamp"):
            out.append(f"{TS(x)} AS {c}")
        elif c == "event_date":
            out.append(f"{D(x)} AS {c}")
        else:
            out.append(f"{x} AS {c}" if prefix else c)
    return ", ".join(out)


def with_t(body: str, extra: str = "") -> str:
    ctes = _BASE + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


HAS_KEY = "json_extract_string(metadata, '$.network_type') IS NOT NULL"
LAG = "date_diff('second', event_timestamp, ingestion_timestamp)"
ORDER = "source_sequence_number DESC, ingestion_timestamp DESC"
INW = "ingestion_timestamp <= min(ingestion_timestamp) OVER (PARTITION BY event_id) + INTERVAL 72 HOUR"

_DEDUP_BOUNDED_CTES = f"""
f AS (SELECT *, {INW} AS inw FROM telemetry),
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {ORDER}) AS rn FROM f WHERE inw),
silver AS (SELECT * EXCLUDE (inw, rn) FROM r WHERE rn = 1
           UNION ALL SELECT * EXCLUDE (inw) FROM f WHERE NOT inw)"""

_DEDUP_LATEST_CTES = f"""
rl AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {ORDER}) AS rn FROM telemetry),
latest AS (SELECT * EXCLUDE (rn) FROM rl WHERE rn = 1)"""


def _rule_sql(name, sev, obs_sql, passed_sql, flag_fail, detail):
    return (f"SELECT '{name}' AS name, '{sev}' AS severity, CAST(o AS DOUBLE) AS observed, "
            f"coalesce({passed_sql}, false) AS passed, "
            f"CASE WHEN coalesce({passed_sql}, false) THEN 'PASS' ELSE '{flag_fail}' END AS flag, "
            f"'{detail}' AS detail FROM ({obs_sql})")


QUALITY_REPORT = with_t(" UNION ALL ".join([
    _rule_sql("schema_drift_before_boundary", "hard",
              f"SELECT count(*) AS o FROM telemetry WHERE event_date < DATE '2024-01-16' AND {HAS_KEY}",
              "CAST(o AS DOUBLE) = 0.0", "FAIL", "has to be eq 0"),
    _rule_sql("hot_game_share", "soft",
              "SELECT max(n)::DOUBLE / (SELECT count(*) FROM telemetry) AS o "
              "FROM (SELECT game_id, count(*) AS n FROM telemetry GROUP BY game_id)",
              "abs(CAST(o AS DOUBLE) - 0.37::DOUBLE) <= 0.02::DOUBLE", "WARN", "0.02 or less away from 0.37"),
    _rule_sql("late_arrival_rate", "soft",
              f"SELECT sum(CASE WHEN {LAG} > 300 THEN 1 ELSE 0 END)::DOUBLE / count(*) AS o FROM telemetry",
              "abs(CAST(o AS DOUBLE) - 0.025::DOUBLE) <= 0.01::DOUBLE", "WARN", "0.01 or less away from 0.025"),
    _rule_sql("duplicate_rate", "soft",
              "SELECT (count(*) - count(DISTINCT event_id))::DOUBLE / count(*) AS o FROM telemetry",
              "abs(CAST(o AS DOUBLE) - 0.01::DOUBLE) <= 0.005::DOUBLE", "WARN", "0.005 or less away from 0.01"),
    _rule_sql("producers", "hard", "SELECT count(DISTINCT producer_id) AS o FROM telemetry",
              "CAST(o AS DOUBLE) >= 3.0", "FAIL", "has to be ge 3"),
    _rule_sql("crash_rate", "hard",
              "SELECT count(*) FILTER (WHERE event_type = 'crash')::DOUBLE / count(*) AS o FROM telemetry",
              "CAST(o AS DOUBLE) <= 0.02::DOUBLE", "FAIL", "has to be le 0.02"),
]))

_Q_IN = "q AS (SELECT * REPLACE (nullif(player_id, 5) AS player_id) FROM telemetry)"
_Q_BAD = "player_id IS NULL OR event_id IS NULL OR event_timestamp IS NULL"
_Q_REASONS = ("concat_ws(',', CASE WHEN player_id IS NULL THEN 'player_id:not_null' END, "
              "CASE WHEN event_id IS NULL THEN 'event_id:not_null' END, "
              "CASE WHEN event_timestamp IS NULL THEN 'event_timestamp:not_null' END)")

DUPLICATE_CENSUS = with_t("""
SELECT 'identical' AS flavor, CAST(coalesce(sum(ident), 0) AS BIGINT) AS n_rows,
       count(*) FILTER (WHERE ident > 0) AS n_keys FROM k
UNION ALL
SELECT 'correction', CAST(coalesce(sum(corr), 0) AS BIGINT), count(*) FILTER (WHERE corr > 0) FROM k
UNION ALL
SELECT 'out_of_window', CAST(coalesce(sum(late), 0) AS BIGINT), count(*) FROM l""", f"""
pre AS (SELECT event_id, source_sequence_number, ingestion_timestamp, count(*) AS c
        FROM telemetry GROUP BY ALL),
f AS (SELECT *, {INW} AS inw FROM pre),
v AS (SELECT event_id, source_sequence_number, sum(c) AS n FROM f WHERE inw GROUP BY ALL),
k AS (SELECT event_id, sum(n - 1) AS ident, count(*) - 1 AS corr FROM v GROUP BY event_id),
l AS (SELECT event_id, sum(c) AS late FROM f WHERE NOT inw GROUP BY event_id)""")

TELEMETRY_KIND = with_t(f"SELECT {present_cols()}, kind FROM telemetry_k")

DEFECT_CONFORMANCE = with_t("""
SELECT * FROM (VALUES
  ('skew', 'hot_game_share', 0.37::DOUBLE, 0.02::DOUBLE, (SELECT hot FROM s)),
  ('late_arrivals', 'late_rate', 0.025::DOUBLE, 0.005::DOUBLE, (SELECT late::DOUBLE / rows FROM s)),
  ('duplicates', 'duplicate_rate', 0.01::DOUBLE, 0.005::DOUBLE, (SELECT (rows - events)::DOUBLE / events FROM s)),
  ('schema_drift', 'first_drift_day', 15.0::DOUBLE, 0.0::DOUBLE,
     (SELECT CAST(date_diff('day', DATE '2024-01-01', first_drift) AS DOUBLE) FROM s)),
  ('schema_drift', 'drift_rows_before_boundary', 0.0::DOUBLE, 0.0::DOUBLE, (SELECT before::DOUBLE FROM s)),
  ('crashes', 'crash_rate', 0.005::DOUBLE, 0.001::DOUBLE, (SELECT crash::DOUBLE / events FROM s)),
  ('small_files', 'flush_files_per_partition', NULL::DOUBLE, NULL::DOUBLE, (SELECT fpp FROM cells))
) AS v(defect, metric, expected, tolerance, observed)
""".replace("SELECT * FROM (VALUES", "SELECT defect, metric, expected, tolerance, observed, "
            "CASE WHEN expected IS NULL THEN NULL ELSE abs(observed - expected) <= tolerance END AS passed "
            "FROM (VALUES"), f"""
s AS (SELECT count(*) AS rows, count(DISTINCT event_id) AS events,
             count(*) FILTER (WHERE {LAG} > 300) AS late,
             count(*) FILTER (WHERE event_type = 'crash') AS crash,
             min(CASE WHEN {HAS_KEY} THEN event_date END) AS first_drift,
             count(*) FILTER (WHERE {HAS_KEY} AND event_date < DATE '2024-01-16') AS before,
             (SELECT max(n) FROM (SELECT count(*) AS n FROM telemetry GROUP BY game_id))::DOUBLE / count(*) AS hot
      FROM telemetry),
cells AS (SELECT count(*)::DOUBLE / count(DISTINCT event_date) AS fpp FROM (
            SELECT DISTINCT event_date, producer_id, time_bucket(INTERVAL 5 MINUTE, ingestion_timestamp)
            FROM telemetry))""")

_DECODE_EVENT = "['login', 'logout', 'purchase', 'match_start', 'match_end'][event_id % 5 + 1]"
_DECODE_DEVICE = "['PS5', 'PS4'][event_id % 2 + 1]"
_DECODE_NET = "['wifi', 'ethernet', 'cellular'][event_id % 3 + 1]"
_AFTER = "ts >= TIMESTAMP '2024-01-16 00:00:00'"

ORACLE = {
    "defect_conformance": DEFECT_CONFORMANCE,
    "drift_before_boundary": with_t(
        f"SELECT count(*) FILTER (WHERE event_date < DATE '2024-01-16' AND {HAS_KEY}) AS observed, "
        f"count(*) FILTER (WHERE {HAS_KEY}) AS rows_with_key FROM telemetry"),
    "hot_key_share": with_t(
        "SELECT game_id, count(*) AS n_rows, count(*) / (SELECT count(*) FROM telemetry) AS share, "
        "count(*) = max(count(*)) OVER () AS is_hottest FROM telemetry GROUP BY game_id"),
    "late_arrival_rate": with_t(
        f"SELECT CAST(sum(CASE WHEN {LAG} > 300 THEN 1 ELSE 0 END) AS BIGINT) AS late_rows, "
        f"count(*) AS total_rows, sum(CASE WHEN {LAG} > 300 THEN 1 ELSE 0 END)::DOUBLE / count(*) "
        "AS observed FROM telemetry"),
    "quality_report": QUALITY_REPORT,
    "quarantine_rejects": with_t(
        f"SELECT {present_cols()}, {_Q_REASONS} AS _reasons FROM q WHERE {_Q_BAD}", _Q_IN),
    "quarantine_clean": with_t(f"SELECT {present_cols()} FROM q WHERE NOT ({_Q_BAD})", _Q_IN),
    "producer_sequence": with_t(
        "SELECT event_id, producer_id, row_number() OVER (PARTITION BY producer_id ORDER BY event_id) - 1 "
        "AS sequence_index FROM base"),
    "dedup_latest": with_t(f"SELECT {present_cols()} FROM latest", _DEDUP_LATEST_CTES),
    "dedup_bounded": with_t(f"SELECT {present_cols()} FROM silver", _DEDUP_BOUNDED_CTES),
    "duplicate_census": DUPLICATE_CENSUS,
    "flush_bucket_layout": with_t(
        f"SELECT {D('event_date')} AS event_date, producer_id, {TS('fs')} AS flush_start, "
        "count(*) AS n_rows, strftime(fs, '%Y%m%dT%H%M') AS flush_stamp FROM ("
        "SELECT *, time_bucket(INTERVAL 5 MINUTE, ingestion_timestamp) AS fs FROM telemetry) "
        "GROUP BY event_date, producer_id, fs"),
    "drift_key_census": with_t(
        f"SELECT json_key, {D('min(event_date)')} AS first_date, {D('max(event_date)')} AS last_date, "
        "count(DISTINCT event_date) AS n_dates, count(*) AS n_rows FROM ("
        "SELECT event_date, unnest(json_keys(metadata)) AS json_key FROM telemetry) GROUP BY json_key"),
    "late_routing": with_t(
        f"SELECT CASE WHEN {LAG} <= 300 THEN 'on_time' WHEN {LAG} <= 72 * 3600 THEN 'late_open' "
        "ELSE 'late_closed' END AS route, count(*) AS n_rows FROM telemetry GROUP BY 1"),
    "partition_balance": with_t(
        "SELECT count(*) AS n_partitions, min(n) AS min_rows, max(n) AS max_rows, "
        "sum(n)::DOUBLE / count(*) AS mean_rows, (max(n) - min(n)) * 100.0::DOUBLE / max(n) AS spread_pct "
        "FROM (SELECT event_date, count(*) AS n FROM telemetry GROUP BY event_date)"),
    "landing_completeness": with_t(
        f"SELECT {D('coalesce(e.event_date, a.event_date)')} AS event_date, "
        "coalesce(e.expected, 0) AS expected, coalesce(a.actual, 0) AS actual, "
        "coalesce(e.expected, 0) - coalesce(a.actual, 0) AS missing_count, "
        "CASE WHEN e.expected IS NULL THEN 'unexpected' WHEN a.actual IS NULL OR a.actual = 0 THEN 'missing' "
        "WHEN a.actual < e.expected THEN 'partial' WHEN a.actual > e.expected THEN 'excess' "
        "ELSE 'complete' END AS status FROM e FULL OUTER JOIN a ON e.event_date = a.event_date",
        "e AS (SELECT CAST(ts AS DATE) AS event_date, count(*) AS expected FROM events GROUP BY 1), "
        "a AS (SELECT event_date, count(DISTINCT event_id) AS actual FROM telemetry GROUP BY 1)"),
    "salted_group_count": with_t(
        f"SELECT game_id, count(*) AS n_rows, count(DISTINCT player_id) AS n_players, "
        f"{TS('min(event_timestamp)')} AS first_event, {TS('max(event_timestamp)')} AS last_event "
        "FROM telemetry GROUP BY game_id"),
    "salted_join": with_t(
        f"SELECT t.event_id, t.source_sequence_number, {TS('t.ingestion_timestamp')} AS ingestion_timestamp, "
        "t.game_id, g.game_players, g.game_rows FROM telemetry t JOIN g ON t.game_id = g.game_id",
        "g AS (SELECT game_id, count(DISTINCT player_id) AS game_players, count(*) AS game_rows "
        "FROM telemetry GROUP BY game_id)"),
    "join_sources": with_t(
        f"SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, p.player_events, "
        f"{TS('p.first_event')} AS first_event FROM orders o JOIN p ON o.o_custkey = p.o_custkey",
        "p AS (SELECT player_id AS o_custkey, count(*) AS player_events, min(event_timestamp) AS first_event "
        "FROM telemetry GROUP BY player_id)"),
    "dictionary_decode": (
        f"SELECT event_id, {_DECODE_EVENT} AS event_type_name, {_DECODE_DEVICE} AS device, "
        f"{_DECODE_NET} AS network_type FROM events"),
    "json_build": (
        f"SELECT event_id, '{{\"device\": \"' || {_DECODE_DEVICE} || '\", \"app_version\": \"' || "
        f"CASE WHEN {_AFTER} THEN '1.3.0' ELSE '1.2.0' END || '\"' || "
        f"CASE WHEN {_AFTER} THEN ', \"network_type\": \"' || {_DECODE_NET} || '\"' ELSE '' END || '}}' "
        "AS metadata FROM events"),
    "union_with_duplicates": TELEMETRY_KIND,
    "blob_catalog": (
        "SELECT sha256(text) AS sha256, CAST(max(strlen(text)) AS BIGINT) AS n_bytes, count(*) AS n_refs, "
        "'blobs/' || sha256(text) AS blob_path FROM documents WHERE text IS NOT NULL GROUP BY sha256(text)"),
    "blob_integrity": (
        "WITH ptr AS (SELECT sha256(text) AS pointer, count(*) AS refs FROM documents "
        "  WHERE text IS NOT NULL GROUP BY 1), "
        "store AS (SELECT DISTINCT sha256(text) AS pointer FROM (SELECT text FROM documents UNION ALL "
        "  SELECT text FROM benchmark) WHERE text IS NOT NULL) "
        "SELECT CAST((SELECT coalesce(sum(refs), 0) FROM ptr) AS BIGINT) AS rows_with_pointer, "
        "(SELECT count(*) FROM ptr) AS blobs_referenced, "
        "(SELECT count(*) FROM ptr WHERE pointer NOT IN (SELECT pointer FROM store)) AS missing_blobs, "
        "CAST((SELECT coalesce(sum(refs), 0) FROM ptr WHERE pointer NOT IN (SELECT pointer FROM store)) "
        "  AS BIGINT) AS rows_missing_blob, "
        "(SELECT count(*) FROM store WHERE pointer NOT IN (SELECT pointer FROM ptr)) AS orphan_blobs, "
        "(SELECT count(*) FROM store) AS blobs_stored"),
    "contract_conformance": with_t("""
SELECT c.column_name, c.declared_type, c.actual_type, c.status,
       CASE c.column_name
         WHEN 'event_id' THEN (SELECT count(*) FILTER (WHERE event_id IS NULL) FROM telemetry)
         WHEN 'player_id' THEN (SELECT count(*) FILTER (WHERE player_id IS NULL) FROM telemetry)
         WHEN 'game_id' THEN (SELECT count(*) FILTER (WHERE game_id IS NULL) FROM telemetry)
         WHEN 'event_type' THEN (SELECT count(*) FILTER (WHERE event_type IS NULL) FROM telemetry)
         WHEN 'event_timestamp' THEN (SELECT count(*) FILTER (WHERE event_timestamp IS NULL) FROM telemetry)
         WHEN 'ingestion_timestamp' THEN (SELECT count(*) FILTER (WHERE ingestion_timestamp IS NULL) FROM telemetry)
         WHEN 'producer_id' THEN (SELECT count(*) FILTER (WHERE producer_id IS NULL) FROM telemetry)
         WHEN 'source_sequence_number' THEN (SELECT count(*) FILTER (WHERE source_sequence_number IS NULL) FROM telemetry)
         WHEN 'metadata' THEN (SELECT count(*) FILTER (WHERE metadata IS NULL) FROM telemetry)
         WHEN 'stack_trace' THEN (SELECT count(*) FILTER (WHERE stack_trace IS NULL) FROM telemetry)
         WHEN 'event_date' THEN (SELECT count(*) FILTER (WHERE event_date IS NULL) FROM telemetry)
       END AS n_nulls,
       0::BIGINT AS n_uncastable
FROM (VALUES
  ('event_id', 'bigint', 'bigint', 'ok'), ('player_id', 'bigint', 'bigint', 'ok'),
  ('game_id', 'bigint', 'bigint', 'ok'), ('event_type', 'string', 'string', 'ok'),
  ('event_timestamp', 'timestamp', 'timestamp_ntz', 'castable'),
  ('ingestion_timestamp', 'timestamp', 'timestamp_ntz', 'castable'),
  ('producer_id', 'bigint', 'bigint', 'ok'), ('source_sequence_number', 'bigint', 'bigint', 'ok'),
  ('metadata', 'string', 'string', 'ok'), ('stack_trace', 'string', 'string', 'ok'),
  ('event_date', NULL, 'date', 'extra')
) AS c(column_name, declared_type, actual_type, status)"""),
    "silver_metadata": with_t(
        f"SELECT event_id, {D('event_date')} AS event_date, json_extract_string(metadata, '$.device') AS device, "
        "json_extract_string(metadata, '$.app_version') AS app_version, "
        "json_extract_string(metadata, '$.network_type') AS network_type FROM telemetry"),
    "gold_daily_events": with_t(
        f"SELECT {D('event_date')} AS event_date, game_id, event_type, count(*) AS n_events, "
        "count(DISTINCT player_id) AS n_players FROM silver GROUP BY event_date, game_id, event_type",
        _DEDUP_BOUNDED_CTES),
    "gold_daily_rates": with_t(
        f"SELECT {D('event_date')} AS event_date, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {LAG} > 300) AS late_rows, "
        "count(*) FILTER (WHERE event_type = 'crash') AS crash_rows, "
        f"(count(*) FILTER (WHERE {LAG} > 300))::DOUBLE / count(*) AS late_rate, "
        "(count(*) FILTER (WHERE event_type = 'crash'))::DOUBLE / count(*) AS crash_rate "
        "FROM silver GROUP BY event_date", _DEDUP_BOUNDED_CTES),
    "gold_player_activity": with_t(
        "SELECT player_id, count(*) AS n_events, count(DISTINCT game_id) AS n_games, "
        f"count(DISTINCT event_date) AS n_active_days, {TS('min(event_timestamp)')} AS first_event, "
        f"{TS('max(event_timestamp)')} AS last_event FROM silver GROUP BY player_id",
        _DEDUP_BOUNDED_CTES),
    "table_diff": with_t(
        f"SELECT {present_cols()}, side, count(*) AS n_copies FROM ("
        "SELECT *, 'only_in_a' AS side FROM (SELECT * FROM silver EXCEPT ALL SELECT * FROM latest) "
        "UNION ALL SELECT *, 'only_in_b' FROM (SELECT * FROM latest EXCEPT ALL SELECT * FROM silver)) "
        f"GROUP BY ALL",
        _DEDUP_BOUNDED_CTES + "," + _DEDUP_LATEST_CTES),
}

_BRONZE = with_t(f"SELECT {present_cols()}, 'player_events' AS _source_name, "
                 f"{D('event_date')} AS source_partition FROM telemetry")
_CELLS = ("SELECT event_date, count(DISTINCT (producer_id, time_bucket(INTERVAL 5 MINUTE, ingestion_timestamp))) "
          "AS n FROM telemetry GROUP BY event_date")

ORACLE.update({
    "schema_evolution": with_t(
        "SELECT field, 'same' AS status, n_values FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM telemetry) "
        "ON COLUMNS(*) INTO NAME field VALUE n_values) UNION ALL SELECT 'client_region', 'added', "
        "count(*) FROM telemetry WHERE event_date = (SELECT max(event_date) FROM telemetry) "
        "AND player_id IS NOT NULL"),
    "exact_sample": with_t(
        f"SELECT event_id, source_sequence_number, {TS('ingestion_timestamp')} AS ingestion_timestamp FROM telemetry "
        f"ORDER BY sha256('42|' || event_id || '|' || source_sequence_number || '|' || {TS('ingestion_timestamp')}), "
        "1, 2, 3 LIMIT 100"),
    "table_fingerprint": with_t(
        "SELECT count(*) AS n_rows, sum(h)::VARCHAR AS hash_sum, bit_xor(h) AS hash_xor FROM ("
        "SELECT ('0x' || substr(sha256(concat_ws('|', coalesce(event_id::VARCHAR, '~'), coalesce(player_id::VARCHAR, '~'), "
        "coalesce(source_sequence_number::VARCHAR, '~'), "
        f"coalesce({TS('ingestion_timestamp')}, '~'), coalesce(metadata, '~'))), 1, 12))::BIGINT AS h FROM telemetry)"),
    "first_partitions": with_t(f"SELECT {D('event_date')} AS event_date FROM (SELECT DISTINCT event_date "
                               "FROM telemetry) ORDER BY event_date LIMIT 5"),
    "late_closed_rows": with_t(f"SELECT {present_cols()} FROM telemetry WHERE {LAG} > 72 * 3600"),
    "document_blob_pointers": (
        "SELECT d.doc_id, b.blob_path FROM documents d LEFT JOIN ("
        "SELECT DISTINCT sha256(text) AS sha, 'blobs/' || sha256(text) AS blob_path FROM benchmark "
        "WHERE text IS NOT NULL) b ON sha256(d.text) = b.sha"),
    "bronze_full_refresh": _BRONZE,
    "bronze_incremental": _BRONZE,
    "bronze_second_source": (f"SELECT * REPLACE ({TS('o_orderdate')} AS o_orderdate), 'orders' AS _source_name "
                             "FROM orders"),
    "landing_file_counts": with_t(f"SELECT {D('event_date')} AS event_date, n AS n_files, n AS n_small_files FROM ({_CELLS})"),
    "compact": with_t(f"SELECT {D('event_date')} AS event_date, n AS files_before, 1::BIGINT AS files_after, "
                      f"true AS compacted FROM ({_CELLS})"),
    "stream_dedup": ORACLE["dedup_bounded"],
    "stream_flush_counts": with_t(
        f"SELECT {TS('time_bucket(INTERVAL 5 MINUTE, ingestion_timestamp)')} AS flush_start, producer_id, "
        "count(*) AS n_rows FROM telemetry GROUP BY 1, 2"),
})

#: The same over the clean rows only (queries refined_*).
_CLEAN_CTES = ("clean AS (SELECT * FROM telemetry WHERE player_id <> 5),"
               + _DEDUP_BOUNDED_CTES.replace("FROM telemetry", "FROM clean"))

ORACLE.update({
    "refined_rejects": with_t(
        f"SELECT {present_cols()}, 'player_id:not_null' AS _reasons FROM "
        "(SELECT * REPLACE (NULL::BIGINT AS player_id) FROM telemetry WHERE player_id = 5)"),
    "refined_silver": with_t(f"SELECT {present_cols()} FROM silver", _CLEAN_CTES),
    **{f"refined_{name}": ORACLE[f"gold_{name}"].replace(_DEDUP_BOUNDED_CTES, _CLEAN_CTES)
       for name in ("daily_events", "daily_rates", "player_activity")},
    "refined_duplicate_rates": with_t(
        f"SELECT {D('event_date')} AS event_date, sum(n)::BIGINT AS n_rows, count(*) AS n_keys, "
        "sum(n - 1)::DOUBLE / sum(n) AS duplicate_rate FROM (SELECT event_date, event_id, count(*) AS n FROM telemetry "
        "WHERE player_id <> 5 GROUP BY ALL) GROUP BY event_date"),
})

# Five dates land at a time (a drop); see the registered queries.
_DAY = "date_diff('day', DATE '2024-01-01', event_date)"
_DELIVERED = f"""
d AS (SELECT *, {_DAY} // 5 * 2 + CASE WHEN event_id % 300 = 5 AND event_type = 'match_end' THEN 1 ELSE 0 END AS n
      FROM telemetry),
m AS (SELECT n, max(max(event_date)) OVER (ORDER BY n) AS newest, n = min(n) OVER () AS is_first FROM d GROUP BY n),
routed AS (SELECT d.* EXCLUDE (n), NOT is_first AND event_date <= newest - 3 AS side FROM d JOIN m USING (n)),
opened AS (SELECT * EXCLUDE (side) FROM routed WHERE NOT side),"""

_VERSION_B = """
a AS (SELECT * FROM telemetry),
b AS (SELECT * REPLACE (
        CASE WHEN day(event_date) = 11 AND event_id % 30 = 2 THEN 'altered' ELSE event_type END AS event_type,
        CASE WHEN day(event_date) = 23 AND event_id % 25 = 3 THEN '?' ELSE stack_trace END AS stack_trace)
      FROM (SELECT * FROM telemetry WHERE NOT (day(event_date) = 5 AND event_id % 50 = 0)
            UNION ALL SELECT * FROM telemetry WHERE day(event_date) = 17 AND event_id % 40 = 1)),
diff AS (SELECT *, 'only_in_a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
         UNION ALL SELECT *, 'only_in_b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))"""

ORACLE.update({
    "stream_silver": with_t(
        f"SELECT {present_cols()}, false AS side FROM silver "
        f"UNION ALL SELECT {present_cols()}, true FROM routed WHERE side",
        _DELIVERED + _DEDUP_BOUNDED_CTES.replace("FROM telemetry", "FROM opened")),
    "stream_late_split": with_t(
        "SELECT n AS micro_batch, count(*) AS n_rows, count(*) FILTER (WHERE late) AS n_late, "
        "count(*) FILTER (WHERE NOT late) AS written_on_time, count(*) FILTER (WHERE late) AS written_late "
        "FROM (SELECT d.n, coalesce(ingestion_timestamp < clock - INTERVAL 24 HOUR, false) AS late "
        "FROM d JOIN m USING (n)) GROUP BY n",
        f"d AS (SELECT *, dense_rank() OVER (ORDER BY {_DAY} // 5) - 1 AS n FROM telemetry), "
        "m AS (SELECT n, max(max(ingestion_timestamp)) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING) AS clock FROM d GROUP BY n)"),
    "silver_written": ORACLE["dedup_bounded"],
    "hot_keys": with_t("SELECT game_id, event_type, count(*) AS n_rows FROM telemetry GROUP BY ALL "
                       "HAVING count(*) >= 0.05::DOUBLE * (SELECT count(*) FROM telemetry)"),
    "tree_diff": with_t(f"SELECT {present_cols()}, side, count(*) AS n_copies FROM diff GROUP BY ALL", _VERSION_B),
    "partition_diff": with_t(
        f"SELECT {D('event_date')} AS event_date, (SELECT count(*) FROM a WHERE a.event_date = x.event_date) AS rows_a, "
        "(SELECT count(*) FROM b WHERE b.event_date = x.event_date) AS rows_b, "
        "event_date NOT IN (SELECT event_date FROM diff) AS is_equal "
        "FROM (SELECT DISTINCT event_date FROM telemetry) x", _VERSION_B),
    "ingest_progress": with_t(
        "SELECT 1 AS run, n - held AS rows_read, n - held AS rows_added, n - held AS rows_stamped FROM c "
        "UNION ALL SELECT 2, 0, 0, 0 FROM c UNION ALL SELECT 3, held, held, held FROM c "
        "UNION ALL SELECT 4, n, 0, 0 FROM c",
        "c AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_date = (SELECT max(event_date) FROM telemetry)) "
        "AS held FROM telemetry)"),
    "bronze_compacted": _BRONZE,
    "bronze_compacted_files": with_t(f"SELECT {D('event_date')} AS event_date, count(*) AS n_rows, 1::BIGINT AS n_files "
                                     "FROM telemetry GROUP BY event_date"),
    "landing_gaps": with_t(
        f"SELECT {D('event_date')} AS event_date, producer_id, strftime(min(fs), '%Y%m%dT%H%M') AS first_missing, "
        "strftime(max(fs), '%Y%m%dT%H%M') AS last_missing, count(*) AS n_missing FROM ("
        "SELECT *, nth - row_number() OVER (PARTITION BY event_date, producer_id ORDER BY fs) AS island "
        "FROM n WHERE missing) GROUP BY event_date, producer_id, island",
        "c AS (SELECT DISTINCT event_date, producer_id, time_bucket(INTERVAL 5 MINUTE, ingestion_timestamp) AS fs "
        "FROM telemetry), n AS (SELECT *, row_number() OVER (PARTITION BY event_date, producer_id ORDER BY fs) AS nth, "
        "epoch(fs)::BIGINT // 300 // 3 % 40 = producer_id AS missing FROM c)"),
    "type_drift": """SELECT * FROM (VALUES
  ('event_id', 'bigint', 'bigint', 'same'), ('player_id', 'int,bigint,string', 'string', 'widened'),
  ('source_sequence_number', 'int,bigint', 'bigint', 'widened'), ('event_date', 'date', 'date', 'same'),
  ('stack_trace', 'string', 'string', 'partial')) AS v(field, types, widened, status)""",
    "drift_rescue": with_t(
        "SELECT event_id, CASE WHEN NOT unfit THEN player_id END AS player_id, source_sequence_number, "
        "CASE WHEN day(event_date) > 10 THEN stack_trace END AS stack_trace, NULL::VARCHAR AS metadata, "
        f"{D('event_date')} AS event_date, CASE WHEN unfit THEN '{{\"player_id\":\"p-' || player_id || '\"}}' END AS rescued "
        "FROM (SELECT *, day(event_date) > 20 AND event_id % 50 = 0 AS unfit FROM telemetry)"),
    "json_round_trip": "SELECT doc_id, source, sha256('\"\\' || chr(10) || chr(9) || text) AS text_sha FROM documents",
})

ORACLE.update({
    "order_cents": "SELECT o_orderkey, t // 10 + CASE WHEN t % 10 > 5 OR t % 10 = 5 AND t // 10 % 2 = 1 THEN 1 ELSE 0 END "
                   "AS cents FROM (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT * 15 AS t FROM orders)",
    "quality_text": QUALITY_REPORT.replace("WITH base", "WITH base", 1).replace(
        "SELECT 'schema_drift_before_boundary' AS name",
        "SELECT rpad(flag, 5, ' ') || ' ' || rpad(name, 28, ' ') || ' observed=' || printf('%.4f', observed) || ' / ' || detail "
        "AS line FROM (SELECT 'schema_drift_before_boundary' AS name", 1) + ")",
    "ingest_every_source": with_t(
        "SELECT 'orders' AS source, count(*) AS n_rows, count(DISTINCT o_orderpriority) AS n_partitions, 'PASS' AS small_files "
        "FROM orders UNION ALL SELECT 'player_events', count(*), count(DISTINCT event_date), 'PASS' FROM telemetry"),
    "table_by_name": "SELECT o_orderpriority, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1",
    "binary_blob_scan": (
        "SELECT (doc_id % 64)::INT AS shelf, sum(strlen(text) + 1)::BIGINT AS n_bytes, "
        "sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256 FROM documents WHERE text IS NOT NULL GROUP BY 1"),
    "optimized_bronze": _BRONZE,
})
