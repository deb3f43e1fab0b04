"""Plan-shape regression: no registered query may contain a cartesian or
nested-loop join or Python evaluation, and scans must prune columns."""

import re

import pytest

from conftest import SF001
from sluice.plans.registry import QUERIES

# Queries that write files while being built are covered by their own tests.
WRITES = {"bronze_full_refresh", "bronze_incremental", "bronze_second_source", "bronze_compacted",
          "bronze_compacted_files", "ingest_progress", "ingest_every_source", "table_by_name", "optimized_bronze",
          "binary_blob_scan", "landing_file_counts", "landing_gaps", "small_files_audit", "compact", "stream_dedup",
          "stream_flush_counts", "stream_late_split", "stream_silver", "zorder_layout", "producer_sequence"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        if "event_id:bigint" in schema:          # the events table: never read whole
            assert "value:double" not in schema and "props:string" not in schema and "user_id" not in schema
