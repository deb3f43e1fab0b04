"""Row lineage: the same stamp on batch and streaming reads."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINEAGE_COLUMNS = ["_source_name", "_source_file", "_ingested_at", "_batch_id"]
# Columns that differ from run to run by design; fingerprints and oracles skip them.
RUN_COLUMNS = ["_ingested_at", "_batch_id"]


def new_run_id() -> str:
    return uuid.uuid4().hex


def add_lineage(df: DataFrame, source_name: str, run_id: str | None = None,
                source_file_col: Column | None = None) -> DataFrame:
    """Stamp source name, source file, ingestion time and run id on each row.

    ``_metadata.file_path`` is used for the file: it works for Parquet/CSV/JSON
    batch and streaming scans alike. The run id is a literal fixed when the
    plan is built, so one ingest call has one id across all its tasks."""
    return df.withColumns({
        "_source_name": F.lit(source_name),
        "_source_file": source_file_col if source_file_col is not None
        else F.col("_metadata.file_path"),
        "_ingested_at": F.current_timestamp(),
        "_batch_id": F.lit(run_id or new_run_id()),
    })
