"""From Bronze on by contract: row rules split the table into clean rows and
rejects (with their reasons), clean rows are deduplicated into Silver, and Gold
summaries are written over the written Silver. Every step overwrites its
table, so a second run over the same Bronze gives the same tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import gold
from sluice.operators.dedup import write_bounded
from sluice.operators.quality import read_quarantined, write_quarantined
from sluice.sources.contract import SourceContract

#: Columns that the Gold summaries of an event source need.
EVENT_COLUMNS = frozenset(["event_date", "game_id", "event_type", "player_id", "event_timestamp",
                           "ingestion_timestamp"])


@dataclass
class RefineResult:
    source: str
    rejects: int
    clean: int
    silver: int | None = None
    tables: dict[str, str] = field(default_factory=dict)


def tables_root(contract: SourceContract) -> str:
    """The folder that holds the layers: the Bronze table lies in <root>/bronze/."""
    return contract.bronze_path.rstrip("/").rsplit("/", 2)[0]


def duplicate_rates(clean: DataFrame, keys: list[str], part: str) -> DataFrame:
    """Rows, distinct keys and the share of extra copies per partition."""
    per_key = clean.groupBy(part, *keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(part).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
        (F.sum(F.col("n") - 1) / F.sum("n")).alias("duplicate_rate"))


def refine(spark: SparkSession, contract: SourceContract, bronze: DataFrame, root: str | None = None,
           time_col: str = "ingestion_timestamp") -> RefineResult:
    """Write the contract's clean and rejected rows, its Silver (if it has a
    dedup key) and, for event sources, its Gold tables. Every Bronze row is
    either clean or rejected; that is checked."""
    root = (root or tables_root(contract)).rstrip("/")
    name, parts = contract.name, [p for p in contract.partition_by if p in bronze.columns]
    checked = f"{root}/checked/{name}"
    write_quarantined(bronze, list(contract.row_rules), checked, partition_by=parts)
    clean, rejects = read_quarantined(spark, checked)
    result = RefineResult(name, rejects.count(), clean.count(), tables={"checked": checked})
    if result.rejects + result.clean != bronze.count():
        raise RuntimeError(f"{name}: {result.rejects} rejects and {result.clean} clean rows don't make up Bronze")
    if not contract.dedup_key or time_col not in clean.columns:
        return result
    silver_path = f"{root}/silver/{name}"
    keys = list(contract.dedup_key)
    order = list(contract.order_by) or [time_col]
    silver = write_bounded(clean, silver_path, keys, order, time_col, contract.dedup_window_hours or 72, parts)
    result.silver, result.tables["silver"] = silver.count(), silver_path
    if EVENT_COLUMNS <= set(silver.columns):
        for table, df in (("daily_events", gold.daily_events(silver)), ("daily_rates", gold.daily_rates(silver)),
                          ("player_activity", gold.player_activity(silver)),
                          ("duplicate_rates", duplicate_rates(clean, keys, "event_date"))):
            result.tables[table] = f"{root}/gold/{name}/{table}"
            df.write.mode("overwrite").parquet(result.tables[table])
    return result
