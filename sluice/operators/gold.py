"""Gold summaries over deduplicated Silver: daily events by game and type,
daily defect rates, and player activity. Plain aggregates; rerunning them
over the same Silver gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import seconds_between


def daily_events(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date", "game_id", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("player_id").alias("n_players"))


def daily_rates(silver: DataFrame, late_after_s: int = 300) -> DataFrame:
    lag = seconds_between(F.col("event_timestamp"), F.col("ingestion_timestamp"))
    return (silver.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(lag > late_after_s).alias("late_rows"),
        F.count_if(F.col("event_type") == "crash").alias("crash_rows"))
        .withColumn("late_rate", F.col("late_rows") / F.col("n_rows"))
        .withColumn("crash_rate", F.col("crash_rows") / F.col("n_rows")))


def player_activity(silver: DataFrame) -> DataFrame:
    return silver.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("game_id").alias("n_games"),
        F.count_distinct("event_date").alias("n_active_days"),
        F.min("event_timestamp").alias("first_event"), F.max("event_timestamp").alias("last_event"))
