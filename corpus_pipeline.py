"""The corpus pipeline: toxic documents go, one of each group of near copies
stays, sources are mixed to their weights, and what is left is packed into
sequences. Each stage takes (spark, docs, sf_dir) and returns a DataFrame;
``run`` writes each one's result to the shared folder and reads it again. The
stages keep rows with null ids and the input's columns (the last one returns
pieces); an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import minhash_forest, mixing, packing, toxicity
from sluice.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.first_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("minhash_near_dedup", drop_near_copies),
          ("source_mix", mix_sources), ("best_fit_packing", pack)]

#: SQL can't express the trained machine nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
