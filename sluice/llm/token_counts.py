"""Token counts of whole texts; see ``tokens`` for overlap resynchronisation.

Nulls: a null text counts as empty (0 bytes, 0 tokens); a null id is kept.
Empty tables give no rows, repeated rows are counted each, and other columns
are ignored. Special strings inside texts are read as the library does by
default: as special tokens."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import tokens
from sluice.llm.common import ship

BYTE_BPE = "byte_bpe_50k.json"
LIMIT = 512


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row. ``tokenizer`` is the
    path of a byte-level vocabulary file that every executor has."""
    ship(docs.sparkSession)
    path = tokenizer or tokens.default_path(BYTE_BPE)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(partial(tokens.count_tokens, path=path),
                            f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
