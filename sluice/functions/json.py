"""JSON-in-a-string helpers (the reference keeps ``metadata`` as raw text)."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_key(text: Column, key: str) -> Column:
    """Value of a top-level key; malformed JSON, JSON null and SQL NULL all
    give NULL."""
    return F.get_json_object(text, f"$.{key}")


def json_keys(text: Column) -> Column:
    """Array of the top-level keys of a JSON object string."""
    return F.json_object_keys(text)


def parse_json_fields(text: Column, fields: dict[str, str]) -> Column:
    """Typed struct from a JSON string; a missing key is NULL."""
    ddl = ", ".join(f"`{k}` {t}" for k, t in fields.items())
    return F.from_json(text, ddl)


def json_string(text: Column) -> Column:
    """A JSON string with its quotes; what JSON can't hold is escaped."""
    inside = F.to_json(F.struct(text.alias("v")))                 # {"v":"..."}
    return F.substring(inside, F.lit(6), F.length(inside) - 6)


def json_object_text(pairs: list[tuple[str, Column]]) -> Column:
    """Exact-bytes JSON object text ``{"k": "v", "k2": "v2"}`` from string
    columns, in the given key order. A pair whose value is NULL is left out,
    so one builder covers both the pre- and post-drift shapes.
    ``to_json`` would drop the spaces, so the text is concatenated."""
    parts = [
        F.when(v.isNotNull(), F.concat(F.lit(f"{json.dumps(k, ensure_ascii=False)}: "), json_string(v)))
        for k, v in pairs
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
