"""Contract conformance (declared vs actual schema, per-row castability),
typed conformance casts, and the Silver projection of JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.json import parse_json_fields
from sluice.sources.contract import SourceContract

# Widenings that never lose information; anything else is checked per row.
_SAFE = {
    ("int", "bigint"), ("smallint", "bigint"), ("tinyint", "bigint"), ("smallint", "int"),
    ("tinyint", "int"), ("float", "double"), ("int", "double"), ("timestamp_ntz", "timestamp"),
    ("timestamp", "timestamp_ntz"), ("date", "timestamp"), ("date", "timestamp_ntz"),
}


def _status(actual: str | None, declared: str | None) -> str:
    if declared is None:
        return "extra"
    if actual is None:
        return "missing"
    if actual == declared:
        return "ok"
    return "castable" if (actual, declared) in _SAFE else "mismatch"


def conformance_report(df: DataFrame, contract: SourceContract) -> DataFrame:
    """One row per declared or present column: declared type, actual type,
    status (ok / castable / mismatch / missing / extra), NULL count and
    values that do not cast to the declared type. Extra columns are allowed
    (schema-on-read); missing ones and uncastable values are not. The
    per-row counts come from a single aggregate pass."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    declared = contract.declared_types()
    names = list(declared) + [c for c in actual if c not in declared]
    aggs = []
    for c in names:
        if c in actual:
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"n_null__{c}"))
            bad = F.lit(False)
            if c in declared and _status(actual[c], declared[c]) == "mismatch":
                bad = F.col(c).isNotNull() & F.col(c).try_cast(declared[c]).isNull()
            aggs.append(F.count_if(bad).alias(f"n_bad__{c}"))
    counts = df.agg(*aggs) if aggs else df.sparkSession.range(1).drop("id")
    rows = []
    for c in names:
        a, d = actual.get(c), declared.get(c)
        nn = F.col(f"`n_null__{c}`") if c in actual else F.lit(None).cast("long")
        nb = F.col(f"`n_bad__{c}`") if c in actual else F.lit(None).cast("long")
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(d).cast("string").alias("declared_type"),
                             F.lit(a).cast("string").alias("actual_type"),
                             F.lit(_status(a, d)).alias("status"),
                             nn.alias("n_nulls"), nb.alias("n_uncastable")))
    return counts.select(F.inline(F.array(*rows)))


def conform(df: DataFrame, contract: SourceContract) -> DataFrame:
    """Cast declared columns to their declared types (``try_cast``: values
    that do not fit become NULL, and :func:`conformance_report` counts them),
    add declared-but-absent columns as typed NULLs, keep extra columns."""
    declared = contract.declared_types()
    exprs = {}
    for name, t in declared.items():
        if name in df.columns:
            exprs[name] = F.col(name).try_cast(t)
        else:
            exprs[name] = F.lit(None).cast(t)
    return df.withColumns(exprs)


RESCUED = "_rescued"

#: Each type and the next wider ones: every value of a type is one of the wider.
_WIDER = {
    "tinyint": ("smallint",), "smallint": ("int",), "int": ("bigint", "double"), "bigint": ("decimal(20,0)",),
    "decimal(20,0)": ("string",), "float": ("double",), "double": ("string",), "boolean": ("string",),
    "date": ("timestamp_ntz",), "timestamp_ntz": ("string",), "timestamp": ("string",), "binary": ("string",),
    "void": ("tinyint", "boolean", "date", "float", "timestamp", "binary"), "string": (),
}


def _wider_or_same(t: str) -> list[str]:
    """The type and all wider ones, nearest first."""
    out, level = [t], [t]
    while level:
        level = [w for x in level for w in _WIDER.get(x, ("string",) if x != "string" else ())]
        out += [w for w in level if w not in out]
    return out


def widest(types: list[str]) -> str:
    """The narrowest type of the lattice that holds every value of ``types``:
    text, if nothing narrower does. Types outside it only hold themselves."""
    first, *rest = types
    common = [w for w in _wider_or_same(first) if all(w in _wider_or_same(t) for t in rest)]
    least = [c for c in common if all(w in _wider_or_same(c) for w in common)]
    return least[0] if least else "string"


def merged_types(schemas: list[T.StructType]) -> dict[str, str]:
    """Column -> the type that holds all files' values, in order of appearance."""
    seen: dict[str, list[str]] = {}
    for schema in schemas:
        for f in schema.fields:
            kinds = seen.setdefault(f.name, [])
            if f.dataType.simpleString() not in kinds:
                kinds.append(f.dataType.simpleString())
    return {c: widest(kinds) for c, kinds in seen.items()}


def read_drifted(spark, groups: list[list[str]], **options) -> DataFrame:
    """Rows of files whose columns changed type or came and went: each group of
    paths is read by its own schema, its columns are widened to the type that
    holds all groups' values, and absent ones are NULL. (``mergeSchema`` refuses
    such files.)"""
    frames = [spark.read.options(**options).parquet(*paths) for paths in groups]
    types = merged_types([f.schema for f in frames])
    out = None
    for f in frames:
        row = f.select(*[(F.col(c).cast(t) if c in f.columns else F.lit(None).cast(t)).alias(c) for c, t in types.items()])
        out = row if out is None else out.unionByName(row)
    return out


def type_drift(schemas: dict[str, T.StructType]) -> list[tuple[str, str, str, str]]:
    """(column, types by group in order of appearance, widened type, status:
    ``same`` / ``widened`` / ``partial`` where a group lacks the column)."""
    types = merged_types(list(schemas.values()))
    out = []
    for c, wide in types.items():
        own = [s[c].dataType.simpleString() for s in schemas.values() if c in s.fieldNames()]
        kinds = list(dict.fromkeys(own))
        status = "widened" if len(kinds) > 1 else "partial" if len(own) < len(schemas) else "same"
        out.append((c, ",".join(kinds), wide, status))
    return out


def conform_rescued(df: DataFrame, contract: SourceContract, rescued: str = RESCUED) -> DataFrame:
    """:func:`conform` without loss: a value that doesn't fit its declared type
    is NULL there and stays in ``rescued``, JSON text of such columns and their
    values as text (NULL if all fit)."""
    declared = contract.declared_types()
    lost = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in declared.items() if c in df.columns}
    values = [F.when(bad, F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")))
              for c, bad in lost.items() if df.schema[c].dataType.simpleString() != declared[c]]
    if values:
        unfit = F.array_compact(F.array(*values))
        text = F.when(F.size(unfit) > 0, F.to_json(F.map_from_entries(unfit)))
    else:
        text = F.lit(None).cast("string")
    return conform(df.withColumn(rescued, text), contract)


SILVER_METADATA_FIELDS = {"device": "string", "app_version": "string", "network_type": "string"}


def silver_projection(df: DataFrame, json_col: str = "metadata",
                      fields: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Parse the JSON text into typed columns on read; a missing key is NULL."""
    fields = fields or SILVER_METADATA_FIELDS
    parsed = parse_json_fields(F.col(json_col), fields).alias("_m")
    keep = keep if keep is not None else [c for c in df.columns if c != json_col]
    return df.select(*keep, parsed).select(*keep, *[F.col(f"_m.{k}").alias(k) for k in fields])


def typed_nulls(df: DataFrame, columns: dict[str, T.DataType | str]) -> DataFrame:
    """Add absent columns as NULLs of a stable type (never a void column)."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})
