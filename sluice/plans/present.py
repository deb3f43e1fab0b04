"""Engine-neutral presentation of results for cross-engine comparison:
dates and timestamps become ISO text (DuckDB hands DATE to pandas as a
datetime, Spark as a date, so raw values would not hash alike). The text is
built from calendar fields, so it does not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.time import instant_to_ntz, iso_timestamp_sql


def present(df: DataFrame) -> DataFrame:
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    if instants:  # an instant is shown as its UTC wall clock
        df = df.withColumns({c: instant_to_ntz(F.col(f"`{c}`")) for c in instants})
    out = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.TimestampNTZType):
            out.append(f"{iso_timestamp_sql(f.name)} AS {name}")
        elif isinstance(f.dataType, T.DateType):
            out.append(f"CAST({name} AS STRING) AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)
