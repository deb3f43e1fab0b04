"""Bounded deduplication of a stream in two queries, without losing a row.

:func:`split_by_clock` is the first. Before each micro-batch the clock is the
newest time of the batches before; rows more than the allowed delay behind it
are late. Late rows and rows on time are written side by side, the latter
stamped with the clock under which they were taken, and every batch leaves an
account of both. Late rows are a table, not a number.

:func:`run_keyed_dedup` is the second: keyed state over the rows on time. Its
watermark runs on the stamped clock instead of the rows' own time. A row that
was on time at clock c is never older than c minus the delay, and files are read
in the order they were written; so the watermark stays behind every row to
come, however the second query's micro-batches are cut, and Spark drops none
(:class:`Account` counts that).

State of a key: the earliest time seen, the best row that is certainly inside
the window, and rows that may still fall out of it because an earlier copy may
come. As soon as the watermark has passed the earliest time, that is final and
one row is all that is kept. Every change emits the key's best row anew; rows
certainly outside the window are emitted once, as they come. A key's event-time
timer ends its state ``lifetime_hours`` after the earliest time; keys of a hash
bucket share a state value and Spark's timer, set to the first of theirs, since
the cost of a call of the state function is by far larger than that of a key.
Until then the result is that of :func:`sluice.operators.dedup.dedup_bounded`; a
copy that comes later still starts a window of its own.
"""

from __future__ import annotations

import pickle
import threading
import zlib
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupStateTimeout

from sluice.functions.time import add_hours, epoch_micros, ntz_to_instant
from sluice.operators.dedup import FIRST_SEEN
from sluice.operators.ingest import read_if_there

CLOCK = "_clock"
LATE = "_late"
HOUR = 3_600_000_000                          # microseconds
#: Clock of a first batch without any time.
NO_CLOCK = "TIMESTAMP_NTZ'1970-01-02 00:00:00'"
ACCOUNT = "newest timestamp_ntz, n_rows long, n_late long, sink_batch long"


def ntz(value) -> Column:
    """A naive datetime as a literal that no time zone touches."""
    return F.expr(f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'")


def split_by_clock(stream: DataFrame, path: str, checkpoint: str, time_col: str, delay_hours: int = 72) -> None:
    """Drain ``stream`` into ``<path>/rows``: its columns, ``_clock`` and
    ``_late``, a folder per micro-batch that a replay replaces; and one account
    per batch into ``<path>/accounts`` (newest time, rows, late rows). Rows
    without a time are on time. The first batch has no clock before it: none of
    its rows is late, and its oldest time is stamped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        accounts = read_if_there(spark, f"{path}/accounts", ACCOUNT)
        newest = None if accounts is None else accounts.where(F.col("sink_batch") < batch_id).agg(F.max("newest")).first()[0]
        t = F.col(time_col)
        if newest is None:
            oldest = batch.agg(F.min(time_col)).first()[0]
            clock, late = F.expr(NO_CLOCK) if oldest is None else ntz(oldest), F.lit(False)
        else:
            clock = ntz(newest)
            late = F.coalesce(t < add_hours(clock, -delay_hours), F.lit(False))
        seen = Observation()
        tagged = batch.withColumns({CLOCK: clock, LATE: late}).observe(
            seen, F.max(t).alias("newest"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(LATE)).alias("n_late"))
        tagged.write.mode("overwrite").partitionBy(LATE).parquet(f"{path}/rows/sink_batch={batch_id}")
        got = seen.get
        latest = max((x for x in (newest, got["newest"]) if x is not None), default=None)
        row = spark.range(1).select((F.lit(None) if latest is None else ntz(latest)).cast("timestamp_ntz").alias("newest"),
                                    F.lit(got["n_rows"]).alias("n_rows"), F.lit(got["n_late"]).alias("n_late"))
        row.write.mode("overwrite").parquet(f"{path}/accounts/sink_batch={batch_id}")

    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    spark = stream.sparkSession
    if read_if_there(spark, f"{path}/accounts", ACCOUNT) is None:      # nothing has landed yet: a table without rows
        schema = T.StructType([*stream.schema.fields, T.StructField(CLOCK, T.TimestampNTZType())])
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/rows/sink_batch=-1/{LATE}=false")
        spark.createDataFrame([], "newest timestamp_ntz, n_rows long, n_late long").write.mode("overwrite").parquet(
            f"{path}/accounts/sink_batch=-1")


def _rows_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CLOCK, T.TimestampNTZType()),
                         T.StructField("sink_batch", T.LongType()), T.StructField(LATE, T.BooleanType())])


def read_split(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Everything the split has written, with its clock, micro-batch and ``_late``."""
    return spark.read.schema(_rows_schema(schema)).parquet(f"{path}/rows")


def read_late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The side table: late rows of every batch."""
    return read_split(spark, path, schema).where(F.col(LATE)).select(*schema.fieldNames())


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Rows, late rows and newest time of every batch of the split."""
    return spark.read.schema(ACCOUNT).parquet(f"{path}/accounts")


def on_time_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """The rows on time as a stream, in the order they were written."""
    reader = spark.readStream.schema(_rows_schema(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.parquet(f"{path}/rows").where(~F.col(LATE)).select(*schema.fieldNames(), CLOCK)


class Account(StreamingQueryListener):
    """Counts what a query's micro-batches read and what its watermark dropped."""

    def __init__(self):
        self.batches = self.rows = self.dropped = self.state_rows = 0
        self._ended = threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.batches += 1
        self.rows += p.numInputRows
        self.dropped += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.state_rows = sum(s.numRowsTotal for s in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._ended.set()

    def wait(self, seconds: float = 60) -> None:
        """Until all events of the query have come."""
        self._ended.wait(seconds)


#: How values travel through Python as text, and how they are ordered there.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT = (T.FloatType, T.DoubleType)
_AS_IS = (T.StringType, T.DateType, T.TimestampNTZType, T.BooleanType)


def as_text(name: str, kind: T.DataType) -> Column:
    """A value as text that casts back to the same value."""
    c = F.col(name)
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, (*_WHOLE, *_FLOAT, *_AS_IS, T.DecimalType)):
        return c.cast("string")
    raise TypeError(f"column {name}: rows of type {kind.simpleString()} can't be kept in a key's state")


def from_text(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unhex(c)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(c.cast("long"))
    return c.cast(kind)


def order_of(kind: T.DataType) -> str:
    if isinstance(kind, (*_WHOLE, T.TimestampType)):
        return "whole"
    return "float" if isinstance(kind, _FLOAT) else "decimal" if isinstance(kind, T.DecimalType) else "text"


def rank(row: list, places: list[tuple[int, str]]) -> tuple:
    """What rows are compared by: NULL is lowest, NaN highest, as in Spark."""
    out = []
    for place, order in places:
        v = row[place]
        if v is None:
            out.append((0,))
        elif order == "whole":
            out.append((1, int(v)))
        elif order == "decimal":
            out.append((1, Decimal(v)))
        elif order == "float":
            out.append((1, v == "NaN", 0.0 if v == "NaN" else float(v)))
        else:
            out.append((1, v))
    return tuple(out)


class KeyState:
    """What is known of a key; see the module's text. Times are microseconds;
    rows are lists of texts, the time first."""

    def __init__(self, watermark: int, places: list[tuple[int, str]], window: int, kept: tuple | None = None):
        self.places, self.window = places, window
        self.first, self.generation, self.best, self.waiting = kept or (None, watermark, None, [])

    def take(self, rows: list[list], watermark: int) -> list[tuple[list, bool]]:
        """Add rows; (row, inside) to emit."""
        times = [int(r[0]) for r in rows if r[0] is not None]
        if times:
            self.first = min(times) if self.first is None else min(self.first, *times)
        # No later copy can be older than the watermark, nor move the window's start below this.
        lowest = min(self.first, watermark) if self.first is not None else watermark
        inside, outside, waiting = [], [], []
        for r in [*self.waiting, *rows]:
            t = None if r[0] is None else int(r[0])
            if t is not None and t > self.first + self.window:
                outside.append(r)
                continue
            inside.append(r)
            if t is not None and t > lowest + self.window:
                waiting.append(r)
        out = [(r, False) for r in outside]
        if inside or self.best is not None:
            pool = inside if self.best is None else [*inside, self.best]
            out.append((max(pool, key=lambda r: rank(r, self.places)), True))
        waits = {id(r) for r in waiting}
        sure = [r for r in inside if id(r) not in waits]
        if sure:
            self.best = max(sure if self.best is None else [*sure, self.best], key=lambda r: rank(r, self.places))
        self.waiting = waiting
        return out

    def kept(self) -> tuple:
        return self.first, self.generation, self.best, self.waiting


_OUT = "row array<string>, first_seen long, generation long, inside boolean"
_STATE = "state binary"
#: Groups of keys that share a state value, unless told otherwise. A call of the
#: state function costs about a millisecond however few rows it gets.
BUCKETS = 1 << 13


def _stepper(places: list[tuple[int, str]], n_keys: int, window_us: int, lifetime_us: int):
    import pandas as pd

    def step(bucket, chunks: Iterator, state) -> Iterator:
        now_ms = state.getCurrentWatermarkMs()
        watermark = now_ms * 1000
        # key -> what is kept of it and when its timer ends (milliseconds)
        keys: dict[tuple, tuple[tuple, int]] = pickle.loads(zlib.decompress(state.get[0])) if state.exists else {}
        touched: dict[tuple, KeyState] = {}
        newest: dict[tuple, int] = {}
        best: dict[tuple, list] = {}
        if not state.hasTimedOut:
            # A chunk at a time: rows of one key don't meet in memory beyond what is undecided.
            for chunk in chunks:
                rows_of: dict[tuple, list] = {}
                for row, clock in zip(chunk["_row"], chunk[CLOCK].to_numpy("datetime64[us]").astype("int64").tolist()):
                    row = list(row)
                    key = tuple(row[1:1 + n_keys])
                    rows_of.setdefault(key, []).append(row)
                    newest[key] = max(newest.get(key, watermark), clock)
                out = []
                for key, rows in rows_of.items():
                    known = touched.get(key)
                    if known is None:
                        known = touched[key] = KeyState(watermark, places, window_us, keys.get(key, (None,))[0])
                    for row, inside in known.take(rows, watermark):
                        if inside:
                            best[key] = row
                        else:
                            out.append((row, known.first, known.generation))
                if out:
                    rows, first, generation = zip(*out)
                    yield pd.DataFrame({"row": rows, "first_seen": first, "generation": generation, "inside": False})
            if best:
                of = [touched[key] for key in best]
                yield pd.DataFrame({"row": [*best.values()], "first_seen": pd.array([k.first for k in of], dtype="Int64"),
                                    "generation": [k.generation for k in of], "inside": True})
        # Timers that have ended take their keys along, unless rows of the key have just come.
        left = {key: kept for key, kept in keys.items() if key not in touched and kept[1] >= now_ms}
        for key, known in touched.items():
            end = (known.first if known.first is not None else newest[key]) + lifetime_us   # rows without a time: from now
            left[key] = known.kept(), max(end, watermark + 1000) // 1000
        if not left:
            state.remove()
            return
        state.update((zlib.compress(pickle.dumps(left), 1),))
        state.setTimeoutTimestamp(max(min(end for _, end in left.values()), now_ms + 1))

    return step


def _layout(schema: T.StructType, keys: list[str], order_cols: list[str], time_col: str):
    """Columns in the order that their texts have in a row, after the time."""
    names = schema.fieldNames()
    rest = [*order_cols, *[c for c in names if c not in keys and c not in order_cols]]
    return [*keys, *rest], [(1 + len(keys) + i, order_of(schema[c].dataType)) for i, c in enumerate(rest)]


def dedup_updates(rows: DataFrame, keys: list[str], order_cols: list[str], time_col: str, window_hours: int = 72,
                  lifetime_hours: int = 144, delay_hours: int = 72, buckets: int = BUCKETS) -> DataFrame:
    """A stream of updates from a stream of rows with their ``_clock``: rows as
    texts, the key's first time, its generation and whether the row is inside
    the window (then it takes the place of the one before). Keys are dealt into
    ``buckets`` by their hash; the number has to stay with the checkpoint."""
    schema = T.StructType([f for f in rows.schema.fields if f.name != CLOCK])
    names, places = _layout(schema, keys, order_cols, time_col)
    time = F.col(time_col)
    micros = epoch_micros(time) if isinstance(schema[time_col].dataType, T.TimestampNTZType) else F.unix_micros(time)
    packed = rows.select(
        F.pmod(F.xxhash64(*[as_text(k, schema[k].dataType) for k in keys]), F.lit(buckets)).alias("_bucket"), ntz_to_instant(F.col(CLOCK)).alias(CLOCK),
        F.array(micros.cast("string"), *[as_text(c, schema[c].dataType) for c in names]).alias("_row"))
    return (packed.withWatermark(CLOCK, f"{int(delay_hours)} hours")
            .groupBy("_bucket")
            .applyInPandasWithState(_stepper(places, len(keys), window_hours * HOUR, lifetime_hours * HOUR), _OUT, _STATE,
                                    "update", GroupStateTimeout.EventTimeTimeout))


def run_keyed_dedup(rows: DataFrame, path: str, checkpoint: str, keys: list[str], order_cols: list[str], time_col: str,
                    window_hours: int = 72, lifetime_hours: int = 144, delay_hours: int = 72,
                    buckets: int = BUCKETS) -> Account:
    """Drain a stream of rows on time into the updates under ``path``, a folder
    per micro-batch. The account has what was read and dropped."""
    spark = rows.sparkSession
    account = Account()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/sink_batch={batch_id}")

    updates = dedup_updates(rows, keys, order_cols, time_col, window_hours, lifetime_hours, delay_hours, buckets)
    spark.streams.addListener(account)
    try:
        (updates.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        account.wait()
    finally:
        spark.streams.removeListener(account)
    return account


def read_deduplicated(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order_cols: list[str],
                      time_col: str, keep_first_seen: bool = False) -> DataFrame:
    """The table that the updates make: each key's last row inside the window,
    and every row outside it."""
    names, _ = _layout(schema, keys, order_cols, time_col)
    kind = f"{_OUT}, sink_batch long"
    there = read_if_there(spark, path, kind)
    t = spark.createDataFrame([], kind) if there is None else there
    ids = {f"_key{i}": F.get("row", F.lit(1 + i)) for i in range(len(keys))}
    best = (t.where("inside").withColumns(ids).groupBy(*ids, "generation")
            .agg(F.max_by(F.struct("row", "first_seen"), F.col("sink_batch")).alias("last")).select("last.*"))
    both = best.unionByName(t.where("not inside").select("row", "first_seen"))
    typed = {c: from_text(F.get("row", F.lit(1 + i)), schema[c].dataType) for i, c in enumerate(names)}
    first = [F.timestamp_micros("first_seen").alias(FIRST_SEEN)] if keep_first_seen else []
    return both.select(*[typed[c].alias(c) for c in schema.fieldNames()], *first)
