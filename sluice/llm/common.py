"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sluice
from sluice.session import scratch_path

#: Words are maximal runs of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: A table is broadcast only if its measured size is below this.
BROADCAST_BYTES = 8 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's modules to the Python workers, once per application
    (Spark copies the archive from the driver to them)."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(sluice.__file__).parent
        path = Path(tempfile.mkdtemp(prefix="sluice-")) / "sluice.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(path))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: a cut of
    the lineage that survives lost executors and is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, as a path that every
    executor can open and memory-map. It has to be a mounted file system."""
    uri = urlparse(scratch_path(spark, name))
    if uri.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder in spark.checkpoint.dir, "
                         f"not {uri.scheme}://")
    return unquote(uri.path)


def crc_of_id(col: Column) -> Column:
    """crc32 of the id as text (0 for a null id)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def checked_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows times ``row_bytes`` (an
    upper bound of a row's size) fit; else plain, for a shuffled join."""
    limit = BROADCAST_BYTES // row_bytes
    return F.broadcast(df) if len(df.select(F.lit(1)).take(limit + 1)) <= limit else df


def gapless(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, rows: int,
            per_task: int = 1024) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... without gaps inside each group, in no set
    order, with no group in one task. Rows of a group are dealt by a hash of
    ``order`` into buckets of about ``per_task`` of the ``rows`` rows; a
    bucket's offset comes from the counts, which are broadcast as long as they
    are few: the rows are then shuffled and sorted once, for the numbers alone.
    ``df`` should be materialised."""
    buckets = max(1, -(-rows // per_task))
    b, at = f"{name}__bucket", f"{name}__at"
    df = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = df.groupBy(*group, b).agg(F.count(F.lit(1)).alias("n__"))
    before = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"{g}__r") for g in group], F.col(b).alias(f"{b}__r"),
                            F.coalesce(F.sum("n__").over(before), F.lit(0)).alias(at))
    same = [F.col(g).eqNullSafe(F.col(f"{g}__r")) for g in group] + [F.col(b) == F.col(f"{b}__r")]
    sized = all(isinstance(df.schema[g].dataType, T.NumericType) for g in group)      # a text may have any size
    few = sized and counts.count() * 16 * (len(group) + 3) <= BROADCAST_BYTES
    out = df.join(F.broadcast(offsets) if few else offsets, same, "left")
    inside = Window.partitionBy(*group, b).orderBy(*order)
    return (out.withColumn(name, F.col(at) + F.row_number().over(inside) - 1)
            .drop(b, f"{b}__r", at, *[f"{g}__r" for g in group]))
