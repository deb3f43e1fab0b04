"""File scans: batch source reads, table reads, views and file inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.hashing import sha256_hex
from sluice.session import session_conf
from sluice.sources.contract import SUPPORTED_FORMATS, ContractError, SourceContract


#: Folders are listed by one job, a task per folder of the first level that has
#: several. By default every folder of over 32 folders starts a job of its own,
#: one after the other.
LISTING = {"spark__sql__sources__parallelPartitionDiscovery__threshold": 1}


def read_source(spark: SparkSession, contract: SourceContract, landing_root: str | None = None,
                schema=None) -> DataFrame:
    """Batch scan of a source's own landing subtree, format from the contract,
    reader options passed through, Hive partitions discovered from the path.
    Schema-on-read unless ``schema`` is given."""
    if contract.format not in SUPPORTED_FORMATS:
        raise ContractError(f"{contract.name}: unsupported format {contract.format!r}")
    reader = spark.read.format(contract.format).options(**contract.read_options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(landing_location(contract, landing_root))


def landing_location(contract: SourceContract, landing_root: str | None = None) -> str:
    if landing_root is None:
        return contract.landing_path
    return f"{landing_root.rstrip('/')}/{contract.landing_path}"


def source_file() -> Column:
    """The file a row was read from; works for batch and streaming file scans."""
    return F.col("_metadata.file_path")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table by path (contains '/') or by catalog name."""
    if "/" in table:
        return spark.read.parquet(table)
    return spark.table(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def file_inventory(spark: SparkSession, root: str, partition_col: str | None = None,
                   glob: str = "*.parquet") -> DataFrame:
    """One row per data file under ``root``: path, size in bytes, modification
    time and (optionally) the Hive partition value parsed from the path.
    Only file metadata is read: the binary content column is pruned."""
    with session_conf(spark, **LISTING):
        listed = (spark.read.format("binaryFile")
                  .option("recursiveFileLookup", "true")
                  .option("pathGlobFilter", glob)
                  .load(root))
    files = listed.select(F.col("path"), F.col("length").alias("size_bytes"),
                          F.col("modificationTime").alias("modified_at"))
    if partition_col:
        # Folder names escape special characters as %XX; decode them (a
        # literal '+' is kept, it is not an escaped space here).
        raw = F.regexp_extract("path", f"{partition_col}=([^/]+)", 1)
        files = files.withColumn(partition_col,
                                 F.url_decode(F.regexp_replace(raw, "\\+", "%2B")))
    return files


def blob_catalog(rows: DataFrame, content_col: str) -> DataFrame:
    """Content-addressed catalog of the distinct contents referenced by rows:
    sha256, byte size, pointer path and how many rows reference each blob.
    Identical contents collapse in the map-side partial aggregate, so a blob
    referenced by a third of all rows is never gathered in one task."""
    keyed = rows.select(sha256_hex(F.col(content_col)).alias("sha256"),
                        F.octet_length(F.col(content_col)).alias("n_bytes"))
    return (keyed.where(F.col("sha256").isNotNull())
            .groupBy("sha256")
            .agg(F.max("n_bytes").cast("long").alias("n_bytes"),
                 F.count(F.lit(1)).alias("n_refs"))
            .withColumn("blob_path", F.concat(F.lit("blobs/"), F.col("sha256"))))


def binary_blobs(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Catalog of blob files on storage: path, size, sha256 of the bytes."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root)
            .select("path", F.col("length").alias("n_bytes"),
                    sha256_hex(F.col("content")).alias("sha256")))
