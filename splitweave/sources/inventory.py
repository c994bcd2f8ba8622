"""What is stored: files, table directories, partition values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET
from splitweave.functions.text import bucket_in_path, join_path
from splitweave.sources.local import rows_frame
from splitweave.sources.paths import child_names

# Child directories that are not tables.
NOT_TABLES = {"metadata", ".metadata", "_metadata"}


def file_inventory(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """(path, bytes, directory, id_bucket) of every non-empty file. Only listings are read, never file contents.

    Spark plans at least one (empty) task per file; for millions of files cap them with
    ``spark.sql.files.maxPartitionNum``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(paths)
        .select("path", F.col("length").alias("bytes"))
        .where("bytes > 0")
    )
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.select(
        "path",
        "bytes",
        F.regexp_replace(folder, r"(/[^/=]+=[^/]*)+$", "").alias("directory"),
        bucket_in_path("path").alias(BUCKET),
    )


def dir_bytes(spark: SparkSession, path: str) -> int:
    return file_inventory(spark, path).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]


def size_by(inventory: DataFrame, *columns: str) -> DataFrame:
    return inventory.groupBy(*columns).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("files"))


def discover_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name -> directory: every child directory, or the root itself when only Parquet files lie in it."""
    names = [n for n in child_names(spark, root) if n not in NOT_TABLES]
    if names:
        return {n: join_path(root, n) for n in names}
    if any(n.endswith(".parquet") for n in child_names(spark, root, directories=False)):
        return {root.rstrip("/").split("/")[-1]: root}
    return {}


def storage_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Bucket numbers that have a directory; directories whose value is not a number are ignored."""
    return bucket_rows(spark, {"": child_names(spark, path)}).select(BUCKET)


def bucket_rows(spark: SparkSession, names: dict[str, list[str]]) -> DataFrame:
    """(table_name, id_bucket) from partition names such as ``id_bucket=7``, listed per table."""
    found = rows_frame(spark, [(t, n) for t, listed in names.items() for n in listed], "table_name string, name string")
    return found.select("table_name", bucket_in_path("name").alias(BUCKET)).where(F.col(BUCKET).isNotNull()).distinct()
