"""Dated snapshots: which one to read, and the marker that says which one was read."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.functions.text import MARKER_PATH, SNAPSHOT_COLUMN, SOURCES_PATH, join_path, normalize_path
from splitweave.sources.local import rows_frame
from splitweave.sources.paths import child_names

SNAPSHOT_DIR = re.compile(r"snapshot_dt=(\d{4}-\d{2}-\d{2})")
UNSET = (None, "", "_NONE_")


def latest_snapshot(spark: SparkSession, base: str) -> str:
    found = [m.group(1) for m in map(SNAPSHOT_DIR.fullmatch, child_names(spark, base)) if m]
    if not found:
        raise FileNotFoundError(f"no snapshot_dt=YYYY-MM-DD directory under {base}")
    return max(found)


def resolve_snapshot(spark: SparkSession, base: str, requested: str | None = None) -> str:
    return latest_snapshot(spark, base) if requested in UNSET else requested


def read_snapshot(spark: SparkSession, base: str, dt: str, keep_dt: bool = False) -> DataFrame:
    """One snapshot directory. ``keep_dt`` adds the date as a column (text), the default leaves it out."""
    leaf = join_path(base, f"{SNAPSHOT_COLUMN}={dt}")
    if not keep_dt:
        return spark.read.parquet(leaf)
    rows = spark.read.option("basePath", base).parquet(leaf)
    return rows.withColumn(SNAPSHOT_COLUMN, F.col(SNAPSHOT_COLUMN).cast("string"))


def latest_snapshot_rows(df: DataFrame, column: str = SNAPSHOT_COLUMN) -> DataFrame:
    """Rows of the greatest snapshot. On a partition column the subquery prunes the scan.

    The subquery itself opens every file's footer; of a directory of snapshots, ``read_snapshot`` of
    ``latest_snapshot`` only lists the directories.
    """
    newest = df.select(F.max(column).alias("newest")).scalar()
    return df.where(F.col(column) == newest)


def write_marker(spark: SparkSession, root: str, dt: str) -> None:
    spark.createDataFrame([(dt,)], "value string").coalesce(1).write.mode("overwrite").text(join_path(root, MARKER_PATH))


def read_marker_under(spark: SparkSession, root: str) -> str | None:
    try:
        first = spark.read.text(join_path(root, MARKER_PATH)).take(1)
    except AnalysisException:
        return None
    return (first[0].value.strip() or None) if first else None


def read_marker(spark: SparkSession, location: str) -> str | None:
    """Snapshot date kept next to a table's directory; None when nobody wrote it."""
    return read_marker_under(spark, normalize_path(join_path(location, "..")))


def write_sources(spark: SparkSession, root: str, group: str, rows: list[tuple[str, str, str]]) -> None:
    """(table, snapshot date, source directory) of tables under ``root``; a later call for the group replaces its rows."""
    lowered = [(t.lower(), dt, path) for t, dt, path in rows]
    sources = rows_frame(spark, lowered, "table_name string, snapshot_dt string, source string")
    sources.coalesce(1).write.mode("overwrite").json(join_path(root, SOURCES_PATH, group))


def read_sources(spark: SparkSession, root: str) -> dict[str, tuple[str, str]]:
    """{table: (snapshot date, source directory)} of the tables under ``root``: a few words for each; none when nobody wrote them."""
    places = [join_path(root, SOURCES_PATH, g) for g in child_names(spark, join_path(root, SOURCES_PATH))]
    if not places:
        return {}
    rows = spark.read.schema("table_name string, snapshot_dt string, source string").json(places).collect()
    return {r["table_name"]: (r["snapshot_dt"], r["source"]) for r in rows}
