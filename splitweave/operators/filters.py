"""Row filters on names, keys, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET, BUCKETS, KEY, bucket_of
from splitweave.functions.text import SNAPSHOT_COLUMN


def filter_names(df: DataFrame, column: str, names: str | None) -> DataFrame:
    """Rows whose name is in a comma-separated list (spaces and case ignored); empty or ``_NONE_`` keeps all."""
    if names is None or names.strip() in ("", "_NONE_"):
        return df
    return df.where(F.lower(column).isin([n.strip().lower() for n in names.split(",")]))


def registry_filter(df: DataFrame, prefix: str, exclude: list[str] = (), name: str = "name", id_col: str = "id") -> DataFrame:
    kept = F.col(name).startswith(prefix) & F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != "")
    return df.where(kept & ~F.col(name).isin(list(exclude)) if exclude else kept)


def null_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.where(F.col(key).isNull())


def at_snapshot(df: DataFrame, dt: str, column: str = SNAPSHOT_COLUMN) -> DataFrame:
    """Rows of one date; on a partition column only that directory is listed and read."""
    return df.where(F.col(column) == F.lit(dt))


def lookup_key(df: DataFrame, value: object, key: str = KEY, n: int = BUCKETS) -> DataFrame:
    """Rows of one key in a table partitioned by bucket: the bucket is a constant, so one directory is read."""
    typed = F.lit(value).cast(df.schema[key].dataType)
    return df.where((F.col(key) == typed) & (F.col(BUCKET) == bucket_of(typed, n)))
