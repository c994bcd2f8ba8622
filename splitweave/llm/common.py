"""What the operators share: the shared folder, files reached from tasks, Arrow text as bytes."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.sources.paths import shared_scratch

BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Let a Python worker get few rows at once, so that long texts don't add up in its memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_noted: list[list[str]] = []


@contextlib.contextmanager
def scratch_of() -> Iterator[list[str]]:
    """The places that ``written`` fills inside, in order, for a caller who knows when nothing reads them any more."""
    places: list[str] = []
    _noted.append(places)
    try:
        yield places
    finally:
        _noted[:] = [p for p in _noted if p is not places]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    for places in _noted:
        places.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it; usable in tasks."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def with_small(left: DataFrame, right: DataFrame, on: str | list[str], how: str, limit: int = 200_000) -> DataFrame:
    """Join with a table that is broadcast if its counted rows are within the limit, and left to Spark otherwise.

    ``right`` should be cheap to count, such as a written table of a few short columns.
    """
    return left.join(F.broadcast(right) if right.count() <= limit else right, on, how)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without copying them, and where each row starts in them; null is empty."""
    column = column.cast(pa.string()) if not pa.types.is_string(column.type) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return bytes_, at - at[0]


def slabs(offsets: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each; a longer row gets a range of its own."""
    found, first = [], 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        found.append((first, last))
        first = last
    return found


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers start, start + 1, … of every (start, length), one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)
