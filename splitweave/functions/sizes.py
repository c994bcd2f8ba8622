"""File-count planning from measured size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitweave.functions.keys import as_column

# Lower bound in GB -> target MB per file, and the file counts a table may have.
SIZE_BANDS = [(30, 380), (20, 392), (10, 490), (0, 400)]
FILE_COUNTS = [24, 28, 32, 36, 48, 56, 64, 96, 112, 128]


def gigabytes(num_bytes: Column | str) -> Column:
    return as_column(num_bytes) / F.lit(float(1 << 30))


def target_mb(size_gb: Column | str) -> Column:
    size = as_column(size_gb)
    return F.coalesce(*[F.when(size >= low, F.lit(mb)) for low, mb in SIZE_BANDS])


def nearest_file_count(n: Column | str) -> Column:
    """Allowed count closest to ``n``; of two equally close ones the smaller."""
    wanted = as_column(n)
    choices = F.array(*[F.lit(c) for c in FILE_COUNTS])
    by_distance = F.transform(choices, lambda c: F.struct(F.abs(c - wanted).alias("far"), c.alias("count")))
    return F.array_min(by_distance).getField("count")


def raw_file_count(size_gb: Column | str, mb: Column | None = None) -> Column:
    size = as_column(size_gb)
    per_file = target_mb(size) if mb is None else mb
    return F.greatest(F.lit(1), F.ceil(size * 1024 / per_file).cast("int"))


def planned_file_count(size_gb: Column | str, mb: Column | None = None) -> Column:
    return nearest_file_count(raw_file_count(size_gb, mb))


def size_out_of_range(num_bytes: Column | str, low_mb: float, high_mb: float) -> Column:
    """Non-empty file smaller than ``low_mb`` or larger than ``high_mb``."""
    mb = as_column(num_bytes) / F.lit(1024.0 * 1024.0)
    return (mb > 0) & ~mb.between(low_mb, high_mb)


def row_width(schema: T.StructType) -> int:
    """Rough bytes per row, used only to decide how many rows one write task may get."""
    width = 0
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.BooleanType, T.ByteType)):
            width += 1
        elif isinstance(kind, (T.ShortType, T.IntegerType, T.FloatType, T.DateType)):
            width += 4
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            width += 20
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            width += 100
        else:
            width += 8
    return max(width, 8)


def rows_per_file(schema: T.StructType, mb: int = 400) -> int:
    return max(1, mb * 1024 * 1024 // row_width(schema))
