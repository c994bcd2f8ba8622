"""Listings and Parquet footers, read by a bounded number of tasks with file system calls."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET, KEY
from splitweave.functions.text import bucket_in_path
from splitweave.sources.inventory import file_inventory
from splitweave.sources.local import rows_frame
from splitweave.sources.paths import child_names
from splitweave.functions.text import join_path

TASKS = 256


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the path inside it; usable in tasks."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri("s3://" + path.split("://", 1)[1] if path.startswith(("s3a://", "s3n://")) else path)


def tasks_can_list(path: str) -> bool:
    """Whether tasks can open the path themselves. What only Spark's readers reach is listed by Spark instead."""
    try:
        opened(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _folders(spark: SparkSession, paths: list[str], wanted: int) -> list[tuple[str, bool]]:
    """(folder, with what lies below): the given ones, opened level by level until there are ``wanted``, so that tasks share them."""
    done, todo = [], list(paths)
    while todo and len(done) + len(todo) < wanted:
        below = {p: [join_path(p, c) for c in child_names(spark, p)] for p in todo}
        if not any(below.values()):
            break
        done += [(p, not below[p]) for p in todo]
        todo = [c for cs in below.values() for c in cs]
    return done + [(p, True) for p in todo]


def _hidden(relative: str) -> bool:
    return any(p.startswith(".") or p.startswith("_") and "=" not in p for p in relative.split("/") if p)


def listed_files(spark: SparkSession, paths: str | list[str], pattern: str = "*", tasks: int = TASKS) -> DataFrame:
    """(path, bytes, directory, id_bucket) of every non-empty file below the paths, as ``file_inventory`` gives it.

    The driver opens as many levels of directories as give each task some; the directories are dealt over at most ``tasks`` tasks,
    and these list them. File names reach neither the driver nor the plan, however many there are.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    if not all(tasks_can_list(p) for p in given):
        return file_inventory(spark, given, pattern)
    folders = _folders(spark, given, 4 * tasks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for folder, deep in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, inside = opened(folder)
                root = folder.rstrip("/") if ":" in folder.split("/")[0] else "file:" + folder.rstrip("/")
                if fs.get_file_info(inside).type == pafs.FileType.File:
                    found = [fs.get_file_info(inside)]
                else:
                    found = fs.get_file_info(pafs.FileSelector(inside, recursive=deep))
                kept = [(root + f.path[len(inside.rstrip("/")) :], f.size) for f in found if f.type == pafs.FileType.File and f.size]
                kept = [(p, n) for p, n in kept if not _hidden(p[len(root) :]) and fnmatch(p.rsplit("/", 1)[-1], pattern)]
                for at in range(0, len(kept), 10_000):
                    part = kept[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in part]), pa.array([n for _, n in part], pa.int64())], ["path", "bytes"])

    rows = rows_frame(spark, folders, "folder string, deep boolean").repartition(max(1, min(tasks, len(folders))))
    files = rows.mapInArrow(work, "path string, bytes bigint")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.select("path", "bytes", F.regexp_replace(folder, r"(/[^/=]+=[^/]*)+$", "").alias("directory"), bucket_in_path("path").alias(BUCKET))


def footers(spark: SparkSession, paths: str | list[str], tasks: int = TASKS) -> DataFrame:
    """(path, column_name, rows, bytes) of every Parquet file and top-level column: compressed size, from the footers alone."""
    tasks = min(tasks, spark.sparkContext.defaultParallelism)
    files = listed_files(spark, paths, "*.parquet", tasks).select("path").repartition(tasks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, inside = opened("/" + path.split(":", 1)[1].lstrip("/") if path.startswith("file:") else path)
                meta = pq.read_metadata(inside, filesystem=fs)
                sizes: dict[str, int] = dict.fromkeys(meta.schema.to_arrow_schema().names, 0)
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        column = group.column(c)
                        sizes[column.path_in_schema.split(".")[0]] += column.total_compressed_size
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n), pa.array(list(sizes)), pa.array([meta.num_rows] * n, pa.int64()), pa.array(list(sizes.values()), pa.int64())],
                    ["path", "column_name", "rows", "bytes"],
                )

    return files.mapInArrow(work, "path string, column_name string, rows bigint, bytes bigint")


def narrow_sizes(spark: SparkSession, paths: str | list[str], groups: dict[str, list[str]], key: str = KEY) -> DataFrame:
    """(table_name, bytes): what the columns of each narrow table take up in the source, its key included.

    A table of as many rows with the same columns, written in the same format, has about this size; other row orders compress
    a little better or worse.
    """
    wanted = [(t, c) for t, columns in groups.items() for c in {c.lower() for c in [*columns, key]}]
    per_column = footers(spark, paths).groupBy(F.lower("column_name").alias("name")).agg(F.sum("bytes").alias("bytes"))
    named = rows_frame(spark, wanted, "table_name string, name string").join(per_column, "name", "left")
    return named.groupBy("table_name").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
