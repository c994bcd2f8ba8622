"""Many small Parquet files of one task, written with file system calls; Spark's writer makes a task of each, or a directory."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from splitweave.sources.footers import opened
from splitweave.sources.paths import qualified


def tasks_can_write(df: DataFrame, path: str) -> bool:
    """Whether tasks can open the path themselves, and Arrow holds every column."""
    try:
        to_arrow_schema(df.schema)
        fs, folder = opened(qualified(df.sparkSession, path))
        fs.create_dir(folder)
    except (pa.ArrowException, PySparkException, OSError):
        return False
    return True


def write_numbered(df: DataFrame, path: str, number: str) -> None:
    """Replace the directory by one file for each value of ``number``, in the order of their names; that column is left out.

    Rows with equal numbers must be in one partition, in the order of ``number``; a task holds the rows of one file. A file
    appears under its name when it is complete, and a task that runs again replaces its files, so none is found twice. An
    empty file by Spark's writer comes first and keeps the schema.
    """
    spark = df.sparkSession
    df.drop(number).limit(0).write.mode("overwrite").option("compression", "snappy").parquet(path)
    place = qualified(spark, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(place)
        waiting, at, done = [], None, 0

        def close() -> None:
            part = f"{folder}/_{uuid.uuid4().hex}"
            pq.write_table(pa.Table.from_batches(waiting), part, filesystem=fs, compression="snappy", store_schema=False)
            fs.move(part, f"{folder}/part-{at:010d}.snappy.parquet")

        for b in batches:
            n, rows = b.column(number).to_numpy(), b.drop_columns([number])
            edges = np.r_[0, np.flatnonzero(np.diff(n)) + 1, len(n)].tolist() if len(n) else []
            for i, j in zip(edges, edges[1:], strict=False):
                if at is not None and at != n[i]:
                    close()
                    waiting = []
                at = int(n[i])
                waiting.append(rows.slice(i, j - i))
                done += j - i
        if at is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["rows"])

    df.mapInArrow(work, "rows long").agg(F.sum("rows")).collect()
