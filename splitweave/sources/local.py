"""Small control tables made on the driver: names, statuses, partition numbers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def rows_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """DataFrame of a few known rows. Handed over as Arrow it becomes a local relation, whose size the optimizer
    knows, so joins with it are broadcast instead of shuffled."""
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    table = pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)
    return spark.createDataFrame(table, schema)
