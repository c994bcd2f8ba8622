"""The mapping table: which column of the wide source goes to which narrow table.

It is a control table of a few thousand rows. ``mapping_columns`` is the one place that brings it to the
driver, because table and column names are part of the plans that are built from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splitweave.functions.keys import KEY
from splitweave.sources.local import rows_frame

MAX_MAPPING_ROWS = 200_000


def read_mapping(
    spark: SparkSession, path: str, table_col: str | None = None, column_col: str | None = None
) -> DataFrame:
    """(pos, table_name, column_name) of a CSV with a header; every value is text.

    ``pos`` numbers the rows from 0 in the order of the files' names and of the rows in them, for any number of files and of splits
    of a file. Without explicit names the first headers that end in TABLE and COLUMN are used.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)

    def ending(word: str) -> str:
        hits = [c for c in raw.columns if c.upper().endswith(word)]
        if not hits:
            raise ValueError(f"no header ends in {word}: {raw.columns}")
        return hits[0]

    rows = raw.select(
        F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col(table_col or ending("TABLE")).alias("table_name"),
        F.col(column_col or ending("COLUMN")).alias("column_name"),
    )
    # The rows of a block lie together in one task: their place in it and the rows of all blocks before it make the number.
    blocks = rows.groupBy("file", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # one row for each block
    offsets = blocks.select("file", "start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = rows.join(offsets, ["file", "start"])
    return placed.select((F.col("offset") + F.col("at") - F.col("first")).alias("pos"), "table_name", "column_name")


def mapping_groups(mapping: DataFrame) -> DataFrame:
    """Ordered column list per table; ``first_pos`` keeps the tables in file order."""
    listed = mapping.where(F.col("table_name").isNotNull() & F.col("column_name").isNotNull())
    return listed.groupBy("table_name").agg(
        F.min("pos").alias("first_pos"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "column_name"))), lambda x: x["column_name"]).alias(
            "columns"
        ),
    )


def mapping_columns(mapping: DataFrame) -> dict[str, list[str]]:
    """All columns by table; a mapping with more usable rows than MAX_MAPPING_ROWS is refused before any reach the driver."""
    groups = mapping_groups(mapping)
    if (groups.agg(F.sum(F.size("columns"))).first()[0] or 0) > MAX_MAPPING_ROWS:
        raise ValueError(f"more than {MAX_MAPPING_ROWS} mapping rows; this is not a mapping table")
    groups = groups.orderBy("first_pos").collect()
    return {g["table_name"]: list(g["columns"]) for g in groups}


def mapping_errors(wide: DataFrame, mapping: DataFrame, key: str = KEY) -> DataFrame:
    """(table_name, column_name, problem) for names the source lacks and names listed twice in one table."""
    known = rows_frame(mapping.sparkSession, [(n,) for n in {c.lower() for c in [*wide.columns, key]}], "name string")
    named = mapping.withColumn("name", F.lower("column_name"))
    missing = named.join(known, "name", "left_anti").select("table_name", "column_name").distinct()
    repeated = (
        named.groupBy("table_name", "name").agg(F.count("*").alias("times"), F.min("column_name").alias("column_name"))
        .where("times > 1")
        .select("table_name", "column_name")
    )
    return missing.withColumn("problem", F.lit("missing")).unionByName(repeated.withColumn("problem", F.lit("repeated")))


def field_counts(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("table_name").agg(F.count("*").alias("fields"))
