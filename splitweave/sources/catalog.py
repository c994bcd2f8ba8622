"""What is registered: tables, columns, partitions, properties."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitweave.functions.keys import BUCKET
from splitweave.sources.inventory import bucket_rows
from splitweave.sources.local import rows_frame

# Scalar type names a table may be registered with; decimals and nested types are built from them.
PLAIN_TYPES = {
    "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "string", "date", "timestamp", "binary",
}


def registered_type(kind: T.DataType) -> str:
    """Type name used in a table definition; anything a table cannot be registered with becomes string."""
    if isinstance(kind, T.ArrayType):
        return f"array<{registered_type(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{registered_type(kind.keyType)},{registered_type(kind.valueType)}>"
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"{f.name}:{registered_type(f.dataType)}" for f in kind.fields) + ">"
    name = kind.simpleString()
    return name if name in PLAIN_TYPES or isinstance(kind, T.DecimalType) else "string"


def describe_schema(df: DataFrame, table: str, max_cols: int | None = None) -> DataFrame:
    """(table_name, pos, column_name, type_name) from the schema alone, no rows are read."""
    rows = [(table, i, f.name, registered_type(f.dataType)) for i, f in enumerate(df.schema.fields[:max_cols], 1)]
    return rows_frame(df.sparkSession, rows, "table_name string, pos int, column_name string, type_name string")


def list_tables(
    spark: SparkSession,
    db: str,
    prefix: str = "",
    not_suffix: str | None = None,
    exclude: list[str] | None = None,
    limit: int = 0,
) -> DataFrame:
    """Names of a database's tables; ``limit`` 0 means all."""
    names = spark.sql(f"SHOW TABLES IN {db}").where("not isTemporary").select(F.col("tableName").alias("table_name"))
    names = names.where(F.col("table_name").startswith(prefix))
    if not_suffix:
        names = names.where(~F.col("table_name").endswith(not_suffix))
    if exclude:
        names = names.where(~F.col("table_name").isin(exclude))
    return names.orderBy("table_name").limit(limit) if limit else names


def table_names(spark: SparkSession, db: str, prefix: str = "", **options) -> list[str]:
    return sorted(r.table_name for r in list_tables(spark, db, prefix, **options).collect())


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


class TableInfo(NamedTuple):
    columns: list[str]
    partitions: list[tuple[str, str]]
    details: dict[str, str]


def describe_table(spark: SparkSession, table: str) -> TableInfo:
    """Data columns, (name, type) of partition columns, and entries such as Type, Provider and Location."""
    rows = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    names = [n for n, _ in rows]

    def section(title: str) -> list[tuple[str, str]]:
        if title not in names:
            return []
        rest = rows[names.index(title) + 1:]
        stop = next((i for i, (n, _) in enumerate(rest) if n == "" or (n.startswith("# ") and n != "# col_name")), len(rest))
        return [r for r in rest[:stop] if r[0] != "# col_name"]

    first_section = next((i for i, n in enumerate(names) if n == "" or n.startswith("# ")), len(names))
    partitions = section("# Partition Information")
    by = {n for n, _ in partitions}
    return TableInfo(
        [n for n in names[:first_section] if n not in by], partitions, dict(section("# Detailed Table Information"))
    )


def location(spark: SparkSession, table: str) -> str:
    return describe_table(spark, table).details["Location"]


def registered_tables(spark: SparkSession, db: str, prefix: str = "", exclude: list[str] | None = None) -> DataFrame:
    """(table_name, location, column_count, partition_keys) of a database's tables."""
    rows = []
    for name in table_names(spark, db, prefix, exclude=exclude):
        info = describe_table(spark, f"{db}.{name}")
        keys = ", ".join(c for c, _ in info.partitions)
        rows.append((name, info.details.get("Location"), len(info.columns), keys))
    return rows_frame(spark, rows, "table_name string, location string, column_count int, partition_keys string")


def partition_names(spark: SparkSession, table: str) -> list[str]:
    """Registered partitions of a table; none for a table that is not partitioned."""
    try:
        return [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    except AnalysisException:
        return []


def catalog_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Bucket numbers registered for a table."""
    return bucket_rows(spark, {table: partition_names(spark, table)}).select(BUCKET)
