"""Projections: vertical split, bucket column, identity and allow-list shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET, BUCKETS, KEY, as_column, bucket_of, find_column
from splitweave.functions.text import SNAPSHOT_COLUMN, join_path, schema_name
from splitweave.sources.mapping import mapping_columns



def canonical_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """The key column under its canonical name, whatever its case in the source."""
    found = find_column(df.columns, key)
    if found is None:
        raise ValueError(f"no column {key} in {df.columns}")
    return df if found == key else df.withColumnRenamed(found, key)


def narrow_columns(listed: list[str], key: str = KEY) -> list[str]:
    """Columns of one narrow table: mapping order, with the key appended when the mapping leaves it out."""
    cols = [key if c.lower() == key.lower() else c for c in listed]
    return cols if key in cols else cols + [key]


def usable(wide: DataFrame, cols: list[str]) -> bool:
    known = {c.lower() for c in wide.columns}
    lowered = [c.lower() for c in cols]
    return set(lowered) <= known and len(set(lowered)) == len(lowered)


def vertical_split(wide: DataFrame, mapping: DataFrame | dict[str, list[str]], key: str = KEY) -> dict[str, DataFrame]:
    """One narrow DataFrame per usable table of the mapping; see ``mapping_errors`` for the others.

    Each one is a plain ``select``, so Parquet reads only its own columns.
    """
    groups = mapping if isinstance(mapping, dict) else mapping_columns(mapping)
    wide = canonical_key(wide, key)
    wanted = {name: narrow_columns(listed, key) for name, listed in groups.items()}
    return {
        name: wide.select(*[F.col(f"`{c}`").alias(c) for c in cols])
        for name, cols in wanted.items()
        if usable(wide, cols)
    }


def capped_projection(df: DataFrame, key: str = KEY, max_cols: int | None = None) -> DataFrame:
    """Key first, the other columns in order; all of them, or at most ``max_cols`` in total where a cap is asked for."""
    rest = [c for c in df.columns if c != key]
    ordered = [key, *rest] if key in df.columns else rest
    return df.select(*ordered[:max_cols])


def registered_columns(
    df: DataFrame, max_cols: int | None = None, key: str = KEY, partition: str = BUCKET
) -> tuple[list[str], list[str]]:
    """(kept, dropped) column names; nothing is dropped without a cap, and the key and the partition column never are."""
    attributes = [c for c in df.columns if c not in (key, partition)]
    room = len(attributes) if max_cols is None else max(0, max_cols - (key in df.columns))
    kept = set(attributes[:room]) | {key, partition}
    return [c for c in df.columns if c in kept], attributes[room:]


def with_id_bucket(df: DataFrame, key: str = KEY, n: int = BUCKETS) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(key, n))


def with_snapshot(df: DataFrame, dt: str) -> DataFrame:
    return df.withColumn(SNAPSHOT_COLUMN, F.lit(dt))


def identity_projection(df: DataFrame, key: str = KEY, all_columns: bool = True, partition: str = BUCKET) -> DataFrame:
    """``row_id`` (a copy of the key), the key, then the other data columns."""
    others = [c for c in df.columns if c not in (key, partition)] if all_columns else []
    return df.select(F.col(key).alias("row_id"), key, *others)


def allowed_projection(
    df: DataFrame,
    exclude: list[str] = (),
    partition_keys: list[str] = (),
    add_partition_keys: bool = True,
    max_cols: int | None = None,
) -> DataFrame:
    """Only the columns that may be exposed: data columns without the excluded ones, then the partition keys.

    A cap counts both, and cuts data columns; partition keys stay.
    """
    data = [c for c in df.columns if c not in exclude and c not in partition_keys]
    keys = list(partition_keys) if add_partition_keys else []
    return df.select(*(data if max_cols is None else data[: max(0, max_cols - len(keys))]), *keys)


def with_input_source(
    df: DataFrame,
    bucket: Column | str,
    table: str = "table_name",
    snapshot: str = SNAPSHOT_COLUMN,
    id_list_path: str = "addressable_ids/raw_input",
    attribute_path: str = "attributes/raw_input",
    id_list_word: str = "addressable",
) -> DataFrame:
    """Adds ``input_source``, the raw directory a table was built from; empty when bucket or date is missing."""
    store = F.lit(bucket) if isinstance(bucket, str) else bucket
    folder = F.when(F.lower(as_column(table)).contains(id_list_word), F.lit(id_list_path)).otherwise(F.lit(attribute_path))
    path = F.concat(F.lit("s3://"), store, F.lit("/"), folder, F.lit("/snapshot_dt="), as_column(snapshot), F.lit("/"))
    filled = (F.coalesce(store, F.lit("")) != "") & (F.coalesce(as_column(snapshot), F.lit("")) != "")
    return df.withColumn("input_source", F.when(filled, path).otherwise(F.lit("")))


def mapped_fields(
    columns: DataFrame,
    id_col: str = KEY,
    match_key: str = "AXM",
    namespace: str = "",
    exclude: list[str] = (BUCKET,),
) -> DataFrame:
    """One row per column of (table_name, pos, column_name): its role for identity resolution."""
    is_id = F.col("column_name") == id_col
    return columns.where(~F.col("column_name").isin(list(exclude)) if exclude else F.lit(True)).select(
        "table_name",
        "pos",
        schema_name("table_name").alias("schema_name"),
        F.col("column_name").alias("field_name"),
        F.when(is_id, F.lit("ID")).otherwise(F.lit("ATTRIBUTE")).alias("type"),
        F.when(is_id, F.lit(match_key)).alias("matching_key"),
        F.when(is_id, F.lit(namespace)).alias("namespace"),
    )


def schema_documents(fields: DataFrame, match_key: str = "AXM") -> DataFrame:
    """(table_name, schema_name, document): the fields of each table as one JSON text."""
    field = F.struct(
        F.col("field_name").alias("fieldName"),
        "type",
        F.col("matching_key").alias("matchingKey"),
        F.col("namespace").alias("idNamespaceArn"),
    )
    grouped = fields.groupBy("table_name", "schema_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", field.alias("f")))), lambda x: x["f"]).alias("fields")
    )
    about = F.concat(F.lit("ER schema for "), "table_name", F.lit(f" with {match_key} identity and attributes"))
    return grouped.select(
        "table_name",
        "schema_name",
        F.to_json(
            F.struct(F.col("schema_name").alias("schemaName"), about.alias("description"), F.col("fields").alias("mappedInputFields"))
        ).alias("document"),
    )


def versioned_path(base: str, table: str, stamp: str | None = None) -> str:
    """``base/table/v=stamp``; no version part when the stamp is empty or ``_NONE_``."""
    path = join_path(base, table)
    return path if stamp in (None, "", "_NONE_") else join_path(path, stamp if stamp.startswith("v=") else f"v={stamp}")
