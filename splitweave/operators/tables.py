"""Catalog tables: register, partition, repair, bucket, copy.

Statements on names and properties run on the driver, one per table; rows are only touched by the writes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from splitweave.functions.keys import BUCKET, BUCKETS, KEY
from splitweave.functions.text import join_path
from splitweave.operators.columns import capped_projection, identity_projection, registered_columns
from splitweave.operators.layout import write_bucketed
from splitweave.operators.parallel import at_once, failure
from splitweave.sources.catalog import describe_table, location, partition_names, properties, registered_type, table_exists
from splitweave.sources.inventory import discover_tables
from splitweave.sources.local import rows_frame
from splitweave.sources.paths import child_names
from splitweave.sources.snapshots import read_marker_under

# Properties that describe virtual partitions.
VIRTUAL_PARTITION_PROPERTIES = ("projection.", "storage.location.template")
MAX_PARTITIONS_PER_STATEMENT = 100


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(field: T.StructField) -> str:
    # A timestamp without zone stays one: reading it as text would fail on the files.
    ntz = isinstance(field.dataType, T.TimestampNTZType)
    return f"`{field.name}` {'timestamp_ntz' if ntz else registered_type(field.dataType)}"


def define_table(
    spark: SparkSession,
    table: str,
    path: str,
    fields: list[T.StructField],
    comment: str,
    props: dict[str, str],
    partition: T.StructField | None = None,
) -> None:
    """Drop the definition and define it again over the same files. Only external tables: dropping a managed one
    would delete its files."""
    if table_exists(spark, table) and describe_table(spark, table).details.get("Type") == "MANAGED":
        raise ValueError(f"{table} is a managed table")
    cols = ", ".join(_column(f) for f in [*fields, *([partition] if partition else [])])
    by = f"PARTITIONED BY (`{partition.name}`)" if partition else ""
    extra = f"TBLPROPERTIES ({', '.join(f'{_quoted(k)} = {_quoted(v)}' for k, v in props.items())})" if props else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({cols}) USING parquet {by} LOCATION {_quoted(path)} COMMENT {_quoted(comment)} {extra}"
    )


def snapshot_comment(dt: str | None) -> str:
    return f"Bucketed table created from snapshot_dt={dt}" if dt else "Bucketed table"


def register_external(
    spark: SparkSession, db: str, root: str, prefix: str, max_cols: int | None = None, key: str = KEY
) -> DataFrame:
    """Register every table directory under ``root``; (table_name, status, dropped_columns) per table."""
    dt = read_marker_under(spark, root)
    found = discover_tables(spark, root)

    def register(name: str) -> tuple:
        table = prefix + name.lower()
        try:
            df = spark.read.parquet(found[name])
            kept, dropped = registered_columns(df, max_cols, key)
            # Directory columns are not file columns: Spark finds them itself until the table is partitioned.
            fields = [df.schema[c] for c in kept if c != BUCKET]
            props = {"classification": "parquet", **({"snapshot_dt": dt} if dt else {})}
            define_table(spark, f"{db}.{table}", found[name], fields, snapshot_comment(dt), props)
            return table, "registered", dropped
        except Exception as e:  # one broken directory must not stop the others
            return table, failure(e), []

    done = list(at_once(spark, register, found).values())
    return rows_frame(spark, done, "table_name string, status string, dropped_columns array<string>")


def ensure_partitioned(spark: SparkSession, table: str) -> str:
    """Partition an unpartitioned registration by bucket over the same files; no data moves."""
    info = describe_table(spark, table)
    if [c for c, _ in info.partitions] == [BUCKET]:
        return "already_partitioned"
    details = info.details
    fields = [f for f in spark.table(table).schema.fields if f.name != BUCKET]
    define_table(
        spark, table, details["Location"], fields, details.get("Comment", ""), _own_properties(spark, table),
        T.StructField(BUCKET, T.IntegerType()),
    )
    return "migrated"


def _own_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {k: v for k, v in properties(spark, table).items() if not k.startswith(("spark.", "transient_", "option."))}


def repair_partitions(spark: SparkSession, table: str) -> int:
    """Register every partition found in storage; how many the table has now."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)
    return len(partition_names(spark, table))


def add_missing(spark: SparkSession, table: str, missing: list[int], batch: int = MAX_PARTITIONS_PER_STATEMENT) -> int:
    """Register only the given partitions, several per statement."""
    root = location(spark, table)
    for i in range(0, len(missing), batch):
        parts = " ".join(
            f"PARTITION ({BUCKET}={v}) LOCATION {_quoted(join_path(root, f'{BUCKET}={v}'))}" for v in missing[i : i + batch]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(table)
    return len(missing)


def strip_properties(
    spark: SparkSession, table: str, prefixes: tuple[str, ...] = VIRTUAL_PARTITION_PROPERTIES
) -> list[str]:
    """Remove the properties that start with one of ``prefixes``; the rest of the definition stays."""
    gone = sorted(k for k in properties(spark, table) if k.startswith(prefixes))
    if gone:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({', '.join(map(_quoted, gone))})")
    return gone


def fresh_path(spark: SparkSession, path: str) -> str:
    """The path if nothing is there yet, else a version of it beside it, so that no file of an older table is touched."""
    return path if not (child_names(spark, path) or child_names(spark, path, directories=False)) else f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"


def swap_in(spark: SparkSession, table: str, rows: int, write: Callable[[str], None]) -> None:
    """Let a table be what ``write(name)`` writes under another name, once it holds ``rows`` rows.

    Until then the table stays as it was; a write that fails or loses rows leaves its old rows readable, and nothing else
    behind but files. The old table's files stay where they are. A managed table is refused, since dropping it would delete them.
    """
    if table_exists(spark, table) and describe_table(spark, table).details.get("Type") == "MANAGED":
        raise ValueError(f"{table} is a managed table")
    mark = uuid.uuid4().hex[:12]
    new, old = f"{table}__new_{mark}", f"{table}__old_{mark}"
    try:
        write(new)
        found = spark.table(new).count()
        if found != rows:
            raise RuntimeError(f"{table}: {found} rows were written of {rows}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    had = table_exists(spark, table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")


def create_bucketed(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    path: str,
    key: str = KEY,
    n: int = BUCKETS,
    dt: str | None = None,
    max_cols: int | None = None,
) -> None:
    """Bucketed copy: key first, column cap, comment with the snapshot date. An older table is replaced when the new one is complete."""
    rows, place = source.count(), fresh_path(spark, path)

    def write(name: str) -> None:
        write_bucketed(capped_projection(source, key, max_cols), name, place, key, n)
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(snapshot_comment(dt))}")
        if dt:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('snapshot_dt' = {_quoted(dt)})")

    swap_in(spark, table, rows, write)


def point_table_at(spark: SparkSession, table: str, path: str) -> None:
    """Make a table read another version of its files."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(table)


def create_identity_table(
    spark: SparkSession, source: str, target: str, path: str, force: bool = False, key: str = KEY, all_columns: bool = True
) -> str:
    """Copy of a table with ``row_id``, without the partition column: created, skipped or failed.

    With ``force`` an older copy is replaced when the new one is complete.
    """
    if not table_exists(spark, source) or (table_exists(spark, target) and not force):
        return "skipped"
    df = spark.table(source)
    if key not in df.columns:
        return "skipped"
    place = fresh_path(spark, path)

    def write(name: str) -> None:
        identity_projection(df, key, all_columns).write.format("parquet").option("path", place).option("compression", "snappy").saveAsTable(name)

    swap_in(spark, target, df.count(), write)
    return "created" if table_exists(spark, target) else "failed"
