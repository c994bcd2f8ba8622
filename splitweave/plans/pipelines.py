"""The pipelines. Each takes a session and places, runs the operators in order and returns a status DataFrame."""

from __future__ import annotations

from datetime import date, datetime
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKETS, KEY, bucket_of
from splitweave.functions.text import IDENTITY_SUFFIX, SNAPSHOT_COLUMN, SOURCE_PREFIX, TABLE_PREFIX, join_path, utc_text
from splitweave.operators.columns import (
    canonical_key, mapped_fields, schema_documents, versioned_path, vertical_split,
)
from splitweave.operators.identity import identity_report
from splitweave.operators.joins import registry_join
from splitweave.operators.layout import TARGET_MB, file_plan, slot_counts, write_clustered, write_parts
from splitweave.operators.monitor import REPORT_COLUMNS, alert_rows, auto_repair, monitor, report_rows
from splitweave.operators.parallel import at_once, failure
from splitweave.operators.quality import union_all
from splitweave.operators.registry import not_ready, readiness, readiness_report, readiness_summary
from splitweave.operators.reports import write_report_csv, write_report_json
from splitweave.operators.tables import (
    create_bucketed, create_identity_table, ensure_partitioned, register_external, repair_partitions, strip_properties,
)
from splitweave.sources.catalog import describe_schema, registered_tables, table_names
from splitweave.sources.footers import listed_files, narrow_sizes, tasks_can_list
from splitweave.sources.inventory import size_by
from splitweave.sources.local import rows_frame
from splitweave.sources.mapping import mapping_columns, mapping_errors
from splitweave.sources.paths import remove, shared_scratch
from splitweave.sources.snapshots import read_snapshot, resolve_snapshot, write_marker, write_sources

SHARE_STEPS = 10_000
PLAN_DDL = "table_name string, bytes bigint, size_gb double, target_mb int, raw_files int, planned_files int"


def _snapshot(spark: SparkSession, source: str, snapshot_dt: str | None, key: str) -> tuple[DataFrame, str]:
    dt = resolve_snapshot(spark, source, snapshot_dt)
    return canonical_key(read_snapshot(spark, source, dt), key), dt


def _groups(wide: DataFrame, mapping: DataFrame | None, id_table: str, key: str) -> dict[str, list[str]]:
    return {id_table: [key]} if mapping is None else mapping_columns(mapping)


def split_status(wide: DataFrame, mapping: DataFrame | None, done: dict[str, DataFrame], key: str = KEY) -> DataFrame:
    """(table_name, status, columns, problems) of every table of the mapping."""
    spark = wide.sparkSession
    rows = [(n, "written", len(df.columns)) for n, df in done.items()]
    written = rows_frame(spark, rows, "table_name string, status string, columns int")
    none = F.array().cast("array<string>").alias("problems")
    if mapping is None:
        return written.select("*", none)
    text = F.concat_ws(" ", "problem", "column_name")
    bad = mapping_errors(wide, mapping, key).groupBy("table_name").agg(F.array_sort(F.collect_set(text)).alias("problems"))
    skipped = bad.select("table_name", F.lit("skipped").alias("status"), F.lit(0).alias("columns"), "problems")
    return written.select("*", none).unionByName(skipped)


def split_and_part(
    spark: SparkSession,
    source: str,
    target: str,
    mapping: DataFrame | None = None,
    snapshot_dt: str | None = None,
    key: str = KEY,
    n: int = BUCKETS,
    id_table: str = "addressable_ids",
    marker: bool = True,
    target_file_mb: int = TARGET_MB,
) -> DataFrame:
    """Newest (or given) snapshot → narrow tables → one directory per bucket → marker.

    Without a mapping the source is an id list and only its key is kept. Bucket sizes are counted once for the
    source and hold for every narrow table, since all carry the same keys.
    """
    wide, dt = _snapshot(spark, source, snapshot_dt, key)
    tables = vertical_split(wide, _groups(wide, mapping, id_table, key), key)
    counts = slot_counts(wide, bucket_of(key, n))
    at_once(
        spark, lambda t: write_parts(tables[t], join_path(target, t), key, n, replace="all", mb=target_file_mb, counts=counts),
        tables,
    )
    if marker:
        write_marker(spark, target, dt)
    leaf = join_path(source, f"{SNAPSHOT_COLUMN}={dt}")
    write_sources(spark, target, id_table if mapping is None else "attributes", [(t, dt, leaf) for t in tables])
    return split_status(wide, mapping, tables, key)


def split_and_bucket(
    spark: SparkSession,
    source: str,
    target: str,
    staging: str | None = None,
    mapping: DataFrame | None = None,
    snapshot_dt: str | None = None,
    key: str = KEY,
    n: int = BUCKETS,
    target_file_mb: int | None = None,
    id_table: str = "addressable_ids",
    measured_share: float | None = None,
) -> DataFrame:
    """As above, but each table becomes a planned number of files clustered by key. Returns the file plan.

    The plan comes from the source's Parquet footers: the compressed sizes of a table's columns. Nothing is written to be measured,
    every row is written once.

    With ``measured_share`` that share of the keys, chosen by hash, is written to ``staging`` first and its size scaled up, which
    also measures what the new row order does to compression. A whole staged copy (1.0) then feeds the final write. Sources
    that only Spark's readers reach are measured whole. ``staging`` must be a folder all executors reach.
    """
    wide, dt = _snapshot(spark, source, snapshot_dt, key)
    groups = _groups(wide, mapping, id_table, key)
    tables = vertical_split(wide, groups, key)
    counts = slot_counts(wide, bucket_of(key, n))
    leaf = join_path(source, f"{SNAPSHOT_COLUMN}={dt}")
    if measured_share is None and not tasks_can_list(leaf):
        measured_share = 1.0
    staged: dict[str, str] = {}
    if measured_share is None:
        sizes = narrow_sizes(spark, leaf, {t: groups[t] for t in tables}, key)
    else:
        staging = staging or shared_scratch(spark, "staging")
        staged = {t: join_path(staging, t) for t in tables}
        sizes = _staged_sizes(spark, tables, staged, measured_share, key)
    # A few numbers per table decide how its job is planned.
    planned = {r["table_name"]: r for r in file_plan(sizes, target_file_mb).collect()}
    rows = sum(counts.values())

    def write(t: str) -> None:
        p = planned[t]
        # The file counts end at 128; beyond that, and for a hot key, files of twice the target size are cut.
        max_rows = max(1, ceil(rows * 2 * p["target_mb"] * 1024 * 1024 / max(1, p["bytes"])))
        source_rows = spark.read.parquet(staged[t]) if measured_share is not None and measured_share >= 1 else tables[t]
        write_clustered(source_rows, join_path(target, t), key, n, p["planned_files"], counts, max_rows)

    at_once(spark, write, tables)
    write_marker(spark, target, dt)
    write_sources(spark, target, id_table if mapping is None else "attributes", [(t, dt, leaf) for t in tables])
    written = size_by(listed_files(spark, [join_path(target, t) for t in tables]), "directory").select(
        _table_of_directory(), F.col("bytes").alias("written_bytes"), F.col("files").alias("written_files")
    )
    result = rows_frame(spark, [tuple(r) for r in planned.values()], PLAN_DDL).join(written, "table_name", "left")
    for path in staged.values():
        remove(spark, path)
    return result


def _table_of_directory() -> Column:
    return F.element_at(F.split("directory", "/"), -1).alias("table_name")


def _staged_sizes(spark: SparkSession, tables: dict[str, DataFrame], staged: dict[str, str], share: float, key: str) -> DataFrame:
    """(table_name, bytes) from a staged copy of a share of the keys."""
    measured = F.lit(True) if share >= 1 else bucket_of(key, SHARE_STEPS) < int(share * SHARE_STEPS)
    at_once(spark, lambda t: tables[t].where(measured).write.mode("overwrite").parquet(staged[t]), tables)
    sizes = size_by(listed_files(spark, list(staged.values())), "directory")
    scaled = F.col("bytes") if share >= 1 else F.ceil(F.col("bytes") / share)
    return sizes.select(_table_of_directory(), scaled.alias("bytes"))


def register_and_prepare(
    spark: SparkSession, db: str, root: str, prefix: str = TABLE_PREFIX, max_cols: int | None = None, key: str = KEY
) -> DataFrame:
    """Register the tables under ``root``, partition and repair them: status, partitions and rows per table.

    A table whose step fails gets the status ``failed: …``; the others are prepared and counted all the same.
    """
    registered = {r.table_name: r for r in register_external(spark, db, root, prefix, max_cols, key).collect()}

    def prepare(name: str) -> tuple:
        r, table = registered[name], f"{db}.{name}"
        if r.status != "registered":
            return name, r.status, 0, r.dropped_columns, None
        try:
            status = ensure_partitioned(spark, table)
            strip_properties(spark, table)
            partitions = repair_partitions(spark, table)
            rows = None if status.startswith("failed") else spark.table(table).count()
            return name, status, partitions, r.dropped_columns, rows
        except Exception as e:
            return name, failure(e), 0, r.dropped_columns, None

    done = list(at_once(spark, prepare, registered).values())
    return rows_frame(spark, done, "table_name string, status string, partitions int, dropped_columns array<string>, rows bigint")


def bucketed_build(
    spark: SparkSession,
    db: str,
    base: str,
    source_prefix: str = SOURCE_PREFIX,
    target_prefix: str = "bucketed_",
    target_db: str | None = None,
    only: str | None = None,
    stamp: str | None = None,
    dt: str | None = None,
    key: str = KEY,
    n: int = BUCKETS,
) -> DataFrame:
    """A bucketed copy of each staged table: (table_name, status). A failing table does not stop the others."""
    wanted = None if only in (None, "", "_NONE_") else {x.strip().lower() for x in only.split(",")}
    bases = [t[len(source_prefix):] for t in table_names(spark, db, source_prefix)]
    bases = [b for b in bases if wanted is None or b in wanted]

    def build(b: str) -> str:
        try:
            create_bucketed(
                spark, spark.table(f"{db}.{source_prefix}{b}"), f"{target_db or db}.{target_prefix}{b}",
                versioned_path(base, b, stamp), key, n, dt,
            )
            return "created"
        except Exception as e:
            return failure(e)

    done = at_once(spark, build, bases)
    rows = [(target_prefix + b, str(s)) for b, s in done.items()]
    return rows_frame(spark, rows, "table_name string, status string")


def identity_build(
    spark: SparkSession,
    db: str,
    base: str,
    tables: list[str] | None = None,
    force: bool = False,
    key: str = KEY,
    namespace: str = "",
    match_key: str = "AXM",
) -> DataFrame:
    """Identity copies of the part tables with their schema document: (table_name, status, schema_name, document).

    A table whose copy fails gets the status ``failed: …``; the others are copied all the same.
    """
    names = tables or table_names(spark, db, TABLE_PREFIX, not_suffix=IDENTITY_SUFFIX)

    def copy(t: str) -> str:
        try:
            return create_identity_table(
                spark, f"{db}.{t}", f"{db}.{t}{IDENTITY_SUFFIX}", join_path(base, t + IDENTITY_SUFFIX), force, key
            )
        except Exception as e:
            return failure(e)

    done = at_once(spark, copy, names)
    state = rows_frame(spark, [(t + IDENTITY_SUFFIX, str(s)) for t, s in done.items()], "table_name string, status string")
    ready = [t + IDENTITY_SUFFIX for t in names if spark.catalog.tableExists(f"{db}.{t}{IDENTITY_SUFFIX}")]
    if not ready:
        return state.select("*", F.lit(None).cast("string").alias("schema_name"), F.lit(None).cast("string").alias("document"))
    columns = union_all([describe_schema(spark.table(f"{db}.{t}"), t) for t in ready])
    return state.join(schema_documents(mapped_fields(columns, key, match_key, namespace), match_key), "table_name", "left")


def monitor_and_report(
    spark: SparkSession, db: str, path: str, as_of: date | datetime | str, checked_at: str, n: int = BUCKETS,
    strict_snapshot: bool = False, repair: str = "off", **options
) -> tuple[DataFrame, DataFrame]:
    """(report, alerts), also written below ``path`` as JSON lines and CSV.

    The checks run once: the result is written, and report and alerts read it back. With ``repair`` all or targeted
    the tables that miss partitions are repaired before they are counted; report and alerts tell what was missing,
    the counts are those of the repaired tables, and ``path/json/repairs`` tells what the repair changed.
    """
    prefix = options.get("prefix", TABLE_PREFIX)
    key = options.get("key", KEY)
    window = options.get("window_days", 45)
    source_db = options.get("source_db") or db
    kept = join_path(path, "detail")

    def mend(broken: list[str]) -> None:
        done = at_once(spark, lambda t: auto_repair(spark, f"{db}.{t}", repair, n), broken)
        if done:
            union_all(list(done.values())).write.mode("overwrite").json(join_path(path, "json", "repairs"))

    found = monitor(spark, db, n=n, as_of=as_of, before_counts=None if repair == "off" else mend, **options)
    found.write.mode("overwrite").parquet(kept)
    detail = spark.read.parquet(kept)
    report = report_rows(detail, checked_at)
    alerts = alert_rows(detail, n, key, db, source_db, window, strict_snapshot, options.get("source_prefix", SOURCE_PREFIX), prefix)
    header = spark.range(1).select(
        F.lit(db).alias("database"), F.lit(prefix).alias("prefix"), F.lit(n).alias("bucket_count"),
        utc_text(F.lit(checked_at).cast("timestamp_ntz")).alias("generated_at"),
        F.lit(window).alias("freshness_window_days"),
        F.struct(
            F.lit(options.get("count_check", True)).alias("enabled"),
            F.lit(options.get("source_prefix", SOURCE_PREFIX).rstrip("_")).alias("type"),
            F.lit(source_db).alias("db"),
            F.lit(options.get("tolerance_pct", 0.0)).alias("tolerance_pct"),
        ).alias("compare"),
        F.lit(key).alias("pk_column"), F.lit(options.get("file_size_check", False)).alias("file_size_check"),
    )
    write_report_json(header, report, alerts, join_path(path, "json"))
    write_report_csv(report, join_path(path, "csv"), REPORT_COLUMNS)
    return report, alerts


def readiness_and_report(
    spark: SparkSession,
    db: str,
    path: str,
    configured: DataFrame,
    rules: DataFrame,
    associations: DataFrame,
    account_labels: dict[str, str] | None = None,
    prefix: str = TABLE_PREFIX,
    exclude: tuple[str, ...] = ("part_addressable_ids", "part_addressable_ids_er"),
    formats: tuple[str, ...] = ("json", "csv"),
    collaboration: str | None = None,
) -> DataFrame:
    """Readiness of the registered tables against the registry, written as JSON lines and CSV below ``path``."""
    joined = registry_join(registered_tables(spark, db, prefix, list(exclude)), configured, rules, associations)
    report = readiness_report(joined, account_labels, collaboration)
    ready = readiness(joined)
    if "json" in formats:
        write_report_json(readiness_summary(ready), report, not_ready(ready), join_path(path, "json"))
    if "csv" in formats:
        write_report_csv(report, join_path(path, "csv"))
    return report


def identity_and_report(
    spark: SparkSession, path: str, namespaces: DataFrame, mappings: DataFrame, collaboration: str | None = None, formats: tuple[str, ...] = ("json", "csv")
) -> DataFrame:
    """The identity report, written as JSON lines and CSV below ``path``."""
    report = identity_report(namespaces, mappings, collaboration)
    if "json" in formats:
        report.write.mode("overwrite").json(join_path(path, "json"))
    if "csv" in formats:
        write_report_csv(report, join_path(path, "csv"))
    return report


def refresh(
    spark: SparkSession,
    db: str,
    id_source: str,
    attribute_source: str,
    mapping: DataFrame,
    base: str,
    as_of: date | datetime | str,
    checked_at: str,
    snapshot_dt: str | None = None,
    skip: tuple[str, ...] = (),
    key: str = KEY,
    n: int = BUCKETS,
    registry: dict[str, DataFrame] | None = None,
    **monitor_options,
) -> DataFrame:
    """Ids and attributes split, registered, prepared, copied for identity, monitored: (step, table_name, status).

    ``skip`` names steps to leave out: ids, attributes, register, identity, monitor. With a ``registry`` (configured,
    rules, associations) the readiness report is written too.
    """
    parts = join_path(base, "parts")
    steps: list[DataFrame] = []

    def note(step: str, df: DataFrame) -> None:
        steps.append(df.select(F.lit(step).alias("step"), "table_name", "status"))

    def split(step: str) -> DataFrame:
        source, columns = (id_source, None) if step == "ids" else (attribute_source, mapping)
        return split_and_part(spark, source, parts, columns, snapshot_dt, key, n, marker=False)

    splits = [s for s in ("ids", "attributes") if s not in skip]
    for step, df in at_once(spark, split, splits).items():
        note(step, df)
    if splits:
        write_marker(spark, parts, resolve_snapshot(spark, id_source if splits == ["ids"] else attribute_source, snapshot_dt))
    if "register" not in skip:
        note("register", register_external(spark, db, parts, SOURCE_PREFIX, key=key))
        note("prepare", register_and_prepare(spark, db, parts, TABLE_PREFIX, key=key))
    if "identity" not in skip:
        note("identity", identity_build(spark, db, join_path(base, "identity"), key=key))
    if "monitor" not in skip:
        report, alerts = monitor_and_report(spark, db, join_path(base, "monitor"), as_of, checked_at, n, key=key, **monitor_options)
        alerted = alerts.select("table_name").distinct().withColumn("status", F.lit("alert"))
        seen = report.select(F.col("table").alias("table_name")).join(alerted, "table_name", "left")
        note("monitor", seen.select("table_name", F.coalesce("status", F.lit("ok")).alias("status")))
    if registry is not None:
        ready = readiness_and_report(spark, db, join_path(base, "readiness"), **registry)
        note("readiness", ready.select("table_name", F.when(F.col("ready_for_analysis") == "Yes", "ready").otherwise("not_ready").alias("status")))
    return union_all(steps) if steps else rows_frame(spark, [], "step string, table_name string, status string")
