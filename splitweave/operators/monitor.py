"""Checks of registered tables: partitions, contract, freshness, counts, keys, file sizes, and the alerts from them.

What is known about a table (names, types, partition numbers) becomes a small DataFrame with a row per table or
partition; everything after that is joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET, BUCKETS, KEY
from splitweave.functions.sizes import size_out_of_range
from splitweave.functions.text import (
    IDENTITY_SUFFIX, SOURCE_PREFIX, TABLE_PREFIX, is_stale, join_path, normalize_path, utc_text,
)
from splitweave.operators.columns import with_input_source
from splitweave.operators.joins import count_match
from splitweave.operators.parallel import at_once, failure
from splitweave.operators.quality import key_quality, row_counts, union_all
from splitweave.operators.ranking import first_per_group
from splitweave.operators.tables import add_missing, repair_partitions
from splitweave.sources.catalog import (
    catalog_partitions, describe_table, location, partition_names, properties, table_names,
)
from splitweave.sources.footers import listed_files
from splitweave.sources.inventory import bucket_rows, storage_partitions
from splitweave.sources.local import rows_frame
from splitweave.sources.paths import child_names
from splitweave.sources.snapshots import read_marker_under, read_sources

# The report's columns, in order.
REPORT_COLUMNS = [
    "input_source", "raw_input_snapshot_dt", "table", "location", "s3_partitions", "glue_partitions",
    "missing_glue_count", "table_type_ok", "contract_ok", "count_src", "count_part", "count_diff_pct", "pk_nulls",
    "pk_dupes", "file_issues_sample", "checked_at",
]


def check_freshness(markers: DataFrame, window_days: int, as_of: date | datetime | str) -> DataFrame:
    """markers(table_name, snapshot_dt) with ``stale``: no marker, unreadable, or older than the window."""
    return markers.withColumn("stale", is_stale("snapshot_dt", window_days, as_of))


def partition_integrity(tables: DataFrame, stored: DataFrame, registered: DataFrame, n: int = BUCKETS) -> DataFrame:
    """Per table: partitions stored, registered and missing, with the first five missing ones.

    tables(table_name, virtual), stored and registered (table_name, id_bucket). Virtual partitions count as complete.
    """
    every = F.explode(F.when(F.col("virtual"), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.lit(n - 1))))
    named = tables.select("table_name", F.lit(None).cast("int").alias(BUCKET), F.lit("named").alias("kind"), "virtual")
    parts = [(tables.select("table_name", every.alias(BUCKET)), "wanted"), (stored, "stored"), (registered, "registered")]
    rows = [named] + [
        df.select("table_name", BUCKET, F.lit(kind).alias("kind"), F.lit(None).cast("boolean").alias("virtual")) for df, kind in parts
    ]

    def has(kind: str) -> Column:
        return F.bool_or(F.col("kind") == kind).alias(kind)

    per_bucket = union_all(rows).groupBy("table_name", BUCKET).agg(
        has("wanted"), has("stored"), has("registered"), F.bool_or("virtual").alias("virtual")
    )
    gone = F.col("wanted") & ~F.col("registered")
    # A table's missing list is at most n numbers long.
    per_table = per_bucket.groupBy("table_name").agg(
        F.count_if("stored").alias("storage_partitions"),
        F.count_if("registered").alias("_registered"),
        F.count_if(gone).alias("missing_count"),
        F.slice(F.array_sort(F.collect_list(F.when(gone, F.col(BUCKET)))), 1, 5).alias("missing_sample"),
        F.bool_or("virtual").alias("virtual"),
    )
    complete = F.when(F.col("virtual"), F.lit(n).cast("bigint")).otherwise(F.col("_registered"))
    return per_table.select(
        "table_name", "storage_partitions", complete.alias("catalog_partitions"), "missing_count", "missing_sample"
    )


def contract_problems(columns: list[str], partitions: list[tuple[str, str]], key: str, is_part: bool) -> list[str]:
    found = []
    if key not in columns:
        found.append(f"missing required column {key}")
    if is_part and [c for c, _ in partitions] != [BUCKET]:
        found.append(f"partition key must be [{BUCKET}], got {[c for c, _ in partitions]}")
    elif is_part and partitions[0][1] != "int":
        found.append(f"{BUCKET} must be int, got {partitions[0][1]}")
    return found


def check_contract(spark: SparkSession, tables: list[str], key: str = KEY, is_part: bool = True) -> DataFrame:
    """(table_name, location, virtual, table_type_ok, contract_problems) from the catalog alone, several tables at once.

    A table that cannot be described has that as its problem, and no location.
    """

    def check(table: str) -> tuple:
        name = table.split(".")[-1]
        try:
            columns, partitions, details = describe_table(spark, table)
            external_parquet = details.get("Type") == "EXTERNAL" and details.get("Provider", "").lower() == "parquet"
            virtual = properties(spark, table).get("projection.enabled", "false").lower() == "true"
            return name, details["Location"], virtual, external_parquet, contract_problems(columns, partitions, key, is_part)
        except Exception as e:
            return name, None, False, False, [failure(e)]

    return rows_frame(
        spark, list(at_once(spark, check, tables).values()),
        "table_name string, location string, virtual boolean, table_type_ok boolean, contract_problems array<string>",
    )


def file_size_issues(
    inventory: DataFrame, low_mb: float = 64, high_mb: float = 1024, sample: int | None = None
) -> DataFrame:
    """(directory, id_bucket, path, issue, issues) of every file in a bucket whose size is out of range.

    ``issues`` is the number of such files in the directory; ``sample`` keeps so many rows of each directory for a report.
    """
    bad = inventory.where(F.col(BUCKET).isNotNull() & size_out_of_range("bytes", low_mb, high_mb))
    bad = bad.join(bad.groupBy("directory").agg(F.count("*").alias("issues")), "directory")
    text = F.format_string("id_bucket=%d object %s size=%.1fMB", BUCKET, "path", F.col("bytes") / (1024.0 * 1024.0))
    bad = bad.withColumn("issue", text)
    return bad if sample is None else first_per_group(bad, ["directory"], [F.asc(BUCKET), F.asc("path")], sample)


def alert_rows(
    detail: DataFrame,
    n: int = BUCKETS,
    key: str = KEY,
    db: str = "",
    source_db: str = "",
    window_days: int = 45,
    strict_snapshot: bool = False,
    source_prefix: str = SOURCE_PREFIX,
    prefix: str = TABLE_PREFIX,
) -> DataFrame:
    """(table_name, position, alert): one row per problem of each table of ``monitor``."""
    name = F.col("table_name")
    bare = F.when(name.startswith(prefix), F.substring(name, len(prefix) + 1, 1 << 20)).otherwise(name)

    def said(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    sample = F.array_join(F.col("missing_sample"), ", ")
    mine = said(db + "." if db else "", name)
    named = F.coalesce(F.col("source_name"), said(source_prefix, bare))
    theirs = F.when(named.contains("/"), named).otherwise(said(source_db + "." if source_db else "", named))
    percent = F.format_string("%.3f", F.col("count_diff_pct").try_cast("double"))
    problems = F.array_join("contract_problems", ", ")
    files = F.array_join(F.slice("file_issues", 1, 3), ", ")
    more = F.when(F.col("file_issue_count") > 3, said("]... of ", F.col("file_issue_count"))).otherwise(F.lit("]..."))
    stale = F.lit(strict_snapshot) & F.col("stale")
    no_source = F.col("count_checked") & ~F.col("source_found")
    checks = [
        (F.col("storage_partitions") != n, [name, ": storage has ", F.col("storage_partitions"), f"/{n} id_bucket partitions"]),
        (F.col("missing_count") > 0, [name, ": catalog misses ", F.col("missing_count"), " partitions (e.g., [", sample, "])"]),
        (~F.col("table_type_ok"), [name, ": schema mismatch (external/Parquet)"]),
        (F.size("contract_problems") > 0, [name, ": schema contract issues: ", problems]),
        (stale, [name, ": processed snapshot too old/missing (snap=", F.coalesce("snapshot_dt", F.lit("None")), ")"]),
        (F.col("count_error").isNotNull(), [name, ": not counted, ", F.col("count_error")]),
        (no_source, [name, ": source table not found ", theirs, "; count match skipped"]),
        (F.size("source_problems") > 0, [name, ": source ", theirs, " breaks the contract: ", F.array_join("source_problems", ", ")]),
        (
            F.col("count_mismatch"),
            ["[COUNT_MISMATCH] ", name, ": ", mine, "=", F.col("count_part"), " vs ", theirs, "=", F.col("count_src"), " (Δ=", percent, "%)"],
        ),
        (F.col("pk_nulls") > 0, ["[PK_NULL] ", name, f": {key} NULL rows=", F.col("pk_nulls")]),
        (F.col("pk_dupes") > 0, ["[PK_DUPES] ", name, f": {key} duplicate rows=", F.col("pk_dupes")]),
        (F.size("file_issues") > 0, [name, ": file-size issues (sample): [", files, more]),
    ]
    texts = F.array_compact(F.array(*[F.when(hit, said(*parts)) for hit, parts in checks]))
    return detail.select("table_name", F.posexplode(texts).alias("position", "alert"))


def alert_message(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    """One row: number of alerts and the text of all of them in order, or of the first ``limit``."""
    first = alerts if limit is None else alerts.orderBy("table_name", "position").limit(limit)
    text = F.array_sort(F.collect_list(F.struct("table_name", "position", "alert")))
    total = alerts.agg(F.count("*").alias("n")).scalar()
    return first.agg(F.array_join(F.transform(text, lambda x: x["alert"]), "\n").alias("message")).select(
        total.alias("alerts"), "message"
    )


COUNTS_DDL = (
    "table_name string, count_part bigint, pk_nulls bigint, pk_dupes bigint, count_src bigint, source_found boolean, count_error string, "
    "source_name string, source_problems array<string>"
)


def _resolved(path: str) -> str:
    return normalize_path(path).rstrip("/").removeprefix("file:").lstrip("/")


def _counted(
    spark: SparkSession, db: str, where: dict[str, str], prefix: str, source_db: str, source_prefix: str, key: str, tolerance_pct: float,
    origins: dict[str, str],
) -> DataFrame:
    """(table_name, counts, difference, key quality) of every table, one job each: a table that fails has only its error.

    A table is compared with its source table, unless both read the same files, which would always agree. It is then compared with
    the snapshot it was split from (``origins``), whose rows Spark counts from the footers. A table without the key column is
    counted too; its key quality is unknown. ``source_problems``: what the source table lacks.
    """
    known = set(table_names(spark, source_db, source_prefix))

    def count(t: str) -> tuple:
        source = source_prefix + t[len(prefix):]
        told, problems, other = source, [], None
        try:
            if source in known:
                info = describe_table(spark, f"{source_db}.{source}")
                if _resolved(info.details["Location"]) != _resolved(where[t]):
                    other = spark.table(f"{source_db}.{source}")
                problems = contract_problems(info.columns, info.partitions, key, False)
            if other is None and t in origins:
                told, other = origins[t], spark.read.parquet(origins[t])
            df = spark.table(f"{db}.{t}")
            mine = (key_quality({t: df}, key) if key in df.columns else row_counts({t: df})).first().asDict()
            theirs = None if other is None else row_counts({source: other}).first()["rows"]
            return t, mine["rows"], mine.get("null_keys"), mine.get("duplicate_rows"), theirs, other is not None, None, told, problems
        except Exception as e:
            return t, None, None, None, None, other is not None, failure(e), told, problems

    names = list(where)

    return count_match(rows_frame(spark, list(at_once(spark, count, names).values()), COUNTS_DDL), tolerance_pct)


def _with_file_issues(spark: SparkSession, detail: DataFrame, places: list[str], size_mb: tuple[float, float]) -> DataFrame:
    def bare(path: str) -> Column:
        return F.regexp_replace(path, r"^file:/+|/+$", "")

    ordered = F.array_sort(F.collect_list(F.struct(BUCKET, "path", "issue")))
    issues = file_size_issues(listed_files(spark, places), *size_mb, sample=20).groupBy(bare("directory").alias("_place")).agg(
        F.transform(ordered, lambda x: x["issue"]).alias("file_issues"), F.max("issues").alias("file_issue_count")
    )
    return detail.join(issues, bare("location") == F.col("_place"), "left").drop("_place")


def monitor(
    spark: SparkSession,
    db: str,
    prefix: str = TABLE_PREFIX,
    n: int = BUCKETS,
    as_of: date | datetime | str = "",
    source_db: str | None = None,
    source_prefix: str = SOURCE_PREFIX,
    key: str = KEY,
    window_days: int = 45,
    max_tables: int = 0,
    count_check: bool = True,
    tolerance_pct: float = 0.0,
    file_size_check: bool = False,
    file_size_mb: tuple[float, float] = (64, 1024),
    data_bucket: str = "",
    before_counts: Callable[[list[str]], None] | None = None,
) -> DataFrame:
    """One row per monitored table with every check's result; see ``report_rows`` and ``alert_rows``.

    ``before_counts`` is called with the tables that miss partitions, after these were noted and before anything is
    counted: a repair there leaves the report telling what was missing, and the counts those of the repaired table.
    """
    if source_prefix == prefix and source_db in (None, db):
        raise ValueError("a table would be compared with itself")
    names = table_names(spark, db, prefix, not_suffix=IDENTITY_SUFFIX, limit=max_tables)
    contract = check_contract(spark, [f"{db}.{t}" for t in names], key)
    where = {r["table_name"]: r["location"] for r in contract.select("table_name", "location").collect() if r["location"]}

    stored = bucket_rows(spark, {t: child_names(spark, p) for t, p in where.items()})
    registered = bucket_rows(spark, {t: partition_names(spark, f"{db}.{t}") for t in where})
    roots = {t: normalize_path(join_path(p, "..")) for t, p in where.items()}
    dates = {root: read_marker_under(spark, root) for root in set(roots.values())}
    written_from = {root: read_sources(spark, root) for root in set(roots.values())}
    own = {t: written_from[roots[t]].get(normalize_path(where[t]).rstrip("/").split("/")[-1].lower()) if t in where else None for t in names}
    markers = rows_frame(spark, [(t, own[t][0] if own[t] else dates.get(roots.get(t))) for t in names], "table_name string, snapshot_dt string")
    integrity = partition_integrity(contract.select("table_name", "virtual"), stored, registered, n)
    if before_counts is not None:
        before_counts([r["table_name"] for r in integrity.where("missing_count > 0").select("table_name").collect()])
    detail = contract.join(integrity, "table_name").join(check_freshness(markers, window_days, as_of), "table_name")

    if count_check:
        origins = {t: o[1] for t, o in own.items() if o}
        counted = _counted(spark, db, where, prefix, source_db or db, source_prefix, key, tolerance_pct, origins)
        detail = detail.join(counted, "table_name", "left").na.fill(False, ["count_mismatch"])
    else:
        absent = {c: F.lit(None).cast("bigint") for c in ("count_part", "count_src", "pk_nulls", "pk_dupes")}
        absent |= {"source_found": F.lit(None).cast("boolean"), "count_error": F.lit(None).cast("string")}
        absent |= {"source_name": F.lit(None).cast("string"), "source_problems": F.lit(None).cast("array<string>")}
        detail = detail.withColumns({**absent, "count_diff_pct": F.lit(""), "count_mismatch": F.lit(False)})
    detail = detail.withColumn("count_checked", F.lit(count_check))

    if file_size_check:
        detail = _with_file_issues(spark, detail, list(where.values()), file_size_mb)
    else:
        detail = detail.withColumns({"file_issues": F.lit(None).cast("array<string>"), "file_issue_count": F.lit(None).cast("bigint")})
    detail = detail.withColumn("file_issues", F.coalesce("file_issues", F.array().cast("array<string>")))
    return with_input_source(detail, data_bucket)


def report_rows(detail: DataFrame, checked_at: str) -> DataFrame:
    """The printed report, one row per table."""

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return detail.select(
        "input_source",
        text("snapshot_dt").alias("raw_input_snapshot_dt"),
        F.col("table_name").alias("table"),
        "location",
        F.col("storage_partitions").alias("s3_partitions"),
        F.col("catalog_partitions").alias("glue_partitions"),
        F.col("missing_count").alias("missing_glue_count"),
        "table_type_ok",
        (F.size("contract_problems") == 0).alias("contract_ok"),
        text("count_src").alias("count_src"),
        text("count_part").alias("count_part"),
        text("count_diff_pct").alias("count_diff_pct"),
        text("pk_nulls").alias("pk_nulls"),
        text("pk_dupes").alias("pk_dupes"),
        F.array_join(F.slice("file_issues", 1, 3), ";").alias("file_issues_sample"),
        utc_text(F.lit(checked_at).cast("timestamp_ntz")).alias("checked_at"),
    ).select(*REPORT_COLUMNS)


def auto_repair(spark: SparkSession, table: str, mode: str = "all", n: int = BUCKETS) -> DataFrame:
    """Repair ``off`` / ``all`` / ``targeted``; one row with partitions stored and registered before and after."""
    stored = storage_partitions(spark, location(spark, table))
    before = catalog_partitions(spark, table)
    have_before = before.count()
    if mode == "all":
        repair_partitions(spark, table)
    elif mode == "targeted":
        gone = stored.join(before, BUCKET, "left_anti").orderBy(BUCKET).collect()
        add_missing(spark, table, [r[BUCKET] for r in gone if r[BUCKET] < n])
    after = catalog_partitions(spark, table)
    return stored.agg(F.count("*").alias("stored")).select(
        F.lit(table.split(".")[-1]).alias("table_name"),
        "stored",
        F.lit(have_before).cast("bigint").alias("registered_before"),
        after.agg(F.count("*").alias("n")).scalar().alias("registered_after"),
    )
