"""Pipelines from the command line; ``run_job.py`` at the root is the script to submit."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from splitweave.functions.keys import BUCKETS, KEY
from splitweave.functions.text import SOURCE_PREFIX, TABLE_PREFIX
from splitweave.operators.tables import register_external
from splitweave.plans import pipelines
from splitweave.sources.mapping import read_mapping


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="splitweave")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, **required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option, text in required.items():
            sub.add_argument(f"--{option}", required=True, help=text)
        sub.add_argument("--key", default=KEY)
        sub.add_argument("--bucket-count", type=int, default=BUCKETS)
        return sub

    for name in ("split-and-part", "split-and-bucket"):
        sub = command(name, source="directory of snapshots", target="directory of the narrow tables")
        sub.add_argument("--mapping", help="mapping CSV; without it the source is an id list")
        sub.add_argument("--snapshot-dt", default="_NONE_")
        sub.add_argument("--target-file-mb", type=int)
        if name == "split-and-bucket":
            sub.add_argument("--measured-share", type=float, help="plan from a staged share of the keys instead of the footers")
    for name, prefix in (("register", SOURCE_PREFIX), ("prepare", TABLE_PREFIX)):
        sub = command(name, database="catalog database", root="directory of the tables")
        sub.add_argument("--prefix", default=prefix)
        sub.add_argument("--max-cols", type=int, default=None)
    sub = command("bucketed", database="staged tables", target="directory of the bucketed tables")
    sub.add_argument("--target-database")
    sub.add_argument("--tables", default="")
    sub.add_argument("--version", default="")
    sub.add_argument("--snapshot-dt")
    sub = command("identity", database="part tables", target="directory of the identity tables")
    sub.add_argument("--tables", default="")
    sub.add_argument("--force", action="store_true")
    sub.add_argument("--namespace", default="")
    sub.add_argument("--matching-key", default="AXM")
    sub = command("monitor", database="monitored tables", target="directory of the reports")
    sub.add_argument("--prefix", default=TABLE_PREFIX)
    sub.add_argument("--compare-database")
    sub.add_argument("--auto-repair", default="off", choices=["off", "all", "targeted"])
    sub.add_argument("--strict-snapshot", action="store_true")
    sub.add_argument("--freshness-window-days", type=int, default=45)
    sub.add_argument("--count-tolerance-pct", type=float, default=0.0)
    sub.add_argument("--file-size-check", action="store_true")
    sub.add_argument("--max-tables", type=int, default=0)
    sub.add_argument("--data-bucket", default="")
    sub.add_argument("--source-prefix", default=SOURCE_PREFIX)
    sub.add_argument("--no-count-check", action="store_true")
    sub.add_argument("--file-size-min-mb", type=float, default=64)
    sub.add_argument("--file-size-max-mb", type=float, default=1024)
    sub = command("readiness", database="registered tables", target="directory of the reports")
    _registry(sub, True)
    sub = command("refresh", database="catalog database", target="directory of everything that is made", ids="snapshots of ids", attributes="snapshots of attributes")
    sub.add_argument("--mapping", required=True)
    sub.add_argument("--snapshot-dt", default="_NONE_")
    sub.add_argument("--skip", default="", help="steps to leave out, with commas: ids, attributes, register, identity, monitor")
    sub.add_argument("--strict-snapshot", action="store_true")
    _registry(sub, False)
    return parser


def _registry(sub: argparse.ArgumentParser, required: bool) -> None:
    """The registry's tables, as JSON lines."""
    for name, columns in (("configured", "name, id"), ("rules", "id, document"), ("associations", "association_name")):
        sub.add_argument(f"--{name}", required=required, help=f"JSON lines with {columns}")
    sub.add_argument("--collaboration")


def _read_registry(spark: SparkSession, a: argparse.Namespace) -> dict:
    return {n: spark.read.json(getattr(a, n)) for n in ("configured", "rules", "associations")} | {"collaboration": a.collaboration}


def run(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.command in ("split-and-part", "split-and-bucket"):
        mapping = read_mapping(spark, a.mapping) if a.mapping else None
        if a.command == "split-and-part":
            size = {"target_file_mb": a.target_file_mb} if a.target_file_mb else {}
            return pipelines.split_and_part(spark, a.source, a.target, mapping, a.snapshot_dt, a.key, a.bucket_count, **size)
        return pipelines.split_and_bucket(
            spark, a.source, a.target, None, mapping, a.snapshot_dt, a.key, a.bucket_count, a.target_file_mb, measured_share=a.measured_share
        )
    if a.command == "register":
        return register_external(spark, a.database, a.root, a.prefix, a.max_cols, a.key)
    if a.command == "prepare":
        return pipelines.register_and_prepare(spark, a.database, a.root, a.prefix, a.max_cols, a.key)
    if a.command == "bucketed":
        return pipelines.bucketed_build(
            spark, a.database, a.target, target_db=a.target_database, only=a.tables, stamp=a.version, dt=a.snapshot_dt, key=a.key,
            n=a.bucket_count,
        )
    if a.command == "identity":
        tables = [t.strip() for t in a.tables.split(",") if t.strip()] or None
        return pipelines.identity_build(spark, a.database, a.target, tables, a.force, a.key, a.namespace, a.matching_key)
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    if a.command == "readiness":
        return pipelines.readiness_and_report(spark, a.database, a.target, **_read_registry(spark, a))
    if a.command == "refresh":
        registry = _read_registry(spark, a) if a.configured and a.rules and a.associations else None
        skip = tuple(s.strip() for s in a.skip.split(",") if s.strip())
        return pipelines.refresh(
            spark, a.database, a.ids, a.attributes, read_mapping(spark, a.mapping), a.target, now, now, a.snapshot_dt, skip, a.key, a.bucket_count, registry,
            strict_snapshot=a.strict_snapshot,
        )
    _, alerts = pipelines.monitor_and_report(
        spark, a.database, a.target, now, now, a.bucket_count, a.strict_snapshot, a.auto_repair, prefix=a.prefix,
        source_db=a.compare_database, window_days=a.freshness_window_days, tolerance_pct=a.count_tolerance_pct,
        file_size_check=a.file_size_check, max_tables=a.max_tables, data_bucket=a.data_bucket, key=a.key,
        source_prefix=a.source_prefix, count_check=not a.no_count_check, file_size_mb=(a.file_size_min_mb, a.file_size_max_mb),
    )
    return alerts


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"splitweave {options.command}").getOrCreate()
    rows = run(spark, options)
    failed = 0
    for row in rows.toLocalIterator():  # a status or alert for each table, all of them
        print("\t".join("" if v is None else str(v) for v in row), flush=True)
        failed += any(isinstance(v, str) and v.startswith("failed") for v in row)
    if failed:
        raise SystemExit(f"{failed} failed")
