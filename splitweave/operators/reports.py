"""Report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from splitweave.functions.text import join_path


def write_report_json(header: DataFrame, tables: DataFrame, alerts: DataFrame, path: str) -> None:
    """Three JSON-lines folders, ``summary``, ``tables`` and ``alerts``; nothing is gathered into one document."""
    for name, part in (("summary", header), ("tables", tables), ("alerts", alerts)):
        part.write.mode("overwrite").json(join_path(path, name))


def write_report_csv(report: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV with a header and a fixed column order; Spark decides how many files."""
    (report.select(*columns) if columns else report).write.mode("overwrite").option("header", True).csv(path)
