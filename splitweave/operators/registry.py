"""Readiness of tables for a shared analysis, from registry tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitweave.functions.policy import list_add, lists_equal, providers, receivers
from splitweave.functions.text import account_list, or_na, yes_no
from splitweave.operators.ranking import report_order
from splitweave.operators.sets import text_list


def readiness(joined: DataFrame) -> DataFrame:
    """Flags from ``registry_join``: configured, has_rule, associated, providers, ready."""
    configured = F.col("configured_id").isNotNull()
    has_rule = F.col("rule").isNotNull()
    associated = F.col("association_name").isNotNull()
    listed = F.when(has_rule, providers("rule")).otherwise(F.array().cast("array<string>"))
    return joined.withColumns(
        {"configured": configured, "has_rule": has_rule, "associated": associated, "providers": listed}
    ).withColumn("ready", F.col("configured") & F.col("has_rule") & F.col("associated") & (F.size("providers") > 0))


def readiness_report(joined: DataFrame, account_labels: dict[str, str] | None = None, collaboration: str | None = None) -> DataFrame:
    """The printed report: Yes/No and N/A cells, associated tables first, then by name.

    With ``collaboration`` its name and that of the configured table are told too. ``column_count``, ``partition_keys``, ``allowed_columns_count``, ``analysis_method`` and ``result_rule`` are
    used when the registry has them.
    """
    has = set(joined.columns)
    optional = {
        "column_count": F.col("column_count") if "column_count" in has else F.lit(0),
        "partition_keys": or_na("partition_keys") if "partition_keys" in has else F.lit("N/A"),
        "allowed_columns_count": F.coalesce("allowed_columns_count", F.lit(0)) if "allowed_columns_count" in has else F.lit(0),
        "analysis_method": or_na("analysis_method") if "analysis_method" in has else F.lit("N/A"),
        "result_rule_exists": yes_no(F.col("result_rule").isNotNull()) if "result_rule" in has else F.lit("No"),
    }
    named = [] if collaboration is None else [
        F.lit(collaboration).alias("collaboration_name"),
        or_na(F.when(F.col("configured"), F.col("table_name"))).alias("configured_table_name"),
    ]
    report = readiness(joined).select(
        *named,
        "table_name",
        yes_no(F.lit(True)).alias("registered"),
        yes_no(F.col("configured")).alias("configured_table_exists"),
        or_na(F.col("configured_id").cast("string")).alias("configured_table_id"),
        yes_no(F.col("has_rule")).alias("analysis_rule_exists"),
        account_list("providers", account_labels or {}).alias("allowed_analyses"),
        yes_no(F.col("associated")).alias("association_exists"),
        or_na("association_name").alias("association_name"),
        yes_no(F.col("associated")).alias("in_collaboration"),
        yes_no(F.col("ready")).alias("ready_for_analysis"),
        *[c.alias(n) for n, c in optional.items()],
    )
    return report_order(report, "association_exists", "table_name")


def readiness_summary(ready: DataFrame) -> DataFrame:
    return ready.agg(
        F.count("*").alias("tables"),
        F.count_if("configured").alias("configured"),
        F.count_if("has_rule").alias("with_rule"),
        F.count_if("associated").alias("associated"),
        F.count_if("ready").alias("ready"),
    )


def not_ready(ready: DataFrame) -> DataFrame:
    """Tables that are not ready, with what they lack as one text."""

    def lacks(flag: Column, text: str) -> Column:
        return F.when(~flag, F.lit(text))

    reasons = [
        lacks(F.col("configured"), "Missing configured table"),
        lacks(F.col("has_rule"), "Missing analysis rule"),
        lacks(F.col("associated"), "Not in collaboration"),
    ]
    if "providers" in ready.columns:
        reasons.insert(2, lacks(~F.col("has_rule") | (F.size("providers") > 0), "No allowed providers"))
    if "result_rule" in ready.columns:
        reasons.append(lacks(F.col("result_rule").isNotNull(), "Missing collaboration rule"))
    return ready.where(~F.col("ready")).select(
        "table_name", F.array_join(F.array_compact(F.array(*reasons)), ", ").alias("reasons")
    )


def query_ready(rules: DataFrame) -> DataFrame:
    """rules(table_name, rule, result_rule): queries can run when providers and receivers are both named."""
    p, r = F.size(providers("rule")), F.size(receivers("result_rule"))
    return rules.select(
        "table_name",
        p.alias("provider_count"),
        r.alias("receiver_count"),
        (F.col("rule").isNotNull() & F.col("result_rule").isNotNull() & (p > 0) & (r > 0)).alias("query_ready"),
    )


def change_plan(df: DataFrame, expected: list[str], rule: str = "rule") -> DataFrame:
    """Adds status correct / needs_update / needs_create and the list to store."""
    want = text_list(expected)
    current = providers(rule)
    status = (
        F.when(F.col(rule).isNull(), F.lit("needs_create"))
        .when(lists_equal(current, want), F.lit("correct"))
        .otherwise(F.lit("needs_update"))
    )
    return df.withColumn("status", status).withColumn(
        "new_providers", F.when(F.col("status") == "correct", current).otherwise(want)
    )


def add_provider_plan(df: DataFrame, provider: str, rule: str = "rule") -> DataFrame:
    """Adds one provider to each row's list: already_has_provider / needs_update / needs_create and the new list."""
    current = providers(rule)
    status = (
        F.when(F.col(rule).isNull(), F.lit("needs_create"))
        .when(F.array_contains(current, provider), F.lit("already_has_provider"))
        .otherwise(F.lit("needs_update"))
    )
    return df.withColumn("status", status).withColumn("new_providers", list_add(current, F.lit(provider)))
