"""Differences between what is and what should be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitweave.functions.policy import lists_equal
from splitweave.functions.text import association_name


def column_drift(actual: DataFrame, allowed: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """(table_name, column_name) pairs of both sides with what to do about each."""
    a = actual.select("table_name", "column_name").distinct().withColumn("in_actual", F.lit(True))
    b = allowed.select("table_name", "column_name").distinct().withColumn("in_allowed", F.lit(True))
    both = a.join(b, ["table_name", "column_name"], "full_outer").na.fill(False, ["in_actual", "in_allowed"])
    expected = F.col("in_actual") & ~F.col("column_name").isin(list(exclude)) if exclude else F.col("in_actual")
    return both.withColumn("expected", expected).select(
        "*",
        (F.col("in_actual") & ~F.col("in_allowed")).alias("extra"),
        (~F.col("in_actual") & F.col("in_allowed")).alias("missing"),
        (F.col("in_allowed") & ~F.col("expected")).alias("should_remove"),
        (F.col("expected") & ~F.col("in_allowed")).alias("should_add"),
    )


def drift_by_table(drift: DataFrame) -> DataFrame:
    """Counts per table. A table with nothing allowed is not configured and always needs a fix."""
    flags = ["expected", "extra", "missing", "should_remove", "should_add"]
    counted = drift.groupBy("table_name").agg(
        *[F.count_if(f).alias(f) for f in flags], F.count_if("in_allowed").alias("allowed")
    )
    return counted.withColumn("needs_fix", (F.col("should_remove") + F.col("should_add") > 0) | (F.col("allowed") == 0))


def state_check(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """expected(id, name) against actual(id, association_name): correct, wrong_name, unexpected or missing."""
    want = expected.select("id", association_name("name").alias("expected_name"))
    have = actual.select("id", "association_name")
    state = (
        F.when(F.col("expected_name").isNull(), F.lit("unexpected"))
        .when(F.col("association_name").isNull(), F.lit("missing"))
        .when(F.col("expected_name") == F.col("association_name"), F.lit("correct"))
        .otherwise(F.lit("wrong_name"))
    )
    return want.join(have, "id", "full_outer").withColumn("state", state)


def text_list(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def config_drift(
    df: DataFrame,
    expected_providers: list[str],
    expected_receivers: list[str],
    providers: str = "providers",
    receivers: str = "receivers",
    has_rule: str = "has_rule",
    has_result_rule: str = "has_result_rule",
) -> DataFrame:
    """Adds both match flags and the list of issue texts. Providers must agree in order, receivers as a set."""
    want_p, want_r = text_list(expected_providers), text_list(expected_receivers)
    p_ok = F.col(has_rule) & lists_equal(providers, want_p, ordered=True)
    r_ok = F.col(has_result_rule) & lists_equal(receivers, want_r)

    def differs(kind: str, want: Column, got: str) -> Column:
        return F.concat(F.lit(f"{kind} mismatch: expected ["), F.array_join(want, ", "), F.lit("], got ["), F.array_join(got, ", "), F.lit("]"))

    issues = F.array_compact(
        F.array(
            F.when(~F.col(has_rule), F.lit("no analysis rule on the configured table"))
            .when(~p_ok, differs("provider", want_p, providers)),
            F.when(~F.col(has_result_rule), F.lit("no result rule on the association"))
            .when(~r_ok, differs("receiver", want_r, receivers)),
        )
    )
    return df.select("*", p_ok.alias("providers_match"), r_ok.alias("receivers_match"), issues.alias("issues"))


def match_summary(df: DataFrame, flags: list[str]) -> DataFrame:
    """One row: do all rows match, how many do and how many do not."""
    good = F.lit(True)
    for f in flags:
        good = good & F.col(f)
    return df.select(good.alias("good")).agg(
        F.coalesce(F.bool_and("good"), F.lit(True)).alias("all_match"),
        F.count_if("good").alias("matching"),
        F.count_if(~F.col("good")).alias("not_matching"),
    )


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("rows"))
