"""Key joins of narrow tables, partition anti-joins, registry lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET, KEY, require_same_key_type
from splitweave.functions.text import ASSOCIATION_PREFIX, SNAPSHOT_COLUMN
from splitweave.operators.filters import at_snapshot
from splitweave.operators.skew import both_salted_join, hot_keys, is_hot
from splitweave.sources.catalog import describe_table


def _only_new(b: DataFrame, a: DataFrame, keys: list[str]) -> DataFrame:
    return b.select(*[c for c in b.columns if c in keys or c not in a.columns])


def join_attributes(a: DataFrame, b: DataFrame, key: str = KEY, dt: str | None = None) -> DataFrame:
    """Inner join of two narrow tables, optionally for one snapshot date of the left one.

    Both inputs stay plain scans, so adaptive execution may broadcast a small side or split a skewed key.
    """
    require_same_key_type(a, b, key)
    left = a if dt is None else at_snapshot(a, dt, SNAPSHOT_COLUMN)
    return left.join(_only_new(b, a, [key]), key, "inner")


def join_bucketed(spark: SparkSession, left: str, right: str, key: str = KEY, hot: list | None = None, hot_right: list | None = None) -> DataFrame:
    """Join of two tables bucketed alike on the key: neither side is shuffled.

    Adaptive execution cannot split a bucket, so keys that fill one on either side are joined apart, the full side salted.
    ``hot`` and ``hot_right`` are the frequent keys of the left and the right table; what is not given is measured.
    """
    a, b = spark.table(left), spark.table(right)
    require_same_key_type(a, b, key)
    b = _only_new(b, a, [key])
    hot_left = hot_keys(a, key) if hot is None else hot
    hot_right = hot_keys(b, key) if hot_right is None else hot_right
    every = sorted({*hot_left, *hot_right})
    if not every:
        return a.join(b, key, "inner")
    usual = a.where(~is_hot(key, every)).join(b.where(~is_hot(key, every)), key, "inner")
    apart = both_salted_join(a.where(is_hot(key, every)), b.where(is_hot(key, every)), key, hot_left, hot_right)
    return usual.unionByName(apart)


def join_parts(a: DataFrame, b: DataFrame, key: str = KEY, bucket: int | None = None) -> DataFrame:
    """Join of two partitioned tables on bucket and key; with ``bucket`` only that directory of each is read."""
    require_same_key_type(a, b, key)
    if bucket is not None:
        a, b = a.where(F.col(BUCKET) == bucket), b.where(F.col(BUCKET) == bucket)
    return a.join(_only_new(b, a, [key, BUCKET]), [BUCKET, key], "inner")


def reassemble(tables: list[DataFrame], key: str = KEY, check: bool = True) -> DataFrame:
    """The wide row from its narrow tables. With unique keys every table is shuffled once and no key is hot,
    so NULL and repeated keys are refused first: one shuffle of all tables' keys, with a count for each table."""
    if check:
        numbers = range(len(tables))
        tagged = reduce(DataFrame.unionAll, [t.select(F.col(key).alias("k"), F.lit(i).alias("tag")) for i, t in enumerate(tables)])
        per_key = tagged.groupBy("k").agg(*[F.count_if(F.col("tag") == i).alias(f"n{i}") for i in numbers])
        bad = per_key.where(F.col("k").isNull() | reduce(Column.__or__, [F.col(f"n{i}") > 1 for i in numbers])).take(1)
        if bad:
            raise ValueError(f"keys are not unique: {bad[0]}")

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(_only_new(right, left, [key]), key, "inner")

    return reduce(step, tables)


def reassemble_bucketed(spark: SparkSession, tables: list[str], key: str = KEY) -> DataFrame:
    """The wide row from narrow tables that are bucketed alike on the key: no table is shuffled, each bucket is one task.

    That keys are unique is checked in the same pass: the rows of a bucket are sorted by key for the join, and a row whose key
    repeats that of the row before it fails the query. NULL keys are refused first; the files' statistics tell where there
    are any. Tables in other buckets than the first are refused, since Spark would have to shuffle them.
    """
    layouts = {t: describe_table(spark, t).details for t in tables}
    how = {t: (d.get("Num Buckets"), d.get("Bucket Columns")) for t, d in layouts.items()}
    if len(set(how.values())) > 1 or how[tables[0]][1] != f"[`{key}`]":
        raise ValueError(f"not bucketed alike on {key}: {how}")
    frames = [spark.table(t) for t in tables]
    for name, df in zip(tables, frames):
        require_same_key_type(frames[0], df, key)
        if df.where(F.col(key).isNull()).select(key).take(1):
            raise ValueError(f"keys are not unique: {name} has NULL keys")
    order = Window.partitionBy(key).orderBy(key)

    def unique(name: str, df: DataFrame) -> DataFrame:
        again = F.row_number().over(order)
        said = F.raise_error(F.concat(F.lit(f"keys are not unique: {name} repeats "), F.col(key).cast("string")))
        return df.withColumn("_n", again).where(F.when(F.col("_n") > 1, said.cast("boolean")).otherwise(F.lit(True))).drop("_n")

    checked = [unique(t, df) for t, df in zip(tables, frames)]
    return reduce(lambda left, right: left.join(_only_new(right, left, [key]), key, "inner"), checked)


def missing_partitions(expected: DataFrame, have: DataFrame) -> DataFrame:
    return expected.join(have, expected.columns, "left_anti")


def expected_partitions(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias(BUCKET))


def first_match(df: DataFrame, lookup: DataFrame, candidates: list[str], name: str = "name") -> DataFrame:
    """Adds ``matched``: the first candidate column whose value is a name of ``lookup``."""
    names = lookup.select(F.col(name).alias("_n")).where("_n is not null").distinct()
    out, hits = df, []
    for i, candidate in enumerate(candidates):
        hit = f"_hit{i}"
        out = out.join(names.withColumnRenamed("_n", hit), F.col(candidate) == F.col(hit), "left")
        hits.append(hit)
    return out.withColumn("matched", F.coalesce(*hits)).drop(*hits)


def valid_receivers(wanted: DataFrame, members: DataFrame, own: str, account: str = "account") -> DataFrame:
    """Wanted accounts that are members other than ourselves; all other members when none is."""
    others = members.select(account).where(F.col(account) != own).distinct()
    kept = wanted.select(account).distinct().join(others, account, "left_semi")
    none_kept = kept.agg(F.count("*").alias("n")).scalar() == 0
    return kept.unionByName(others.where(none_kept))


def registry_join(tables: DataFrame, configured: DataFrame, rules: DataFrame, associations: DataFrame) -> DataFrame:
    """tables(table_name) ⟕ configured(name, id) ⟕ rules(id, document) ⟕ associations(association_name).

    An absent side stays NULL; further columns of tables, configured and associations are kept. Small sides are
    broadcast by Spark when their measured size allows it.
    """
    conf = configured.withColumnsRenamed({"name": "table_name", "id": "configured_id"})
    rule = rules.select(F.col("id").alias("configured_id"), F.col("document").alias("rule"))
    return (
        tables.withColumn("_assoc", F.concat(F.lit(ASSOCIATION_PREFIX), "table_name"))
        .join(conf, "table_name", "left")
        .join(rule, "configured_id", "left")
        .join(associations.withColumn("_assoc", F.col("association_name")), "_assoc", "left")
        .drop("_assoc")
    )


def pair_counts(part_counts: DataFrame, source_counts: DataFrame) -> DataFrame:
    """One row per monitored table with both counts; both inputs are (base_name, rows)."""
    src = source_counts.select("base_name", F.col("rows").alias("count_src"))
    return part_counts.withColumnRenamed("rows", "count_part").join(src, "base_name", "left")


def count_match(pairs: DataFrame, tolerance_pct: float = 0.0) -> DataFrame:
    """Adds the difference in percent and whether it is above the tolerance."""
    part, src = F.col("count_part"), F.col("count_src")
    diff = (
        F.when(part.isNull() | src.isNull(), F.lit(None).cast("double"))
        .when((part == 0) & (src == 0), F.lit(0.0))
        .when((part == 0) | (src == 0), F.lit(100.0))
        .otherwise(F.abs(part - src) * F.lit(100.0) / src)
    )
    return (
        pairs.withColumn("_diff", diff)
        .withColumn("count_diff_pct", F.when(F.col("_diff").isNull(), F.lit("")).otherwise(F.format_string("%.6f", "_diff")))
        .withColumn("count_mismatch", F.coalesce(F.col("_diff") > tolerance_pct, F.lit(False)))
        .drop("_diff")
    )
