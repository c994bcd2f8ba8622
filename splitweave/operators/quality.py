"""Counts, key quality, bucket balance, split check. Every pass pre-aggregates on the map side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET, BUCKETS, KEY, bucket_of
from splitweave.operators.columns import narrow_columns
from splitweave.sources.local import rows_frame


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows); an empty read schema, so Parquet answers from row counts."""
    return union_all([row_count(df).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()])


def _per_key(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("k")).groupBy("k").agg(F.count("*").alias("c"))


def duplicate_rows(df: DataFrame, key: str = KEY) -> DataFrame:
    """Number of rows whose key occurs more than once; NULL keys count as one group."""
    return _per_key(df, key).where("c > 1").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("duplicate_rows"))


def key_quality(tables: dict[str, DataFrame], key: str = KEY) -> DataFrame:
    """(table_name, rows, null_keys, duplicate_rows), one pass over the key column of each table.

    Tables stay separate branches of one job, so a bucketed table needs no shuffle at all.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        counted = F.coalesce(F.sum("c"), F.lit(0))
        return _per_key(df, key).agg(
            counted.alias("rows"),
            F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("c"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("duplicate_rows"),
        ).select(F.lit(name).alias("table_name"), "*")

    return union_all([one(n, df) for n, df in tables.items()])


def distinct_users(df: DataFrame, key: str = KEY, approximate: bool = False) -> DataFrame:
    users = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.agg(F.count("*").alias("total_rows"), users.alias("distinct_users"))


def bucket_histogram(df: DataFrame, n: int = BUCKETS, key: str = KEY) -> DataFrame:
    """Rows, distinct keys and share of all rows per bucket; empty buckets appear with 0.

    Counting per key first means that one frequent key, or one full bucket, is spread over the map side.
    """
    bucketed = df.select(F.col(BUCKET) if BUCKET in df.columns else bucket_of(key, n).alias(BUCKET), F.col(key).alias("k"))
    per_bucket = (
        bucketed.groupBy(BUCKET, "k").agg(F.count("*").alias("c"))
        .groupBy(BUCKET).agg(F.sum("c").alias("rows"), F.count("k").alias("keys"))
    )
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias(BUCKET))
    filled = every.join(per_bucket, BUCKET, "left").na.fill(0, ["rows", "keys"])
    total = per_bucket.agg(F.sum("rows").alias("t")).scalar()
    return filled.withColumn("share", F.coalesce(F.col("rows") / total, F.lit(0.0)))


def bucket_balance(histogram: DataFrame) -> DataFrame:
    """One row: smallest and largest bucket and how many are empty."""
    return histogram.agg(
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        F.count_if(F.col("rows") == 0).alias("empty_buckets"),
    )


def check_split(
    wide: DataFrame, tables: dict[str, DataFrame], groups: dict[str, list[str]], key: str = KEY
) -> DataFrame:
    """Per narrow table: row counts, keys missing from it, keys it has too many of, attribute columns.

    Source and tables are one tagged union, so each is scanned and shuffled once, however many tables there are: per key, an
    array with how often it occurs in the source and in every table. Keys and counts are all that is shuffled, after the map side
    has added up what it has.
    """
    names = list(tables)

    def tagged(df: DataFrame, tag: int) -> DataFrame:
        return df.select(F.col(key).alias("k"), F.lit(tag).alias("tag"))

    rows = union_all([tagged(wide, 0), *[tagged(tables[t], i) for i, t in enumerate(names, 1)]])
    counts = [F.count_if(F.col("tag") == i).alias(f"n{i}") for i in range(len(names) + 1)]
    per_key = rows.groupBy("k").agg(*counts)
    ahead, zero = F.col("n0") - F.col("n"), F.lit(0).cast("bigint")

    def total(c: Column | str) -> Column:
        return F.coalesce(F.sum(c), zero)

    each = per_key.select("n0", F.posexplode(F.array(*[F.col(f"n{i}") for i in range(1, len(names) + 1)])).alias("at", "n"))
    found = each.groupBy("at").agg(
        total("n0").alias("source_rows"), total("n").alias("rows"),
        total(F.greatest(ahead, zero)).alias("missing_keys"), total(F.greatest(-ahead, zero)).alias("extra_keys"),
    )
    known = rows_frame(
        wide.sparkSession,
        [(i, t, len(narrow_columns(groups[t], key)) - 1, len([c for c in tables[t].columns if c not in (key, BUCKET)])) for i, t in enumerate(names)],
        "at int, table_name string, mapped_columns int, found_columns int",
    )
    # Without any key no table has a row; they are listed all the same.
    numbers = [F.coalesce(c, zero).alias(c) for c in ("source_rows", "rows", "missing_keys", "extra_keys")]
    ok = (F.col("missing_keys") == 0) & (F.col("extra_keys") == 0) & (F.col("mapped_columns") == F.col("found_columns"))
    return known.join(found, "at", "left").select("table_name", *numbers, "mapped_columns", "found_columns").withColumn("ok", ok)
