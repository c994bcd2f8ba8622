"""Keys that hold a large share of the rows.

Inner, left and anti joins of two plain inputs are left to adaptive execution, which splits skewed shuffle
partitions by itself. It cannot do so when a side was aggregated or bucketed on the join key; those joins use
the measured salt below. Nothing is dropped or capped: a salted key meets every row it would have met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 64
MIN_HOT_ROWS = 1_000_000
HOT_SHARE = 0.001
TRACKED = 8
SKETCH_GROUPS = 256
# Key types the frequent-items sketch accepts; timestamps without zone and bytes go as text, nested keys are left to adaptive execution.
SKETCHED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.BooleanType)


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS, share: float = HOT_SHARE) -> list:
    """Values of ``key`` with at least ``share`` of the rows and ``min_rows`` rows.

    A mergeable frequent-items sketch counts on the map side, so no row is shuffled; the sketches of the input
    splits are merged in two steps, so no task gets them all. At most 1/share values can qualify, which bounds what
    reaches the driver. The sketch tracks several times as many, so it misses none of them.
    """
    kind = df.schema[key].dataType
    if isinstance(kind, T.TimestampNTZType):
        sketched, value = F.col(key).cast("string"), str  # compared as text by ``is_hot``
    elif isinstance(kind, T.BinaryType):
        sketched, value = F.hex(key), bytes.fromhex
    elif isinstance(kind, SKETCHED):
        sketched, value = F.col(key), lambda v: v
    else:
        return []
    limit = int(1 / share)
    tracked = limit * TRACKED
    per_group = df.select(sketched.alias("k")).where("k is not null").groupBy(
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")
    ).agg(F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"))
    # One group for all, and not no group: an empty partition then has no sketch to merge.
    merged = per_group.groupBy((F.col("g") * 0).alias("all")).agg(
        F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    )
    top = merged.select("n", F.expr(f"approx_top_k_estimate(sketch, {limit})").alias("top")).first()
    if top is None:
        return []
    floor = max(min_rows, int(top["n"] * share))
    return [value(t["item"]) for t in top["top"] if t["count"] >= floor]


def is_hot(key: str, hot: list) -> Column:
    """Whether the key is one of ``hot``; text stands for what reads so, such as a timestamp without zone."""
    return (F.col(key).cast("string") if hot and isinstance(hot[0], str) else F.col(key)).isin(hot)


def dealt(df: DataFrame) -> Column:
    """A number that spreads rows evenly: a hash of the row and of its input split.

    It depends on nothing else, so a task that runs again after a lost executor deals its rows the same way. Equal
    rows of one split stay together, equal rows of different splits do not.
    """
    simple = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in simple])


def spread_left(df: DataFrame, key: str, hot: list, salts: int = SALTS) -> DataFrame:
    salt = F.when(F.col(key).isNull() | is_hot(key, hot), F.pmod(dealt(df), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    return df.withColumn("_salt", salt)


def repeat_right(df: DataFrame, key: str, hot: list, salts: int = SALTS) -> DataFrame:
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return df.withColumn("_salt", F.explode(F.when(is_hot(key, hot), every).otherwise(F.array(F.lit(0)))))


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str, hot: list | None = None) -> DataFrame:
    """Join whose left side may hold hot keys and whose right side has few rows per key.

    Pass ``hot`` when the left side is the result of a shuffle: measuring it here would run that shuffle twice.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    return spread_left(left, key, hot).join(repeat_right(right, key, hot), [key, "_salt"], how).drop("_salt")


def both_salted_join(left: DataFrame, right: DataFrame, key: str, hot_left: list, hot_right: list, salts: int = SALTS) -> DataFrame:
    """Inner join in which either side may hold hot keys.

    A key hot on one side has that side's rows dealt over ``salts`` tasks and the other side's few rows repeated. A key hot
    on both has either side dealt over the square root of it, and its rows repeated as often as the other side is dealt.
    Rows of keys that are not hot are neither salted nor repeated.
    """
    both = sorted(set(hot_left) & set(hot_right))
    if not hot_left and not hot_right:
        return left.join(right, key, "inner")

    def parts(hot: list) -> Column:
        root = max(1, round(salts**0.5))
        return F.when(is_hot(key, both), F.lit(root)).when(is_hot(key, hot), F.lit(salts)).otherwise(F.lit(1))

    def salted(df: DataFrame, own: str, hot: list, other: str, hot_other: list) -> DataFrame:
        dealt_out = df.withColumn(own, F.pmod(dealt(df), parts(hot)).cast("int"))
        every = F.explode(F.sequence(F.lit(0), parts(hot_other) - 1)) if hot_other else F.lit(0)
        return dealt_out.withColumn(other, every)

    a, b = salted(left, "_salt_l", hot_left, "_salt_r", hot_right), salted(right, "_salt_r", hot_right, "_salt_l", hot_left)
    return a.join(b, [key, "_salt_l", "_salt_r"], "inner").drop("_salt_l", "_salt_r")
