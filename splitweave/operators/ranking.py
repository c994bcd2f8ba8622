"""Keep-one, latest, top-k and capped lists.

The row_number filters are recognised by the optimizer, which drops losing rows before the shuffle; a key
with a third of all rows therefore sends only a handful of rows per task to its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, group: list[str], order: list[Column], k: int = 1) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def dedupe_keep(
    df: DataFrame, name: str, prefer: str, order: str, id_col: str, keep_all: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): per name the oldest preferred row, else the oldest; names in ``keep_all`` keep every row.

    ``id_col`` must be unique. The dropped rows are found by id, so they spread evenly whatever the names are.
    """
    protected = F.coalesce(F.col(name).isin(list(keep_all)), F.lit(False)) if keep_all else F.lit(False)
    rivals = df.where(~protected)
    winners = first_per_group(rivals, [name], [F.desc(prefer), F.asc(order), F.asc(id_col)])
    dropped = rivals.join(winners.select(id_col), id_col, "left_anti")
    return winners.unionByName(df.where(protected)), dropped


def latest_per_key(df: DataFrame, key: str, order: str, tie: str) -> DataFrame:
    """The row with the greatest ``order`` per key; equal ones are decided by the greatest ``tie``."""
    return first_per_group(df, [key], [F.desc(order), F.desc(tie)])


def quota(df: DataFrame, order: str, k: int) -> DataFrame:
    """The first ``k`` rows in order; ``k`` is a quota of the receiving service and has no default."""
    return df.orderBy(order).limit(k)


def report_order(df: DataFrame, flag: str = "associated", name: str = "table_name") -> DataFrame:
    """Flagged rows first, then by name: a range-partitioned sort, no single-task ranking."""
    return df.orderBy(F.desc(flag), F.asc(name))


def sample_partitions(df: DataFrame, k: int, column: str = "id_bucket") -> DataFrame:
    return df.select(column).distinct().orderBy(column).limit(k)


def cap_per_group(df: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    return first_per_group(df, group, [F.asc(c) for c in order], k)


def joined_issues(df: DataFrame, group: list[str], order: list[str], text: str, k: int) -> DataFrame:
    """First ``k`` texts of each group in order, as one cell separated by semicolons."""
    capped = cap_per_group(df, group, order, k)
    cell = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_text"))))
    return capped.groupBy(*group).agg(F.array_join(F.transform(cell, lambda x: x["_text"]), ";").alias("issues"))


def issues_with_total(df: DataFrame, group: list[str], order: list[str], text: str, k: int) -> DataFrame:
    """As ``joined_issues``, with the number of all texts of the group, also of those that were left out.

    Both are counted before the shuffle: of a group with a third of all rows a task sends ``k`` texts and a number.
    """
    total = df.groupBy(*group).agg(F.count("*").alias("total"))
    both = joined_issues(df, group, order, text, k).unionByName(total, allowMissingColumns=True)  # a union, so that NULL groups meet too
    return both.groupBy(*group).agg(F.max("issues").alias("issues"), F.max("total").alias("total"))
