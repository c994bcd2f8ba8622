"""How rows are laid out in files: clustered, partitioned by bucket, bucketed."""

from __future__ import annotations

from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitweave.functions.keys import BUCKET, BUCKETS, KEY, bucket_of
from splitweave.functions.sizes import gigabytes, planned_file_count, raw_file_count, rows_per_file, target_mb
from splitweave.operators.columns import with_id_bucket
from splitweave.operators.skew import dealt, hot_keys, is_hot
from splitweave.sources.paths import shared_scratch
from splitweave.sources.small_files import tasks_can_write, write_numbered

TARGET_MB = 400
SLOTS = 8192  # of the key's hash, whose weights decide where files are cut
SMALL_ROWS = 10_000  # in a file that doesn't deserve a task of its own
FILES_PER_TASK = 256


def slot_counts(df: DataFrame, slot: Column) -> dict[int, int]:
    """Rows per slot. Counted on the map side; the driver gets one number per slot."""
    return {r["s"]: r["c"] for r in df.groupBy(slot.alias("s")).agg(F.count("*").alias("c")).collect()}


def spread(
    df: DataFrame,
    slot: Column,
    n: int,
    max_rows: int,
    counts: dict[int, int] | None = None,
    together: str | None = None,
) -> DataFrame:
    """Shuffle so that a task holds rows of one slot only and no more than about ``max_rows`` of them.

    A slot that is larger, because the data is large or one key fills it, gets as many tasks as it needs, and its
    rows are dealt out evenly. With ``together`` they are dealt out by that column instead, but for values too
    frequent for one task.
    """
    counts = slot_counts(df, slot) if counts is None else counts
    tasks = [max(1, ceil(counts.get(s, 0) / max_rows)) for s in range(n)]
    if max(tasks) == 1:
        return df.repartitionById(n, slot)
    first = [0, *accumulate(tasks)][:n]
    at = slot + F.lit(1)
    deal = dealt(df)
    if together is not None:
        hot = hot_keys(df, together, min_rows=max_rows)
        deal = F.when(is_hot(together, hot), deal).otherwise(F.xxhash64(F.lit(1), together)) if hot else F.xxhash64(F.lit(1), together)
    parts = F.element_at(F.lit(tasks), at)
    share = F.when(parts > 1, F.pmod(deal, parts)).otherwise(F.lit(0))
    return (
        df.withColumn("_task", (F.element_at(F.lit(first), at) + share).cast("int"))
        .repartitionById(sum(tasks), "_task")
        .drop("_task")
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    key: str = KEY,
    n: int = BUCKETS,
    files: int = 24,
    counts: dict[int, int] | None = None,
    max_rows: int | None = None,
) -> None:
    """``files`` files (at most ``n``), all rows of a key in one of them.

    A file whose bucket range outgrows ``max_rows`` (four times the average, and at least one full file) is cut
    into several, still between keys; only a key that outgrows a file by itself is cut too. ``counts`` are rows
    per bucket, when the caller knows them already.
    """
    files = min(files, n)
    slot = F.floor(bucket_of(key, n) * files / n).cast("int")
    buckets = slot_counts(df, bucket_of(key, n)) if counts is None else counts
    per_slot = [0] * files
    for bucket, rows in buckets.items():
        per_slot[bucket * files // n] += rows
    limit = max_rows or max(rows_per_file(df.schema, TARGET_MB), 4 * sum(per_slot) // files)
    write_parquet(spread(df, slot, files, limit, dict(enumerate(per_slot)), together=key), path)


def write_ranges(df: DataFrame, path: str, key: str = KEY, files: int = 24, max_rows: int | None = None) -> DataFrame:
    """Files of about equal size by ranges of the key's hash, and which keys had to be cut: (key, rows, first_file, files).

    Keys are weighed: those with more rows than a file may hold (``max_rows``, by default a file's share of all rows, at least one
    full file) are found exactly, by counting, and get as many files of their own as they need, over which their rows are dealt
    evenly. The ranges of all other keys are cut where the files become even, never inside a key. Files are numbered in the
    order of their names. A task writes one file, or ``FILES_PER_TASK`` of at most ``SMALL_ROWS`` rows where tasks can open the
    path. Only weights of hash slots reach the driver; the keys that are cut, many if ``max_rows`` is low, are a table in the
    shared folder.
    """
    spark, total = df.sparkSession, df.count()
    limit = max_rows or max(rows_per_file(df.schema, TARGET_MB), ceil(total / files))
    heavy = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows")).where(F.col("rows") > limit)
    heavy, found = heavy.withColumn("files", F.ceil(F.col("rows") / limit).cast("int")), shared_scratch(spark, "cut-keys")
    write_parquet(heavy, found)
    cut = spark.read.schema(heavy.schema).parquet(found)
    taken = {r["s"]: r for r in cut.groupBy(_range_slot("key").alias("s")).agg(F.sum("rows").alias("rows"), F.sum("files").alias("files")).collect()}
    weights = {s: w - (taken[s]["rows"] if s in taken else 0) for s, w in slot_counts(df, _range_slot(key)).items()}
    share = min(limit, max(1, ceil(sum(weights.values()) / files)))
    first, parts, now, held = [0] * SLOTS, [1] * SLOTS, 0, 0
    for s in range(SLOTS):
        w = weights.get(s, 0)
        if held and held + w > share:
            now, held = now + 1, 0
        first[s], parts[s] = now, max(1, ceil(w / limit))
        held += w
        if parts[s] > 1:  # many keys of one slot: dealt by another hash of the key
            now, held = now + parts[s], 0
    *own, end = accumulate((taken[s]["files"] if s in taken else 0 for s in range(SLOTS)), initial=now + 1)  # then the files of cut keys
    table = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")  # noqa: E731  a constant, folded once
    at = _range_slot("key") + F.lit(1)
    before = Window.partitionBy(at).orderBy(F.desc("rows"), "key").rowsBetween(Window.unboundedPreceding, -1)
    manifest = cut.select("key", "rows", (F.element_at(table(own), at) + F.coalesce(F.sum("files").over(before), F.lit(0))).cast("int").alias("first_file"), "files")
    at = _range_slot(key) + F.lit(1)
    file = F.element_at(table(first), at) + F.pmod(F.xxhash64(F.lit(1), key), F.element_at(table(parts), at))
    out = df.withColumn("_file", file.cast("int"))
    if taken:
        mine = (F.col("_first") + F.pmod("_deal", "_files")).cast("int")
        cuts = manifest.select(F.col("key").alias("_key"), F.col("first_file").alias("_first"), F.col("files").alias("_files"))
        out = out.withColumn("_deal", dealt(df)).join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_file", F.coalesce(mine, "_file"))
        out = out.drop("_key", "_first", "_files", "_deal")
    small = limit <= SMALL_ROWS and total > limit and tasks_can_write(df, path)
    each = FILES_PER_TASK if small else 1
    tasks = out.withColumn("_task", F.floor(F.col("_file") / each).cast("int")).repartitionById(ceil(end / each), "_task").drop("_task")
    if small:
        write_numbered(tasks.sortWithinPartitions("_file"), path, "_file")
    else:
        write_parquet(tasks.drop("_file"), path)
    return manifest


def _range_slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def write_parts(
    df: DataFrame,
    path: str,
    key: str = KEY,
    n: int = BUCKETS,
    replace: str = "present",
    mb: int = TARGET_MB,
    counts: dict[int, int] | None = None,
    max_rows: int | None = None,
) -> None:
    """One directory per bucket; one file in it, or more when the bucket is larger than ``mb``.

    ``replace="present"`` overwrites only the buckets that occur in ``df``, ``"all"`` the whole directory.
    """
    rows = df if BUCKET in df.columns else with_id_bucket(df, key, n)
    out = spread(rows, F.col(BUCKET), n, max_rows or rows_per_file(df.schema, mb), counts)
    (
        out.write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", {"present": "dynamic", "all": "static"}[replace])
        .partitionBy(BUCKET)
        .parquet(path)
    )


def refresh_parts(df: DataFrame, path: str, key: str = KEY, n: int = BUCKETS) -> None:
    """Rewrite the buckets that occur in ``df``; the others stay as they are."""
    write_parts(df, path, key, n, replace="present")


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str = KEY, n: int = BUCKETS, mb: int = TARGET_MB, max_rows: int | None = None
) -> None:
    """Table bucketed and sorted by the key, in Spark's own buckets; a large bucket is written by several tasks."""
    slot = F.pmod(F.hash(key), F.lit(n))
    (
        spread(df, slot, n, max_rows or rows_per_file(df.schema, mb))
        .write.mode("overwrite").format("parquet")
        .option("path", path).option("compression", "snappy")
        .bucketBy(n, key).sortBy(key).saveAsTable(table)
    )


def file_plan(sizes: DataFrame, mb: int | None = None) -> DataFrame:
    """Planned file count of each row of (…, bytes); ``mb`` replaces the size bands."""
    per_file = None if mb is None else F.lit(mb)
    gb = F.col("size_gb")
    return sizes.withColumn("size_gb", gigabytes("bytes")).select(
        "*",
        (target_mb(gb) if mb is None else per_file).alias("target_mb"),
        raw_file_count(gb, per_file).alias("raw_files"),
        planned_file_count(gb, per_file).alias("planned_files"),
    )
