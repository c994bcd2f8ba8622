"""One key or bucket with a third of the rows: results stay whole and no task gets it all."""

import pytest
from pyspark.sql import functions as F

from plans import count
from splitweave.operators.identity import ambiguous, map_identities, matched, unmatched
from splitweave.operators.joins import join_attributes, join_bucketed
from splitweave.operators.layout import spread, write_bucketed, write_clustered, write_parts
from splitweave.operators.privacy import overlap_list, private_overlap
from splitweave.operators.quality import bucket_histogram, key_quality
from splitweave.operators.ranking import dedupe_keep, latest_per_key
from splitweave.operators.skew import both_salted_join, hot_keys, is_hot, salted_join
from splitweave.sources.inventory import file_inventory
from splitweave.sources.paths import shared_scratch

ROWS, HOT = 30_000, 10_001


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("bigint")
    return spark.range(0, ROWS, 1, 24).select(key.alias("customer_user_id"), F.col("id").alias("v"))


def same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def rows_per_file(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()]


def test_spread_bounds_tasks(spark, skewed):
    slot = F.pmod("customer_user_id", F.lit(16)).cast("int")
    out = spread(skewed, slot, 16, 2_000)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == ROWS and max(sizes) <= 2_600


def test_parts_file_sizes(spark, skewed):
    path = shared_scratch(spark, "hot-parts")
    write_parts(skewed, path, n=16, max_rows=2_000)
    assert max(rows_per_file(spark, path)) <= 2_600
    assert same(spark.read.parquet(path).drop("id_bucket"), skewed)


def test_clustered_file_sizes(spark, skewed):
    path = shared_scratch(spark, "hot-clustered")
    write_clustered(skewed, path, n=16, files=8, max_rows=3_500)
    assert max(rows_per_file(spark, path)) <= 4_500
    assert same(spark.read.parquet(path), skewed)
    files_of = spark.read.parquet(path).select("customer_user_id", F.col("_metadata.file_path").alias("f"))
    cut = files_of.groupBy("customer_user_id").agg(F.count_distinct("f").alias("n")).where("n > 1")
    assert [r["customer_user_id"] for r in cut.collect()] == [7]


def test_bucketed_file_sizes(spark, skewed, db):
    path = shared_scratch(spark, "hot-bucketed")
    write_bucketed(skewed, f"{db}.hot", path, n=8, max_rows=3_000)
    assert max(rows_per_file(spark, path)) <= 4_000
    assert same(spark.table(f"{db}.hot"), skewed)
    assert spark.table(f"{db}.hot").where("customer_user_id = 7").count() == HOT


def test_hot_keys(skewed):
    assert hot_keys(skewed, "customer_user_id", min_rows=1_000, share=0.01) == [7]
    assert hot_keys(skewed, "v", min_rows=1_000, share=0.01) == []
    assert hot_keys(skewed.where("v < 0"), "customer_user_id", min_rows=1) == []
    assert hot_keys(skewed.select(F.array("v").alias("a")), "a") == []


def test_hot_keys_finds_all_among_many(spark):
    """Forty keys of 1 % each among 300,000 single ones."""
    many = spark.range(0, 500_000, 1, 32).select(
        F.when(F.col("id") < 200_000, -(F.col("id") % 40) - 1).otherwise(F.col("id")).alias("k")
    )
    assert sorted(hot_keys(many, "k", min_rows=1_000)) == list(range(-40, 0))
    assert sorted(hot_keys(many.coalesce(2), "k", min_rows=1_000)) == list(range(-40, 0))
    assert sorted(hot_keys(many.where("k < 0").repartition(3, "k").unionByName(many.where("k = 0")), "k", min_rows=1_000)) == list(range(-40, 0))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, skewed, how):
    right = spark.range(0, ROWS, 2).union(spark.range(7, 8)).select(F.col("id").alias("customer_user_id"))
    assert same(salted_join(skewed, right, "customer_user_id", how, [7]), skewed.join(right, "customer_user_id", how))


def test_bucketed_join_with_hot_key(spark, skewed, db):
    one = spark.range(ROWS).select(F.col("id").alias("customer_user_id"), (F.col("id") * 2).alias("w"))
    for name, df in (("a", skewed), ("b", one)):
        write_bucketed(df, f"{db}.{name}", shared_scratch(spark, name), n=8)
    assert same(join_bucketed(spark, f"{db}.a", f"{db}.b", hot=[7]), skewed.join(one, "customer_user_id"))
    assert same(join_bucketed(spark, f"{db}.a", f"{db}.b"), skewed.join(one, "customer_user_id"))


def test_bucketed_join_with_hot_key_on_the_right(spark, skewed, db):
    one = spark.range(ROWS).select(F.col("id").alias("customer_user_id"), (F.col("id") * 2).alias("w"))
    for name, df in (("one", one), ("many", skewed)):
        write_bucketed(df, f"{db}.{name}", shared_scratch(spark, name), n=8)
    joined = join_bucketed(spark, f"{db}.one", f"{db}.many", hot=[], hot_right=[7])
    assert same(joined, one.join(skewed, "customer_user_id"))


@pytest.mark.parametrize(("hot_left", "hot_right"), [([7], []), ([], [7]), ([7], [7]), ([7, 9], [8]), ([], [])])
def test_both_salted_join(spark, hot_left, hot_right):
    def side(name, rows):
        key = F.when(F.col("id") < rows, F.lit(7)).when(F.col("id") > 280, F.lit(None)).otherwise(F.col("id")).cast("bigint")
        return spark.range(0, 300, 1, 4).select(key.alias("k"), F.col("id").alias(name))

    a, b = side("v", 100), side("w", 50)
    assert same(both_salted_join(a, b, "k", hot_left, hot_right), a.join(b, "k"))


def test_hot_side_is_not_repeated(spark, skewed):
    """The rows of the hot side stay as many as they are; only the few rows of the other side are repeated."""
    few = spark.createDataFrame([(7, 1)], "customer_user_id bigint, w bigint")
    for hot_left, hot_right, a, b in (([7], [], skewed, few), ([], [7], few, skewed)):
        joined = both_salted_join(a, b, "customer_user_id", hot_left, hot_right)
        assert joined.count() == HOT and count(joined, "Generate") == 1


def test_attribute_join_with_hot_key(spark, skewed):
    one = spark.range(ROWS).select(F.col("id").alias("customer_user_id"), (F.col("id") * 2).alias("w"))
    assert join_attributes(skewed, one).count() == ROWS


def test_key_quality(skewed):
    row = key_quality({"t": skewed}).first()
    assert (row["rows"], row["null_keys"], row["duplicate_rows"]) == (ROWS, 0, HOT)


def test_histogram(skewed):
    rows = bucket_histogram(skewed, 16).collect()
    assert sum(r["rows"] for r in rows) == ROWS and max(r["share"] for r in rows) > 0.3
    assert sum(r["keys"] for r in rows) == skewed.select("customer_user_id").distinct().count()


def test_latest_and_dedupe(skewed):
    assert latest_per_key(skewed, "customer_user_id", "v", "v").where("customer_user_id = 7").first()["v"] == 29_997
    kept, dropped = dedupe_keep(skewed.withColumn("p", F.lit(False)), "customer_user_id", "p", "v", "v")
    assert kept.where("customer_user_id = 7").first()["v"] == 0
    assert kept.count() + dropped.count() == ROWS and dropped.count() == HOT - 1


def test_identities_hot_on_both_sides(spark, skewed):
    source = skewed.withColumnRenamed("v", "row_id")
    target = skewed.where("v % 2 = 0").withColumnRenamed("v", "target_id")
    out = map_identities(source, target, "customer_user_id")
    hot = out.where("customer_user_id = 7").collect()
    assert len(hot) == 1 and hot[0]["status"] == "ambiguous" and hot[0]["source_rows"] == HOT
    assert matched(out).count() == ROWS // 3 and ambiguous(out, "customer_user_id").count() == 1
    assert unmatched(out, "customer_user_id").count() == out.count() - ROWS // 3 - 1


@pytest.mark.parametrize("hot", [[], [7]])
def test_overlap_does_not_form_pairs(spark, skewed, hot, monkeypatch):
    """10,001 x 10,001 pairs of the hot key are counted without being formed, on either path."""
    monkeypatch.setattr("splitweave.operators.privacy.hot_keys", lambda df, key: hot)
    a = skewed.select("customer_user_id", (F.col("v") % 5).alias("dim"), F.col("v").alias("x"))
    b = skewed.where("customer_user_id = 7").select("customer_user_id", F.col("v").alias("y"), (F.col("v") % 2).alias("flag"))
    aggs = {
        "pairs": ("count", "y"), "sum_x": ("sum", "x"), "sum_y": ("sum", "y"), "max_y": ("max", "y"), "min_x": ("min", "x"),
        "avg_y": ("avg", "y"), "flags": ("count_distinct", "flag"), "sum_flag": ("sum", "flag"), "keys": ("count", "customer_user_id"),
    }
    got = private_overlap(a, b, ["customer_user_id"], ["dim"], aggs, "customer_user_id", minimum=1)
    a7, b7 = a.where("customer_user_id = 7"), b.agg(F.count("*").alias("nb"), F.sum("y").alias("sb"), F.max("y").alias("mb"), F.sum("flag").alias("fb")).first()
    want = a7.groupBy("dim").agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.min("x").alias("m")).select(
        "dim", (F.col("n") * b7["nb"]).alias("pairs"), (F.col("s") * b7["nb"]).alias("sum_x"), (F.col("n") * b7["sb"]).alias("sum_y"),
        F.lit(b7["mb"]).alias("max_y"), F.col("m").alias("min_x"), F.lit(b7["sb"] / b7["nb"]).alias("avg_y"), F.lit(2).cast("bigint").alias("flags"),
        (F.col("n") * b7["fb"]).alias("sum_flag"), (F.col("n") * b7["nb"]).alias("keys"),
    )
    assert same(got, want)


def test_overlap_small_values_match_plain_join(spark):
    a = spark.createDataFrame([(1, "x", 2), (1, "x", None), (2, "y", 5), (None, "y", 1), (3, "z", 4)], "k int, d string, m int")
    b = spark.createDataFrame([(1, "p", 10), (1, "q", None), (2, "p", 3), (None, "p", 9)], "k int, e string, w int")
    aggs = {"n": ("count", "m"), "nw": ("count", "w"), "s": ("sum", "m"), "a": ("avg", "w"), "lo": ("min", "w"), "hi": ("max", "m"), "de": ("count_distinct", "e")}
    got = private_overlap(a, b, ["k"], ["d"], aggs, "k", minimum=1)
    want = a.join(b, "k").groupBy("d").agg(
        F.count("m").alias("n"), F.count("w").alias("nw"), F.sum("m").alias("s"), F.avg("w").alias("a"), F.min("w").alias("lo"),
        F.max("m").alias("hi"), F.count_distinct("e").alias("de"),
    )
    assert same(got, want)


def test_overlap_rules(spark, skewed):
    with pytest.raises(ValueError):
        private_overlap(skewed, skewed.select("customer_user_id"), ["customer_user_id"], [], {"x": ("stddev", "v")}, "customer_user_id")
    with pytest.raises(ValueError):
        private_overlap(skewed, skewed, ["customer_user_id"], [], {}, "customer_user_id")
    with pytest.raises(ValueError):
        overlap_list(skewed, skewed, ["customer_user_id"], ["v"], ["customer_user_id"], [])


def test_overlap_list_hot(spark, skewed):
    other = skewed.where("customer_user_id = 7").select("customer_user_id")
    got = overlap_list(skewed, other, ["customer_user_id"], ["v"], ["customer_user_id"], ["v"])
    assert got.count() == HOT


def test_file_inventory_counts(spark, skewed):
    path = shared_scratch(spark, "inv")
    write_parts(skewed, path, n=4)
    files = file_inventory(spark, path)
    assert {r["id_bucket"] for r in files.collect()} == {0, 1, 2, 3}
    assert files.select("directory").distinct().count() == 1


@pytest.mark.parametrize("kind", ["timestamp_ntz", "binary", "date", "string"])
def test_hot_keys_of_other_types(spark, kind):
    """A key with a third of the rows is found and salted whatever its type; the join loses and repeats nothing."""
    made = {
        "timestamp_ntz": F.timestamp_seconds(F.col("n")).cast("timestamp_ntz"), "binary": F.col("n").cast("string").cast("binary"),
        "date": F.date_add(F.lit("2001-01-01").cast("date"), F.col("n").cast("int")), "string": F.col("n").cast("string"),
    }[kind]
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("n"), "id").select(made.alias("k"), "id")
    other = spark.range(3000).select(F.col("id").alias("n")).select(made.alias("k"), (F.col("n") + 1).alias("w"))
    hot = hot_keys(rows, "k", min_rows=500)
    assert len(hot) == 1
    assert rows.where(is_hot("k", hot)).count() == 1000 + (0 if 7 % 3 == 0 else 1)
    assert sorted(map(tuple, salted_join(rows, other, "k", "inner", hot).select("id", "w").collect())) == sorted(map(tuple, rows.join(other, "k").select("id", "w").collect()))
    assert hot_keys(rows.select(F.struct("k").alias("k")), "k", min_rows=500) == []
