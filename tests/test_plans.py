"""The plans that matter at scale."""

from pyspark.sql import functions as F

from plans import count, plan
from splitweave.checks.layout import geo_parts, narrow
from splitweave.checks.views import N, order_snapshots, read, stored_wide, mapping
from splitweave.operators.columns import vertical_split, with_id_bucket
from splitweave.operators.filters import at_snapshot, lookup_key
from splitweave.operators.identity import map_identities_by_rules
from splitweave.operators.joins import join_attributes, join_bucketed, join_parts, reassemble
from splitweave.operators.layout import write_bucketed
from splitweave.operators.privacy import private_overlap
from splitweave.operators.quality import key_quality, row_count
from splitweave.operators.ranking import dedupe_keep, latest_per_key, quota
from splitweave.sources.inventory import file_inventory
from splitweave.sources.paths import shared_scratch


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def usual(spark):
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_reads_only_its_columns(spark, sf):
    text = plan(vertical_split(stored_wide(spark, sf), mapping(spark))["GEO_01"])
    assert "ReadSchema: struct<Customer_User_id:bigint,n_name:string,r_name:string>" in text and "Exchange" not in text


def test_bucketed_join_has_no_shuffle(spark, sf, db):
    for t in ("SEG_01", "GEO_01"):
        write_bucketed(narrow(spark, sf, t), f"{db}.{t.lower()}", shared_scratch(spark, t), n=N)
    no_broadcast(spark)
    try:
        joined = join_bucketed(spark, f"{db}.seg_01", f"{db}.geo_01")
        assert count(joined, "Exchange") == 0 and "SortMergeJoin" in plan(joined)
        # Only the rows of frequent keys are shuffled.
        assert count(join_bucketed(spark, f"{db}.seg_01", f"{db}.geo_01", hot=[7]), "Exchange") == 2
    finally:
        usual(spark)


def test_bucketed_key_quality_has_no_key_shuffle(spark, sf, db):
    write_bucketed(narrow(spark, sf, "SEG_01"), f"{db}.q", shared_scratch(spark, "q"), n=N)
    assert "hashpartitioning" not in plan(key_quality({"q": spark.table(f"{db}.q")}), "simple")


def test_bucket_literal_prunes_both_sides(spark, sf):
    parts = spark.read.parquet(geo_parts(spark, sf))
    text = plan(join_parts(parts, parts.withColumnRenamed("n_name", "other"), bucket=3), "simple")
    assert text.count("PartitionFilters: [isnotnull(id_bucket") == 2 and text.count("(id_bucket#") >= 2


def test_lookup_prunes_to_one_bucket(spark, sf):
    text = plan(lookup_key(spark.read.parquet(geo_parts(spark, sf)), 77, n=N), "simple")
    assert "PartitionFilters: [isnotnull(id_bucket" in text and "xxhash64" not in text.split("PartitionFilters")[1]


def test_date_filter_prunes(spark, sf):
    text = plan(at_snapshot(spark.read.parquet(order_snapshots(spark, sf)), "1999-01-01"), "simple")
    assert "snapshot_dt" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_count_reads_no_columns(spark, sf):
    assert "ReadSchema: struct<>" in plan(row_count(read(spark, sf, "lineitem")))


def test_keep_one_filters_before_the_shuffle(spark, sf):
    latest = plan(latest_per_key(read(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey"), "simple")
    above, below = latest.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    rows = read(spark, sf, "orders").withColumn("p", F.lit(True))
    kept, _ = dedupe_keep(rows, "o_custkey", "p", "o_orderdate", "o_orderkey")
    assert plan(kept, "simple").count("WindowGroupLimit") == 2


def test_quota_is_a_top_k(spark, sf):
    assert "TakeOrderedAndProject" in plan(quota(read(spark, sf, "part"), "p_name", 25), "simple")


def test_reassemble_shuffles_each_table_once(spark, sf):
    tables = vertical_split(stored_wide(spark, sf), mapping(spark))
    no_broadcast(spark)
    try:
        assert plan(reassemble(list(tables.values()), check=False), "simple").count("Exchange hashpartitioning") == len(tables)
    finally:
        usual(spark)


def test_inventory_reads_no_contents(spark, sf):
    text = plan(file_inventory(spark, geo_parts(spark, sf)))
    assert "ReadSchema: struct<path:string,length:bigint>" in text


def test_bucket_column_stays_in_codegen(spark, sf):
    assert "Python" not in plan(with_id_bucket(stored_wide(spark, sf), "Customer_User_id"), "simple")


def test_overlap_shuffles_each_side_once(spark, sf):
    a = read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    b = read(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus", "o_orderkey")
    no_broadcast(spark)
    try:
        out = private_overlap(a, b, ["k"], ["c_mktsegment", "o_orderstatus"], {"n": ("count", "o_orderkey")}, "k")
        # one per side, one for the groups
        assert plan(out, "simple").count("Exchange hashpartitioning") == 3
    finally:
        usual(spark)


def test_skewed_partition_of_an_attribute_join_is_split(spark):
    """Plain inputs: adaptive execution cuts the partition of a key with a third of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("bigint")
        many = spark.range(0, 200_000, 1, 8).select(key.alias("customer_user_id"), F.rand(1).alias("v"))
        one = spark.range(200_000).select(F.col("id").alias("customer_user_id"), F.rand(2).alias("w"))
        joined = join_attributes(many, one)
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_identity_rules_read_the_sides_once_per_rule(spark):
    """Every rule is one job over written hits: the answer's plan is one scan, whatever the number of rules."""
    a = spark.range(40).select(F.col("id").alias("row_id"), *[F.when(F.col("id") % 5 == i, F.col("id")).alias(f"k{i}") for i in range(5)])
    b = a.withColumnRenamed("row_id", "target_id")
    got = map_identities_by_rules(a, b, [(f"rule {i}", [f"k{i}"]) for i in range(5)])
    assert count(got, "FileScan") == 1 and count(got, "Exchange") == 0
    assert sorted((r["source_id"], r["target_id"], r["rule_name"]) for r in got.collect()) == [(i, i, f"rule {i % 5}") for i in range(40)]


def test_identity_rule_of_several_columns(spark):
    a = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", None), (4, "c", 3), (5, "c", 3)], "row_id int, n string, b int")
    b = spark.createDataFrame([(11, "a", 1), (12, "a", 2), (13, "b", None), (14, "c", 3)], "target_id int, n string, b int")
    got = map_identities_by_rules(a, b, [("by name", "n"), ("by both", ["n", "b"])])
    assert sorted(map(tuple, got.collect())) == [(1, 11, "by both"), (2, 12, "by both"), (3, 13, "by name")]
    assert map_identities_by_rules(a.limit(0), b, [("by name", "n")]).count() == 0
