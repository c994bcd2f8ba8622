import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from splitweave.functions.keys import bucket_of, find_column, require_same_key_type
from splitweave.functions.policy import analysis_rule, lists_equal, receivers
from splitweave.functions.sizes import size_out_of_range
from splitweave.functions.text import association_name, bucket_in_path, is_stale, join_path, normalize_path, receiver_account
from splitweave.operators.joins import count_match
from splitweave.operators.layout import file_plan
from splitweave.operators.privacy import aggregate_by_rule, list_by_rule, overlap_by_rule, private_overlap


def values(df, column):
    return [r[column] for r in df.collect()]


def test_bucket_depends_on_type_and_null(spark):
    row = spark.range(1).select(
        bucket_of(F.lit(1).cast("bigint")).alias("one"), bucket_of(F.lit(2).cast("bigint")).alias("two"),
        bucket_of(F.lit(-5).cast("bigint")).alias("minus"), bucket_of(F.lit(None).cast("bigint")).alias("null"),
        bucket_of(F.lit("1")).alias("text"), bucket_of(F.lit(1).cast("int")).alias("int"),
    ).first()
    assert tuple(row) == (50, 205, 92, 42, 144, 41)


@pytest.mark.parametrize("gb, raw, planned", [
    (0, 1, 24), (0.5, 2, 24), (9.99, 26, 24), (10, 21, 24), (17.4, 37, 36), (19.9, 42, 36), (20, 53, 56), (30, 81, 96),
    (34, 92, 96), (60, 162, 128),
])
def test_file_plan(spark, gb, raw, planned):
    row = file_plan(spark.createDataFrame([(int(gb * 2**30),)], "bytes bigint")).first()
    assert (row["raw_files"], row["planned_files"]) == (raw, planned)


def test_file_plan_with_target(spark):
    row = file_plan(spark.createDataFrame([(32 * 2**30,)], "bytes bigint"), mb=1024).first()
    assert (row["target_mb"], row["raw_files"], row["planned_files"]) == (1024, 32, 32)


def test_count_difference(spark):
    pairs = spark.createDataFrame(
        [("a", 0, 0), ("b", 0, 5), ("c", 5, 0), ("d", 999950, 1000000), ("e", 1, None)], "base_name string, count_part bigint, count_src bigint"
    )
    got = {r["base_name"]: (r["count_diff_pct"], r["count_mismatch"]) for r in count_match(pairs).collect()}
    assert got == {
        "a": ("0.000000", False), "b": ("100.000000", True), "c": ("100.000000", True), "d": ("0.005000", True), "e": ("", False),
    }
    assert not count_match(pairs.where("base_name = 'd'"), 0.005).first()["count_mismatch"]


def test_association_names(spark):
    names = spark.createDataFrame([("part_x_01-assoc",), ("part_x_01_assoc",), ("acx_part_x_01",)], "n string")
    assert set(values(names.select(association_name("n").alias("n")), "n")) == {"acx_part_x_01"}


def test_bucket_in_path(spark):
    paths = spark.createDataFrame([("s3://b/t/id_bucket=7/f",), ("id_bucket=12",), ("id_bucket=x/f",), ("no",), ("my_id_bucket=3/f",)], "p string")
    assert values(paths.select(bucket_in_path("p").alias("b")), "b") == [7, 12, None, None, None]


def test_stale(spark):
    dates = spark.createDataFrame([("2001-05-16",), ("2001-05-15",), ("2001-13-01",), ("soon",), (None,), ("2001-5-16",)], "d string")
    got = values(dates.select(is_stale("d", 45, "2001-06-30").alias("s")), "s")
    assert got == [False, True, True, True, True, False]
    assert values(dates.select(is_stale("d", 45, "2001-06-30 10:00:00").alias("s")), "s")[0] is True


def test_receiver_accounts(spark):
    given_ = spark.createDataFrame([("111122223333",), ("arn:aws:cleanrooms:r:444455556666:x/y",), ("arn:aws:s3:::b",), ("12",), (None,)], "r string")
    assert values(given_.select(receiver_account("r").alias("a")), "a") == ["111122223333", "444455556666", None, None, None]


def test_policy_levels(spark):
    docs = spark.createDataFrame([('{"v1":{"custom":{"allowedResultReceivers":["1"]}}}',), ('{"v1":{}}',), ("not json",), (None,)], "d string")
    assert values(docs.select(receivers("d").alias("r")), "r") == [["1"], [], [], []]


def test_lists_equal(spark):
    row = spark.range(1).select(
        lists_equal(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("a"))).alias("set"),
        lists_equal(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("a")), ordered=True).alias("ordered"),
    ).first()
    assert tuple(row) == (True, False)


def test_size_range(spark):
    sizes = spark.createDataFrame([(0,), (63 * 2**20,), (64 * 2**20,), (1025 * 2**20,)], "b bigint")
    assert values(sizes.select(size_out_of_range("b", 64, 1024).alias("x")), "x") == [False, True, False, True]


def test_find_column():
    assert find_column(["a", "Customer_User_ID"], "customer_user_id") == "Customer_User_ID"
    assert find_column(["ID", "id"], "id") == "id"
    assert find_column(["a"], "id") is None
    with pytest.raises(ValueError):
        find_column(["ID", "Id"], "id")


def test_key_types_must_agree(spark):
    with pytest.raises(TypeError):
        require_same_key_type(spark.range(1), spark.range(1).select(F.col("id").cast("string").alias("id")), "id")


@given(st.lists(st.sampled_from(["a", "b", ".", "..", ""]), max_size=8))
def test_normalize_path(parts):
    got = normalize_path("s3://bucket/" + "/".join(parts))
    assert got.startswith("s3://bucket") and "/./" not in got and ".." not in got and "//" not in got[5:]


def test_marker_path():
    assert normalize_path(join_path("s3a://b/x/table/", "..", "metadata")) == "s3a://b/x/metadata"
    assert normalize_path("file:/tmp/a/../b") == "file:/tmp/b"


def test_rules(spark):
    assert json.loads(analysis_rule("custom", ["1"]))["v1"]["custom"] == {"allowedAnalyses": ["ANY_QUERY"], "allowedAnalysisProviders": ["1"]}
    people = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, g string")
    rule = analysis_rule("aggregation", columns=["id", "g"])
    assert [r["n"] for r in aggregate_by_rule(people, rule, ["g"], {"n": ("count", "id")}).collect()] == [2]
    for dims, aggs in ((["x"], {}), (["g"], {"n": ("count", "x")}), (["g"], {"n": ("median", "id")})):
        with pytest.raises(ValueError):
            aggregate_by_rule(people, rule, dims, aggs)
    with pytest.raises(ValueError):
        list_by_rule(people, people, analysis_rule("list", columns=["g"], joins=["id"]), ["g"], ["g"])
    with pytest.raises(ValueError):
        analysis_rule("other")


def test_rule_functions_and_operators(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "x", 7), (3, "y", 9)], "k int, g string, v int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "k int")

    def rule(**changed):
        body = {
            "aggregateColumns": [{"columnNames": ["k"], "function": "COUNT"}, {"columnNames": ["v"], "function": "SUM"}],
            "dimensionColumns": ["g"], "joinColumns": ["k"], "scalarFunctions": [],
            "outputConstraints": [{"column": "k", "minimum": 2, "type": "COUNT_DISTINCT"}],
        }
        return json.dumps({"v1": {"aggregation": {**body, **changed}}})

    aggs = {"n": ("count", "k"), "total": ("sum", "v")}
    assert [tuple(r) for r in aggregate_by_rule(a, rule(), ["g"], aggs).collect()] == [("x", 2, 12)]
    assert [tuple(r) for r in overlap_by_rule(a, b, rule(), ["k"], ["g"], aggs).collect()] == [("x", 2, 12)]
    for refused in ({"n": ("max", "k")}, {"n": ("count", "v")}):
        with pytest.raises(ValueError, match="aggregates not allowed"):
            aggregate_by_rule(a, rule(), ["g"], refused)
    with pytest.raises(ValueError, match="no output constraint"):
        aggregate_by_rule(a, rule(outputConstraints=[]), ["g"], aggs)
    with pytest.raises(ValueError, match="no output constraint"):
        aggregate_by_rule(a, analysis_rule("aggregation"), [], {})
    with pytest.raises(ValueError, match="join columns not allowed"):
        overlap_by_rule(a, b, rule(joinColumns=["v"]), ["k"], ["g"], aggs)
    listing = json.dumps({"v1": {"list": {"joinColumns": ["k", "v"], "listColumns": ["g"], "allowedJoinOperators": []}}})
    assert list_by_rule(a, b, listing, ["k"], ["g"]).count() == 2
    with pytest.raises(ValueError, match="OR"):
        list_by_rule(a, a, listing, ["k", "v"], ["g"])


def test_count_of_pairs(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "k int, d string")
    b = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    got = private_overlap(a, b, ["k"], ["d"], {"n": ("count", "*")}, "k", minimum=1)
    assert {r["d"]: r["n"] for r in got.collect()} == {"x": 3, "y": 2}
