"""Defects, reruns, partial refresh, skipped steps."""

import os

import pytest
from pyspark.sql import functions as F

from splitweave.checks.views import AS_OF, CHECKED_AT, N, id_snapshots, mapping, stored_wide, wide_snapshots
from splitweave.functions.keys import bucket_of
from splitweave.functions.text import join_path
from splitweave.operators.columns import allowed_projection, canonical_key, capped_projection, registered_columns, vertical_split, versioned_path
from splitweave.operators.identity import map_identities
from splitweave.operators.joins import reassemble
from splitweave.operators.layout import write_parts
from splitweave.operators.monitor import monitor
from splitweave.operators.quality import duplicate_rows
from splitweave.operators.skew import hot_keys
from splitweave.operators.tables import create_identity_table, ensure_partitioned, register_external
from splitweave.plans.pipelines import bucketed_build, identity_build, monitor_and_report, refresh, register_and_prepare, split_and_bucket, split_and_part
from splitweave.plans.submit import _parser, run
from splitweave.sources.catalog import properties, registered_type, table_names
from splitweave.sources.inventory import dir_bytes, discover_tables, file_inventory, storage_partitions
from splitweave.sources.mapping import mapping_columns, mapping_errors, read_mapping
from splitweave.sources.paths import child_names, shared_scratch
from splitweave.sources.snapshots import latest_snapshot, read_marker, read_marker_under, resolve_snapshot


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_latest_snapshot(spark, sf):
    base = wide_snapshots(spark, sf)
    assert latest_snapshot(spark, base) == "2001-06-01"
    assert [resolve_snapshot(spark, base, x) for x in (None, "", "_NONE_", "2001-05-01")] == ["2001-06-01"] * 3 + ["2001-05-01"]
    with pytest.raises(FileNotFoundError):
        latest_snapshot(spark, shared_scratch(spark, "nothing"))


def test_missing_key(spark):
    with pytest.raises(ValueError):
        canonical_key(spark.range(1))


def test_split_twice_gives_the_same(spark, sf):
    path = shared_scratch(spark, "twice")
    done = [rows(split_and_part(spark, wide_snapshots(spark, sf), path, mapping(spark), n=4)) for _ in range(2)]
    assert done[0] == done[1]
    assert {(r[2], r[3]) for r in done[0]} == {("written", "SEG_01"), ("written", "GEO_01"), ("written", "ORD_01"), ("skipped", "BAD_01")}
    assert spark.read.parquet(join_path(path, "SEG_01")).count() == stored_wide(spark, sf).count()
    assert read_marker_under(spark, path) == "2001-06-01"
    assert read_marker(spark, join_path(path, "SEG_01")) == "2001-06-01"
    assert set(discover_tables(spark, path)) == {"SEG_01", "GEO_01", "ORD_01"}


def test_full_replace_removes_old_buckets(spark):
    path = shared_scratch(spark, "replace")
    users = spark.range(100).select(F.col("id").alias("customer_user_id"))
    write_parts(users, path, n=4)
    write_parts(users.where("customer_user_id = 1"), path, n=4, replace="present")
    assert storage_partitions(spark, path).count() == 4
    write_parts(users.where("customer_user_id = 1"), path, n=4, replace="all")
    assert storage_partitions(spark, path).count() == 1


def test_each_key_in_one_bucket(spark, sf):
    path = shared_scratch(spark, "one")
    write_parts(vertical_split(stored_wide(spark, sf), mapping(spark))["SEG_01"], path, n=N)
    per_key = spark.read.parquet(path).groupBy("customer_user_id").agg(F.count_distinct("id_bucket").alias("n"), F.max("id_bucket").alias("b"))
    assert per_key.where(f"n <> 1 or b not between 0 and {N - 1}").isEmpty()
    assert all(len(child_names(spark, join_path(path, d), directories=False)) <= 2 for d in child_names(spark, path))


def test_split_and_bucket_plan(spark, sf):
    target, staging = shared_scratch(spark, "target"), shared_scratch(spark, "staging")
    plan = split_and_bucket(spark, wide_snapshots(spark, sf), target, staging, mapping(spark), n=64)
    got = {r["table_name"]: (r["planned_files"], r["written_files"]) for r in plan.collect()}
    assert got == {t: (24, 24) for t in ("SEG_01", "GEO_01", "ORD_01")}
    assert child_names(spark, staging) == []


def test_split_and_bucket_from_a_measured_share(spark, sf):
    target, staging = shared_scratch(spark, "target"), shared_scratch(spark, "staging")
    plan = split_and_bucket(spark, wide_snapshots(spark, sf), target, staging, mapping(spark), n=8, measured_share=0.5)
    assert {r["written_files"] for r in plan.collect()} <= {7, 8}
    source = vertical_split(stored_wide(spark, sf), mapping(spark))
    for t, df in source.items():
        assert rows(spark.read.parquet(join_path(target, t))) == rows(df)


def test_directory_size(spark, sf):
    path = shared_scratch(spark, "size")
    spark.range(1000).coalesce(1).write.parquet(path)
    assert dir_bytes(spark, path) == file_inventory(spark, path).first()["bytes"] > 1000


def test_reassemble_refuses_repeated_keys(spark):
    users = spark.createDataFrame([(1, "a"), (1, "b")], "customer_user_id bigint, x string")
    with pytest.raises(ValueError):
        reassemble([users, users.select("customer_user_id")])


def test_duplicate_rows_counts_null_group(spark):
    keys = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",), ("b",)], "customer_user_id string")
    assert duplicate_rows(keys).first()[0] == 5
    assert duplicate_rows(keys.where("customer_user_id = 'a'")).first()[0] == 0


def test_mapping_file_with_any_headers(spark):
    path = shared_scratch(spark, "csv")
    spark.createDataFrame([("T1", "a", "x"), ("T1", "b", "y"), ("T2", "A", "z"), ("T2", "a", "w")], "x_table string, x_column string, d string").coalesce(
        1
    ).write.option("header", True).csv(path)
    m = read_mapping(spark, path)
    assert mapping_columns(m) == {"T1": ["a", "b"], "T2": ["A", "a"]}
    wide = spark.createDataFrame([(1, 2)], "Customer_User_id int, a int")
    assert {(r["table_name"], r["problem"]) for r in mapping_errors(wide, m).collect()} == {("T1", "missing"), ("T2", "repeated")}
    assert vertical_split(wide, m) == {}


def test_cap_keeps_key_and_partition(spark):
    df = spark.range(1).select(*[F.lit(i).alias(f"a{i}") for i in range(120)], F.col("id").alias("customer_user_id"), F.lit(1).alias("id_bucket"))
    kept, dropped = registered_columns(df, 100)
    assert len(kept) == 101 and kept[-2:] == ["customer_user_id", "id_bucket"] and len(dropped) == 21


def test_registered_types(spark):
    schema = spark.sql(
        "select cast(1 as decimal(9,2)) d, array(cast(1 as float)) a, map('k', named_struct('x', 1y)) m, timestamp_ntz'2020-01-01 00:00:00' t, "
        "interval 1 day i, x'00' b"
    ).schema
    assert [registered_type(f.dataType) for f in schema] == [
        "decimal(9,2)", "array<float>", "map<string,struct<x:tinyint>>", "string", "string", "binary",
    ]


def test_broken_directory_does_not_stop_registration(spark, db):
    root = shared_scratch(spark, "broken")
    spark.range(3).write.parquet(join_path(root, "Good"))
    spark.range(3).selectExpr("cast(id as string) as value").write.text(join_path(root, "bad"))
    got = {r["table_name"]: r["status"] for r in register_external(spark, db, root, "ext_").collect()}
    assert got["ext_good"] == "registered" and got["ext_bad"].startswith("failed")
    assert spark.table(f"{db}.ext_good").count() == 3


def test_root_with_files_only_is_one_table(spark):
    root = shared_scratch(spark, "single")
    spark.range(3).write.parquet(root)
    assert list(discover_tables(spark, root).values()) == [root]


def test_identity_table_states(spark, db):
    path = shared_scratch(spark, "er")
    spark.range(3).select(F.col("id").alias("customer_user_id"), F.lit(1).alias("id_bucket")).write.saveAsTable(f"{db}.part_a")
    spark.range(3).write.saveAsTable(f"{db}.part_b")
    assert create_identity_table(spark, f"{db}.none", f"{db}.none_er", path) == "skipped"
    assert create_identity_table(spark, f"{db}.part_b", f"{db}.part_b_er", path) == "skipped"
    assert create_identity_table(spark, f"{db}.part_a", f"{db}.part_a_er", path) == "created"
    assert create_identity_table(spark, f"{db}.part_a", f"{db}.part_a_er", path) == "skipped"
    assert create_identity_table(spark, f"{db}.part_a", f"{db}.part_a_er", path, force=True) == "created"
    assert spark.table(f"{db}.part_a_er").columns == ["row_id", "customer_user_id"]


def test_versioned_path():
    assert versioned_path("s3://b/x/", "t", "20240101T000000Z") == "s3://b/x/t/v=20240101T000000Z"
    assert versioned_path("s3://b/x", "t", "_NONE_") == versioned_path("s3://b/x", "t") == "s3://b/x/t"


def test_bucketed_build_reports_failures(spark, sf, db):
    spark.range(9).select(F.col("id").alias("customer_user_id"), F.lit("x").alias("a")).write.saveAsTable(f"{db}.ext_good")
    spark.range(9).write.saveAsTable(f"{db}.ext_nokey")
    got = {r["table_name"]: r["status"] for r in bucketed_build(spark, db, shared_scratch(spark, "b"), dt="2001-06-01", n=4).collect()}
    assert got["bucketed_good"] == "created" and got["bucketed_nokey"].startswith("failed")
    assert properties(spark, f"{db}.bucketed_good")["snapshot_dt"] == "2001-06-01"


def test_monitor_refuses_comparing_a_table_with_itself(spark, db):
    with pytest.raises(ValueError):
        monitor(spark, db, source_prefix="part_", as_of=AS_OF)


def test_refresh_steps_can_be_skipped(spark, sf, db):
    base = shared_scratch(spark, "skip")
    report = refresh(
        spark, db, id_snapshots(spark, sf), wide_snapshots(spark, sf), mapping(spark), base, AS_OF, CHECKED_AT, n=2,
        skip=("attributes", "identity", "monitor"),
    )
    assert {r["step"] for r in report.collect()} == {"ids", "register", "prepare"}
    assert table_names(spark, db) == ["ext_addressable_ids", "part_addressable_ids"]


def test_file_size_check_in_monitor(spark, sf, db):
    base = shared_scratch(spark, "sizes")
    refresh(
        spark, db, id_snapshots(spark, sf), wide_snapshots(spark, sf), mapping(spark), base, AS_OF, CHECKED_AT, n=2, skip=("identity", "monitor"),
    )
    detail = monitor(spark, db, n=2, as_of=AS_OF, file_size_check=True)
    assert {r["table_name"]: len(r["file_issues"]) for r in detail.collect()} == {
        f"part_{t}": 2 for t in ("addressable_ids", "seg_01", "geo_01", "ord_01")
    }


def test_readiness_of_the_catalog(spark, sf, db):
    base = shared_scratch(spark, "ready")
    configured = spark.createDataFrame([("part_seg_01", "c1"), ("part_geo_01", "c2"), ("part_other", "c3")], "name string, id string")
    rules = spark.createDataFrame([("c1", '{"v1":{"custom":{"allowedAnalysisProviders":["9"]}}}'), ("c2", "{}")], "id string, document string")
    associations = spark.createDataFrame([("acx_part_seg_01",), ("acx_part_geo_01",)], "association_name string")
    report = refresh(
        spark, db, id_snapshots(spark, sf), wide_snapshots(spark, sf), mapping(spark), base, AS_OF, CHECKED_AT, n=2, skip=("identity", "monitor"),
        registry={"configured": configured, "rules": rules, "associations": associations},
    )
    assert {(r["table_name"], r["status"]) for r in report.where("step = 'readiness'").collect()} == {
        ("part_seg_01", "ready"), ("part_geo_01", "not_ready"), ("part_ord_01", "not_ready"),
    }
    written = spark.read.option("header", True).csv(join_path(base, "readiness", "csv"))
    assert {r["table_name"]: r["partition_keys"] for r in written.collect()}["part_seg_01"] == "id_bucket"
    assert spark.read.json(join_path(base, "readiness", "json", "summary")).first()["ready"] == 1


def test_monitor_repairs_before_counting(spark, sf, db):
    root = shared_scratch(spark, "repair")
    write_parts(vertical_split(stored_wide(spark, sf), mapping(spark))["SEG_01"], join_path(root, "seg_01"), n=4)
    register_external(spark, db, root, "part_")
    ensure_partitioned(spark, f"{db}.part_seg_01")
    out = shared_scratch(spark, "repaired")
    report, alerts = monitor_and_report(spark, db, out, AS_OF, CHECKED_AT, 4, repair="targeted")
    assert report.first()["missing_glue_count"] == 4 and spark.table(f"{db}.part_seg_01").count() > 0
    assert report.first()["count_part"] == str(spark.table(f"{db}.part_seg_01").count())
    assert alerts.where("alert like '%catalog misses 4 partitions%'").count() > 0
    row = spark.read.json(join_path(out, "json", "repairs")).first()
    assert (row["registered_before"], row["registered_after"], row["stored"]) == (0, 4, 4)
    assert monitor_and_report(spark, db, out, AS_OF, CHECKED_AT, 4)[0].first()["missing_glue_count"] == 0


def test_command_line(spark, sf, db):
    target = shared_scratch(spark, "cli")
    for line in (
        f"split-and-part --source {id_snapshots(spark, sf)} --target {target} --bucket-count 2",
        f"prepare --database {db} --root {target}",
        f"register --database {db} --root {target}",
        f"bucketed --database {db} --target {target}_b --bucket-count 2 --version v1",
        f"identity --database {db} --target {target}_i",
        f"monitor --database {db} --target {target}_m --bucket-count 2 --strict-snapshot",
    ):
        run(spark, _parser().parse_args(line.split()))
    assert table_names(spark, db) == ["bucketed_addressable_ids", "ext_addressable_ids", "part_addressable_ids", "part_addressable_ids_er"]
    bucket = f"split-and-bucket --source {id_snapshots(spark, sf)} --target {target}_f --bucket-count 4 --target-file-mb 100"
    assert run(spark, _parser().parse_args(bucket.split())).first()["written_files"] <= 4


def test_managed_tables_are_not_redefined(spark, db):
    spark.range(3).write.saveAsTable(f"{db}.part_m")
    with pytest.raises(ValueError):
        ensure_partitioned(spark, f"{db}.part_m")
    assert spark.table(f"{db}.part_m").count() == 3


def test_monitor_goes_on_past_a_broken_table(spark, db):
    """One table with a damaged file, one without the key, one good: the damaged one has an alert, the others their counts."""
    root, source = shared_scratch(spark, "broken"), shared_scratch(spark, "broken-src")
    rows = spark.range(50).select(F.col("id").alias("customer_user_id"), F.col("id").alias("v"))
    for t, df in (("bad", rows), ("good", rows), ("nokey", rows.select(F.col("v").alias("other"), (F.col("v") % 2).cast("int").alias("id_bucket")))):
        if t == "nokey":
            df.write.partitionBy("id_bucket").parquet(join_path(root, t))
        else:
            write_parts(df, join_path(root, t), n=2)
        df.write.parquet(join_path(source, t))
    register_and_prepare(spark, db, root)
    register_external(spark, db, source, "ext_")
    for folder, _, files in os.walk(join_path(root, "bad").removeprefix("file:")):
        for f in files:
            if f.endswith(".parquet"):
                with open(os.path.join(folder, f), "wb") as out:
                    out.write(b"PAR1 damaged PAR1")
                if os.path.exists(crc := os.path.join(folder, f".{f}.crc")):
                    os.remove(crc)
    report, alerts = monitor_and_report(spark, db, shared_scratch(spark, "out"), AS_OF, CHECKED_AT, 2)
    counts = {r["table"]: (r["count_part"], r["count_src"], r["pk_nulls"], r["pk_dupes"]) for r in report.collect()}
    assert counts == {"part_bad": ("", "", "", ""), "part_good": ("50", "50", "0", "0"), "part_nokey": ("50", "50", "", "")}
    said = [(r["table_name"], r["alert"]) for r in alerts.collect()]
    assert [t for t, a in said if "not counted, failed: " in a] == ["part_bad"]
    assert not [a for _, a in said if "source table not found" in a] and "part_good" not in {t for t, _ in said}


def test_monitor_without_counts_and_with_few_tables(spark, sf, db):
    root = shared_scratch(spark, "nocount")
    for t in ("a", "b"):
        write_parts(spark.range(50).select(F.col("id").alias("customer_user_id")), join_path(root, t), n=2)
    register_and_prepare(spark, db, root)
    report, alerts = monitor_and_report(spark, db, shared_scratch(spark, "out"), AS_OF, CHECKED_AT, 2, count_check=False, max_tables=1)
    assert [(r["table"], r["count_part"], r["pk_nulls"]) for r in report.collect()] == [("part_a", "", "")]
    assert alerts.isEmpty()


def test_string_keys(spark, db):
    """Keys are text in many snapshots: same bucket everywhere, same rows back, matches by text."""
    users = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("CUSTOMER_USER_ID"),
        F.col("id").alias("v"),
    )
    source, target = shared_scratch(spark, "text"), shared_scratch(spark, "text-parts")
    users.write.parquet(join_path(source, "snapshot_dt=2024-01-01"))
    m = spark.createDataFrame([(0, "T", "v")], "pos bigint, table_name string, column_name string")
    split_and_part(spark, source, target, m, n=8)
    back = spark.read.parquet(join_path(target, "T"))
    assert back.count() == 3000 and back.where(F.col("id_bucket") != bucket_of("customer_user_id", 8)).isEmpty()
    ids = back.select("customer_user_id", F.col("customer_user_id").alias("row_id"))
    found = map_identities(ids, ids.select("customer_user_id", F.col("row_id").alias("target_id")), "customer_user_id")
    assert {r["status"]: r["count"] for r in found.groupBy("status").count().collect()} == {"matched": 2000, "ambiguous": 1}
    assert hot_keys(back, "customer_user_id", min_rows=100, share=0.01) == ["hot"]


def test_no_column_is_lost_without_a_cap(spark):
    wide = spark.range(3).select(F.col("id").alias("customer_user_id"), *[F.lit(i).alias(f"a{i}") for i in range(130)], F.lit(0).alias("id_bucket"))
    assert capped_projection(wide).columns == wide.columns
    assert registered_columns(wide) == (wide.columns, [])
    assert allowed_projection(wide, partition_keys=["id_bucket"]).columns == wide.columns
    assert allowed_projection(wide, partition_keys=["id_bucket"], max_cols=10).columns == [*wide.columns[:9], "id_bucket"]


def test_mapping_with_null_rows_is_read_whole(spark, monkeypatch):
    rows = [(i, "T" if i % 3 else None, f"c{i}") for i in range(14)]
    m = spark.createDataFrame(rows, "pos bigint, table_name string, column_name string")
    monkeypatch.setattr("splitweave.sources.mapping.MAX_MAPPING_ROWS", 9)
    assert mapping_columns(m) == {"T": [c for _, t, c in rows if t]}
    monkeypatch.setattr("splitweave.sources.mapping.MAX_MAPPING_ROWS", 8)
    with pytest.raises(ValueError):
        mapping_columns(m)


def test_one_broken_table_does_not_stop_the_others(spark, db, tmp_path):
    root = tmp_path / "parts"
    for t in ("good", "bad"):
        write_parts(spark.range(40).select(F.col("id").alias("customer_user_id"), F.lit(1).alias("x")), str(root / t), n=4)
    register_and_prepare(spark, db, str(root))
    for f in (root / "bad").rglob("*.parquet"):
        f.write_bytes(b"PAR1 no Parquet file PAR1")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    spark.catalog.refreshTable(f"{db}.part_bad")
    copies = {r["table_name"]: r["status"] for r in identity_build(spark, db, str(tmp_path / "ids")).collect()}
    assert copies["part_bad_er"].startswith("failed") and not copies["part_good_er"].startswith("failed")
    done = {r["table_name"]: (r["status"], r["rows"]) for r in register_and_prepare(spark, db, str(root)).collect()}
    assert done["part_good"][1] == 40 and done["part_bad"][0].startswith("failed") and done["part_bad"][1] is None
