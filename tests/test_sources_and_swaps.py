"""Footers, listings, file order, swaps, count checks that can fail, one-scan checks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from plans import count, plan
from splitweave.checks.layout import narrow
from splitweave.checks.monitoring import _refreshed_with_defects
from splitweave.checks.views import N, id_snapshots, mapping, read, stored_wide, wide_snapshots
from splitweave.functions.text import join_path
from splitweave.operators.columns import vertical_split
from splitweave.operators.identity import map_identities_by_rules
from splitweave.operators.joins import reassemble_bucketed
from splitweave.operators.layout import write_bucketed, write_ranges
from splitweave.operators.monitor import contract_problems, monitor
from splitweave.functions.policy import analysis_rule
from splitweave.operators.privacy import aggregate_by_rule, overlap_by_rule, private_overlap
from splitweave.operators.quality import check_split
from splitweave.operators.tables import create_bucketed, create_identity_table, fresh_path, swap_in
from splitweave.plans.pipelines import split_and_bucket
from splitweave.plans.submit import _parser, run
from splitweave.sources.footers import footers, listed_files, narrow_sizes, tasks_can_list
from splitweave.sources.inventory import file_inventory
from splitweave.sources.mapping import mapping_columns, read_mapping
from splitweave.sources.paths import shared_scratch
from splitweave.sources.snapshots import read_sources, write_sources


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- listings and footers


def test_many_files_take_few_tasks(spark, tmp_path):
    want = 0
    for d in range(40):
        folder = tmp_path / f"t{d % 4}" / f"id_bucket={d}"
        folder.mkdir(parents=True)
        for f in range(50):
            (folder / f"f{f}.bin").write_bytes(b"x" * (f + d))
            want += f + d
        (folder / "_SUCCESS").write_bytes(b"no")
        (folder / ".f.crc").write_bytes(b"no")
    got = listed_files(spark, str(tmp_path), tasks=8)
    assert got.rdd.getNumPartitions() <= 8
    assert got.agg(F.sum("bytes")).first()[0] == want
    assert got.count() == 40 * 50 - 1  # one is empty
    names = rows(got.groupBy(F.element_at(F.split("directory", "/"), -1)).agg(F.count_distinct("id_bucket")))
    assert names == [("t0", 10), ("t1", 10), ("t2", 10), ("t3", 10)]
    assert rows(got) == rows(file_inventory(spark, str(tmp_path)))
    assert listed_files(spark, str(tmp_path), "f7.bin").count() == 40


def test_listing_of_one_file_and_of_nothing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("abc")
    assert [(r["bytes"], r["id_bucket"]) for r in listed_files(spark, str(tmp_path / "a.txt")).collect()] == [(3, None)]
    os.makedirs(tmp_path / "empty")
    assert listed_files(spark, str(tmp_path / "empty")).count() == 0
    assert tasks_can_list(str(tmp_path)) and not tasks_can_list("viewfs://store/in")


def test_footers_tell_sizes_and_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", F.col("id").cast("string").alias("s"), F.struct(F.col("id").alias("x"), F.lit("y").alias("z")).alias("n")).repartition(3).write.parquet(path)
    got = footers(spark, path)
    per = {r["column_name"]: (r["n"], r["b"]) for r in got.groupBy("column_name").agg(F.sum("rows").alias("n"), F.sum("bytes").alias("b")).collect()}
    assert set(per) == {"id", "s", "n"} and {n for n, _ in per.values()} == {1000}
    files = listed_files(spark, path, "*.parquet").agg(F.sum("bytes")).first()[0]
    assert 0.5 * files < sum(b for _, b in per.values()) < files
    sizes = {r["table_name"]: r["bytes"] for r in narrow_sizes(spark, path, {"A": ["s"], "B": ["S", "n"], "C": ["missing"]}, "ID").collect()}
    assert sizes == {"A": per["id"][1] + per["s"][1], "B": sum(b for _, b in per.values()), "C": per["id"][1]}


def test_split_and_bucket_writes_each_row_once(spark, sf):
    """No job writes anything but the narrow tables and their two small control files."""
    target = shared_scratch(spark, "target")
    plan_rows = split_and_bucket(spark, wide_snapshots(spark, sf), target, mapping=mapping(spark), n=8)
    got = {r["table_name"]: (r["planned_files"], r["written_files"]) for r in plan_rows.collect()}
    assert got == {t: (24, 8) for t in ("SEG_01", "GEO_01", "ORD_01")}
    for t, df in vertical_split(stored_wide(spark, sf), mapping(spark)).items():
        assert rows(spark.read.parquet(join_path(target, t))) == rows(df)
    assert set(read_sources(spark, target)) == {"seg_01", "geo_01", "ord_01"}


def test_sources_are_replaced_by_group(spark):
    root = shared_scratch(spark, "sources")
    assert read_sources(spark, root) == {}
    write_sources(spark, root, "ids", [("IDS", "2001-01-01", "/a")])
    write_sources(spark, root, "attributes", [("T1", "2001-02-01", "/b"), ("T2", "2001-02-01", "/b")])
    write_sources(spark, root, "attributes", [("T1", "2001-03-01", "/c")])
    assert read_sources(spark, root) == {"ids": ("2001-01-01", "/a"), "t1": ("2001-03-01", "/c")}


def test_mapping_rows_are_numbered_over_files_and_splits(spark):
    path = shared_scratch(spark, "many")
    want = [(i, f"T{i % 3}", f"c{i}") for i in range(500)]
    lines = spark.createDataFrame(want, "i int, x_table string, x_column string")
    lines.repartitionByRange(7, "i").sortWithinPartitions("i").drop("i").write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    try:
        assert sorted(map(tuple, read_mapping(spark, path).collect())) == want
        assert mapping_columns(read_mapping(spark, path))["T1"] == [f"c{i}" for i in range(1, 500, 3)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# -- swap after write


def test_failed_write_keeps_the_old_table(spark, sf, db):
    seg, path = narrow(spark, sf, "SEG_01"), shared_scratch(spark, "swap")
    create_bucketed(spark, seg, f"{db}.t", path, n=4)
    before = rows(spark.table(f"{db}.t"))
    with pytest.raises(Exception, match="broken"):
        create_bucketed(spark, seg.withColumn("c_name", F.raise_error(F.lit("broken")).cast("string")), f"{db}.t", path, n=4)
    with pytest.raises(RuntimeError, match="3 rows were written of 5"):
        swap_in(spark, f"{db}.t", 5, lambda name: spark.range(3).write.option("path", shared_scratch(spark, "few")).saveAsTable(name))
    spark.catalog.refreshTable(f"{db}.t")
    assert rows(spark.table(f"{db}.t")) == before
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["t"]
    assert fresh_path(spark, path) != path and fresh_path(spark, path + "-none") == path + "-none"


def test_identity_copy_swaps(spark, sf, db):
    spark.createDataFrame([(1, "a"), (2, "b")], "customer_user_id int, x string").write.option("path", shared_scratch(spark, "s")).saveAsTable(f"{db}.s")
    path = shared_scratch(spark, "er")
    for force in (False, True, True):
        assert create_identity_table(spark, f"{db}.s", f"{db}.s_er", path, force) == "created"
    assert create_identity_table(spark, f"{db}.s", f"{db}.s_er", path) == "skipped"
    assert [r["x"] for r in spark.table(f"{db}.s_er").orderBy("x").collect()] == ["a", "b"]
    spark.range(1).write.saveAsTable(f"{db}.managed")
    with pytest.raises(ValueError):
        swap_in(spark, f"{db}.managed", 1, lambda name: None)


# -- checks that can fail


def test_refresh_sees_its_defects(spark, sf):
    db, steps, root = _refreshed_with_defects(spark, sf)
    alerts = {(r["table_name"], r["alert"].split(":")[0]) for r in spark.read.json(join_path(root, "base", "monitor", "json", "alerts")).select("table_name", "alert").collect()}
    assert ("part_geo_01", "[COUNT_MISMATCH] part_geo_01") in alerts and ("part_seg_01", "[COUNT_MISMATCH] part_seg_01") not in alerts
    assert ("part_seg_01", "[PK_DUPES] part_seg_01") in alerts
    texts = [r["alert"] for r in spark.read.json(join_path(root, "base", "monitor", "json", "alerts")).collect()]
    assert sum("too old" in t for t in texts) == 1 and any("attributes/snapshot_dt=2001-06-01=" in t for t in texts)


def test_source_contract_and_other_prefixes(spark, db):
    """A source that lacks the key alerts; prefixes of more than one word are taken off whole."""
    for name, df in (("mine_new_t", spark.createDataFrame([(1, "a")], "customer_user_id int, x string")), ("src_t", spark.createDataFrame([("a",)], "x string"))):
        df.write.option("path", shared_scratch(spark, name)).saveAsTable(f"{db}.{name}")
    detail = monitor(spark, db, prefix="mine_new_", n=4, as_of="2001-01-01", source_prefix="src_")
    from splitweave.operators.monitor import alert_rows

    said = [r["alert"] for r in alert_rows(detail, 4, source_prefix="src_", prefix="mine_new_").collect()]
    assert any("source src_t breaks the contract: missing required column customer_user_id" in s for s in said)
    assert contract_problems(["x"], [], "customer_user_id", False) == ["missing required column customer_user_id"]


# -- one scan, no product, no shuffle


def test_split_check_scans_the_source_once(spark, sf):
    wide = read(spark, sf, "customer").withColumnRenamed("c_custkey", "customer_user_id")
    groups = {f"T{i}": ["c_name"] for i in range(27)}
    tables = {t: read(spark, sf, "orders").select(F.col("o_custkey").alias("customer_user_id"), F.lit("x").alias("c_name")) for t in groups}
    text = plan(check_split(wide, tables, groups), "simple")
    assert text.count("c_custkey") and sum("FileScan" in line and "c_custkey" in line for line in text.splitlines()) == 1
    assert text.count("Exchange hashpartitioning(k") == 1
    got = check_split(wide, {"a": wide.limit(0), "b": wide.unionByName(wide.where("customer_user_id < 3"))}, {"a": ["c_name"], "b": wide.columns}).collect()
    n = wide.count()
    assert [(r["table_name"], r["source_rows"], r["rows"], r["missing_keys"], r["extra_keys"]) for r in sorted(got)] == [("a", n, 0, n, 0), ("b", n, n + 3, 0, 3)]
    assert [r["rows"] for r in check_split(wide.limit(0), {"a": wide.limit(0)}, {"a": wide.columns}).collect()] == [0]


def test_distinct_values_of_both_sides_form_no_product(spark):
    a = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("x"), (F.col("id") % 3).alias("da"))
    b = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("y"), F.when(F.col("id") % 2 == 0, F.col("id") % 4).alias("db"))
    aggs = {"xs": ("count_distinct", "x"), "ys": ("count_distinct", "y"), "n": ("count", "*"), "s": ("sum", "y")}
    out = private_overlap(a, b, ["k"], ["da", "db"], aggs, "x", minimum=1)
    got = {(r["da"], r["db"]): (r["xs"], r["ys"], r["n"], r["s"]) for r in out.collect()}
    xs = {d: len(range(d, 2000, 3)) for d in range(3)}
    ys = {None: range(1, 2000, 2), 0: range(0, 2000, 4), 2: range(2, 2000, 4)}
    assert got == {(d, e): (xs[d], len(v), xs[d] * len(v), xs[d] * sum(v)) for d in xs for e, v in ys.items()}

    def join_rows(node):
        mine = 0
        if "Join" in node.nodeName():
            metrics = node.metrics()
            mine = metrics.get("numOutputRows").get().value() if metrics.contains("numOutputRows") else 0
        kids = node.children()
        below = [kids.apply(i) for i in range(kids.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            below = [node.executedPlan()]
        if "QueryStage" in node.nodeName():
            below = [node.plan()]
        return mine + sum(join_rows(k) for k in below)

    out = private_overlap(a, b, ["k"], ["da", "db"], aggs, "x", minimum=1)
    frame = out._jdf
    frame.collectToPython()
    assert join_rows(frame.queryExecution().executedPlan()) < 20_000


def test_identity_rules_scan_each_side_once(spark, tmp_path):
    a = spark.range(60).select(F.col("id").alias("row_id"), *[F.when(F.col("id") % 6 == i, F.col("id")).alias(f"k{i}") for i in range(6)])
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = a.mapInArrow(passed, a.schema)
    b = a.withColumnRenamed("row_id", "target_id")
    got = map_identities_by_rules(counted, b, [(f"rule {i}", [f"k{i}"]) for i in range(6)])
    assert sorted(map(tuple, got.collect())) == [(i, i, f"rule {i % 6}") for i in range(60)]
    assert seen.value == 60


def test_identity_rules_compare_values_not_texts(spark):
    a = spark.createDataFrame([(1, 5, 0.0, b"\x01"), (2, 6, 1.5, None)], "row_id int, n int, d double, x binary")
    b = spark.createDataFrame([("p", 5, -0.0, b"\x01"), ("q", 6, 1.5, b"\x02")], "target_id string, n bigint, d double, x binary")
    got = map_identities_by_rules(a, b, [("all", ["n", "d", "x"]), ("number", "n")])
    assert sorted(map(tuple, got.collect())) == [(1, "p", "all"), (2, "q", "number")]
    times = spark.sql("SELECT 1 AS row_id, timestamp'2001-01-01 00:00:00.000001' AS t UNION ALL SELECT 2, timestamp'2001-01-01 00:00:00.000002'")
    got = map_identities_by_rules(times, times.withColumnRenamed("row_id", "target_id"), [("time", "t")])
    assert sorted(map(tuple, got.collect())) == [(1, 1, "time"), (2, 2, "time")]


def test_removed_rows_make_later_keys_unique(spark):
    """A key is judged among the rows that are still open, not among all."""
    a = spark.createDataFrame([(1, "a", "m"), (2, None, "m")], "row_id int, k string, mail string")
    b = spark.createDataFrame([(11, "a", "m"), (12, None, "m")], "target_id int, k string, mail string")
    got = map_identities_by_rules(a, b, [("k", "k"), ("mail", "mail")])
    assert sorted(map(tuple, got.collect())) == [(1, 11, "k"), (2, 12, "mail")]


def test_reassembly_of_bucketed_tables_has_no_shuffle(spark, sf, db):
    for t in ("SEG_01", "GEO_01", "ORD_01"):
        write_bucketed(narrow(spark, sf, t), f"{db}.{t.lower()}", shared_scratch(spark, t), n=N)
    names = [f"{db}.{t}" for t in ("seg_01", "geo_01", "ord_01")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = reassemble_bucketed(spark, names)
        assert count(wide, "Exchange") == 0 and count(wide, "SortMergeJoin") == 2
        assert wide.count() == read(spark, sf, "customer").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    twice = narrow(spark, sf, "SEG_01").limit(3)
    write_bucketed(twice.unionByName(twice), f"{db}.twice", shared_scratch(spark, "twice"), n=N)
    with pytest.raises(Exception, match="keys are not unique"):
        reassemble_bucketed(spark, [names[1], f"{db}.twice"]).collect()
    write_bucketed(twice.withColumn("customer_user_id", F.lit(None).cast("bigint")), f"{db}.nulls", shared_scratch(spark, "nulls"), n=N)
    with pytest.raises(ValueError, match="NULL keys"):
        reassemble_bucketed(spark, [names[1], f"{db}.nulls"])
    write_bucketed(twice, f"{db}.other", shared_scratch(spark, "other"), n=4)
    with pytest.raises(ValueError, match="bucketed alike"):
        reassemble_bucketed(spark, [names[1], f"{db}.other"])


# -- ranges


def test_ranges_cut_only_keys_that_outgrow_a_file(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 7 == 1, F.lit(None)).otherwise(F.col("id") % 500).cast("bigint")
    df = spark.range(30_000).select(key.alias("customer_user_id"), F.col("id").alias("v"))
    path = shared_scratch(spark, "ranges")
    manifest = {r["key"]: (r["rows"], r["files"]) for r in write_ranges(df, path, files=10, max_rows=2000).collect()}
    want = {r[0]: r[1] for r in df.groupBy("customer_user_id").count().collect()}
    assert manifest == {k: (n, -(-n // 2000)) for k, n in want.items() if n > 2000} and set(manifest) == {7, None}
    back = spark.read.parquet(path)
    assert back.count() == 30_000 and back.agg(F.sum("v")).first()[0] == sum(range(30_000))
    spread = back.withColumn("f", F.col("_metadata.file_path")).groupBy("customer_user_id").agg(F.count_distinct("f").alias("n"))
    files = {r["customer_user_id"]: r["n"] for r in spread.collect()}
    assert {k: n for k, n in files.items() if n > 1} == {k: f for k, (_, f) in manifest.items()}
    sizes = [r[1] for r in back.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) <= 2600
    assert write_ranges(df.limit(0), shared_scratch(spark, "none")).count() == 0


def test_small_files_of_ranges_share_tasks(spark):
    key = F.when(F.col("id") % 4 == 0, F.concat(F.lit("k"), F.col("id") % 100)).otherwise(F.concat(F.lit("u"), F.floor(F.col("id") / 8)))
    df = spark.range(12_000).select(
        F.when(F.col("id") % 1000 == 3, F.lit(None)).otherwise(key).alias("customer_user_id"), "id",
        F.timestamp_seconds(F.col("id") * 0.25).alias("t"), F.expr("timestamp_ntz'1500-01-01 00:00:00'").alias("n"), F.expr("date'1200-02-29'").alias("d"),
        (F.col("id") / 7).cast("decimal(20,5)").alias("x"), F.struct(F.array("id").alias("a"), F.lit(None).cast("string").alias("b")).alias("s"),
        F.expr("interval '1' day").alias("i"), F.encode(F.col("id").cast("string"), "utf-8").alias("y"), F.lit(1).cast("tinyint").alias("z"),
    )
    path = shared_scratch(spark, "ranges")
    write_ranges(df, path, files=3, max_rows=9_000)
    spark.sparkContext.setJobGroup("small-files", "")
    try:
        manifest = {r["key"]: r for r in write_ranges(df, path, files=10, max_rows=10).collect()}
        jobs = [spark.sparkContext.statusTracker().getJobInfo(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup("small-files")]
        tasks = max(spark.sparkContext.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds if spark.sparkContext.statusTracker().getStageInfo(s))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    back = spark.read.parquet(path)
    assert back.dtypes == df.dtypes and back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    places = back.groupBy("customer_user_id").agg(F.collect_set(F.col("_metadata.file_name")).alias("f")).collect()
    names = {n for r in places for n in r["f"]}
    assert len(names) > 500 and tasks <= 20
    assert {r["customer_user_id"] for r in places if len(r["f"]) > 1} == set(manifest) and None in manifest
    for r in places:
        numbers = {int(n.split("-")[1].split(".")[0]) for n in r["f"]}
        cut = manifest.get(r["customer_user_id"])
        assert len(numbers) == 1 if cut is None else numbers <= set(range(cut["first_file"], cut["first_file"] + cut["files"]))
    own = [n for r in manifest.values() for n in range(r["first_file"], r["first_file"] + r["files"])]
    assert len(own) == len(set(own)) and all(r["files"] == -(-r["rows"] // 10) for r in manifest.values())


def test_small_files_share_tasks_on_a_mounted_folder(spark):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.small.link./shared", "file://" + shared_scratch(spark, "mounted"))
    df = spark.range(3_000).select(F.floor(F.col("id") / 8).alias("customer_user_id"), "id")
    path = "viewfs://small/shared/ranges"
    spark.sparkContext.setJobGroup("mounted-files", "")
    try:
        assert write_ranges(df, path, files=10, max_rows=10).count() == 0
        jobs = [spark.sparkContext.statusTracker().getJobInfo(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup("mounted-files")]
        tasks = max(spark.sparkContext.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds if spark.sparkContext.statusTracker().getStageInfo(s))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    back = spark.read.parquet(path)
    assert back.dtypes == df.dtypes and back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert back.select("_metadata.file_name").distinct().count() > 200 and tasks <= 20


# -- rules, options


def test_rules_enforce_scalar_functions_and_operators(spark):
    rows = spark.createDataFrame([(i, f"x{i % 2}", -1.5) for i in range(6)], "k int, c string, v double")
    aggs = {"n": ("count", "k")}
    rule = analysis_rule("aggregation", columns=["k", "c", "v"], joins=["k", "c"], functions=["UPPER"])
    assert rows_of_rule(aggregate_by_rule(rows, rule, ["u"], aggs, {"u": ("upper", "c")})) == [("X0", 3), ("X1", 3)]
    for scalars in ({"u": ("lower", "c")}, {"u": ("reverse", "c")}):
        with pytest.raises(ValueError, match="scalar functions not allowed"):
            aggregate_by_rule(rows, rule, ["u"], aggs, scalars)
    every = analysis_rule("aggregation", columns=["k", "c", "v"])
    assert rows_of_rule(aggregate_by_rule(rows, every, ["a"], aggs, {"a": ("abs", "v")})) == [(1.5, 6)]
    with pytest.raises(ValueError, match="dimensions not allowed"):
        aggregate_by_rule(rows, analysis_rule("aggregation", columns=["k"]), ["u"], aggs, {"u": ("upper", "c")})
    either = json.loads(rule)
    either["v1"]["aggregation"]["allowedJoinOperators"] = ["OR"]
    with pytest.raises(ValueError, match="AND"):
        overlap_by_rule(rows, rows.select("k", "c"), json.dumps(either), ["k", "c"], ["c"], aggs)


def rows_of_rule(df):
    return sorted(map(tuple, df.collect()))


def test_command_line_of_refresh_readiness_and_monitor(spark, sf, db, tmp_path):
    paths = {"mapping": str(tmp_path / "m.csv")}
    (tmp_path / "m.csv").write_text("A_TABLE,A_COLUMN\nGEO_01,n_name\nGEO_01,r_name\n")
    for name, line in (("configured", {"name": "part_geo_01", "id": "c1"}), ("rules", {"id": "c1", "document": "{}"}), ("associations", {"association_name": "acx_part_geo_01", "result_rule": None})):
        paths[name] = str(tmp_path / f"{name}.json")
        (tmp_path / f"{name}.json").write_text(json.dumps(line) + "\n")
    registry = f"--configured {paths['configured']} --rules {paths['rules']} --associations {paths['associations']} --collaboration Spring"
    target = shared_scratch(spark, "cli")
    line = f"refresh --database {db} --ids {id_snapshots(spark, sf)} --attributes {wide_snapshots(spark, sf)} --mapping {paths['mapping']} --target {target} --bucket-count 4 {registry}"
    done = {(r["step"], r["table_name"], r["status"]) for r in run(spark, _parser().parse_args(line.split())).collect()}
    assert ("monitor", "part_geo_01", "ok") in done and ("readiness", "part_geo_01", "not_ready") in done
    report = run(spark, _parser().parse_args(f"readiness --database {db} --target {target}_r {registry}".split()))
    assert {(r["collaboration_name"], r["configured_table_name"]) for r in report.collect()} == {("Spring", "part_geo_01"), ("Spring", "N/A")}
    line = f"monitor --database {db} --target {target}_m --bucket-count 4 --no-count-check --file-size-check --file-size-min-mb 0 --file-size-max-mb 0.000001 --source-prefix src_"
    alerts = [r["alert"] for r in run(spark, _parser().parse_args(line.split())).collect()]
    assert sum("file-size issues (sample)" in a and "]... of 4" in a for a in alerts) == 2 and not any("COUNT" in a or "not found" in a for a in alerts)
