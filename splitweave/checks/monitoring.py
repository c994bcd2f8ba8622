"""Table monitor, alerts, reports, repair and the whole refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from splitweave.checks.layout import fresh_db, geo_parts, registered, split_root
from splitweave.checks.registered import query
from splitweave.checks.views import (
    AS_OF, CHECKED_AT, IDS, N, WIDE, bucket_ctes, id_snapshots, mapping, once, read, stored_wide, wide_snapshots,
)
from splitweave.functions.keys import BUCKET
from splitweave.functions.text import join_path
from splitweave.operators.columns import vertical_split, with_id_bucket
from splitweave.operators.layout import write_parquet, write_parts
from splitweave.operators.monitor import (
    alert_message, alert_rows, auto_repair, check_contract, file_size_issues, monitor, partition_integrity, report_rows,
)
from splitweave.operators.tables import add_missing, ensure_partitioned, register_external
from splitweave.plans.pipelines import monitor_and_report, refresh, register_and_prepare
from splitweave.sources.inventory import file_inventory
from splitweave.sources.paths import remove, shared_scratch
from splitweave.sources.snapshots import write_marker


def defective(spark, sf):
    """A clean table, one that lacks bucket 3 and has no source, one with repeated and NULL keys."""

    def write(root):
        tables = vertical_split(stored_wide(spark, sf), mapping(spark))
        big = read(spark, sf, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("customer_user_id"))
        orders = tables["ORD_01"]
        twice = orders.join(big, "customer_user_id", "left_semi").select(*orders.columns)
        unknown = twice.withColumn("customer_user_id", F.lit(None).cast("bigint"))
        parts, ext = join_path(root, "parts"), join_path(root, "ext")
        write_parts(tables["SEG_01"], join_path(parts, "seg_01"), n=N)
        write_parts(with_id_bucket(tables["GEO_01"], n=N).where("id_bucket <> 3"), join_path(parts, "geo_01"), n=N)
        write_parts(orders.unionByName(twice).unionByName(unknown), join_path(parts, "ord_01"), n=N)
        for t in ("SEG_01", "ORD_01"):
            write_parquet(tables[t], join_path(ext, t.lower()))
        write_marker(spark, parts, "2001-05-01")

    return once(spark, sf, "defective", write)


def monitored(spark, sf):
    db, root = fresh_db(spark), defective(spark, sf)
    register_and_prepare(spark, db, join_path(root, "parts"), "part_")
    register_external(spark, db, join_path(root, "ext"), "ext_")
    return db


STATE = f"""WITH {WIDE}, {bucket_ctes('w', 'b')},
  x AS (SELECT count(*) AS n, count(DISTINCT id_bucket) AS buckets, count(DISTINCT id_bucket) FILTER (WHERE id_bucket <> 3) AS geo_buckets,
    count(*) FILTER (WHERE id_bucket <> 3) AS geo,
    count(*) FILTER (WHERE customer_user_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)) AS twice FROM b),
  m AS (SELECT 'part_seg_01' AS table_name, buckets, n AS count_src, n AS count_part, 0 AS pk_nulls, 0 AS pk_dupes FROM x
    UNION ALL SELECT 'part_geo_01', geo_buckets, NULL, geo, 0, 0 FROM x
    UNION ALL SELECT 'part_ord_01', buckets, n, n + 2 * twice, twice, 2 * twice + CASE WHEN twice > 1 THEN twice ELSE 0 END FROM x),
  r AS (SELECT *, {N} - buckets AS missing_count, CASE WHEN count_src IS NULL THEN NULL ELSE abs(count_part - count_src) * 100.0::DOUBLE / count_src END AS diff FROM m)"""

REPORT = STATE + """ SELECT 's3://data/attributes/raw_input/snapshot_dt=2001-05-01/' AS input_source, '2001-05-01' AS raw_input_snapshot_dt,
  table_name AS "table", buckets AS s3_partitions, buckets AS glue_partitions, missing_count AS missing_glue_count, true AS table_type_ok,
  true AS contract_ok, coalesce(count_src::VARCHAR, '') AS count_src, count_part::VARCHAR AS count_part,
  CASE WHEN diff IS NULL THEN '' ELSE printf('%.6f', diff) END AS count_diff_pct, pk_nulls::VARCHAR AS pk_nulls, pk_dupes::VARCHAR AS pk_dupes,
  '' AS file_issues_sample, '2001-06-30T12:00:00Z' AS checked_at FROM r"""


@query("monitor_report", REPORT)
def monitor_report_query(spark, sf):
    detail = monitor(spark, monitored(spark, sf), n=N, as_of=AS_OF, data_bucket="data")
    return report_rows(detail, CHECKED_AT).drop("location")


ALERTS = STATE + f""", a AS (
  SELECT table_name, table_name || ': storage has ' || buckets || '/{N} id_bucket partitions' AS alert FROM r WHERE buckets <> {N}
  UNION ALL SELECT table_name, table_name || ': catalog misses 1 partitions (e.g., [3])' FROM r WHERE missing_count > 0
  UNION ALL SELECT table_name, table_name || ': processed snapshot too old/missing (snap=2001-05-01)' FROM r
  UNION ALL SELECT table_name, table_name || ': source table not found ext_geo_01; count match skipped' FROM r WHERE count_src IS NULL
  UNION ALL SELECT table_name, '[COUNT_MISMATCH] ' || table_name || ': ' || table_name || '=' || count_part || ' vs ext_ord_01=' || count_src
    || ' (Δ=' || printf('%.3f', round(diff, 6)) || '%)' FROM r WHERE diff > 0
  UNION ALL SELECT table_name, '[PK_NULL] ' || table_name || ': customer_user_id NULL rows=' || pk_nulls FROM r WHERE pk_nulls > 0
  UNION ALL SELECT table_name, '[PK_DUPES] ' || table_name || ': customer_user_id duplicate rows=' || pk_dupes FROM r WHERE pk_dupes > 0)"""


def _alerts(spark, sf):
    detail = monitor(spark, monitored(spark, sf), n=N, as_of=AS_OF, window_days=45, data_bucket="data")
    return alert_rows(detail, N, strict_snapshot=True)


@query("alerts", ALERTS + " SELECT table_name, alert FROM a")
def alerts_query(spark, sf):
    return _alerts(spark, sf).drop("position")


@query("alerts_capped", ALERTS + " SELECT count(*) AS alerts, 3 AS lines FROM a")
def alerts_capped_query(spark, sf):
    message = alert_message(_alerts(spark, sf), 3)
    return message.select("alerts", F.size(F.split("message", "\n")).alias("lines"))


@query("partition_integrity", f"""WITH {bucket_ctes('part', 'b', 'p_partkey')},
  t AS (SELECT DISTINCT p_brand AS table_name, p_brand = 'Brand#7' AS virtual FROM part),
  st AS (SELECT p_brand AS table_name, count(DISTINCT id_bucket) AS storage_partitions FROM b GROUP BY 1),
  rg AS (SELECT DISTINCT p_brand AS table_name, id_bucket FROM b WHERE p_size > 25),
  want AS (SELECT table_name, r::INTEGER AS id_bucket FROM t, range({N}) g(r) WHERE NOT virtual),
  gone AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY id_bucket) AS k FROM want
    WHERE (table_name, id_bucket) NOT IN (SELECT table_name, id_bucket FROM rg))
  SELECT table_name, storage_partitions, CASE WHEN virtual THEN {N} ELSE (SELECT count(*) FROM rg WHERE rg.table_name = t.table_name) END AS catalog_partitions,
    (SELECT count(*) FROM gone WHERE gone.table_name = t.table_name) AS missing_count,
    coalesce((SELECT string_agg(id_bucket::VARCHAR, ',' ORDER BY id_bucket) FROM gone WHERE gone.table_name = t.table_name AND k <= 5), '') AS missing_sample
  FROM t JOIN st USING (table_name)""")
def partition_integrity_query(spark, sf):
    """Tables by brand: a part stores its bucket, the larger ones have it registered; one brand has virtual partitions."""
    part = read(spark, sf, "part")
    tables = part.select(F.col("p_brand").alias("table_name"), (F.col("p_brand") == "Brand#7").alias("virtual")).distinct()
    at = with_id_bucket(part, "p_partkey", N).withColumnRenamed("p_brand", "table_name")
    stored = at.select("table_name", BUCKET).distinct()
    listed = at.where("p_size > 25").select("table_name", BUCKET).distinct()
    out = partition_integrity(tables, stored, listed, N)
    return out.withColumn("missing_sample", F.array_join("missing_sample", ","))


@query("schema_contract", """SELECT t AS table_name, true AS table_type_ok, p AS problems FROM
  (VALUES ('part_seg_01', ''), ('part_geo_01', ''), ('part_ord_01', ''), ('ext_seg_01', 'partition key must be [id_bucket], got []')) v(t, p)
  WHERE (SELECT count(*) FROM customer) > 0""")
def schema_contract_query(spark, sf):
    db = registered(spark, sf)
    names = [f"{db}.{t}" for t in ("part_seg_01", "part_geo_01", "part_ord_01", "ext_seg_01")]
    return check_contract(spark, names).select("table_name", "table_type_ok", F.array_join("contract_problems", "; ").alias("problems"))


@query("file_size_issues", f"WITH {WIDE}, {bucket_ctes('w', 'b')} SELECT DISTINCT id_bucket, 1::BIGINT AS issues FROM b")
def file_size_issues_query(spark, sf):
    issues = file_size_issues(file_inventory(spark, geo_parts(spark, sf)))
    return issues.groupBy(BUCKET).agg(F.count("*").alias("issues"))


@query("auto_repair", f"""WITH {WIDE}, {bucket_ctes('w', 'b')}, c AS (SELECT count(DISTINCT id_bucket) AS n FROM b)
  SELECT 'part_' || t AS table_name, n AS stored, 2::BIGINT AS registered_before, CASE t WHEN 'seg_01' THEN 2 ELSE n END AS registered_after
  FROM c, unnest(['seg_01', 'geo_01', 'ord_01']) u(t)""")
def auto_repair_query(spark, sf):
    db = fresh_db(spark)
    register_external(spark, db, split_root(spark, sf), "part_")
    done = []
    for table, mode in (("seg_01", "off"), ("geo_01", "all"), ("ord_01", "targeted")):
        name = f"{db}.part_{table}"
        ensure_partitioned(spark, name)
        add_missing(spark, name, [0, 1])
        done.append(auto_repair(spark, name, mode, N))
    return done[0].unionByName(done[1]).unionByName(done[2])


def _reported(spark, sf):
    path = shared_scratch(spark, "report")
    monitor_and_report(spark, monitored(spark, sf), path, AS_OF, CHECKED_AT, N, data_bucket="data")
    return path


@query("report_json", REPORT)
def report_json_query(spark, sf):
    return spark.read.json(join_path(_reported(spark, sf), "json", "tables")).drop("location")


@query("report_csv", STATE + """ SELECT table_name AS "table", buckets::VARCHAR AS s3_partitions, count_part::VARCHAR AS count_part,
  CASE WHEN pk_nulls > 0 THEN 'bad' ELSE 'good' END AS keys FROM r""")
def report_csv_query(spark, sf):
    rows = spark.read.option("header", True).csv(join_path(_reported(spark, sf), "csv"))
    return rows.select("table", "s3_partitions", "count_part", F.when(F.col("pk_nulls") == "0", "good").otherwise("bad").alias("keys"))


@query("refresh_report", """WITH v(step, table_name, status) AS (VALUES
  ('ids', 'addressable_ids', 'written'), ('attributes', 'SEG_01', 'written'), ('attributes', 'GEO_01', 'written'), ('attributes', 'ORD_01', 'written'),
  ('attributes', 'BAD_01', 'skipped')),
  t(t) AS (SELECT unnest(['addressable_ids', 'seg_01', 'geo_01', 'ord_01']))
  SELECT * FROM v UNION ALL SELECT 'register', 'ext_' || t, 'registered' FROM t UNION ALL SELECT 'prepare', 'part_' || t, 'migrated' FROM t
  UNION ALL SELECT 'identity', 'part_' || t || '_er', 'created' FROM t UNION ALL SELECT 'monitor', 'part_' || t, 'ok' FROM t""")
def refresh_report_query(spark, sf):
    return refresh(
        spark, fresh_db(spark), id_snapshots(spark, sf), wide_snapshots(spark, sf), mapping(spark), shared_scratch(spark, "refresh"),
        AS_OF, CHECKED_AT, n=4,
    )


def _refreshed_with_defects(spark, sf):
    """Attributes in which keys occur twice, an older id list, and a bucket that is lost between the split and the registration."""
    root, db = shared_scratch(spark, "defects"), fresh_db(spark)
    attributes, ids = join_path(root, "attributes"), join_path(root, "ids")
    wide = stored_wide(spark, sf)
    wide.unionByName(wide.where("Customer_User_id % 50 = 7")).write.parquet(join_path(attributes, "snapshot_dt=2001-06-01"))
    read(spark, sf, "events").select(F.col("user_id").alias("Customer_User_id")).distinct().write.parquet(join_path(ids, "snapshot_dt=2001-04-01"))
    given = (spark, db, ids, attributes, mapping(spark), join_path(root, "base"), AS_OF, CHECKED_AT)
    refresh(*given, n=N, skip=("register", "identity", "monitor"))
    remove(spark, join_path(root, "base", "parts", "GEO_01", f"{BUCKET}=3"))
    return db, refresh(*given, n=N, skip=("ids", "attributes"), strict_snapshot=True), root


DEFECTS = f"""WITH {WIDE}, {bucket_ctes('w', 'b')}, {IDS}, {bucket_ctes('ids', 'i')},
  x AS (SELECT *, unnest(range(CASE WHEN customer_user_id % 50 = 7 THEN 2 ELSE 1 END)) AS copy FROM b),
  t AS (SELECT 'part_seg_01' AS table_name, count(*) AS rows, count(*) FILTER (WHERE customer_user_id % 50 = 7) AS twice, count(DISTINCT id_bucket) AS buckets FROM x
    UNION ALL SELECT 'part_ord_01', count(*), count(*) FILTER (WHERE customer_user_id % 50 = 7), count(DISTINCT id_bucket) FROM x
    UNION ALL SELECT 'part_geo_01', count(*), count(*) FILTER (WHERE customer_user_id % 50 = 7), count(DISTINCT id_bucket) FROM x WHERE id_bucket <> 3
    UNION ALL SELECT 'part_addressable_ids', count(*), 0, count(DISTINCT id_bucket) FROM i),
  r AS (SELECT table_name, rows AS count_part, twice AS pk_dupes, buckets, CASE WHEN table_name = 'part_addressable_ids' THEN rows ELSE (SELECT count(*) FROM x) END AS count_src,
    CASE WHEN table_name = 'part_addressable_ids' THEN '2001-04-01' ELSE '2001-06-01' END AS snapshot_dt FROM t)"""


@query("refresh_defects", DEFECTS + f""" SELECT table_name, snapshot_dt, buckets AS s3_partitions, count_src::VARCHAR AS count_src, count_part::VARCHAR AS count_part,
    pk_dupes::VARCHAR AS pk_dupes, CASE WHEN count_part <> count_src OR pk_dupes > 0 OR buckets <> {N} OR snapshot_dt < '2001-05-16' THEN 'alert' ELSE 'ok' END AS status FROM r""")
def refresh_defects_query(spark, sf):
    """Every defect is seen: repeated keys, rows lost with a bucket, an old snapshot of one table only."""
    _, steps, root = _refreshed_with_defects(spark, sf)
    report = spark.read.json(join_path(root, "base", "monitor", "json", "tables"))
    state = steps.where("step = 'monitor'").select("table_name", "status")
    return report.select(F.col("table").alias("table_name"), F.col("raw_input_snapshot_dt").alias("snapshot_dt"), "s3_partitions", "count_src", "count_part", "pk_dupes").join(state, "table_name")


@query("alert_message", ALERTS + """, o AS (SELECT *, CASE WHEN alert LIKE '%storage has%' THEN 0 WHEN alert LIKE '%catalog misses%' THEN 1
    WHEN alert LIKE '%too old%' THEN 4 WHEN alert LIKE '%not found%' THEN 6 WHEN alert LIKE '[COUNT%' THEN 7 WHEN alert LIKE '[PK_NULL%' THEN 8 ELSE 9 END AS k FROM a)
  SELECT count(*) AS alerts, string_agg(alert, chr(10) ORDER BY table_name, k) AS message FROM o""")
def alert_message_query(spark, sf):
    """The whole text, every alert in it."""
    return alert_message(_alerts(spark, sf))
