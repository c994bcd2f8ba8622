"""Joins, identity mapping, shared-data queries, ranking."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from splitweave.checks.registered import query
from splitweave.checks.views import (
    COPIES, DATED, N, REGISTRY, WIDE, bucket_ctes, copies, once, order_snapshots, mapping, read,
    registry, stored_wide,
)
from splitweave.functions.keys import BUCKET
from splitweave.functions.policy import analysis_rule
from splitweave.functions.text import join_path, receiver_account
from splitweave.operators.columns import vertical_split, with_id_bucket
from splitweave.operators.layout import write_parts
from splitweave.operators.filters import filter_names, null_keys, registry_filter
from splitweave.operators.identity import ambiguous, map_identities, map_identities_by_rules, matched, unmatched
from splitweave.operators.joins import (
    count_match, expected_partitions, first_match, join_attributes, join_parts, missing_partitions, pair_counts,
    registry_join, valid_receivers,
)
from splitweave.operators.privacy import aggregate_by_rule, list_by_rule, overlap_by_rule, overlap_list, private_aggregate, private_overlap
from splitweave.operators.ranking import (
    cap_per_group, dedupe_keep, issues_with_total, joined_issues, latest_per_key, quota, report_order, sample_partitions,
)
from splitweave.sources.snapshots import latest_snapshot_rows


def _narrow(spark, sf):
    return vertical_split(stored_wide(spark, sf), mapping(spark))


@query("attribute_join", f"""WITH {WIDE}, {DATED}
  SELECT d.o_custkey AS customer_user_id, o_orderkey, o_orderstatus, d.snapshot_dt, c_name, c_mktsegment, c_acctbal
  FROM d JOIN w ON d.o_custkey = w.customer_user_id WHERE d.snapshot_dt = '1998-01-01'""")
def attribute_join_query(spark, sf):
    orders = spark.read.parquet(order_snapshots(spark, sf)).select(
        F.col("o_custkey").alias("customer_user_id"), "o_orderkey", "o_orderstatus", F.col("snapshot_dt").cast("string").alias("snapshot_dt")
    )
    return join_attributes(orders, _narrow(spark, sf)["SEG_01"], dt="1998-01-01")


@query("bucket_aligned_join", f"""WITH {WIDE}, {bucket_ctes('w', 'b')}
  SELECT id_bucket, customer_user_id, c_name, c_mktsegment, c_acctbal, n_name, r_name FROM b""")
def bucket_aligned_join_query(spark, sf):
    """Both sides as they lie in directories of buckets."""

    def write(path):
        for name, df in _narrow(spark, sf).items():
            write_parts(df, join_path(path, name), n=N)

    root = once(spark, sf, "aligned-parts", write)
    return join_parts(*[spark.read.parquet(join_path(root, t)) for t in ("SEG_01", "GEO_01")])


@query("missing_partitions", f"""WITH o AS (SELECT c_custkey AS customer_user_id FROM customer WHERE c_acctbal < 0),
  {bucket_ctes('o', 'b', n=256)} SELECT r::INTEGER AS id_bucket FROM range(256) t(r) WHERE r NOT IN (SELECT id_bucket FROM b)""")
def missing_partitions_query(spark, sf):
    some = read(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("customer_user_id"))
    return missing_partitions(expected_partitions(spark, 256), with_id_bucket(some).select(BUCKET).distinct())


@query("registry_join", f"WITH {REGISTRY} SELECT table_name, column_count, configured_id, allowed_columns_count, analysis_method, rule, association_name, result_rule FROM joined")
def registry_join_query(spark, sf):
    r = registry(spark, sf)
    return registry_join(r["tables"].drop("partition_keys"), r["configured"], r["rules"], r["associations"])


@query("first_match", """WITH t AS (SELECT p_partkey, 'part_t_' || p_partkey AS table_name, 'acx_part_t_' || p_partkey AS association_name FROM part)
  SELECT table_name, association_name, CASE WHEN p_partkey % 4 = 0 THEN table_name WHEN p_partkey % 3 = 0 THEN association_name END AS matched FROM t""")
def first_match_query(spark, sf):
    part = read(spark, sf, "part")
    table = F.concat(F.lit("part_t_"), F.col("p_partkey").cast("string"))
    names = part.where("p_partkey % 4 = 0").select(table.alias("name")).unionByName(
        part.where("p_partkey % 3 = 0").select(F.concat(F.lit("acx_"), table).alias("name"))
    )
    tables = part.select(table.alias("table_name"), F.concat(F.lit("acx_"), table).alias("association_name"))
    return first_match(tables, names, ["table_name", "association_name"])


ACCOUNTS = """wanted AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS account FROM supplier WHERE s_suppkey % {step} = {rest}),
  others AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS account FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey <> 6),
  kept AS (SELECT account FROM wanted WHERE account IN (SELECT account FROM others))"""
VALID = "SELECT account FROM kept UNION ALL SELECT account FROM others WHERE (SELECT count(*) FROM kept) = 0"


def _valid(step, rest):
    def run(spark, sf):
        account = F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("account")
        supplier = read(spark, sf, "supplier")
        wanted = supplier.where(f"s_suppkey % {step} = {rest}").select(account)
        return valid_receivers(wanted, supplier.where("s_suppkey % 2 = 0").select(account), "000000000006")

    return run


query("valid_receivers", f"WITH {ACCOUNTS.format(step=3, rest=0)} {VALID}")(_valid(3, 0))
query("valid_receivers_fallback", f"WITH {ACCOUNTS.format(step=2, rest=1)} {VALID}")(_valid(2, 1))


@query("receiver_accounts", """SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS account FROM supplier WHERE s_suppkey % 3 <> 2""")
def receiver_accounts_query(spark, sf):
    digits = F.lpad(F.col("s_suppkey").cast("string"), 12, "0")
    arn = F.concat(F.lit("arn:aws:cleanrooms:us-east-1:"), digits, F.lit(":membership/m/configuredtableassociation/a"))
    given = F.when(F.col("s_suppkey") % 3 == 0, digits).when(F.col("s_suppkey") % 3 == 1, arn).otherwise(F.concat(F.lit("x"), digits))
    rows = read(spark, sf, "supplier").select("s_suppkey", receiver_account(given).alias("account"))
    return rows.where("account is not null")


# -- identity mapping ------------------------------------------------------------------------------------------------

SIDES = """src AS (SELECT 's' || c_custkey AS row_id, c_custkey AS k FROM customer
    UNION ALL SELECT DISTINCT 'e' || user_id, user_id FROM events),
  tgt AS (SELECT DISTINCT 't' || o_custkey AS target_id, o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'u' || c_custkey, c_custkey FROM customer WHERE c_acctbal < 0),
  s AS (SELECT k, count(*) AS source_rows, min(row_id) AS source_id FROM src GROUP BY k),
  t AS (SELECT k, count(*) AS target_rows, min(target_id) AS target_id FROM tgt GROUP BY k)"""


def _ids(prefix, df, key, id_name):
    return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias(id_name), F.col(key).alias("customer_user_id"))


def _identities(spark, sf):
    """Source: every customer, those with events twice. Target: customers with urgent orders, and those in debt."""
    customer, events, orders = (read(spark, sf, t) for t in ("customer", "events", "orders"))
    source = _ids("s", customer, "c_custkey", "row_id").unionByName(
        _ids("e", events.select("user_id").distinct(), "user_id", "row_id")
    )
    urgent = orders.where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    target = _ids("t", urgent, "o_custkey", "target_id").unionByName(
        _ids("u", customer.where("c_acctbal < 0"), "c_custkey", "target_id")
    )
    return map_identities(source, target, "customer_user_id")


@query("identity_map", f"""WITH {SIDES} SELECT source_id, target_id, 'ONE_SOURCE_TO_ONE_TARGET' AS rule_name
  FROM s JOIN t ON s.k = t.k WHERE source_rows = 1 AND target_rows = 1""")
def identity_map_query(spark, sf):
    return matched(_identities(spark, sf))


@query("identity_unmatched", f"WITH {SIDES} SELECT k AS customer_user_id, source_rows FROM s WHERE k NOT IN (SELECT k FROM t)")
def identity_unmatched_query(spark, sf):
    return unmatched(_identities(spark, sf), "customer_user_id")


@query("identity_ambiguous", f"""WITH {SIDES} SELECT s.k AS customer_user_id, source_rows, target_rows FROM s JOIN t ON s.k = t.k
  WHERE source_rows > 1 OR target_rows > 1""")
def identity_ambiguous_query(spark, sf):
    return ambiguous(_identities(spark, sf), "customer_user_id")


@query("identity_map_rules", """WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_custkey END AS k, c_name AS mail,
    CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS n, c_acctbal AS b FROM customer),
  b AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS k,
    CASE WHEN c_nationkey < 5 THEN 'same' ELSE c_name END AS mail, c_nationkey AS n, c_acctbal AS b FROM customer),
  r1 AS (SELECT a.c_custkey AS source_id, b.c_custkey AS target_id, 'BY_KEY' AS rule_name FROM a JOIN b ON a.k = b.k),
  r2 AS (SELECT a.c_custkey AS source_id, b.c_custkey AS target_id, 'BY_MAIL' AS rule_name FROM a JOIN b ON a.mail = b.mail
    WHERE a.c_custkey NOT IN (SELECT source_id FROM r1) AND b.c_custkey NOT IN (SELECT target_id FROM r1)),
  r AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2),
  a3 AS (SELECT n, b, count(*) AS rows, min(c_custkey) AS source_id FROM a WHERE n IS NOT NULL AND c_custkey NOT IN (SELECT source_id FROM r) GROUP BY n, b),
  b3 AS (SELECT n, b, count(*) AS rows, min(c_custkey) AS target_id FROM b WHERE c_custkey NOT IN (SELECT target_id FROM r) GROUP BY n, b)
  SELECT * FROM r UNION ALL
  SELECT source_id, target_id, 'BY_NATION_AND_BALANCE' FROM a3 JOIN b3 ON a3.n = b3.n AND a3.b = b3.b WHERE a3.rows = 1 AND b3.rows = 1""")
def identity_map_rules_query(spark, sf):
    customer, k = read(spark, sf, "customer"), F.col("c_custkey")
    nation, balance = F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    source = customer.select(
        k.alias("row_id"), F.when(F.col("c_acctbal") >= 0, k).alias("key"), F.col("c_name").alias("mail"),
        F.when(k % 3 != 0, F.col("c_nationkey")).alias("nation"), balance,
    )
    target = customer.select(
        k.alias("target_id"),
        F.when(F.col("c_mktsegment") != "BUILDING", k).alias("key"),
        F.when(F.col("c_nationkey") < 5, F.lit("same")).otherwise(F.col("c_name")).alias("mail"),
        nation, balance,
    )
    rules = [("BY_KEY", "key"), ("BY_MAIL", "mail"), ("BY_NATION_AND_BALANCE", ["nation", "balance"])]
    return map_identities_by_rules(source, target, rules)


# -- shared-data queries ---------------------------------------------------------------------------------------------


@query("private_aggregate", """SELECT o_orderstatus, o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS people,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, min(o_totalprice) AS least, max(o_totalprice) AS most
  FROM orders GROUP BY ALL HAVING count(DISTINCT o_custkey) >= 2""")
def private_aggregate_query(spark, sf):
    orders = read(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    aggs = {
        "orders": ("count", "o_orderkey"), "people": ("count_distinct", "o_custkey"), "total": ("sum", "price"),
        "least": ("min", "o_totalprice"), "most": ("max", "o_totalprice"),
    }
    out = private_aggregate(orders, ["o_orderstatus", "o_orderpriority"], aggs, "o_custkey")
    return out.withColumn("total", F.col("total").cast("double"))


@query("private_aggregate_small_groups", """SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day, count(*) AS orders
  FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey) >= 6""")
def private_aggregate_small_groups_query(spark, sf):
    orders = read(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date").cast("string"))
    return private_aggregate(orders, ["day"], {"orders": ("count", "o_orderkey")}, "o_custkey", minimum=6)


@query("aggregate_by_rule", """SELECT event_type, count(user_id) AS events, count(DISTINCT user_id) AS people FROM events
  GROUP BY event_type HAVING count(DISTINCT user_id) >= 2""")
def aggregate_by_rule_query(spark, sf):
    rule = analysis_rule("aggregation", columns=["user_id", "event_type"])
    aggs = {"events": ("count", "user_id"), "people": ("count_distinct", "user_id")}
    return aggregate_by_rule(read(spark, sf, "events"), rule, ["event_type"], aggs)


@query("aggregate_by_rule_scalar", """SELECT upper(event_type) AS kind, count(user_id) AS events, max(floor(value)) AS most FROM events
  GROUP BY 1 HAVING count(DISTINCT user_id) >= 2""")
def aggregate_by_rule_scalar_query(spark, sf):
    """Columns derived by scalar functions that the rule names."""
    rule = analysis_rule("aggregation", columns=["user_id", "event_type", "value"], functions=["UPPER", "FLOOR"])
    aggs = {"events": ("count", "user_id"), "most": ("max", "whole")}
    out = aggregate_by_rule(read(spark, sf, "events"), rule, ["kind"], aggs, {"kind": ("upper", "event_type"), "whole": ("floor", "value")})
    return out.withColumn("most", F.col("most").cast("double"))


@query("overlap_by_rule", """SELECT c_mktsegment, count(DISTINCT user_id) AS people, max(value) AS most
  FROM customer JOIN events ON c_custkey = user_id GROUP BY c_mktsegment
  HAVING count(DISTINCT user_id) >= 5 AND count(DISTINCT event_type) >= 2""")
def overlap_by_rule_query(spark, sf):
    rule = json.dumps({"v1": {"aggregation": {
        "aggregateColumns": [{"columnNames": ["person"], "function": "COUNT_DISTINCT"}, {"columnNames": ["value"], "function": "MAX"}],
        "dimensionColumns": ["c_mktsegment"], "joinColumns": ["user_id"], "scalarFunctions": [],
        "outputConstraints": [
            {"column": "person", "minimum": 5, "type": "COUNT_DISTINCT"}, {"column": "event_type", "minimum": 2, "type": "COUNT_DISTINCT"},
        ],
    }}})
    customer = read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_custkey").alias("person"), "c_mktsegment")
    events = read(spark, sf, "events").select("user_id", "event_type", "value")
    aggs = {"people": ("count_distinct", "person"), "most": ("max", "value")}
    return overlap_by_rule(customer, events, rule, ["user_id"], ["c_mktsegment"], aggs)


@query("list_by_rule", "SELECT DISTINCT c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def list_by_rule_query(spark, sf):
    rule = analysis_rule("list", columns=["c_name", "c_mktsegment"], joins=["user_id"])
    customer = read(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    return list_by_rule(customer, read(spark, sf, "events"), rule, ["user_id"], ["c_name", "c_mktsegment"])


@query("private_overlap_distinct", """SELECT c_mktsegment, event_type, count(DISTINCT c_name) AS names, count(DISTINCT event_id) AS events,
    count(*) AS pairs, max(value) AS most FROM customer JOIN events ON c_nationkey = user_id % 25
  GROUP BY ALL HAVING count(DISTINCT c_name) >= 3""")
def private_overlap_distinct_query(spark, sf):
    """Both sides have a column whose distinct values are counted, and few keys."""
    customer = read(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("k"), "c_name", "c_mktsegment")
    events = read(spark, sf, "events").select((F.col("user_id") % 25).alias("k"), "event_id", "event_type", "value")
    aggs = {"names": ("count_distinct", "c_name"), "events": ("count_distinct", "event_id"), "pairs": ("count", "*"), "most": ("max", "value")}
    return private_overlap(customer, events, ["k"], ["c_mktsegment", "event_type"], aggs, "c_name", minimum=3)


@query("private_overlap", """SELECT c_mktsegment, event_type, count(*) AS pairs, count(DISTINCT c_custkey) AS people,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(value) AS least,
    round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS mean_balance
  FROM customer JOIN events ON c_custkey = user_id GROUP BY ALL HAVING count(DISTINCT c_custkey) >= 5""")
def private_overlap_query(spark, sf):
    customer = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_user_id"), "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)").alias("balance")
    )
    events = read(spark, sf, "events").select(
        F.col("user_id").alias("customer_user_id"), "event_type", "event_id", F.col("value").alias("amount"),
        F.col("value").cast("decimal(18,2)").alias("exact"),
    )
    aggs = {
        "pairs": ("count", "event_id"), "people": ("count_distinct", "customer_user_id"), "total": ("sum", "exact"),
        "least": ("min", "amount"), "sum_balance": ("sum", "balance"), "n_balance": ("count", "balance"),
    }
    out = private_overlap(customer, events, ["customer_user_id"], ["c_mktsegment", "event_type"], aggs, "customer_user_id", 5)
    mean = F.round(F.col("sum_balance").cast("double") / F.col("n_balance"), 4)
    return out.withColumn("mean_balance", mean).withColumn("total", F.col("total").cast("double")).drop("sum_balance", "n_balance")


@query("overlap_list", """SELECT DISTINCT c_mktsegment, c_nationkey, c_custkey FROM customer
  WHERE c_custkey IN (SELECT user_id FROM events) OR c_custkey IN (SELECT event_id FROM events WHERE event_type = 'error')""")
def overlap_list_query(spark, sf):
    customer = read(spark, sf, "customer").withColumn("key_a", F.col("c_custkey")).withColumn("key_b", F.col("c_custkey"))
    events = read(spark, sf, "events").select(
        F.col("user_id").alias("key_a"), F.when(F.col("event_type") == "error", F.col("event_id")).alias("key_b")
    )
    listed = ["c_mktsegment", "c_nationkey", "c_custkey"]
    return overlap_list(customer, events, ["key_a", "key_b"], listed, ["key_a", "key_b"], listed)


@query("overlap_list_both_sides", """SELECT DISTINCT c_mktsegment, o_orderpriority FROM customer JOIN orders ON c_custkey = o_custkey""")
def overlap_list_both_sides_query(spark, sf):
    customer = read(spark, sf, "customer").withColumnRenamed("c_custkey", "k")
    orders = read(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    listed = ["c_mktsegment", "o_orderpriority"]
    return overlap_list(customer, orders, ["k"], listed, ["k"], listed)


# -- counts ----------------------------------------------------------------------------------------------------------


@query("count_match", """WITH p AS (SELECT p_brand, count(*) AS n FROM part WHERE p_size % 3 <> 0 AND p_brand <> 'Brand#3' GROUP BY 1),
  s AS (SELECT p_brand, CASE WHEN p_brand = 'Brand#5' THEN 0 ELSE count(*) END AS n FROM part WHERE p_brand <> 'Brand#7' GROUP BY 1),
  c AS (SELECT p.p_brand AS base_name, p.n AS count_part, s.n AS count_src, CASE WHEN s.n IS NULL THEN NULL WHEN s.n = 0 THEN 100.0
    ELSE abs(p.n - s.n) * 100.0::DOUBLE / s.n END AS diff FROM p LEFT JOIN s ON p.p_brand = s.p_brand)
  SELECT base_name, count_part, count_src, CASE WHEN diff IS NULL THEN '' ELSE printf('%.6f', diff::DOUBLE) END AS count_diff_pct,
    coalesce(diff > 30, false) AS count_mismatch FROM c""")
def count_match_query(spark, sf):
    part = read(spark, sf, "part").withColumnRenamed("p_brand", "base_name")
    parts = part.where("p_size % 3 <> 0 and base_name <> 'Brand#3'").groupBy("base_name").agg(F.count("*").alias("rows"))
    source = part.where("base_name <> 'Brand#7'").groupBy("base_name").agg(
        F.when(F.first("base_name") == "Brand#5", F.lit(0).cast("bigint")).otherwise(F.count("*")).alias("rows")
    )
    return count_match(pair_counts(parts, source), 30)


# -- names -----------------------------------------------------------------------------------------------------------


@query("filter_names", "SELECT p_partkey, p_brand AS brand FROM part WHERE p_brand IN ('Brand#2', 'Brand#17', 'Brand#9')")
def filter_names_query(spark, sf):
    part = read(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    return filter_names(part, "brand", " Brand#2, BRAND#17 ,brand#9,none")


@query("registry_filter", """SELECT p_type || '_' || p_partkey AS name, nullif(p_partkey % 8, 0)::BIGINT AS id FROM part
  WHERE p_type LIKE 'E%' AND p_partkey % 8 <> 0 AND p_partkey NOT IN (1, 5)""")
def registry_filter_query(spark, sf):
    rows = read(spark, sf, "part").select(
        F.concat(F.col("p_type"), F.lit("_"), F.col("p_partkey").cast("string")).alias("name"), F.expr("nullif(p_partkey % 8, 0)").alias("id")
    )
    return registry_filter(rows, "E", ["ECONOMY_1", "ECONOMY_5"])


@query("null_keys", "SELECT event_id FROM events WHERE user_id % 10 = 0")
def null_keys_query(spark, sf):
    rows = read(spark, sf, "events").withColumn("customer_user_id", F.expr("nullif(user_id % 10, 0)"))
    return null_keys(rows).select("event_id")


# -- ranking ---------------------------------------------------------------------------------------------------------

KEEP_ALL = ["part_t_7", "part_t_8"]
RANKED = f"""{COPIES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_associated DESC, created, id) AS r,
  name IN ('part_t_7', 'part_t_8') AS protected FROM copies)"""


@query("dedupe_kept", f"WITH {RANKED} SELECT name, id, is_associated, created FROM ranked WHERE r = 1 OR protected")
def dedupe_kept_query(spark, sf):
    return dedupe_keep(copies(spark, sf), "name", "is_associated", "created", "id", KEEP_ALL)[0]


@query("dedupe_dropped", f"WITH {RANKED} SELECT id, name, is_associated, created FROM ranked WHERE r > 1 AND NOT protected")
def dedupe_dropped_query(spark, sf):
    return dedupe_keep(copies(spark, sf), "name", "is_associated", "created", "id", KEEP_ALL)[1]


@query("latest_per_key", f"""WITH {DATED} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, snapshot_dt FROM
  (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY snapshot_dt DESC, o_orderkey DESC) AS r FROM d) WHERE r = 1""")
def latest_per_key_query(spark, sf):
    rows = spark.read.parquet(order_snapshots(spark, sf)).withColumn("snapshot_dt", F.col("snapshot_dt").cast("string"))
    return latest_per_key(rows, "o_custkey", "snapshot_dt", "o_orderkey")


@query("latest_snapshot_rows", f"WITH {DATED} SELECT o_orderkey, o_custkey FROM d WHERE snapshot_dt = (SELECT max(snapshot_dt) FROM d)")
def latest_snapshot_rows_query(spark, sf):
    return latest_snapshot_rows(spark.read.parquet(order_snapshots(spark, sf))).select("o_orderkey", "o_custkey")


@query("quota_topk", """SELECT p_partkey, name FROM (SELECT p_partkey, 'part_' || p_name || '_' || p_partkey AS name FROM part)
  ORDER BY name LIMIT 25""")
def quota_topk_query(spark, sf):
    name = F.concat(F.lit("part_"), F.col("p_name"), F.lit("_"), F.col("p_partkey").cast("string")).alias("name")
    return quota(read(spark, sf, "part").select("p_partkey", name), "name", 25)


@query("report_order", f"WITH {REGISTRY} SELECT table_name, associated FROM ready")
def report_order_query(spark, sf):
    r = registry(spark, sf)
    joined = registry_join(r["tables"], r["configured"], r["rules"], r["associations"])
    return report_order(joined.select("table_name", F.col("association_name").isNotNull().alias("associated")))


@query("sample_partitions", f"""WITH o AS (SELECT DISTINCT o_custkey AS customer_user_id FROM orders), {bucket_ctes('o', 'b', n=256)}
  SELECT DISTINCT id_bucket FROM b ORDER BY 1 LIMIT 5""")
def sample_partitions_query(spark, sf):
    rows = read(spark, sf, "orders").withColumnRenamed("o_custkey", "customer_user_id")
    return sample_partitions(with_id_bucket(rows), 5)


@query("cap_per_group", """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r
  FROM events) WHERE r <= 3""")
def cap_per_group_query(spark, sf):
    return cap_per_group(read(spark, sf, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"], 3)


@query("issues_with_total", """SELECT nullif(user_id % 10, 0) AS k, string_agg(event_type, ';' ORDER BY event_id) FILTER (WHERE r <= 3) AS issues, count(*) AS total
  FROM (SELECT *, row_number() OVER (PARTITION BY nullif(user_id % 10, 0) ORDER BY event_id) AS r FROM events) GROUP BY 1""")
def issues_with_total_query(spark, sf):
    """The first three events of each group, also of the NULL one, and how many there are."""
    events = read(spark, sf, "events").select(F.expr("nullif(user_id % 10, 0)").alias("k"), "event_id", "event_type")
    return issues_with_total(events, ["k"], ["event_id"], "event_type", 3)


@query("joined_issues", """SELECT user_id, string_agg(event_type, ';' ORDER BY event_id) AS issues FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r <= 3 GROUP BY user_id""")
def joined_issues_query(spark, sf):
    return joined_issues(read(spark, sf, "events"), ["user_id"], ["event_id"], "event_type", 3)
