"""Names, policies, readiness, drift, identity report."""

from __future__ import annotations

from pyspark.sql import functions as F

from splitweave.checks.registered import query
from splitweave.checks.views import ACCOUNT_A, ACCOUNT_B, AS_OF, LABELS, REGISTRY, read, registry
from splitweave.functions.policy import list_add, providers, receivers
from splitweave.functions.text import (
    join_path,
    account_list, arn_part, arn_path, association_name, base_name, file_safe, method_label, or_na, part_name, registered_name,
    schema_name, snapshot_in_path, source_name, utc_text, yes_no,
)
from splitweave.operators.identity import identity_report, namespace_rows
from splitweave.operators.joins import registry_join
from splitweave.operators.monitor import check_freshness
from splitweave.operators.registry import (
    add_provider_plan, change_plan, not_ready, query_ready, readiness, readiness_report, readiness_summary,
)
from splitweave.plans.pipelines import identity_and_report
from splitweave.sources.paths import shared_scratch
from splitweave.operators.sets import column_drift, config_drift, drift_by_table, match_summary, state_check, status_counts


def joined(spark, sf):
    r = registry(spark, sf)
    return registry_join(r["tables"], r["configured"], r["rules"], r["associations"])


# -- names -----------------------------------------------------------------------------------------------------------


@query("scalar_text", """WITH n AS (SELECT p_partkey, p_name, 'part_' || replace(p_name, ' ', '_') || '_' || p_partkey ||
    CASE p_partkey % 4 WHEN 0 THEN '-assoc' WHEN 1 THEN '_assoc' WHEN 2 THEN '_er' ELSE '' END AS name FROM part)
  SELECT p_partkey, '2024-0' || (1 + p_partkey % 9) || '-15' AS dt, regexp_replace(name, '^part_', '') AS base,
    'ext_' || regexp_replace(name, '^part_', '') AS source, 'part_' || regexp_replace(name, '^part_', '') AS part,
    'acx_' || regexp_replace(name, '[-_]assoc$', '') AS association,
    'ACX_SCHEMA_' || replace(replace(upper(name), 'PART_', ''), '_ER', '') AS schema_name,
    'ext_' || lower(upper(name)) AS registered, regexp_replace(p_name || '/é#' || p_partkey, '[^\\p{L}\\p{N}_-]', '_', 'g') AS safe,
    CASE p_partkey % 3 WHEN 0 THEN 'rule-based' WHEN 1 THEN 'rule-based' ELSE 'provider' END AS method,
    CASE WHEN p_partkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS flag, CASE WHEN p_partkey % 5 = 0 THEN 'N/A' ELSE p_name END AS named FROM n""")
def scalar_text_query(spark, sf):
    k = F.col("p_partkey")
    ending = F.when(k % 4 == 0, F.lit("-assoc")).when(k % 4 == 1, F.lit("_assoc")).when(k % 4 == 2, F.lit("_er")).otherwise(F.lit(""))
    name = F.concat(F.lit("part_"), F.translate("p_name", " ", "_"), F.lit("_"), k.cast("string"), ending)
    path = F.concat(F.lit("s3a://data/raw/snapshot_dt=2024-0"), (k % 9 + 1).cast("string"), F.lit("-15/f.parquet"))
    code = F.when(k % 3 == 0, F.lit("RULE_BASED")).when(k % 3 == 2, F.lit("PROVIDER"))
    return read(spark, sf, "part").select(
        "p_partkey",
        snapshot_in_path(path).alias("dt"),
        base_name(name).alias("base"),
        source_name(name).alias("source"),
        part_name(name).alias("part"),
        association_name(name).alias("association"),
        schema_name(name).alias("schema_name"),
        registered_name(F.upper(name), "ext_").alias("registered"),
        file_safe(F.concat(F.col("p_name"), F.lit("/é#"), k.cast("string"))).alias("safe"),
        method_label(code).alias("method"),
        yes_no(k % 2 == 0).alias("flag"),
        or_na(F.when(k % 5 != 0, F.col("p_name"))).alias("named"),
    )


@query("utc_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def utc_text_query(spark, sf):
    return read(spark, sf, "events").select("event_id", utc_text("ts").alias("at"))


@query("account_format", f"""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN '1111-2222-3333 (Query runner)'
  ELSE '1111-2222-3333 (Query runner), ' || lpad(CAST(s_suppkey AS VARCHAR), 12, '9') END AS accounts FROM supplier""")
def account_format_query(spark, sf):
    k = F.col("s_suppkey")
    other = F.lpad(k.cast("string"), 12, "9")
    listed = (
        F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 1, F.array(F.lit(ACCOUNT_A)))
        .otherwise(F.array(F.lit(ACCOUNT_A), other))
    )
    return read(spark, sf, "supplier").select("s_suppkey", account_list(listed, LABELS).alias("accounts"))


@query("arn_parts", """SELECT s_suppkey, 'us-east-' || (s_suppkey % 4) AS region, lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS account,
  'db_' || s_nationkey AS source_db, 'part_s_' || s_suppkey AS table_name FROM supplier""")
def arn_parts_query(spark, sf):
    k = F.col("s_suppkey").cast("string")
    arn = F.concat(
        F.lit("arn:aws:glue:us-east-"), (F.col("s_suppkey") % 4).cast("string"), F.lit(":"), F.lpad(k, 12, "0"),
        F.lit(":table/db_"), F.col("s_nationkey").cast("string"), F.lit("/part_s_"), k,
    )
    return read(spark, sf, "supplier").select(
        "s_suppkey", arn_part(arn, 3).alias("region"), arn_part(arn, 4).alias("account"),
        arn_path(arn, 2).alias("source_db"), arn_path(arn, 1).alias("table_name"),
    )


@query("snapshot_freshness", f"""WITH m AS (SELECT 'c' || o_custkey AS table_name, max(o_orderdate) AS d FROM orders GROUP BY 1)
  SELECT table_name, strftime(d, '%Y-%m-%d') AS snapshot_dt, d < DATE '{AS_OF}' - 45 AS stale FROM m
  UNION ALL SELECT s_name, 'soon', true FROM supplier UNION ALL SELECT 'x' || s_name, NULL, true FROM supplier""")
def snapshot_freshness_query(spark, sf):
    markers = read(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("d")).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("table_name"),
        F.col("d").cast("date").cast("string").alias("snapshot_dt"),
    )
    supplier = read(spark, sf, "supplier")
    broken = supplier.select(F.col("s_name").alias("table_name"), F.lit("soon").alias("snapshot_dt"))
    absent = supplier.select(F.concat(F.lit("x"), F.col("s_name")).alias("table_name"), F.lit(None).cast("string").alias("snapshot_dt"))
    return check_freshness(markers.unionByName(broken).unionByName(absent), 45, AS_OF)


# -- policies --------------------------------------------------------------------------------------------------------


@query("policy_lists", f"""WITH {REGISTRY} SELECT table_name, array_to_string(providers, ',') AS providers, array_to_string(receivers, ',') AS receivers,
  len(providers)::INTEGER AS provider_count FROM policy""")
def policy_lists_query(spark, sf):
    return joined(spark, sf).select(
        "table_name",
        F.array_join(providers("rule"), ",").alias("providers"),
        F.array_join(receivers("result_rule"), ",").alias("receivers"),
        F.size(providers("rule")).alias("provider_count"),
    )


@query("list_add", f"""WITH {REGISTRY} SELECT table_name, array_to_string(CASE WHEN list_contains(providers, '{ACCOUNT_B}') THEN providers
  ELSE list_append(providers, '{ACCOUNT_B}') END, ',') AS providers FROM policy""")
def list_add_query(spark, sf):
    added = list_add(providers("rule"), F.lit(ACCOUNT_B))
    return joined(spark, sf).select("table_name", F.array_join(added, ",").alias("providers"))


# -- readiness -------------------------------------------------------------------------------------------------------


@query("readiness_report", f"""WITH {REGISTRY} SELECT table_name, 'Yes' AS registered, CASE WHEN configured THEN 'Yes' ELSE 'No' END AS configured_table_exists,
  coalesce(configured_id, 'N/A') AS configured_table_id, CASE WHEN has_rule THEN 'Yes' ELSE 'No' END AS analysis_rule_exists,
  CASE len(providers) WHEN 0 THEN 'N/A' WHEN 1 THEN '1111-2222-3333 (Query runner)' ELSE '1111-2222-3333 (Query runner), {ACCOUNT_B}' END AS allowed_analyses,
  CASE WHEN associated THEN 'Yes' ELSE 'No' END AS association_exists, coalesce(association_name, 'N/A') AS association_name,
  CASE WHEN associated THEN 'Yes' ELSE 'No' END AS in_collaboration, CASE WHEN ready THEN 'Yes' ELSE 'No' END AS ready_for_analysis,
  column_count, 'id_bucket' AS partition_keys, coalesce(allowed_columns_count, 0) AS allowed_columns_count, coalesce(analysis_method, 'N/A') AS analysis_method,
  CASE WHEN result_rule IS NOT NULL THEN 'Yes' ELSE 'No' END AS result_rule_exists FROM ready""")
def readiness_report_query(spark, sf):
    return readiness_report(joined(spark, sf), LABELS)


@query("readiness_report_named", f"""WITH {REGISTRY} SELECT 'Spring' AS collaboration_name, CASE WHEN configured THEN table_name ELSE 'N/A' END AS configured_table_name,
  table_name, CASE WHEN ready THEN 'Yes' ELSE 'No' END AS ready_for_analysis FROM ready""")
def readiness_report_named_query(spark, sf):
    report = readiness_report(joined(spark, sf), LABELS, "Spring")
    return report.select("collaboration_name", "configured_table_name", "table_name", "ready_for_analysis")


@query("readiness_summary", f"""WITH {REGISTRY} SELECT count(*) AS tables, count(*) FILTER (WHERE configured) AS configured,
  count(*) FILTER (WHERE has_rule) AS with_rule, count(*) FILTER (WHERE associated) AS associated, count(*) FILTER (WHERE ready) AS ready FROM ready""")
def readiness_summary_query(spark, sf):
    return readiness_summary(readiness(joined(spark, sf)))


@query("not_ready", f"""WITH {REGISTRY} SELECT table_name, concat_ws(', ', CASE WHEN NOT configured THEN 'Missing configured table' END,
  CASE WHEN NOT has_rule THEN 'Missing analysis rule' END, CASE WHEN has_rule AND len(providers) = 0 THEN 'No allowed providers' END,
  CASE WHEN NOT associated THEN 'Not in collaboration' END, CASE WHEN result_rule IS NULL THEN 'Missing collaboration rule' END) AS reasons FROM ready WHERE NOT ready""")
def not_ready_query(spark, sf):
    return not_ready(readiness(joined(spark, sf)))


@query("query_ready", f"""WITH {REGISTRY} SELECT table_name, len(providers)::INTEGER AS provider_count, len(receivers)::INTEGER AS receiver_count,
  (rule IS NOT NULL AND result_rule IS NOT NULL AND len(providers) > 0 AND len(receivers) > 0) AS query_ready FROM policy""")
def query_ready_query(spark, sf):
    return query_ready(joined(spark, sf))


# -- drift -----------------------------------------------------------------------------------------------------------

DRIFT = f"""{REGISTRY}, m AS (SELECT table_name, providers, receivers, has_rule, result_rule IS NOT NULL AS has_result_rule,
    has_rule AND providers = ['{ACCOUNT_A}'] AS providers_match,
    result_rule IS NOT NULL AND list_sort(receivers) = ['{ACCOUNT_A}', '{ACCOUNT_B}'] AS receivers_match FROM ready)"""


def _drift(spark, sf):
    rows = joined(spark, sf).select(
        "table_name", providers("rule").alias("providers"), receivers("result_rule").alias("receivers"),
        F.col("rule").isNotNull().alias("has_rule"), F.col("result_rule").isNotNull().alias("has_result_rule"),
    )
    return config_drift(rows, [ACCOUNT_A], [ACCOUNT_B, ACCOUNT_A])


@query("list_drift", f"""WITH {DRIFT} SELECT table_name, providers_match, receivers_match, concat_ws('; ',
    CASE WHEN NOT has_rule THEN 'no analysis rule on the configured table' WHEN NOT providers_match
      THEN 'provider mismatch: expected [{ACCOUNT_A}], got [' || array_to_string(providers, ', ') || ']' END,
    CASE WHEN NOT has_result_rule THEN 'no result rule on the association' WHEN NOT receivers_match
      THEN 'receiver mismatch: expected [{ACCOUNT_B}, {ACCOUNT_A}], got [' || array_to_string(receivers, ', ') || ']' END) AS issues FROM m""")
def list_drift_query(spark, sf):
    return _drift(spark, sf).select("table_name", "providers_match", "receivers_match", F.array_join("issues", "; ").alias("issues"))


@query("drift_summary", f"""WITH {DRIFT}, g AS (SELECT providers_match AND receivers_match AS good FROM m)
  SELECT bool_and(good) AS all_match, count(*) FILTER (WHERE good) AS matching, count(*) FILTER (WHERE NOT good) AS not_matching FROM g""")
def drift_summary_query(spark, sf):
    return match_summary(_drift(spark, sf), ["providers_match", "receivers_match"])


CHANGES = f"""{REGISTRY}, c AS (SELECT *, CASE WHEN rule IS NULL THEN 'needs_create'
  WHEN list_sort(providers) = ['{ACCOUNT_A}', '{ACCOUNT_B}'] THEN 'correct' ELSE 'needs_update' END AS status FROM policy)"""


@query("change_plan", f"""WITH {CHANGES} SELECT table_name, status, CASE status WHEN 'correct' THEN array_to_string(providers, ',')
  ELSE '{ACCOUNT_B},{ACCOUNT_A}' END AS new_providers FROM c""")
def change_plan_query(spark, sf):
    plan = change_plan(joined(spark, sf), [ACCOUNT_B, ACCOUNT_A])
    return plan.select("table_name", "status", F.array_join("new_providers", ",").alias("new_providers"))


@query("add_provider_plan", f"""WITH {REGISTRY} SELECT table_name, CASE WHEN rule IS NULL THEN 'needs_create'
    WHEN list_contains(providers, '{ACCOUNT_B}') THEN 'already_has_provider' ELSE 'needs_update' END AS status,
  array_to_string(CASE WHEN list_contains(providers, '{ACCOUNT_B}') THEN providers ELSE list_append(providers, '{ACCOUNT_B}') END, ',') AS new_providers FROM policy""")
def add_provider_plan_query(spark, sf):
    plan = add_provider_plan(joined(spark, sf), ACCOUNT_B)
    return plan.select("table_name", "status", F.array_join("new_providers", ",").alias("new_providers"))


@query("status_counts", f"WITH {CHANGES} SELECT status, count(*) AS rows FROM c GROUP BY status")
def status_counts_query(spark, sf):
    return status_counts(change_plan(joined(spark, sf), [ACCOUNT_B, ACCOUNT_A]))


def _columns(spark, sf):
    """Columns of tables by brand: those that exist and those that are allowed."""
    part = read(spark, sf, "part").select(
        F.col("p_brand").alias("table_name"), F.concat(F.lit("attr_"), F.col("p_size").cast("string")).alias("column_name"), "p_partkey"
    )
    actual = part.where("p_partkey % 3 <> 0 or column_name = 'attr_7'").select("table_name", "column_name")
    allowed = part.where("p_partkey % 4 <> 0 and table_name <> 'Brand#9'").select("table_name", "column_name")
    return column_drift(actual, allowed, ["attr_7", "attr_8"])


DRIFTED = """p AS (SELECT p_brand AS table_name, 'attr_' || p_size AS column_name, p_partkey FROM part),
  a AS (SELECT DISTINCT table_name, column_name, true AS in_actual FROM p WHERE p_partkey % 3 <> 0 OR column_name = 'attr_7'),
  l AS (SELECT DISTINCT table_name, column_name, true AS in_allowed FROM p WHERE p_partkey % 4 <> 0 AND table_name <> 'Brand#9'),
  j AS (SELECT table_name, column_name, coalesce(in_actual, false) AS in_actual, coalesce(in_allowed, false) AS in_allowed FROM a FULL JOIN l USING (table_name, column_name)),
  e AS (SELECT *, in_actual AND column_name NOT IN ('attr_7', 'attr_8') AS expected FROM j),
  f AS (SELECT *, in_actual AND NOT in_allowed AS extra, NOT in_actual AND in_allowed AS missing, in_allowed AND NOT expected AS should_remove,
    expected AND NOT in_allowed AS should_add FROM e)"""


@query("column_drift", f"WITH {DRIFTED} SELECT * FROM f")
def column_drift_query(spark, sf):
    return _columns(spark, sf)


@query("column_drift_by_table", f"""WITH {DRIFTED} SELECT table_name, count(*) FILTER (WHERE expected) AS expected, count(*) FILTER (WHERE extra) AS extra,
  count(*) FILTER (WHERE missing) AS missing, count(*) FILTER (WHERE should_remove) AS should_remove, count(*) FILTER (WHERE should_add) AS should_add,
  count(*) FILTER (WHERE in_allowed) AS allowed, (bool_or(should_remove) OR bool_or(should_add) OR NOT bool_or(in_allowed)) AS needs_fix FROM f GROUP BY table_name""")
def column_drift_by_table_query(spark, sf):
    return drift_by_table(_columns(spark, sf))


@query("state_check", """WITH e AS (SELECT p_partkey AS id, 'acx_part_' || p_partkey AS expected_name FROM part WHERE p_size > 5),
  a AS (SELECT p_partkey AS id, CASE WHEN p_brand = 'Brand#4' THEN 'part_' || p_partkey || '-assoc' ELSE 'acx_part_' || p_partkey END AS association_name
    FROM part WHERE p_type <> 'PROMO')
  SELECT id, expected_name, association_name, CASE WHEN expected_name IS NULL THEN 'unexpected' WHEN association_name IS NULL THEN 'missing'
    WHEN expected_name = association_name THEN 'correct' ELSE 'wrong_name' END AS state FROM e FULL JOIN a USING (id)""")
def state_check_query(spark, sf):
    part, k = read(spark, sf, "part"), F.col("p_partkey").cast("string")
    expected = part.where("p_size > 5").select(F.col("p_partkey").alias("id"), F.concat(F.lit("part_"), k, F.lit("_assoc")).alias("name"))
    name = F.when(F.col("p_brand") == "Brand#4", F.concat(F.lit("part_"), k, F.lit("-assoc"))).otherwise(F.concat(F.lit("acx_part_"), k))
    return state_check(expected, part.where("p_type <> 'PROMO'").select(F.col("p_partkey").alias("id"), name.alias("association_name")))


# -- identity report -------------------------------------------------------------------------------------------------


def _namespaces(spark, sf):
    k = F.col("s_suppkey")
    text = k.cast("string")
    arn = F.concat(F.lit("arn:aws:glue:us-east-1:000000000001:table/db_"), F.col("s_nationkey").cast("string"), F.lit("/part_s_"), text)
    source = F.struct(arn.alias("arn"), F.concat(F.lit("ACX_SCHEMA_"), text).alias("schema_name"))
    none = "array<struct<arn:string,schema_name:string>>"
    kind = F.struct(F.when(k % 3 == 0, F.lit("RULE_BASED")).when(k % 3 == 1, F.lit("PROVIDER")).alias("type"))
    return read(spark, sf, "supplier").select(
        F.col("s_name").alias("name"),
        F.when(k % 7 == 0, F.array().cast(none)).otherwise(F.array(source)).alias("input_sources"),
        F.array(kind).alias("mappings"),
    )


def _mappings(spark, sf):
    k = F.col("s_suppkey")
    text = k.cast("string")

    def field(name, kind, match):
        return F.struct(name.alias("field_name"), F.lit(kind).alias("type"), match.alias("match_key"))

    none = F.lit(None).cast("string")
    return read(spark, sf, "supplier").where("s_suppkey % 5 <> 0").select(
        F.concat(F.lit("acx_schema_"), text).alias("schema_name"),
        F.array(
            field(F.concat(F.lit("row_"), text), "UNIQUE_ID", none),
            field(F.lit("first_id"), "ID", F.lit("AML")),
            field(F.when(k % 2 == 0, F.lit("customer_user_id")).otherwise(F.lit("mail")), "STRING", F.when(k % 4 != 0, F.lit("AXM"))),
            field(F.lit("attr"), "ATTRIBUTE", F.lit("no")),
        ).alias("fields"),
    )


NAMESPACES = """ns AS (SELECT s_suppkey AS k, s_name AS name, CASE s_suppkey % 3 WHEN 1 THEN 'provider' ELSE 'rule-based' END AS method,
  CASE WHEN s_suppkey % 7 <> 0 THEN 'us-east-1' END AS region, CASE WHEN s_suppkey % 7 <> 0 THEN 'db_' || s_nationkey END AS source_db,
  CASE WHEN s_suppkey % 7 <> 0 THEN 'part_s_' || s_suppkey END AS table_name, CASE WHEN s_suppkey % 7 <> 0 THEN 'ACX_SCHEMA_' || s_suppkey END AS schema_name
  FROM supplier)"""


@query("namespace_rows", f"WITH {NAMESPACES} SELECT name, method, region, source_db, table_name, schema_name FROM ns")
def namespace_rows_query(spark, sf):
    return namespace_rows(_namespaces(spark, sf))


@query("identity_report", f"""WITH {NAMESPACES} SELECT name, method, coalesce(source_db, 'N/A') AS source_db, coalesce(region, 'N/A') AS region,
  coalesce(table_name, 'N/A') AS table_name, coalesce(lower(schema_name), 'N/A') AS schema_name,
  CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN 'N/A' ELSE 'row_' || k END AS unique_id,
  CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN 'N/A' WHEN k % 4 = 0 THEN 'first_id' WHEN k % 2 = 0 THEN 'customer_user_id' ELSE 'mail' END AS input_field,
  CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN 'N/A' WHEN k % 4 = 0 THEN 'AML' ELSE 'AXM' END AS match_key FROM ns""")
def identity_report_query(spark, sf):
    return identity_report(_namespaces(spark, sf), _mappings(spark, sf))


@query("identity_report_named", f"""WITH {NAMESPACES} SELECT 'Spring' AS collaboration_name, name, method, coalesce(lower(schema_name), 'N/A') AS schema_name FROM ns""")
def identity_report_named_query(spark, sf):
    """Read back from the CSV it was written to."""
    path = shared_scratch(spark, "identity-report")
    identity_and_report(spark, path, _namespaces(spark, sf), _mappings(spark, sf), "Spring")
    return spark.read.option("header", True).csv(join_path(path, "csv")).select("collaboration_name", "name", "method", "schema_name")
