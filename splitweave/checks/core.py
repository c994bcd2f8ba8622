"""Split, hash, projections, counts and key quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from splitweave.checks.registered import query
from splitweave.checks.views import (
    DIRTY, IDS, MAPPING, N, WIDE, bucket_ctes, dirty, id_list, mapping, narrow_sql, read, shown, stored_wide, wide,
)
from splitweave.functions.keys import BUCKET
from splitweave.operators.columns import (
    allowed_projection, canonical_key, capped_projection, identity_projection, mapped_fields, registered_columns,
    vertical_split, with_id_bucket, with_input_source, with_snapshot,
)
from splitweave.operators.joins import reassemble
from splitweave.operators.quality import (
    bucket_balance, bucket_histogram, check_split, distinct_users, duplicate_rows, key_quality, row_counts, union_all,
)
from splitweave.sources.catalog import describe_schema
from splitweave.sources.mapping import field_counts, mapping_columns, mapping_errors, mapping_groups

ATTRIBUTES = "c_name, c_mktsegment, c_acctbal, n_name, r_name, order_cnt"


@query("canonical_key", f"WITH {WIDE} SELECT customer_user_id, {ATTRIBUTES} FROM w")
def canonical_key_query(spark, sf):
    return canonical_key(wide(spark, sf)).select("customer_user_id", *ATTRIBUTES.split(", "))


def _split(table):
    return lambda spark, sf: shown(vertical_split(wide(spark, sf), mapping(spark))[table])


query("vertical_split_seg", f"WITH {WIDE} {narrow_sql('SEG_01')}")(_split("SEG_01"))
query("vertical_split_geo", f"WITH {WIDE} {narrow_sql('GEO_01')}")(_split("GEO_01"))
query("vertical_split_ord", f"WITH {WIDE} {narrow_sql('ORD_01')}")(_split("ORD_01"))


def part_mapping(spark, sf):
    """A mapping with a row per part: good names in several spellings, unknown names, repeated names."""
    k = F.col("p_partkey") % 5
    column = (
        F.when(k == 0, F.lit("c_name")).when(k == 1, F.lit("N_NAME")).when(k == 2, F.lit("order_cnt"))
        .when(k == 3, F.concat(F.lit("no_such_"), F.col("p_size").cast("string"))).otherwise(F.lit("Customer_User_id"))
    )
    return read(spark, sf, "part").select(
        F.col("p_partkey").alias("pos"),
        F.concat(F.col("p_brand"), F.lit("_"), (F.col("p_partkey") % 97).cast("string")).alias("table_name"),
        column.alias("column_name"),
    )


PART_MAPPING = """m AS (SELECT p_partkey AS pos, p_brand || '_' || (p_partkey % 97) AS table_name,
  CASE p_partkey % 5 WHEN 0 THEN 'c_name' WHEN 1 THEN 'N_NAME' WHEN 2 THEN 'order_cnt'
    WHEN 3 THEN 'no_such_' || p_size ELSE 'Customer_User_id' END AS column_name FROM part)"""


@query("mapping_groups", f"""WITH {PART_MAPPING} SELECT table_name, min(pos) AS first_pos,
  string_agg(column_name, ',' ORDER BY pos) AS columns FROM m GROUP BY table_name""")
def mapping_groups_query(spark, sf):
    return mapping_groups(part_mapping(spark, sf)).withColumn("columns", F.array_join("columns", ","))


@query("mapping_errors", f"""WITH {PART_MAPPING}
  SELECT DISTINCT table_name, column_name, 'missing' AS problem FROM m WHERE lower(column_name) LIKE 'no_such%'
  UNION ALL
  SELECT table_name, min(column_name) AS column_name, 'repeated' AS problem FROM m
  GROUP BY table_name, lower(column_name) HAVING count(*) > 1""")
def mapping_errors_query(spark, sf):
    return mapping_errors(wide(spark, sf), part_mapping(spark, sf))


@query("field_counts", f"WITH {PART_MAPPING} SELECT table_name, count(*) AS fields FROM m GROUP BY table_name")
def field_counts_query(spark, sf):
    return field_counts(part_mapping(spark, sf))


@query("capped_projection", f"WITH {WIDE} SELECT customer_user_id, c_name, c_mktsegment, c_acctbal, n_name FROM w")
def capped_projection_query(spark, sf):
    rows = canonical_key(wide(spark, sf))
    return capped_projection(rows.select(*[c for c in rows.columns if c != "customer_user_id"], "customer_user_id"), max_cols=5)


@query("registered_columns", f"""WITH {WIDE}, {bucket_ctes('w', 'b')}
  SELECT customer_user_id, c_name, c_mktsegment, id_bucket FROM b""")
def registered_columns_query(spark, sf):
    rows = with_id_bucket(canonical_key(wide(spark, sf)), n=N)
    return rows.select(*registered_columns(rows, 3)[0])


DESCRIBED = """SELECT '{t}' AS table_name, row_number() OVER ()::INTEGER AS pos, column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint'
  WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'array<float>' ELSE 'string' END AS type_name
  FROM (DESCRIBE {t})"""
DESCRIBED_TABLES = ("customer", "orders", "lineitem", "events", "embeddings", "documents")


@query("schema_rows", " UNION ALL ".join(DESCRIBED.format(t=t) for t in DESCRIBED_TABLES))
def schema_rows_query(spark, sf):
    return union_all([describe_schema(read(spark, sf, t), t) for t in DESCRIBED_TABLES])


@query("id_bucket", f"WITH {WIDE}, {bucket_ctes('w', 'b', n=256)} SELECT customer_user_id, id_bucket FROM b")
def id_bucket_query(spark, sf):
    return with_id_bucket(canonical_key(wide(spark, sf))).select("customer_user_id", BUCKET)


@query("identity_projection", f"""WITH {WIDE} SELECT customer_user_id AS row_id, customer_user_id, c_name, c_mktsegment,
  c_acctbal FROM w""")
def identity_projection_query(spark, sf):
    return identity_projection(with_id_bucket(vertical_split(wide(spark, sf), mapping(spark))["SEG_01"], n=N))


@query("identity_projection_ids", f"WITH {IDS} SELECT customer_user_id AS row_id, customer_user_id FROM ids")
def identity_projection_ids_query(spark, sf):
    return identity_projection(with_id_bucket(id_list(spark, sf), n=N), all_columns=False)


@query("allowed_projection", f"""WITH {WIDE}, {bucket_ctes('w', 'b')}
  SELECT customer_user_id, c_mktsegment, n_name, r_name, order_cnt, id_bucket FROM b""")
def allowed_projection_query(spark, sf):
    rows = with_id_bucket(canonical_key(wide(spark, sf)), n=N)
    hidden = ["c_name", "c_acctbal", "order_total", "first_order", "last_order"]
    return allowed_projection(rows, hidden, [BUCKET])


@query("schema_mapping_rows", """WITH c AS (SELECT 'part_t_' || (p_partkey % 300) || '_er' AS table_name, p_partkey AS pos,
    CASE p_partkey % 4 WHEN 0 THEN 'customer_user_id' WHEN 1 THEN 'id_bucket' ELSE 'attr_' || p_partkey END AS column_name FROM part)
  SELECT table_name, pos, 'ACX_SCHEMA_' || replace(replace(upper(table_name), 'PART_', ''), '_ER', '') AS schema_name,
    column_name AS field_name, CASE column_name WHEN 'customer_user_id' THEN 'ID' ELSE 'ATTRIBUTE' END AS type,
    CASE column_name WHEN 'customer_user_id' THEN 'AXM' END AS matching_key,
    CASE column_name WHEN 'customer_user_id' THEN 'ns-1' END AS namespace
  FROM c WHERE column_name <> 'id_bucket'""")
def schema_mapping_rows_query(spark, sf):
    k = F.col("p_partkey")
    columns = read(spark, sf, "part").select(
        F.concat(F.lit("part_t_"), (k % 300).cast("string"), F.lit("_er")).alias("table_name"),
        k.alias("pos"),
        F.when(k % 4 == 0, F.lit("customer_user_id")).when(k % 4 == 1, F.lit("id_bucket"))
        .otherwise(F.concat(F.lit("attr_"), k.cast("string"))).alias("column_name"),
    )
    return mapped_fields(columns, namespace="ns-1")


@query("input_source", """WITH t AS (SELECT CASE p_partkey % 10 WHEN 0 THEN 'part_Addressable_ids_' || p_partkey ELSE 'part_t_' || p_partkey END
    AS table_name, CASE WHEN p_partkey % 7 <> 0 THEN '2024-01-' || (10 + p_partkey % 20) END AS snapshot_dt FROM part)
  SELECT *, CASE WHEN snapshot_dt IS NULL THEN '' ELSE 's3://data/' || CASE WHEN lower(table_name) LIKE '%addressable%'
    THEN 'addressable_ids/raw_input' ELSE 'attributes/raw_input' END || '/snapshot_dt=' || snapshot_dt || '/' END AS input_source FROM t""")
def input_source_query(spark, sf):
    k = F.col("p_partkey")
    tables = read(spark, sf, "part").select(
        F.when(k % 10 == 0, F.concat(F.lit("part_Addressable_ids_"), k.cast("string")))
        .otherwise(F.concat(F.lit("part_t_"), k.cast("string"))).alias("table_name"),
        F.when(k % 7 != 0, F.concat(F.lit("2024-01-"), (k % 20 + 10).cast("string"))).alias("snapshot_dt"),
    )
    return with_input_source(tables, "data")


@query("with_snapshot", "SELECT c_custkey, c_mktsegment, '2001-06-01' AS snapshot_dt FROM customer")
def with_snapshot_query(spark, sf):
    return with_snapshot(read(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "2001-06-01")


QUALITY_OF = """SELECT {name} AS table_name, sum(c)::BIGINT AS rows, coalesce(sum(c) FILTER (WHERE k IS NULL), 0)::BIGINT AS null_keys,
  coalesce(sum(c) FILTER (WHERE c > 1), 0)::BIGINT AS duplicate_rows
  FROM (SELECT {key} AS k, count(*) AS c FROM {source} GROUP BY 1)"""


@query("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("customer", "orders", "events", "lineitem")))
def row_counts_query(spark, sf):
    return row_counts({t: read(spark, sf, t) for t in ("customer", "orders", "events", "lineitem")})


@query("key_quality", f"WITH {DIRTY} " + " UNION ALL ".join([
    QUALITY_OF.format(name="'dirty'", key="customer_user_id", source="dirty"),
    QUALITY_OF.format(name="'orders'", key="o_custkey", source="orders"),
    QUALITY_OF.format(name="'customer'", key="c_custkey", source="customer"),
]))
def key_quality_query(spark, sf):
    return key_quality({
        "dirty": dirty(spark, sf),
        "orders": read(spark, sf, "orders").withColumnRenamed("o_custkey", "customer_user_id"),
        "customer": read(spark, sf, "customer").withColumnRenamed("c_custkey", "customer_user_id"),
    })


@query("duplicate_rows", """SELECT coalesce(sum(c), 0)::BIGINT AS duplicate_rows
  FROM (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1) WHERE c > 1""")
def duplicate_rows_query(spark, sf):
    return duplicate_rows(read(spark, sf, "lineitem"), "l_orderkey")


@query("distinct_users", "SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS distinct_users FROM orders")
def distinct_users_query(spark, sf):
    return distinct_users(read(spark, sf, "orders"), "o_custkey")


HISTOGRAM = f"""WITH o AS (SELECT o_custkey AS customer_user_id FROM orders), {bucket_ctes('o', 'b', n=256)},
  h AS (SELECT id_bucket, count(*) AS rows, count(DISTINCT customer_user_id) AS keys FROM b GROUP BY 1),
  f AS (SELECT r::INTEGER AS id_bucket, coalesce(rows, 0) AS rows, coalesce(keys, 0) AS keys
    FROM range(256) t(r) LEFT JOIN h ON r = h.id_bucket)"""


@query("bucket_histogram", HISTOGRAM + " SELECT *, rows / (SELECT sum(rows) FROM h)::DOUBLE AS share FROM f")
def bucket_histogram_query(spark, sf):
    return bucket_histogram(read(spark, sf, "orders").withColumnRenamed("o_custkey", "customer_user_id"))


@query("bucket_balance", HISTOGRAM + """ SELECT min(rows) AS min_rows, max(rows) AS max_rows,
  count(*) FILTER (WHERE rows = 0) AS empty_buckets FROM f""")
def bucket_balance_query(spark, sf):
    return bucket_balance(bucket_histogram_query(spark, sf))


@query("split_check", """WITH n AS (SELECT count(*) AS c, count(*) FILTER (WHERE c_nationkey = 3) AS lost,
    count(*) FILTER (WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)) AS twice FROM customer)
  SELECT 'SEG_01' AS table_name, c AS source_rows, c AS rows, 0 AS missing_keys, 0 AS extra_keys, 3 AS mapped_columns, 3 AS found_columns, true AS ok FROM n
  UNION ALL SELECT 'GEO_01', c, c - lost, lost, 0, 2, 2, false FROM n
  UNION ALL SELECT 'ORD_01', c, c + twice, 0, twice, 4, 4, false FROM n""")
def split_check_query(spark, sf):
    """A good table, one that lost keys and one that has some keys twice."""
    source, groups = canonical_key(stored_wide(spark, sf)), mapping_columns(mapping(spark))
    tables = vertical_split(source, groups)
    geo, orders = tables["GEO_01"], tables["ORD_01"]
    tables["GEO_01"] = geo.where("n_name <> 'NATION_3'")
    big = read(spark, sf, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("customer_user_id"))
    tables["ORD_01"] = orders.unionByName(orders.join(big, "customer_user_id", "left_semi"))
    return check_split(source, tables, groups)


@query("reassemble", f"""WITH {WIDE} SELECT {ATTRIBUTES}, customer_user_id, CAST(order_total AS DOUBLE) AS order_total,
  CAST(first_order AS VARCHAR) AS first_order, CAST(last_order AS VARCHAR) AS last_order FROM w""")
def reassemble_query(spark, sf):
    tables = vertical_split(stored_wide(spark, sf), mapping(spark))
    return shown(reassemble([tables[t] for t in MAPPING if t in tables]))
