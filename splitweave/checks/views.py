"""Inputs of the registered queries, derived from the given tables; in Spark and, alike, as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.functions.text import join_path
from splitweave.sources.paths import shared_scratch

N = 16
AS_OF = "2001-06-30"
CHECKED_AT = "2001-06-30 12:00:00"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- the wide source -------------------------------------------------------------------------------------------------


def wide(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("order_cnt"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("order_total"),
        F.min("o_orderdate").cast("date").alias("first_order"),
        F.max("o_orderdate").cast("date").alias("last_order"),
    )
    nation, region = read(spark, sf, "nation"), read(spark, sf, "region")
    return (
        read(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(orders, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("Customer_User_id"),
            "c_name", "c_mktsegment", "c_acctbal", "n_name", "r_name",
            F.coalesce("order_cnt", F.lit(0).cast("bigint")).alias("order_cnt"),
            "order_total", "first_order", "last_order",
        )
    )


WIDE = """w AS (
  SELECT c_custkey AS customer_user_id, c_name, c_mktsegment, c_acctbal, n_name, r_name,
         coalesce(order_cnt, 0) AS order_cnt, order_total, first_order, last_order
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (
    SELECT o_custkey, count(*) AS order_cnt, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS order_total,
           CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order
    FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""

MAPPING = {
    "SEG_01": ["c_name", "c_mktsegment", "c_acctbal"],
    "GEO_01": ["n_name", "r_name"],
    "ORD_01": ["CUSTOMER_USER_ID", "order_cnt", "order_total", "first_order", "last_order"],
    "BAD_01": ["c_name", "no_such_column"],
}
MAPPING_ROWS = [(t, c) for t, cols in MAPPING.items() for c in cols]


def mapping(spark: SparkSession) -> DataFrame:
    rows = [(i, t, c) for i, (t, c) in enumerate(MAPPING_ROWS)]
    return spark.createDataFrame(rows, "pos bigint, table_name string, column_name string")


def narrow_sql(table: str, source: str = "w", extra: str = "") -> str:
    """SELECT of one narrow table with the decimal and the dates as the compare wants them."""
    shown = {
        "order_total": "CAST(order_total AS DOUBLE) AS order_total",
        "first_order": "CAST(first_order AS VARCHAR) AS first_order",
        "last_order": "CAST(last_order AS VARCHAR) AS last_order",
    }
    cols = [c.lower() for c in MAPPING[table]]
    cols = cols if "customer_user_id" in cols else cols + ["customer_user_id"]
    return "SELECT " + ", ".join(shown.get(c, c) for c in cols) + extra + " FROM " + source


def shown(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, as in ``narrow_sql``."""
    kinds = {"order_total": "double", "first_order": "string", "last_order": "string"}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


# -- the exact bucket in SQL -----------------------------------------------------------------------------------------

# The five primes of the public xxHash64 algorithm.
PRIMES = [11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261]


def bucket_ctes(source: str, out: str, key: str = "customer_user_id", n: int = N) -> str:
    """CTEs that end in ``out``: all columns of ``source`` and ``id_bucket`` of a 64-bit key, n a power of two."""
    word = "18446744073709551616"
    p1, p2, p3, p4, p5 = [f"{p}::UHUGEINT" for p in PRIMES]
    m = f"{word}::UHUGEINT"

    def rotated(x: str, r: int) -> str:
        return f"(({x} * {2 ** r}::UHUGEINT) % {m} + {x} // {2 ** (64 - r)}::UHUGEINT)"

    steps = [
        f"((({key}::HUGEINT + {word}::HUGEINT) % {word}::HUGEINT)::UHUGEINT * {p2}) % {m}",
        f"({rotated('hv', 31)} * {p1}) % {m}",
        f"xor(hv, (50::UHUGEINT + {p5}) % {m})",
        f"({rotated('hv', 27)} * {p1} + {p4}) % {m}",
        f"(xor(hv, hv // {2 ** 33}::UHUGEINT) * {p2}) % {m}",
        f"(xor(hv, hv // {2 ** 29}::UHUGEINT) * {p3}) % {m}",
        f"xor(hv, hv // {2 ** 32}::UHUGEINT) % {n}::UHUGEINT",
    ]
    ctes, last = [], source
    for i, step in enumerate(steps):
        cols = "*" if i == 0 else "* EXCLUDE (hv)"
        ctes.append(f"{out}_{i} AS (SELECT {cols}, {step} AS hv FROM {last})")
        last = f"{out}_{i}"
    ctes.append(f"{out} AS (SELECT * EXCLUDE (hv), CASE WHEN {key} IS NULL THEN {42 % n} ELSE hv::INTEGER END AS id_bucket FROM {last})")
    return ",\n".join(ctes)


# -- snapshots, keys with defects ------------------------------------------------------------------------------------


def dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    day = F.concat(F.year("o_orderdate").cast("string"), F.lit("-01-01"))
    return read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day.alias("snapshot_dt"))


DATED = """d AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS snapshot_dt FROM orders)"""


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        "event_id", "event_type", "value", F.expr("nullif(user_id % 10, 0)").alias("customer_user_id")
    )


DIRTY = "dirty AS (SELECT event_id, event_type, value, nullif(user_id % 10, 0) AS customer_user_id FROM events)"


def id_list(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(F.col("user_id").alias("customer_user_id")).distinct()


IDS = "ids AS (SELECT DISTINCT user_id AS customer_user_id FROM events)"


# -- registry tables from part ---------------------------------------------------------------------------------------

# Account numbers made up for the tests.
ACCOUNT_A, ACCOUNT_B = "111122223333", "444455556666"
LABELS = {ACCOUNT_A: "Query runner"}


def _k(part: int) -> Column:
    return F.col("p_partkey") % part


def _policy(field: str, first: int) -> Column:
    lists = (
        F.when((F.col("p_partkey") + first) % 3 == 0, F.lit(""))
        .when((F.col("p_partkey") + first) % 3 == 1, F.lit(f'"{ACCOUNT_A}"'))
        .otherwise(F.lit(f'"{ACCOUNT_A}","{ACCOUNT_B}"'))
    )
    full = F.concat(F.lit('{"v1":{"custom":{"' + field + '":['), lists, F.lit("]}}}"))
    return F.when(_k(11) == 0, F.lit('{"v1":{}}')).otherwise(full)


def _policy_sql(field: str, first: int) -> str:
    return f"""CASE WHEN p_partkey % 11 = 0 THEN '{{"v1":{{}}}}' ELSE
      '{{"v1":{{"custom":{{"{field}":[' || CASE (p_partkey + {first}) % 3 WHEN 0 THEN '' WHEN 1 THEN '"{ACCOUNT_A}"'
      ELSE '"{ACCOUNT_A}","{ACCOUNT_B}"' END || ']}}}}}}' END"""


def registry(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    part = read(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    table = F.concat(F.lit("part_t_"), key)
    return {
        "tables": part.select(table.alias("table_name"), F.col("p_size").alias("column_count"), F.lit("id_bucket").alias("partition_keys")),
        "configured": part.where(_k(7) != 0).select(
            table.alias("name"), F.concat(F.lit("ct-"), key).alias("id"), (F.col("p_size") - 1).alias("allowed_columns_count"),
            F.lit("DIRECT_QUERY").alias("analysis_method"),
        ),
        "rules": part.where(_k(5) != 0).select(
            F.concat(F.lit("ct-"), key).alias("id"), _policy("allowedAnalysisProviders", 0).alias("document")
        ),
        "associations": part.where(_k(4) != 0).select(
            F.concat(F.lit("acx_"), table).alias("association_name"),
            F.when(_k(13) != 0, _policy("allowedResultReceivers", 1)).alias("result_rule"),
        ),
    }


REGISTRY = f"""t AS (SELECT p_partkey, 'part_t_' || p_partkey AS table_name, p_size AS column_count FROM part),
conf AS (SELECT 'part_t_' || p_partkey AS name, 'ct-' || p_partkey AS id, p_size - 1 AS allowed_columns_count, 'DIRECT_QUERY' AS analysis_method FROM part WHERE p_partkey % 7 <> 0),
rules AS (SELECT 'ct-' || p_partkey AS id, {_policy_sql('allowedAnalysisProviders', 0)} AS document FROM part WHERE p_partkey % 5 <> 0),
assoc AS (SELECT 'acx_part_t_' || p_partkey AS association_name,
  CASE WHEN p_partkey % 13 <> 0 THEN {_policy_sql('allowedResultReceivers', 1)} END AS result_rule FROM part WHERE p_partkey % 4 <> 0),
joined AS (SELECT p_partkey, table_name, column_count, conf.id AS configured_id, allowed_columns_count, analysis_method, document AS rule, association_name, result_rule
  FROM t LEFT JOIN conf ON conf.name = table_name LEFT JOIN rules ON rules.id = conf.id
  LEFT JOIN assoc ON association_name = 'acx_' || table_name),
policy AS (SELECT *, coalesce(from_json(json_extract(rule, '$.v1.custom.allowedAnalysisProviders'), '["VARCHAR"]'), []) AS providers,
  coalesce(from_json(json_extract(result_rule, '$.v1.custom.allowedResultReceivers'), '["VARCHAR"]'), []) AS receivers FROM joined),
ready AS (SELECT *, configured_id IS NOT NULL AS configured, rule IS NOT NULL AS has_rule, association_name IS NOT NULL AS associated,
  (configured_id IS NOT NULL AND rule IS NOT NULL AND association_name IS NOT NULL AND len(providers) > 0) AS ready FROM policy)"""


def copies(spark: SparkSession, sf: str) -> DataFrame:
    """Several registry rows of one name, some associated, with a creation date."""
    return read(spark, sf, "part").select(
        F.concat(F.lit("part_t_"), _k(300).cast("string")).alias("name"),
        F.col("p_partkey").alias("id"),
        (_k(3) == 0).alias("is_associated"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string").alias("created"),
    )


COPIES = """copies AS (SELECT 'part_t_' || (p_partkey % 300) AS name, p_partkey AS id, p_partkey % 3 = 0 AS is_associated,
  CAST(DATE '2024-01-01' + p_size AS VARCHAR) AS created FROM part)"""


# -- written inputs, once per session and data directory ------------------------------------------------------------

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf: str, name: str, write) -> str:
    """Directory that ``write(path)`` filled; written the first time it is asked for."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _written:
        path = shared_scratch(spark, name)
        write(path)
        _written[at] = path
    return _written[at]


def wide_snapshots(spark: SparkSession, sf: str) -> str:
    """Two dated snapshots of the wide source, a directory that is none, and an older one with fewer columns."""

    def write(path: str) -> None:
        rows = wide(spark, sf)
        rows.write.parquet(join_path(path, "snapshot_dt=2001-06-01"))
        rows = spark.read.parquet(join_path(path, "snapshot_dt=2001-06-01"))
        rows.select("Customer_User_id").write.parquet(join_path(path, "snapshot_dt=2001-05-01"))
        rows.select("Customer_User_id").write.parquet(join_path(path, "snapshot_old"))

    return once(spark, sf, "wide-snapshots", write)


def stored_wide(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(join_path(wide_snapshots(spark, sf), "snapshot_dt=2001-06-01"))


def id_snapshots(spark: SparkSession, sf: str) -> str:
    def write(path: str) -> None:
        id_list(spark, sf).withColumnRenamed("customer_user_id", "Customer_User_id").write.parquet(
            join_path(path, "snapshot_dt=2001-06-01")
        )

    return once(spark, sf, "id-snapshots", write)


def order_snapshots(spark: SparkSession, sf: str) -> str:
    def write(path: str) -> None:
        dated_orders(spark, sf).write.partitionBy("snapshot_dt").parquet(path)

    return once(spark, sf, "order-snapshots", write)
