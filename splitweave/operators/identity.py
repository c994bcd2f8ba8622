"""One-to-one identity mapping and the identity report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitweave.functions.text import arn_part, arn_path, join_path, method_label, or_na
from splitweave.operators.ranking import first_per_group
from splitweave.sources.paths import shared_scratch

RULE = "ONE_SOURCE_TO_ONE_TARGET"


def _per_key(df: DataFrame, on: str, id_col: str, rows: str, one: str) -> DataFrame:
    return df.groupBy(F.col(on).alias("k")).agg(F.count("*").alias(rows), F.min(id_col).alias(one))


def map_identities(
    source: DataFrame, target: DataFrame, on: str, source_id: str = "row_id", target_id: str = "target_id", rule: str = RULE
) -> DataFrame:
    """One row per source key: status matched, ambiguous or unmatched.

    A key that is on both sides exactly once is matched and carries both ids. A key on both sides but repeated on
    either is ambiguous. A key the target lacks, or a NULL key, is unmatched. Each side is counted per key before
    the join, so the join meets every key once and a frequent key never forms pairs.
    """
    s = _per_key(source, on, source_id, "source_rows", "source_id")
    t = _per_key(target.where(F.col(on).isNotNull()), on, target_id, "target_rows", "target_id")
    both = s.join(t, "k", "left").na.fill(0, ["target_rows"])
    status = (
        F.when(F.col("target_rows") == 0, F.lit("unmatched"))
        .when((F.col("source_rows") == 1) & (F.col("target_rows") == 1), F.lit("matched"))
        .otherwise(F.lit("ambiguous"))
    )
    matched = F.col("status") == "matched"
    return both.withColumn("status", status).select(
        F.col("k").alias(on),
        "status",
        "source_rows",
        "target_rows",
        F.when(matched, F.col("source_id")).alias("source_id"),
        F.when(matched, F.col("target_id")).alias("target_id"),
        F.when(matched, F.lit(rule)).alias("rule_name"),
    )


def matched(mapped: DataFrame) -> DataFrame:
    return mapped.where("status = 'matched'").select("source_id", "target_id", "rule_name")


def unmatched(mapped: DataFrame, on: str) -> DataFrame:
    return mapped.where("status = 'unmatched'").select(on, "source_rows")


def ambiguous(mapped: DataFrame, on: str) -> DataFrame:
    return mapped.where("status = 'ambiguous'").select(on, "source_rows", "target_rows")


def map_identities_by_rules(
    source: DataFrame, target: DataFrame, rules: list[tuple[str, str | list[str]]], source_id: str = "row_id", target_id: str = "target_id"
) -> DataFrame:
    """(source_id, target_id, rule_name) for several (rule name, column or columns) pairs; the first rule that matches wins.

    A rule of several columns matches rows that are equal in all of them; a NULL in any of them matches nothing. Ids
    must be unique on their side. Rows already matched take no part in later rules.

    Both sides are read once, whatever the number of rules: the keys of all rules become one written table of candidates
    (rank of the rule, key, side, id). The ranks are then
    resolved in order among the ids still open; each takes one anti-join by id, which spreads evenly, and one grouping
    by key, both of its own candidates only.
    """
    if not rules:
        raise ValueError("no rules")
    spark, folder = source.sparkSession, shared_scratch(source.sparkSession, "identities")
    columns = [[given] if isinstance(given, str) else list(given) for _, given in rules]
    flat = list(dict.fromkeys(c for cs in columns for c in cs))
    # One union, so that Spark brings the columns of both sides to common types.
    both = source.select(F.lit(True).alias("_s"), F.col(source_id).cast("string").alias("_id"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(flat)]).unionAll(
        target.select(F.lit(False).alias("_s"), F.col(target_id).cast("string").alias("_id"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(flat)])
    )
    at = {c: f"_c{i}" for i, c in enumerate(flat)}
    keys = [_key([_text(both, at[c]) for c in cs]).alias(str(i)) for i, cs in enumerate(columns)]
    offered = both.select("_s", "_id", F.posexplode(F.array(*keys)).alias("rank", "key")).where("key is not null")
    # Text, rank and key in each file part in order of rank, so that a rank reads its own row groups.
    offered.sortWithinPartitions("rank").write.parquet(join_path(folder, "candidates"))
    candidates = spark.read.schema(offered.schema).parquet(join_path(folder, "candidates"))
    pair = "_source string, _target string, rank int"
    places: list[str] = []
    for i in range(len(rules)):
        mine = candidates.where(F.col("rank") == i)
        if places:
            taken = spark.read.schema(pair).parquet(*places)
            gone = taken.select(F.explode(F.array(F.struct(F.lit(True).alias("_s"), F.col("_source").alias("_id")), F.struct(F.lit(False).alias("_s"), F.col("_target").alias("_id")))).alias("t")).select("t.*")
            mine = mine.join(gone, ["_s", "_id"], "left_anti")
        one = mine.groupBy("key").agg(
            F.count_if("_s").alias("s"), F.count_if(~F.col("_s")).alias("t"),
            F.max(F.when(F.col("_s"), F.col("_id"))).alias("_source"), F.max(F.when(~F.col("_s"), F.col("_id"))).alias("_target"),
        ).where("s = 1 and t = 1")
        places.append(join_path(folder, f"rule-{i}"))
        one.select("_source", "_target", F.lit(i).alias("rank")).write.parquet(places[-1])
    names = F.element_at(F.lit([n for n, _ in rules]), F.col("rank") + 1)
    return spark.read.schema(pair).parquet(*places).select(
        F.col("_source").cast(source.schema[source_id].dataType).alias("source_id"), F.col("_target").cast(target.schema[target_id].dataType).alias("target_id"), names.alias("rule_name")
    )


def _text(df: DataFrame, column: str) -> Column:
    """A column as text that is equal if and only if the values are: no negative zero, whole timestamps, bytes as digits."""
    kind = df.schema[column].dataType
    if kind.typeName() in ("float", "double"):
        return F.when(F.col(column) == 0, "0").otherwise(F.col(column).cast("string"))
    return F.hex(column) if kind.typeName() == "binary" else F.col(column).cast("string")


def _key(columns: list[Column]) -> Column:
    """The columns as one text, equal if and only if all of them are; NULL if one is."""
    known = reduce(Column.__and__, [c.isNotNull() for c in columns])
    return F.when(known, F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])))


def namespace_rows(namespaces: DataFrame) -> DataFrame:
    """Flat namespace rows from (name, input_sources array<struct<arn, schema_name>>, mappings array<struct<type>>)."""
    first = F.get("input_sources", F.lit(0))
    arn = first["arn"]
    has_table = F.coalesce(arn.contains("table"), F.lit(False))
    return namespaces.select(
        "name",
        method_label(F.get("mappings", F.lit(0))["type"]).alias("method"),
        F.when(has_table, arn_part(arn, 3)).alias("region"),
        F.when(has_table, arn_path(arn, 2)).alias("source_db"),
        F.when(has_table, arn_path(arn, 1)).alias("table_name"),
        first["schema_name"].alias("schema_name"),
    )


def schema_fields(mappings: DataFrame) -> DataFrame:
    """Unique id, input field and match key of (schema_name, fields array<struct<field_name, type, match_key>>)."""
    unique = F.filter("fields", lambda f: f["type"] == "UNIQUE_ID")
    keyed = F.filter("fields", lambda f: f["type"].isin("ID", "STRING") & (F.coalesce(f["match_key"], F.lit("")) != ""))
    return mappings.select(
        F.upper("schema_name").alias("schema_upper"),
        F.col("schema_name").alias("mapping_name"),
        F.try_element_at(unique, F.lit(-1))["field_name"].alias("unique_id"),
        F.try_element_at(keyed, F.lit(-1))["field_name"].alias("input_field"),
        F.try_element_at(keyed, F.lit(-1))["match_key"].alias("match_key"),
    )


def identity_report(namespaces: DataFrame, mappings: DataFrame, collaboration: str | None = None) -> DataFrame:
    """One row per namespace with the schema mapping of the same name in any case; with ``collaboration`` its name comes first."""
    fields = first_per_group(schema_fields(mappings), ["schema_upper"], [F.asc("mapping_name")])
    rows = namespace_rows(namespaces).withColumn("schema_upper", F.upper("schema_name"))
    joined = rows.join(fields, "schema_upper", "left")
    named = [] if collaboration is None else [F.lit(collaboration).alias("collaboration_name")]
    return joined.select(
        *named,
        "name",
        "method",
        *[or_na(c).alias(c) for c in ("source_db", "region", "table_name")],
        or_na(F.lower("schema_name")).alias("schema_name"),
        *[or_na(c).alias(c) for c in ("unique_id", "input_field", "match_key")],
    )
