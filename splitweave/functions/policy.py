"""Nested policy documents kept as JSON text."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from splitweave.functions.keys import as_column

# Field names of the policy document.
POLICY_SCHEMA = (
    "v1 struct<custom:struct<allowedAnalyses:array<string>,"
    "allowedAnalysisProviders:array<string>,allowedResultReceivers:array<string>>>"
)
PROVIDERS = "allowedAnalysisProviders"
RECEIVERS = "allowedResultReceivers"
MINIMUM_PEOPLE = 2


def analysis_rule(
    kind: str,
    providers: list[str] = (),
    columns: list[str] = (),
    joins: list[str] = (),
    functions: list[str] = ("ALL",),
) -> str:
    """Rule document of a table: custom (who may query), aggregation or list (what a query may do)."""
    if kind == "custom":
        body = {"allowedAnalyses": ["ANY_QUERY"], PROVIDERS: list(providers)}
    elif kind == "aggregation":
        body = {
            "aggregateColumns": [{"columnNames": list(columns), "function": "ALLOWED"}],
            "dimensionColumns": list(columns),
            "joinColumns": list(joins),
            "outputConstraints": [{"column": c, "minimum": MINIMUM_PEOPLE, "type": "COUNT_DISTINCT"} for c in columns[:1]],
            "scalarFunctions": list(functions),
        }
    elif kind == "list":
        body = {"joinColumns": list(joins), "listColumns": list(columns), "allowedJoinOperators": ["OR"]}
    else:
        raise ValueError(f"unknown rule kind {kind}")
    return json.dumps({"v1": {kind: body}})


def policy_list(document: Column | str, field: str) -> Column:
    """One list of a policy document; a missing level gives an empty list."""
    parsed = F.from_json(as_column(document), POLICY_SCHEMA)
    return F.coalesce(parsed["v1"]["custom"][field], F.array().cast("array<string>"))


def providers(document: Column | str) -> Column:
    return policy_list(document, PROVIDERS)


def receivers(document: Column | str) -> Column:
    return policy_list(document, RECEIVERS)


def lists_equal(a: Column | str, b: Column | str, ordered: bool = False) -> Column:
    left, right = as_column(a), as_column(b)
    if ordered:
        return left == right
    return F.array_sort(F.array_distinct(left)) == F.array_sort(F.array_distinct(right))


def list_add(values: Column | str, extra: Column) -> Column:
    """The list with one more value, without repeats."""
    return F.array_union(as_column(values), F.array(extra))
