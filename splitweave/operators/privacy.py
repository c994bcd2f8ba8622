"""Queries under shared-data rules: minimum population and list overlap.

The minimum counts distinct persons on the joined rows. It does not protect against differencing two queries.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitweave.operators.quality import union_all
from splitweave.operators.skew import both_salted_join, hot_keys, salted_join

ALLOWED = ("count", "count_distinct", "sum", "avg", "min", "max")
Aggs = dict[str, tuple[str, str]]


def _check(aggs: Aggs, allowed: tuple[str, ...]) -> None:
    refused = sorted({f for f, _ in aggs.values()} - set(allowed))
    if refused:
        raise ValueError(f"aggregates not allowed: {refused}")


def _plain(function: str, column: str) -> Column:
    if function == "count":
        return F.count(column)
    return {"count_distinct": F.count_distinct, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[function](column)


def private_aggregate(
    df: DataFrame, dims: list[str], aggs: Aggs, constraint: str, minimum: int = 2, allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """``aggs`` is {name: (function, column)}. Groups with fewer than ``minimum`` distinct ``constraint`` values go."""
    _check(aggs, allowed)
    outputs = [_plain(f, c).alias(name) for name, (f, c) in aggs.items()]
    return (
        df.groupBy(*dims).agg(*outputs, F.count_distinct(constraint).alias("_people"))
        .where(F.col("_people") >= minimum).drop("_people")
    )


def _outside(named: Iterable[str], allowed: list[str], what: str) -> None:
    refused = sorted(set(named) - set(allowed))
    if refused:
        raise ValueError(f"{what} not allowed: {refused}")


# Fixed value: the function of a rule's column group that allows every aggregate.
ANY_FUNCTION = "ALLOWED"


# Scalar functions of one column that a rule document may name, and the word that allows all of them.
SCALARS = ("ABS", "CEILING", "FLOOR", "LN", "LOWER", "ROUND", "RTRIM", "SQRT", "TRIM", "UPPER")
ANY_SCALAR = "ALL"
Scalars = dict[str, tuple[str, str]]


def _scalar(df: DataFrame, scalars: Scalars, allowed: list[str]) -> DataFrame:
    """The derived columns that this side has the inputs of, after checking that the rule names their functions."""
    named = {f.upper() for f, _ in scalars.values()}
    _outside(named, SCALARS, "scalar functions")
    if ANY_SCALAR not in allowed:
        _outside(named, [f.upper() for f in allowed], "scalar functions")
    for name, (f, c) in scalars.items():
        if c in df.columns:
            df = df.withColumn(name, F.call_function(f.lower(), F.col(c)))
    return df


def _aggregation(rule: str, dims: list[str], aggs: Aggs, scalars: Scalars | None = None) -> list[dict]:
    """The output constraints of an aggregation rule document, after checking that it allows the dimensions and aggregates.

    A derived column is allowed where the column it comes from is.
    """
    body = json.loads(rule)["v1"]["aggregation"]
    of = lambda c: (scalars or {}).get(c, (None, c))[1]
    dims, aggs = [of(d) for d in dims], {n: (f, of(c)) for n, (f, c) in aggs.items()}
    _outside(dims, body["dimensionColumns"], "dimensions")
    groups = body["aggregateColumns"]
    _outside({c for _, c in aggs.values()}, [c for g in groups for c in g["columnNames"]], "columns")
    allowed = {(f, c) for g in groups for c in g["columnNames"] for f in (ALLOWED if g["function"] == ANY_FUNCTION else [g["function"].lower()])}
    refused = sorted(set(aggs.values()) - allowed)
    if refused:
        raise ValueError(f"aggregates not allowed: {refused}")
    if not body["outputConstraints"]:
        raise ValueError("the rule has no output constraint, so nobody's rows would be protected")
    return body["outputConstraints"]


def _constrained(aggregate: Callable[[Aggs, str, int], DataFrame], aggs: Aggs, limits: list[dict]) -> DataFrame:
    """The aggregate under its first constraint, without the groups that fail one of the others."""
    hidden = {f"_limit{i}": ("count_distinct", c["column"]) for i, c in enumerate(limits[1:])}
    out = aggregate({**aggs, **hidden}, limits[0]["column"], limits[0]["minimum"])
    for name, c in zip(hidden, limits[1:]):
        out = out.where(F.col(name) >= c["minimum"])
    return out.drop(*hidden)


def aggregate_by_rule(df: DataFrame, rule: str, dims: list[str], aggs: Aggs, scalars: Scalars | None = None) -> DataFrame:
    """``private_aggregate`` under an aggregation rule document: its columns, its functions for each, its minimum.

    ``scalars`` is {new column: (function, column)}; the rule must name the function among its scalar functions. A rule without an
    output constraint is refused.
    """
    limits = _aggregation(rule, dims, aggs, scalars)
    rows = _scalar(df, scalars or {}, json.loads(rule)["v1"]["aggregation"].get("scalarFunctions", []))
    return _constrained(lambda all_, column, minimum: private_aggregate(rows, dims, all_, column, minimum), aggs, limits)


def overlap_by_rule(a: DataFrame, b: DataFrame, rule: str, on: list[str], dims: list[str], aggs: Aggs, scalars: Scalars | None = None) -> DataFrame:
    """``private_overlap`` under an aggregation rule document, which must allow the join columns and scalar functions too.

    Several join columns must all be equal; a rule that lists join operators must have AND among them then.
    """
    body = json.loads(rule)["v1"]["aggregation"]
    _outside(on, body["joinColumns"], "join columns")
    if len(on) > 1 and "AND" not in body.get("allowedJoinOperators", ["AND"]):
        raise ValueError("the rule does not allow join columns to be combined with AND")
    limits = _aggregation(rule, dims, aggs, scalars)
    left, right = (_scalar(df, scalars or {}, body.get("scalarFunctions", [])) for df in (a, b))
    return _constrained(lambda all_, column, minimum: private_overlap(left, right, on, dims, all_, column, minimum), aggs, limits)


def list_by_rule(a: DataFrame, b: DataFrame, rule: str, join_cols: list[str], list_cols: list[str]) -> DataFrame:
    """``overlap_list`` under a list rule document. Several join columns need OR among its join operators."""
    body = json.loads(rule)["v1"]["list"]
    if len(join_cols) > 1 and "OR" not in body["allowedJoinOperators"]:
        raise ValueError("the rule does not allow join columns to be combined with OR")
    return overlap_list(a, b, join_cols, list_cols, body["joinColumns"], body["listColumns"])


def _collapse(df: DataFrame, on: list[str], dims: list[str], aggs: Aggs, tag: str) -> DataFrame:
    """One side with one row per join key, own dimensions and own distinct-counted columns."""
    own = [c for c in df.columns if c not in on]
    distinct = {c for f, c in aggs.values() if f == "count_distinct"}
    keys = on + [c for c in own if c in dims or c in distinct]
    measures = [F.count("*").alias(f"_n_{tag}")]
    for name, (f, c) in aggs.items():
        if c not in own or c in keys:
            continue
        if f in ("sum", "avg"):
            measures.append(F.sum(c).alias(f"_sum_{name}"))
        if f in ("count", "avg"):
            measures.append(F.count(c).alias(f"_cnt_{name}"))
        if f in ("min", "max"):
            measures.append((F.min if f == "min" else F.max)(c).alias(f"_val_{name}"))
    known = df.where(" and ".join(f"`{c}` is not null" for c in on))
    if len(keys) > len(on) and not hot_keys(known, on[0]):
        # Without a frequent key, rows shuffled by the join key serve both this grouping and the join.
        known = known.repartition(*on)
    return known.groupBy(*keys).agg(*measures)


def private_overlap(
    a: DataFrame,
    b: DataFrame,
    on: list[str],
    dims: list[str],
    aggs: Aggs,
    constraint: str,
    minimum: int = 2,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """Minimum-population aggregate over ``a`` joined with ``b``.

    The pairs of a key are never formed: each side is collapsed first to partial counts and sums, and a row of one
    side then weighs as many times as the other side has rows. A frequent key is collapsed on the map side before
    any shuffle. Where both sides have distinct-counted columns, each side's are counted in a join of their own, against no
    more than the other side's dimensions: a key with many values on both sides then never forms their product.
    Column names other than ``on`` must differ between the sides.
    """
    _check(aggs, allowed)
    shared = sorted((set(a.columns) & set(b.columns)) - set(on))
    if shared:
        raise ValueError(f"columns on both sides: {shared}")
    distinct = {n: c for n, (f, c) in aggs.items() if f == "count_distinct"} | {"_people": constraint}
    theirs = {n: c for n, c in distinct.items() if c not in a.columns and c not in dims}
    ours = {n: c for n, c in distinct.items() if c not in on and c not in dims and n not in theirs}
    every = aggs | {"_people": ("count_distinct", constraint)}
    if not (ours and theirs):
        counted = _overlap(a, b, on, dims, every)
    else:
        first = _overlap(a, b, on, dims, {n: v for n, v in every.items() if n not in theirs})
        second = _overlap(a, b, on, dims, {n: every[n] for n in theirs})
        # Both have the same groups; as a union they meet by grouping, where NULL dimensions are equal.
        counted = first.unionByName(second, allowMissingColumns=True).groupBy(*dims).agg(*[F.first(n, ignorenulls=True).alias(n) for n in every])
    return counted.where(F.col("_people") >= minimum).select(*dims, *aggs)


def _overlap(a: DataFrame, b: DataFrame, on: list[str], dims: list[str], aggs: Aggs) -> DataFrame:
    left, right = (_collapse(df, on, dims, aggs, t) for df, t in ((a, "a"), (b, "b")))
    joined = left.join(right, on, "inner")
    pairs = F.col("_n_a") * F.col("_n_b")

    def output(name: str, f: str, c: str) -> Column:
        other = F.col("_n_b") if c in a.columns and c not in on else F.col("_n_a")
        if c == "*":
            return F.sum(pairs)
        collapsed = c in left.columns or c in right.columns
        if f == "count_distinct":
            return F.count_distinct(c)
        if f in ("min", "max"):
            return (F.min if f == "min" else F.max)(c if collapsed else f"_val_{name}")
        count = F.sum(F.when(F.col(c).isNotNull(), pairs)) if collapsed else F.sum(F.col(f"_cnt_{name}") * other)
        if f == "count":
            return F.coalesce(count, F.lit(0))
        total = F.sum(F.col(c) * pairs) if collapsed else F.sum(F.col(f"_sum_{name}") * other)
        return total if f == "sum" else total / count

    return joined.groupBy(*dims).agg(*[output(n, f, c).alias(n) for n, (f, c) in aggs.items()])


def overlap_list(
    a: DataFrame, b: DataFrame, join_cols: list[str], list_cols: list[str], allowed_join: list[str], allowed_list: list[str]
) -> DataFrame:
    """Distinct ``list_cols`` of the rows of ``a`` that have a partner in ``b`` on any of ``join_cols``.

    Several join columns combine with OR, as a union of equi-joins. Columns of ``b`` may be listed too. A side that
    could multiply rows is made distinct before they meet, and keys frequent on either side are salted there.
    """
    _outside(join_cols, allowed_join, "join columns")
    _outside(list_cols, allowed_list, "list columns")
    theirs = [c for c in list_cols if c not in a.columns]
    ours = [c for c in list_cols if c in a.columns]

    def on(j: str) -> DataFrame:
        left = a.where(F.col(j).isNotNull()).select(*dict.fromkeys([j, *ours]))
        right = b.where(F.col(j).isNotNull()).select(*dict.fromkeys([j, *theirs])).distinct()
        hot = hot_keys(a, j)
        if not theirs:
            return salted_join(left, right, j, "left_semi", hot).select(*list_cols)
        return both_salted_join(left.distinct(), right, j, hot, hot_keys(b, j)).select(*list_cols)

    return union_all([on(j) for j in join_cols]).distinct()
