"""Operators against plain Python on small random inputs with NULL and repeated keys."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from splitweave.operators.identity import map_identities
from splitweave.operators.joins import join_bucketed
from splitweave.operators.layout import write_bucketed
from splitweave.operators.privacy import overlap_list, private_overlap
from splitweave.operators.quality import check_split, key_quality
from splitweave.operators.ranking import dedupe_keep
from splitweave.sources.paths import shared_scratch

SEEDS = [1, 2, 3]


@pytest.fixture()
def keyed(request):
    r = random.Random(request.param)

    def table(n):
        return [(r.choice([None, *range(12)]), i, r.choice("xyz")) for i in range(n)]

    return table(25), table(20)


def frame(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, ("bigint", "bigint", "string"))))


@pytest.mark.parametrize("keyed", SEEDS, indirect=True)
def test_identities(spark, keyed):
    left, right = keyed
    s, t = Counter(k for k, *_ in left), Counter(k for k, *_ in right if k is not None)
    want = {
        (k, "unmatched" if k is None or not t[k] else "matched" if c == t[k] == 1 else "ambiguous") for k, c in s.items()
    }
    out = map_identities(frame(spark, left, ["k", "row_id", "d"]), frame(spark, right, ["k", "target_id", "e"]), "k").collect()
    assert {(r["k"], r["status"]) for r in out} == want
    ids, targets = {k: i for k, i, _ in left}, {k: i for k, i, _ in right}
    for r in out:
        if r["status"] == "matched":
            assert (r["source_id"], r["target_id"]) == (ids[r["k"]], targets[r["k"]])


@pytest.mark.parametrize("keyed", SEEDS, indirect=True)
def test_overlap(spark, keyed):
    left, right = keyed
    groups = defaultdict(list)
    for ka, va, d in left:
        for kb, vb, e in right:
            if ka is not None and ka == kb:
                groups[d, e].append((ka, va, vb))
    want = {
        g: (len(p), len({k for k, _, _ in p}), sum(va for _, va, _ in p), max(vb for _, _, vb in p))
        for g, p in groups.items() if len({k for k, _, _ in p}) >= 2
    }
    aggs = {"n": ("count", "*"), "people": ("count_distinct", "k"), "s": ("sum", "va"), "m": ("max", "vb")}
    a, b = frame(spark, left, ["k", "va", "d"]), frame(spark, right, ["k", "vb", "e"])
    got = {(r["d"], r["e"]): (r["n"], r["people"], r["s"], r["m"]) for r in private_overlap(a, b, ["k"], ["d", "e"], aggs, "k").collect()}
    assert got == want
    listed = overlap_list(a, b, ["k"], ["d", "e"], ["k"], ["d", "e"])
    assert {(r["d"], r["e"]) for r in listed.collect()} == set(groups)
    alone = overlap_list(a, b, ["k"], ["va"], ["k"], ["va"])
    keys = {k for k, *_ in right if k is not None}
    assert {r["va"] for r in alone.collect()} == {v for k, v, _ in left if k in keys}


@pytest.mark.parametrize("keyed", SEEDS, indirect=True)
def test_keep_one(spark, keyed):
    rows = [(name, i, d == "x", (i * 7) % 5) for name, i, d in keyed[0]]
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    kept = set()
    for name, members in groups.items():
        if name == 3:
            kept |= {m[1] for m in members}
        else:
            kept.add(min(members, key=lambda m: (not m[2], m[3], m[1]))[1])
    df = spark.createDataFrame(rows, "name bigint, id bigint, associated boolean, created bigint")
    got, dropped = dedupe_keep(df, "name", "associated", "created", "id", [3])
    assert {r["id"] for r in got.collect()} == kept
    assert sorted([r["id"] for r in got.collect()] + [r["id"] for r in dropped.collect()]) == [m[1] for m in rows]


@pytest.mark.parametrize("keyed", SEEDS, indirect=True)
def test_key_quality_and_split(spark, keyed):
    left, right = keyed
    a, b = (frame(spark, t, ["customer_user_id", "v", "d"]) for t in keyed)
    for rows, df in ((left, a), (right, b)):
        c = Counter(k for k, *_ in rows)
        got = key_quality({"t": df}).first()
        assert (got["rows"], got["null_keys"], got["duplicate_rows"]) == (len(rows), c[None], sum(n for n in c.values() if n > 1))
    s, t = Counter(k for k, *_ in left), Counter(k for k, *_ in right)
    row = check_split(a, {"T": b}, {"T": ["v", "d"]}).first()
    assert (row["missing_keys"], row["extra_keys"]) == (sum((s - t).values()), sum((t - s).values()))
    assert (row["source_rows"], row["rows"], row["mapped_columns"], row["found_columns"]) == (len(left), len(right), 2, 2)


@pytest.mark.parametrize("keyed", SEEDS[:1], indirect=True)
def test_bucketed_join(spark, keyed, db):
    left, right = keyed
    a, b = frame(spark, left, ["customer_user_id", "v", "d"]), frame(spark, right, ["customer_user_id", "w", "e"])
    for name, df in (("a", a), ("b", b)):
        write_bucketed(df, f"{db}.{name}", shared_scratch(spark, name), n=4)
    want = Counter((k, v, w) for k, v, _ in left for j, w, _ in right if k is not None and k == j)
    for hot in ([], [1, 5]):
        got = join_bucketed(spark, f"{db}.a", f"{db}.b", hot=hot).select("customer_user_id", F.col("v"), F.col("w")).collect()
        assert Counter(map(tuple, got)) == want
