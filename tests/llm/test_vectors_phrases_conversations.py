"""Vector range join, phrase mining and conversation repair against plain versions, and on odd inputs."""

import collections
import hashlib
import itertools
import os
import random
import re
import urllib.parse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from splitweave.llm import collocations, conversations, vectorjoin
from splitweave.llm.queries import damaged

# -- vectors


def plain_links(rows, threshold=0.95):
    usable = {}
    for i, v in rows:
        if i is None:
            continue
        good = v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable[i] = max([x for x in (usable.get(i), [float(y) for y in v] if good else None) if x is not None], default=None)
    ids = sorted(usable)
    near = collections.defaultdict(set)
    for a, b in itertools.combinations([i for i in ids if usable[i]], 2):
        x, y = usable[a], usable[b]
        width = max(len(x), len(y))
        x, y = (np.pad(v, (0, width - len(v))) / np.abs(v).max() for v in (x, y))
        if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
            near[a].add(b)
            near[b].add(a)
    out = {}
    for i in ids:
        if i not in out:
            todo = [i]
            out[i] = i
            while todo:
                for k in near[todo.pop()]:
                    if k not in out:
                        out[k] = i
                        todo.append(k)
    return sorted((i, len(near[i]), out[i], out[i] == i) for i in ids)


def clusters(r, centres, each, width, spread):
    out = []
    for _ in range(centres):
        c = r.normal(size=width)
        out += [list(map(float, c + spread * r.normal(size=width))) for _ in range(each)]
    return out


@pytest.mark.parametrize(("spread", "settings"), [(0.15, {}), (0.15, {"cell_rows": 20}), (0.02, {"cell_rows": 40, "sample": 30}), (0.3, {"cell_rows": 10, "most_pivots": 7})])
def test_vector_join(spark, monkeypatch, spread, settings):
    r = np.random.default_rng(4)
    vectors = clusters(r, 12, 25, 8, spread)
    rows = list(enumerate(vectors)) + [(1000 + i, vectors[3]) for i in range(40)]  # many equal ones
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [1.0, None] + [0.0] * 6), (2003, [float("nan")] * 8), (2004, [float("inf")] + [1.0] * 7), (2005, []), (2006, [1.0]), (2007, [3.0, 0.0])]
    rows += [(None, vectors[0]), (5, vectors[5]), (6, vectors[200]), (2008, [1e200 * x for x in vectors[9]]), (2009, [1e-200 * x for x in vectors[9]])]
    df = spark.createDataFrame([(i, v, 1, "n", "x") for i, v in rows], "vec_id long, embedding array<double>, label int, node string, w string")
    monkeypatch.setattr(vectorjoin, "HELD", 16)  # blocks and lanes of few rows
    monkeypatch.setattr(vectorjoin, "STREAMED", 64)
    assert sorted(map(tuple, vectorjoin.near_vectors(df, **settings).collect())) == plain_links(rows)
    assert vectorjoin.near_vectors(df.limit(0)).collect() == []


def test_vector_join_needs_a_threshold(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        vectorjoin.near_vectors(df, threshold=0.0)
    assert [tuple(x) for x in vectorjoin.near_vectors(df).collect()] == [(1, 0, 1, True)]


def test_cells_that_are_not_visited_hold_nothing_near():
    r = np.random.default_rng(8)
    u = vectorjoin.directions(np.array(clusters(r, 40, 20, 6, 0.1)))
    pivots = vectorjoin.farthest_first(u, 25)
    d = vectorjoin.distances(u, pivots)
    own, radius = d.argmin(axis=1), np.sqrt(0.1)
    to = vectorjoin.visits(d, own, vectorjoin.distances(pivots, pivots), radius)
    a, b = np.nonzero(u @ u.T >= 0.95)
    other = own[a] != own[b]
    assert (to[a, own[b]] ^ to[b, own[a]])[other].all()  # of two cells one visits the other, and only one
    assert to.mean() < 0.4


def test_vectors_are_written_once_whatever_the_cells(spark, monkeypatch):
    """Random directions visit most cells; neither that nor the number of blocks multiplies what goes to disk."""
    x = np.random.default_rng(3).normal(size=(3000, 16))
    x[1] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    tables = {}

    def noted(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = written(df, name)
        tables.setdefault(name, (plan, sum(os.path.getsize(urllib.parse.urlparse(f).path) for f in out.inputFiles())))
        return out

    written = vectorjoin.written
    monkeypatch.setattr(vectorjoin, "written", noted)
    monkeypatch.setattr(vectorjoin, "HELD", 64)
    monkeypatch.setattr(vectorjoin, "STREAMED", 1024)
    got = vectorjoin.near_vectors(df, cell_rows=30).collect()
    u = vectorjoin.directions(np.float32(x).astype(float))
    assert [(g.vec_id, g.n_links) for g in sorted(got)] == list(enumerate((u @ u.T >= 0.95).sum(axis=1) - 1))
    assert "Exchange" not in tables["found"][0]  # pairs of blocks are read, not shuffled
    assert sum(size for _, size in tables.values()) < 6 * 4 * x.size
    assert sum(plan.count("hashpartitioning") + plan.count("rangepartitioning") for _, (plan, _) in tables.items() if "v#" in plan) <= 2


def test_ordered_bytes_sort_as_vectors_do():
    r = np.random.default_rng(6)
    for kind in ("<f4", "<f8"):
        rows = [r.choice([-2.5, -1.0, -0.0, 0.0, 1e-30, 1.0, 3e8], size=n).tolist() for n in r.integers(0, 6, size=300)]
        bad = [[1.0, None], [float("nan")], [1.0, float("-inf")], None, [], [0.0, -0.0]]
        column = pa.array(rows + bad, pa.list_(pa.float32() if kind == "<f4" else pa.float64()))
        told, size = vectorjoin.ordered_bytes(column, kind)
        told, usable = told.to_pylist(), [any(v) for v in rows]
        assert [v is not None for v in told] == usable + [False] * len(bad)
        known = [([np.dtype(kind).type(x) + 0.0 for x in v], b) for v, b, ok in zip(rows, told, usable, strict=False) if ok]
        assert [v for v, _ in sorted(known, key=lambda x: x[1])] == sorted(v for v, _ in known)
        back = vectorjoin.of_ordered(pa.array([b for _, b in known], pa.binary()), 6, kind)
        assert back.tolist() == [v + [0.0] * (6 - len(v)) for v, _ in known]
        assert size.to_pylist() == [len(v) if ok else 0 for v, ok in zip(rows, usable, strict=True)] + [0] * len(bad)


@pytest.mark.parametrize("few", [200_000, 0])
def test_repeated_ids_keep_their_largest_vector(spark, few):
    rows = [(1, b"a"), (2, b"b"), (2, b"c"), (3, None), (4, None), (4, b"d"), (4, b""), (5, None), (5, None), (6, b"e"), (6, b"e")]
    got = vectorjoin.one_row_each(spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in rows], "vec_id long, v binary"), few).collect()
    assert sorted((i, v if v is None else bytes(v)) for i, v in got) == [(1, b"a"), (2, b"c"), (3, None), (4, b"d"), (5, None), (6, b"e")]


@pytest.mark.parametrize(("width", "spread"), [(8, 0.1), (64, 0.1), (64, 1.0), (200, 0.02)])
def test_pairs_of_blocks(width, spread):
    r = np.random.default_rng(9)
    x = np.float32(clusters(r, 30, 20, width, spread) + r.normal(size=(300, width)).tolist())[r.permutation(900)]
    u = vectorjoin.directions(x.astype(float))
    pivots, basis = u[:1], vectorjoin.narrow_basis(u[:400], 0.95)
    assert (basis is None) == (width == 8)
    part = lambda at, k: vectorjoin.Block((k, 0, 0.0, 2.0, np.array(at).tobytes(), np.ones(len(at), np.int64).tobytes(), x[at].tobytes()), width, "<f4", pivots, basis)
    a, b = part(list(range(500)), 0), part(list(range(500, 900)), 1)
    rows, cols = np.arange(1, 500, 3), np.arange(399)
    got = {(i, k) for row, col in vectorjoin.near_pairs(a, rows, b, cols, 0.95, basis) for i, k in zip(row.tolist(), col.tolist(), strict=True)}
    assert got == {(int(rows[i]), int(cols[k])) for i, k in zip(*np.nonzero(u[:500][rows] @ u[500:][cols].T >= 0.95), strict=True)}
    flags = r.random(1003) < 0.01
    assert sorted(vectorjoin.found_true(flags)) == np.flatnonzero(flags).tolist()


# -- phrases


def plain_phrases(rows, least=30, longest=4, top=2000, scale=2_000_000):
    count, words, out = collections.defaultdict(collections.Counter), collections.Counter(), []
    for lang, text in rows:
        group = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            w = re.findall(r"[^ \t]+", piece)
            words[group] += len(w)
            for k in range(1, longest + 1):
                count[group].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for group, c in count.items():
        known = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for q, b in known.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    longer[q[i : i + m]] = max(longer[q[i : i + m]], b)
        kept = []
        for p, a in known.items():
            if 100 * longer[p] < 80 * a:
                s, k = min((scale * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((s, a, " ".join(p), c[p[:k]], c[p[k:]]))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(group, i, p, a, l, r, words[group], s) for i, (s, a, p, l, r) in enumerate(kept[:top], 1)]
    return sorted(out)


def found_phrases(df, **settings):
    return sorted(map(tuple, collocations.phrases(df, **settings).collect()))


@pytest.mark.parametrize("least", [30, 3])
def test_phrases(spark, sf, least):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain_phrases([tuple(x) for x in df.select("lang", "text").collect()], least)
    assert found_phrases(df, least=least) == want
    assert len(want) > 10
    assert found_phrases(df, least=least, top=5) == sorted(x for x in want if x[1] <= 5)


def test_phrases_odd(spark):
    rows = [("und", "a b. A b\tc"), (None, "a b a b a b a b a b"), ("en", None), ("en", ""), ("en", "É" * 5 + " y" * 3000), ("fr", "the the the the the the"), ("fr", "x\x1cy z z, x\x1cy z z")] * 4
    rows += [("en", "p q r s t u v w " * 50), ("de", " \t . , ;"), ("de", "one"), ("a\tb", "c d e c d e c d e"), ("a", "b c d b c d")]
    df = spark.createDataFrame([(a, b, 1, "z", 3, "g") for a, b in rows], "lang string, text string, n long, phrase string, size int, group string")
    for longest in (2, 3, 4, 5):
        assert found_phrases(df, least=2, longest=longest) == plain_phrases(rows, 2, longest)
    assert found_phrases(df.limit(0)) == []


def test_words_do_not_depend_on_parts(monkeypatch):
    texts = [" ".join("abcdefghij" * 40), "one two three four five, " * 30, "q" * 500, None, "", "a,b.c d\ne f" * 9, "é ü,"]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y", "x", "y", "x", "y", "x"]), pa.array(texts)], ["group", "text"])

    def told():
        return [(w.words[c].as_py(), groups[g].as_py(), bool(on)) for w, groups, _ in collocations.parts(batch) for c, g, on in zip(w.codes, w.group, w.on, strict=True)]

    whole = told()
    monkeypatch.setattr(collocations, "PART", 16)
    assert told() == whole


def test_paths_hold_every_edge_once(spark):
    rows = [("en", "a b c d e f g h i j k l m", 3), ("en", "x y z a b c d e f q r s t", 2), ("fr", "u v w u v w u v w u v w", 5)]
    edges = collections.Counter()
    for lang, text, n in rows:
        w = text.split()
        for i in range(len(w) - 3):
            edges[lang, " ".join(w[i : i + 4])] += n
    df = spark.createDataFrame([(*k, n) for k, n in edges.items()], "group string, run string, n long")
    paths = collocations.compacted(df)
    assert {(g, r): n for g, r, n in map(tuple, collocations.path_edges(paths, 4).collect())} == edges
    got = {(p.start, len(p.words)) for p in paths.collect()}
    assert got == {("a b c d", 3), ("x y z a", 3), ("d e f g", 7), ("d e f q", 4), ("u v w u", 3)} or len(got) < len(edges) / 3


def test_scores_pass_64_bits(spark):
    big = 10**17
    row = spark.createDataFrame([(big, big, big + 1)], "a long, l long, r long")
    score = row.select(F.expr("(cast(2000000 as decimal(16,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").alias("s")).first()[0]
    assert score == 2_000_000 * big // (2 * big + 1)


# -- conversations


WHITE = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = [(t, " " if a is None else a, " " if b is None else b) for t, a, b in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))
    seen, faults, items = set(), collections.Counter(), []
    for _, role, text in rows:
        rest = text.rstrip(WHITE)
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults[fault] += 1
        items.append((role, text, fault))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(items))
    never = (10**9, "", ())
    more = lambda c, cost, letter, *turn: (c[0] + cost, c[1] + letter, c[2] + turn)

    def inserted(s):
        for k in (0, 1, 3):
            s[2] = min(s[2], more(s[k], 5, "I", "user:"))
        s[3] = min(s[3], more(s[2], 5, "I", "assistant:"))
        return s

    state = [(0, "", ()), never, never, never]
    for role, text, fault in items:
        state = inserted(state)
        new = [more(c, 2, "D") for c in state]
        if fault in ("", "truncated"):
            extra = 5 if fault else 0
            if role[:1] == "s":
                new[1] = min(new[1], more(state[0], extra, "K", f"{role}:{text}"))
            for k in (0, 1, 3):
                if role[:1] == "u":
                    new[2] = min(new[2], more(state[k], extra, "K", f"{role}:{text}"))
                new[2] = min(new[2], more(state[k], extra + 1, "R", f"user:{text}"))
            if role[:1] == "a":
                new[3] = min(new[3], more(state[2], extra, "K", f"{role}:{text}"))
            new[3] = min(new[3], more(state[2], extra + 1, "R", f"assistant:{text}"))
        state = new
    state = inserted(state)
    best = min(state[0], state[3])
    return faults["blank"], faults["duplicate"], faults["truncated"], illegal, best[0], best[1], digest("\n".join(best[2]))


def test_repair(spark):
    r = random.Random(5)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "u", "a"], ["Hi.", "Yes!", "no", "", " ", None, "x? \n", "long one."] + [f"t{i}." for i in range(30)] + [f"t{i}" for i in range(10)]
    rows = [(c, r.choice([None, *range(14)]), r.choice(roles), r.choice(texts)) for c in range(60) for _ in range(r.randint(1, 14))]
    rows += [(None, i, q, f"n {i}.") for i, q in enumerate(["user", "user", "assistant"])]
    rows += [(1000, i, r.choice(["system", "user", "assistant", "tool"]), f"long {i}" + r.choice([".", "", "!"])) for i in range(900)]
    rows += [(1001, i, "user", f"cut {i}") for i in range(300)] + [(1001, 700, "assistant", "x.")]  # vectors that don't converge
    rows += [(1002, i % 5, "user", "same.") for i in range(500)]
    rows += [(1003, i, ["user", "assistant"][i % 2], f"fine {i}.") for i in range(600)]
    rows += [(1004, i, "assistant" if i % 3 else "user", f"cut {i}") for i in range(301)] + [(1005, 0, "user", "w " * 60_000 + ".")]
    df = spark.createDataFrame([(*x, "e", 1) for x in rows], "conv_id long, turn long, role string, text string, audit string, _k int")
    by = collections.defaultdict(list)
    for c, *rest in rows:
        by[c].append(tuple(rest))
    want = {c: plain_repair(v) for c, v in by.items()}
    for items in (conversations.ITEMS, 7):
        pieces = conversations.repair(df, items=items)
        got = {x[0]: tuple(x[1:]) for x in conversations.summaries(pieces).collect()}
        assert got == want
    assert conversations.summaries(conversations.repair(df.limit(0))).collect() == []


def test_steps_forget_where_they_began():
    steps = conversations.Steps()
    begins = {steps.start(bytes([1, 2] * 20), end) for end in (conversations.END, (0, 0, 0, 0), (0, 7, 1, 3), (0, -5, -5, -5))}
    assert len(begins) == 1


def test_gaps_and_damage(spark):
    rows = spark.createDataFrame([(1, None, None, None), (1, 3, "user", "a."), (1, 9, "user", "b."), (2, None, "user", "c."), (None, 1, "user", "d.")], "conv_id long, turn long, role string, text string")
    assert {tuple(x) for x in conversations.gaps(rows).collect()} == {(1, 5), (2, 0), (None, 0)}
    import zlib

    fault = zlib.crc32(b"1: ") % 20
    got = [tuple(x) for x in damaged(rows.where("turn is null and conv_id = 1")).collect()]
    assert got == {0: [], 1: [(1, None, " ", "")], 3: [(1, None, " ", " ")] * 2, 4: [(1, None, "user", " ")]}.get(fault, [(1, None, " ", " ")])
