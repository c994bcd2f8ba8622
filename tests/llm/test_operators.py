"""Each operator against a plain version of itself, and on odd inputs: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from splitweave.llm import chunks, decontaminate, language, packing, secrets, simhash, tokenfile, tokens, topk, urls, warc
from splitweave.llm.components import components
from splitweave.llm.queries import ORACLES, QUERIES, held_out
from splitweave.sources.paths import shared_scratch
from tools.compare import compare, database

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
EXTRA = "_id long, key string, id string, start string, words string, score string, text string, doc_id long, lang string"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def odd(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(7, "k", "i", "s", "w", "c", t, d, lang) for d, t, lang in rows], EXTRA)


ODD = [(1, None, "en"), (2, "", None), (3, "the same text of several words here", "en"), (3, "the same text of several words here", "en"), (None, "no id but some words", None), (5, " \t\n ", "de"), (6, "é" * 3 + " word " * 3000, "fr"), (7, "x" * 100_000, None), (8, "1234 5678", None)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    assert compare(spark, database(sf), sf, name, QUERIES[name], ORACLES[name]).startswith("ok")


# -- top-k


def brute_top_k(rows, k=5):
    rows = {i: v for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    whole = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in rows.items()}
    out = []
    for q in (i for i in whole if i % 50 == 0):
        s = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)
        out += [(q, r, i, -x) for r, (x, i) in enumerate(s[:k], 1)]
    return sorted(out)


def test_top_k(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([-1.0, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(400)]  # many ties
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0]), (1050, [float("nan")] * 4), (1002, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (1100, []), (1003, [1.0]), rows[7]]
    df = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], "vec_id long, embedding array<float>, score string, _d string")
    got = topk.top_k(df, lambda i: i % 50 == 0, pivots=4, sample=40, block=64, query_block=3)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_top_k(rows)
    assert topk.top_k(df.limit(0), lambda i: i % 50 == 0).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (3, [1e300])], "vec_id long, embedding array<double>")
    assert [x[2] for x in sorted(topk.top_k(few, lambda i: i % 50 == 0).collect())] == [3, 1]


# -- substring dedup


def brute_spans(texts, min_words=12):
    at = {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        h, cuts = 0, []
        for i, b in enumerate(data):
            h = ((h << 2) + int(chunks.GEAR[b])) & 0xFFFFFFFF
            if h < 2**32 // 24 and chunks.WINDOW - 1 <= i < len(data) - 1 and (data[i + 1] & 0xC0) != 0x80:
                cuts.append(i)
        cuts = [c for k, c in enumerate(cuts) if k == 0 or c - cuts[k - 1] > 8]
        edges = [0, *(c + 1 for c in cuts), len(data)]
        at[d] = [(len(data[:a].decode()), data[a:b].decode(), len(re.findall(rb"(?<![^\x20\x09-\x0d])[^\x20\x09-\x0d]", data[max(0, a - 1) : b])) - (a > 0 and not data[a - 1 : a].isspace())) for a, b in itertools.pairwise(edges) if b > a]
    first = {}
    for d in sorted(at):
        for s, c, _ in at[d]:
            first.setdefault(c, (d, s))
    out = []
    for d, rows in at.items():
        run = []
        for s, c, w in [*rows, (None, None, 0)]:
            if c is not None and first[c] != (d, s):
                run.append((s, c, w))
                continue
            if sum(x[2] for x in run) >= min_words:
                out.append((d, run[0][0], sum(len(x[1]) for x in run), sum(x[2] for x in run), *first[run[0][1]]))
            run = []
    return sorted(out)


def test_spans(spark, docs, texts):
    few = {d: t for d, t in texts.items() if len(t) < 4000}
    got = chunks.repeated_spans(docs.where("length(text) < 4000"))
    assert sorted(map(tuple, got.collect())) == brute_spans(few)
    assert len(got.collect()) > 10


def test_spans_of_planted_passages(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(55) for _ in range(100)]
    rows = [(2 * i + j, f"{prose(r.randint(0, 90))} {p} {prose(r.randint(0, 90))}") for i, p in enumerate(passages) for j in (0, 1)]
    df = spark.createDataFrame(rows + [(1000 + i, prose(200)) for i in range(100)], "doc_id long, text string")
    spans = chunks.repeated_spans(df)
    found = {x["doc_id"] for x in spans.collect()}
    assert not found - {2 * i + 1 for i in range(100)} and len(found) >= 97
    cut = {x["doc_id"]: x["text"] for x in chunks.without_spans(df, spans).collect()}
    for x in spans.collect():
        t = dict(rows)[x["doc_id"]]
        assert t[x["start"] :][: x["length"]] in dict(rows)[x["first_doc_id"]] and cut[x["doc_id"]] == t[: x["start"]] + t[x["start"] + x["length"] :]


def test_spans_odd(spark):
    twice = chunks.repeated_spans(odd(spark, ODD), min_words=4).collect()
    assert {x["doc_id"] for x in twice} <= {6, 7}  # repeats inside one text
    assert chunks.repeated_spans(odd(spark, ODD).limit(0)).collect() == []


# -- packing


def fewest(lengths, capacity):
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in {x for x in rooms if x >= lengths[i]}:
            rest = list(rooms)
            rest.remove(room)
            go(i + 1, [*rest, room - lengths[i]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_plan_is_best():
    r = random.Random(5)
    searched = 0
    hard = [(60, [44, 24, 24, 22, 21, 17, 8, 8, 6, 6])]
    for t in range(150):
        capacity = r.choice([10, 30, 100])
        lengths = [r.randint(max(1, capacity // 6), capacity * 3 // 4) for _ in range(r.randint(1, 9))]
        capacity, lengths = hard[t] if t < len(hard) else (capacity, lengths)
        counts = dict(collections.Counter(lengths))
        plan = packing.plan_of(counts, capacity)
        seen = collections.Counter()
        for n, filled in plan:
            assert sum(x * u for x, u in filled) <= capacity
            seen.update({x: n * u for x, u in filled})
        assert seen == counts
        best = fewest(lengths, capacity)
        assert packing.lower_bound(counts, capacity) <= best == sum(n for n, _ in plan)
        searched += sum(n for n, _ in packing.best_fit(counts, capacity)) > best
    assert searched  # best fit alone was not enough everywhere


def test_plan_without_limits_is_proved():
    """Every undominated filling and every number of it is tried: what comes back is the fewest, and says so."""
    r = random.Random(2)
    for _ in range(200):
        capacity = r.randint(20, 60)
        lengths = [r.randint(max(1, capacity // 8), capacity // 2 + 3) for _ in range(r.randint(6, 12))]
        plan, proved = packing.proved_plan(dict(collections.Counter(lengths)), capacity, None, None, None)
        assert proved and sum(n for n, _ in plan) == fewest(lengths, capacity)
    many = {x: 1 for x in range(8, 24)}
    assert len(packing.completions(many, sorted(many, reverse=True), 60, None, None)) > 20 * packing.FILLINGS
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    assert not packing.proved_plan(dict(collections.Counter(lengths)), 60, 0)[1]


def test_packing(spark, docs, texts):
    tok = Tokenizer.from_file(BYTE)
    ids = {d: tok.encode(t, add_special_tokens=False).ids + [0] for d, t in texts.items()}
    check_packed(packing.pack(docs, BYTE, group_rows=20).collect(), list(ids.items()), 2048)


def check_packed(rows, ids, capacity):
    placed, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for x in rows:
        placed[x["sequence_id"]].append((x["offset"], x["length"]))
        by_doc[x["doc_id"]].append(x)
    for parts in placed.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= capacity
    for d, own in ids:
        parts = sorted(by_doc[d], key=lambda x: x["piece"])[: max(1, -(-len(own) // capacity))]
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        assert sum(p["length"] for p in parts) == len(own) and all(p["length"] == capacity for p in parts[1:])
        for p in parts:
            assert p["ids_crc32"] == zlib.crc32(np.array(own[p["start"] :][: p["length"]], "<u4").tobytes())
    assert len(placed) >= packing.lower_bound(dict(collections.Counter(x["length"] for x in rows)), capacity)


def test_packing_odd(spark):
    tok = Tokenizer.from_file(BYTE)
    rows = packing.pack(odd(spark, [x for x in ODD if x[0] != 3]), BYTE, capacity=64).collect()
    check_packed(rows, [(d, tok.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, _ in ODD if d != 3], 64)
    assert packing.pack(odd(spark, ODD).limit(0), BYTE).collect() == []
    twice = packing.pack(odd(spark, ODD), BYTE).where("doc_id = 3").collect()
    assert len(twice) == 2 and len({(x["sequence_id"], x["offset"]) for x in twice}) == 2


@pytest.mark.parametrize(("path", "layout"), [(BYTE, "spaced"), (WORD, "dropped")])
def test_ids_do_not_depend_on_pieces(path, layout, texts):
    tok, enc = Tokenizer.from_file(path), tokens.Encoder(path, layout)
    r = random.Random(2)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "\xa0", "\u2003", "\x1c", "\x85", "a", "B", "it's", "'ll", "9", "12", "é", "e\u0301", "\u0301", "Σ", "ΑΣ", "<|endoftext|>", "!", "…", "中文", "🙂", "\u200d", "_", "ß", "İ"]
    made = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(4000)]
    made += [" ".join(r.choice(parts) + r.choice(parts) for _ in range(200)) for _ in range(60)]
    for t, got in zip([*made, *texts.values()], enc.encode([*made, *texts.values()]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize(("path", "layout"), [(BYTE, "spaced"), (WORD, "dropped")])
def test_latin_words_need_only_the_model(path, layout):
    tok, enc = Tokenizer.from_file(path), tokens.Encoder(path, layout)
    letters = [c for c in map(chr, range(0x41, 0x250)) if re.fullmatch(tokens.LETTERS, c)]
    marks = [c for c in map(chr, range(33, 127)) if re.fullmatch(tokens.MARKS, c)]
    assert all(c.isalpha() for c in letters) and len(letters) == 52 + 397 and len(marks) == 31
    r = random.Random(5)
    words = ["".join(r.choices(letters, k=r.randint(1, 9))) for _ in range(3000)] + ["house", "House", "HOUSE", "x" * 60, "x" * 60 + ",", "y" * 60 + "!", "y" * 60]
    words += [w + "".join(r.choices(marks, k=r.randint(1, 5))) for w in [*words, *letters]] + ["a" + "#" * 70]
    want = [tok.encode("a " + w, add_special_tokens=False).ids for w in words]
    enc.encode(["a"])
    enc.tokenizer = None
    for _ in range(2):
        assert [np.frombuffer(g, "<u4").tolist() for g in enc.encode(["a " + w for w in words])] == want
    assert not any(len(p) > tokens.LONGEST_CACHED for p in [*enc.after_space, *enc.marks])


# -- language


def test_language(spark, docs):
    found = language.identify(docs, ~held_out(F.col("doc_id")))
    told = found.where(held_out(F.col("doc_id"))).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert told[0] >= 0.97 and 0 <= told[1] <= told[2] <= 1


def test_language_odd_and_mixed(spark):
    en, fr, ru = "the quick house stands there with those things ", "une maison est dans cette rue avec les autres ", "дом стоит на этой улице вместе с другими "
    teach = odd(spark, [(i, t * 20, lang) for i, (t, lang) in enumerate([(en, "en"), (fr, "fr"), (ru, "ru")])])
    mixed = [(100, en * 2 + fr * 3, None), (101, ru + en, None), (102, "中文", None), *ODD]
    rows = language.identify(teach.union(odd(spark, [(d, t, None) for d, t, _ in mixed])), F.lit(True)).collect()
    by = {x["doc_id"]: x for x in rows}
    assert len(rows) == 3 + len(mixed) and by[1]["score"] is not None
    none = {x["lang_pred"] for x in rows if x["text"] is None or not any(c.isalpha() for c in x["text"])}
    assert none == {"und"} and all(x["lang_pred"] != "und" for x in rows if x["text"] and any(c.isalpha() for c in x["text"]))
    spans = by[100]["spans"]
    assert [s["lang"] for s in spans] == ["en", "fr"] and by[100]["lang_pred"] == "fr" and abs(spans[1]["start"] - 2 * len(en)) < 8
    assert [s["lang"] for s in by[101]["spans"]] == ["ru", "en"]
    nothing = language.identify(odd(spark, mixed), F.lit(False)).collect()
    assert {x["lang_pred"] for x in nothing} == {"und"} and all(x["spans"] == [] for x in nothing)
    assert language.identify(odd(spark, ODD).limit(0), F.lit(True)).collect() == []


def test_paths_are_best():
    g = np.random.default_rng(4)
    for _ in range(200):
        n, k = g.integers(1, 7), g.integers(1, 4)
        scores, penalty = g.normal(size=(n, k)).astype(np.float32) * 3, 2.0
        value = lambda p, scores=scores: sum(scores[i, x] for i, x in enumerate(p)) - penalty * sum(a != b for a, b in itertools.pairwise(p))
        got = language.best_paths(scores, np.array([0, n]), penalty)
        assert value(got) >= max(map(value, itertools.product(range(k), repeat=int(n)))) - 1e-4


# -- SimHash


def plain_fingerprint(text, k=4):
    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), seed=42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, distance):
    rows = list(prints.items())
    label = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for (a, x), (b, y) in itertools.combinations(rows, 2):
            if (x ^ y).bit_count() <= distance and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def test_near_duplicates(spark, docs, texts):
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    label = plain_components(prints, 4)
    got = simhash.near_duplicates(docs).collect()
    assert {(x["doc_id"], x["fingerprint"], x["component_id"]) for x in got} == {(d, f"{p:016x}", label[d]) for d, p in prints.items()}


def test_links_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FEW", 4)
    monkeypatch.setattr(simhash, "TILE", 16)
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(3)]
    prints = {}
    for i in range(240):
        x = r.choice(base)
        for _ in range(r.randint(0, 9)):
            x ^= 1 << r.randrange(64)
        prints[i] = x if x not in prints.values() else r.getrandbits(64)
    df = spark.createDataFrame([(i, [simhash.signed(x)]) for i, x in prints.items()], "id long, fp array<long>")
    found = {x["node"]: x["component"] for x in components(simhash.links(df, simhash.exact_keys(240, 4), 1, 4)).collect()}
    assert {i: found.get(i, i) for i in prints} == plain_components(prints, 4)


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_close_pairs_share_blocks(blocks):
    r, masks = random.Random(blocks), simhash.block_masks(blocks, 4)
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), 4):
            y ^= 1 << b
        assert any((x ^ y) & m == 0 for m in masks)


def test_near_duplicates_odd(spark):
    got = simhash.near_duplicates(odd(spark, ODD)).collect()
    assert sorted(x["doc_id"] for x in got) == sorted(d for d, _, _ in ODD if d is not None)
    by = {x["doc_id"]: x for x in got}
    assert {by[d]["fingerprint"] for d in (1, 2, 5)} == {"0" * 16} and {by[d]["component_id"] for d in (1, 2, 5)} == {1}
    assert simhash.near_duplicates(odd(spark, ODD).limit(0)).collect() == []


def test_near_duplicates_of_repeated_ids(spark):
    """Texts that share an id are told apart: only what is linked belongs together."""
    r = random.Random(3)
    prose = lambda: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(60))
    a, b, c = prose(), prose(), prose()
    got = simhash.near_duplicates(spark.createDataFrame([(1, a), (1, b), (2, b), (0, c), (5, c), (1, a)], "doc_id long, text string")).collect()
    by = collections.defaultdict(list)
    for x in got:
        by[x["class_id"]].append((x["doc_id"], x["component_id"]))
    assert sorted(sorted(v) for v in by.values()) == [[(0, 0), (5, 0)], [(1, 1), (1, 1)], [(1, 1), (2, 1)]]
    assert len({x["text_hash"] for x in got}) == 3


def test_components_of_chains(spark):
    r = random.Random(2)
    order = r.sample(range(1, 300), 200)
    rows = [*itertools.pairwise(order), (1000, 1001), (1001, 1000), (5000, 5000)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(order, min(order)), 1000: 1000, 1001: 1000}


# -- decontamination


def brute_overlaps(docs, items, min_words=13, ratio=0.8):
    split = lambda t: [m.encode() for m in re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())]
    out = {}
    for d, t in docs.items():
        w = split(t)
        for i, item in items.items():
            q = split(item)
            for shift in range(-len(q) + 1, len(w)):
                low, high = max(0, shift), min(len(w), shift + len(q))
                e = [w[p] == q[p - shift] for p in range(low, high)]
                if not any(all(e[p + k] for k, c in enumerate(m) if c == "1") for m in decontaminate.seeds(len(q)) for p in range(len(e) - len(m) + 1)):
                    continue
                got = decontaminate.stretch(np.array(e, np.int64), np.ones(len(e), np.int64), 0)
                if got and got[2] >= min(min_words, len(q)) and got[1] >= ratio * got[2]:
                    out[d, i] = max(out.get((d, i), 0), got[1])
    return out


def test_overlaps(spark):
    r = random.Random(6)
    prose = lambda n: ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 5))) for _ in range(n)]
    items = {i: prose(r.choice([4, 5, 8, 12, 20, 40])) for i in range(30)}
    docs = {}
    for d in range(150):
        w = prose(r.randint(0, 60))
        if d % 3:
            q = list(items[r.randrange(30)])
            for j in r.sample(range(len(q)), len(q) // 10):
                q[j] = "other"
            low = r.choice([0, 0, len(q) // 3])
            w[r.randint(0, len(w)) :] = [*q[low:], *prose(r.randint(0, 30))]
        docs[d] = " ".join(x.upper() if r.random() < 0.2 else x + r.choice(["", ",", "."]) for x in w)
    text = {i: " ".join(q) for i, q in items.items()}
    got = decontaminate.overlaps(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(text.items()), "item_id long, text string"))
    assert {(x["doc_id"], x["item_id"]): x["matched"] for x in got.collect()} == brute_overlaps(docs, text)
    assert got.count() > 60


def stated_overlaps(docs, items, min_words=13, share=(4, 5)):
    """Every pair with some alignment and some window that is long and equal enough; the most equal words of one."""
    out = {}
    for (d, w), (i, q) in itertools.product(docs.items(), items.items()):
        least = min(min_words, len(q))
        for shift in range(-len(q) + 1, len(w)) if len(q) >= 5 else []:
            e = [w[p] == q[p - shift] for p in range(max(0, shift), min(len(w), shift + len(q)))]
            n = [0, *itertools.accumulate(e)]
            for a, b in itertools.combinations(range(len(n)), 2):
                if b - a >= least and (n[b] - n[a]) * share[1] >= (b - a) * share[0]:
                    out[d, i] = max(out.get((d, i), 0), n[b] - n[a])
    return out


def test_overlaps_as_stated(spark):
    """Substitutions anywhere, also at the edges of a passage or item, and passages that a loosely similar text follows."""
    r = random.Random(8)
    items = {i: [f"i{i}w{j}" for j in range(n)] for i, n in enumerate([4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 20, 25, 40])}
    docs = {}
    for d in range(450):
        q = items[d % 15]
        n = r.randint(min(13, len(q)), min(len(q), 26))
        low = r.randint(0, len(q) - n)
        part = q[low : low + n]
        for j in r.sample(range(n), min(n, n // 5 + (d % 4 == 0))):
            part[j] = "other"
        docs[d] = [*["lead"] * r.randint(0, 9), *part, *["tail"] * r.randint(0, 9)]
    items[100] = [f"long{j}" for j in range(120)]
    docs[1000] = [w if j < 20 or j % 4 else "other" for j, w in enumerate(items[100])]
    items[101] = [f"edge{j}" for j in range(13)]
    docs[1001] = ["edge0", "other", *items[101][2:]]
    docs[1002] = ["lead", "other", *items[5][1:], "tail"]
    lay = lambda rows, c: spark.createDataFrame([(k, " ".join(w)) for k, w in rows.items()], f"{c} long, text string")
    got = {(x["doc_id"], x["item_id"]): x["matched"] for x in decontaminate.overlaps(lay(docs, "doc_id"), lay(items, "item_id")).collect()}
    want = stated_overlaps(docs, items)
    assert got == want and {(1000, 100), (1001, 101), (1002, 5)} <= got.keys() and 250 < len(got) < 450


@pytest.mark.parametrize("n", range(5, 26))
def test_masks_meet_every_stretch(n):
    """Stretches of n words with as many others among them as may be; longer ones hold one of 13 to 25 words that is equal enough."""
    masks = decontaminate.seeds(n)
    for out in itertools.combinations(range(n), n // 5):
        assert any(all(c == "0" or p + k not in out for k, c in enumerate(m)) for m in masks for p in range(n - len(m) + 1)), out


def test_overlaps_inside_another(spark):
    """An item that meets the document in one window only, amid the windows of another item."""
    prose = [f"w{i}" for i in range(60)]
    other = prose[20:33]
    other[4], other[9] = "this", "that"
    items = {1: " ".join(prose), 2: " ".join(other)}
    docs = {d: " ".join([*["lead"] * d, *prose]) for d in range(4)}
    got = decontaminate.overlaps(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string"))
    assert {(x["doc_id"], x["item_id"]): x["matched"] for x in got.collect()} == brute_overlaps(docs, items)
    assert got.count() == 8


def test_overlaps_odd(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the same text of several words here"), (None, "no id but some words"), (4, "word " * 50)], "item_id long, text string")
    got = decontaminate.overlaps(odd(spark, ODD), items)
    assert sorted((x["doc_id"], x["item_id"]) for x in got.collect()) == [(3, 3), (6, 4)]
    assert decontaminate.overlaps(odd(spark, ODD), items.limit(0)).collect() == [] == decontaminate.overlaps(odd(spark, ODD).limit(0), items).collect()


def test_overlaps_of_long_items_and_repeated_ids(spark):
    """An item of 20,000 words takes a row for each window, not its words in each; rows that share an id keep their own words."""
    import time

    r = random.Random(6)
    prose = lambda n: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    long, other, third = prose(20_000), prose(40), prose(40)
    items = spark.createDataFrame([(1, long), (2, other), (2, third)], "item_id long, text string")
    part = " ".join(long.split()[15_000:15_020])
    docs = spark.createDataFrame([(1, f"{prose(30)} {part} {prose(30)}"), (1, f"{prose(30)} {other} {prose(5)}"), (2, prose(200)), (3, third)], "doc_id long, text string")
    start = time.time()
    got = sorted((x["doc_id"], x["item_id"], x["matched"]) for x in decontaminate.overlaps(docs, items).collect())
    assert got == [(1, 1, 20), (1, 2, 40), (3, 2, 40)] and time.time() - start < 60


# -- token file


def test_token_file(spark, docs, texts):
    tok, path = Tokenizer.from_file(WORD), shared_scratch(spark, "tokens")
    tokenfile.write_token_file(docs, path, WORD)
    index = tokenfile.read_index(spark, path)
    rows, start = sorted(map(tuple, tokenfile.read_documents(index, path).select("doc_id", "start", "n_tokens", "ids_crc32", "ids").collect())), 0
    for (d, s, n, crc, ids), key in zip(rows, sorted(texts), strict=True):
        want = tok.encode(texts[key], add_special_tokens=False).ids + [2]
        assert (d, s, n, ids) == (key, start, len(want), want) and crc == zlib.crc32(np.array(want, "<u4").tobytes())
        start += n
    some = tokenfile.read_documents(index, path, F.col("doc_id").isin(3, 77), with_ids=False).collect()
    assert sorted(x["doc_id"] for x in some) == [3, 77]


def test_token_file_odd(spark):
    path = shared_scratch(spark, "tokens")
    tokenfile.write_token_file(odd(spark, ODD), path, WORD)
    rows = tokenfile.read_documents(tokenfile.read_index(spark, path), path).orderBy("start").collect()
    assert [x["doc_id"] for x in rows] == [None, 1, 2, 3, 3, 5, 6, 7, 8] and [x["ids"] for x in rows if x["doc_id"] in (1, 2, 5)] == [[2]] * 3
    empty = shared_scratch(spark, "tokens")
    tokenfile.write_token_file(odd(spark, ODD).limit(0), empty, WORD)
    assert tokenfile.read_documents(tokenfile.read_index(spark, empty), empty).collect() == []


def test_frames(tmp_path):
    r, path = random.Random(8), str(tmp_path / "f.zst")
    parts = [bytes(r.randrange(256) for _ in range(4 * n)) for n in (0, 1, 70, 3, 0, 500, 2)]
    fs = pyarrow.fs.LocalFileSystem()
    with fs.open_output_stream(path, compression=None) as sink:
        w = tokenfile.FrameWriter(sink, 256)
        for p in parts:
            w.add(p)
        w.close()
    size = fs.get_file_info(path).size
    whole = b"".join(parts)
    with fs.open_input_file(path) as f:
        reader = tokenfile.FrameReader(f, size)
        for _ in range(100):
            a = r.randrange(len(whole) // 4)
            n = r.randrange(len(whole) // 4 - a + 1)
            assert reader.read(a, n) == whole[4 * a : 4 * (a + n)]
    data = bytearray((tmp_path / "f.zst").read_bytes())
    data[20] ^= 1
    (tmp_path / "f.zst").write_bytes(data)
    with fs.open_input_file(path) as f, pytest.raises(Exception):  # noqa: B017
        tokenfile.FrameReader(f, size).read(0, 5)


# -- URLs

URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?q#f", "http://example.org", "https://x.example.org/en/12", "https://org/", "s://b.com/fr/://c.org/", "http://com/de/", "http://.com/fr/", "http://notcom/fr/", "http://a\n.com/de/x", "x://y.com?/fr/"]


def test_urls(spark):
    from splitweave.llm.queries import RULES

    rules = [*RULES, ("org", "", "block"), ("a.example.org", "/es", "allow"), ("com", "/fr/", "block")]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, URLS[5], "h", "r"), (4, URLS[4], "h", "r")], "page_id long, url string, host string, rule string")

    def plain(url):
        _, found, rest = (url or "").partition("://")
        host = re.sub(r"[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0]) if found else ""
        path = re.match(r"[^?#]*", rest[len(host) :])[0] if found else ""
        fits = [(len(h.split(".")), len(p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fits)[3] if fits else None, max(fits)[4] if fits else "allow")

    want = collections.Counter((i, *plain(u)) for i, u, *_ in map(tuple, df.collect()))
    assert collections.Counter(map(tuple, urls.judge(df, rules).collect())) == want
    assert collections.Counter(map(tuple, urls.judge(df, rules, max_rules=0).collect())) == want
    assert urls.judge(df.limit(0), rules).collect() == []


# -- WARC


def test_warc(spark):
    big, other = "<p>" + "é" * 600 + "</p>", "x" * 1000
    rows = [(1, "http://a/1", big), (5, None, big), (3, "http://a/\r\nX: 1", big), (7, "u", "small"), (8, "u", "small"), (9, "u", None), (10, "u", ""), (None, "u", big), (None, "u", "y" * 2000), (12, "u", other), (12, "u", other), (13, "u", "\r\n\r\nWARC/1.0\r\n" * 99)]
    df = spark.createDataFrame([(*x, "d") for x in rows], "page_id long, url string, html string, digest string")
    folder = shared_scratch(spark, "warc")
    got = warc.archive(df, folder).collect()
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if g == h and j is not None]
        keeper = max(same) if len(data) >= 1000 and same and max(same) != i else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if keeper else "response", keeper))
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert warc.archive(df.limit(0), shared_scratch(spark, "warc")).collect() == []


def test_warc_members(spark, sf):
    pages, raw, folder = spark.read.parquet(f"{sf}/pages.parquet"), shared_scratch(spark, "raw"), shared_scratch(spark, "warc")
    archives = warc.normalise(warc.write_archives(pages, raw, archive_bytes=20_000), raw, folder)
    assert archives.count() > 2
    read = {x["id"]: (x["url"], bytes(x["payload"]).decode()) for x in warc.read_records(archives, folder, with_payload=True).collect() if x["record_type"] == "response"}
    full = {x["page_id"]: (x["url"], x["html"]) for x in pages.collect()}
    assert read == {i: full[i] for i in read} and len(read) > 40


# -- secrets


def plain_base(text):
    out = []
    for k, (pattern, group, least) in enumerate([(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8), (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32)]):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(out)


def test_base_spans(spark, docs, texts):
    made = ["PassWord:'abcdefgh' token=short secret = \"x\"", "password: token: abcdefgh12", "api_key=apikey=12345678", "AKIA" + "A" * 11 + " AKIA" + "B" * 12 + " xAKIAZ", "f" * 31 + " " + "0" * 40, "ſecret=abcdefghij toKen=abcdefghij"]
    for t in [*made, *texts.values()]:
        assert secrets.base_spans(t) == plain_base(t), t
    rows = QUERIES["op10_secret_scan"](spark, "/root/testdata/sf0.001").collect()
    for x in rows:
        base = plain_base(texts[x["doc_id"]])
        told = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert x["base_sha256"] == hashlib.sha256(told.encode()).hexdigest() and set(told.split(",")) <= set(x["spans"].split(","))
        assert (x["n_assign"], x["n_access"], x["n_hex"]) == tuple(sum(k == j for _, k, _ in base) for j in range(3))


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('db_pwd = "Xk29fjQ0aa"', ["Xk29fjQ0aa"]),
        ('k = "Xk29fjQ0aa"\nclient_credential = k', ["Xk29fjQ0aa"]),
        ('a = "Xk29fjQ0"\nb = "z81Lmn4Q"\nPRIVATE_KEY = a + b', ["Xk29fjQ0", "z81Lmn4Q"]),
        ('const authKey: string = "Zx81-99ab_Q"; let n = 5', ["Zx81-99ab_Q"]),
        ('{"credentials": "Qq8171kkz0", "name": "Qq8171kkz1"}', ["Qq8171kkz0"]),
        ("export DB_PASS=hY7719xkQ2", ["hY7719xkQ2"]),
        ("signing_key: aB3/dE6+gH9", ["aB3/dE6+gH9"]),
        ('db_pwd = "changeme"', []),
        ('keyboard = "Xk29fjQ0aa"', []),
        ('db_pwd = "${SECRET_NAME}"', []),
        ("The pass is open = true", []),
    ],
)
def test_lexed(text, found):
    assert sorted(text[a:b] for a, b in secrets.lexed(text)) == sorted(found)


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('passphrase = "correct horse battery staple"', ["correct horse battery staple"]),
        ('db_pwd = "qwertyuiopas"', ["qwertyuiopas"]),
        ('client_credential = "839201756283"', ["839201756283"]),
        ('token = "the next word in it"', []),
        ('password: "Enter your password here now"', []),
        ("db_pwd = qwertyuiopas", []),
    ],
)
def test_literals_of_one_kind(text, found):
    assert sorted(text[a:b] for a, b in secrets.lexed(text)) == found


def test_lexing_is_linear():
    """Sums of sums, long chains of constants and very many literals take seconds at most."""
    import time

    start = time.time()
    doubled = 'a0 = "Ab3$xY9_"\n' + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(2000)) + "db_password = a2000\n"
    assert [doubled[a:b] for a, k, b in secrets.all_spans(doubled) if k == 3] == ["Ab3$xY9_"]
    chain = 'x0 = "a1B_"\n' + "".join(f'x{i + 1} = x{i} + "Qz{i}"\nmy_token_{i} = x{i + 1}\n' for i in range(5000))
    assert len(secrets.all_spans(chain)) == 5001
    many = "".join(f'token_{i} = "Zx{i}9aQ{i * 7}b_"\n' for i in range(30_000))
    assert len(secrets.all_spans(many)) == 30_000
    assert time.time() - start < 30


@pytest.mark.parametrize(
    ("text", "spans", "clean"),
    [
        ('password = "Tr0ub4dor&3xyzQ9"', ['password = "Tr0ub4dor', "Tr0ub4dor&3xyzQ9"], '[SECRET]"'),
        ('x = 1; api_key: "abcdEF12#34!z"; y', ['api_key: "abcdEF12', "abcdEF12#34!z"], 'x = 1; [SECRET]"; y'),
        ("db_pwd = '" + "0123456789abcdef" * 2 + "&Zz'", ["0123456789abcdef" * 2 + "&Zz", "0123456789abcdef" * 2], "db_pwd = '[SECRET]'"),
        ('password = "Tr0ub4dor3xyzQ9"', ['password = "Tr0ub4dor3xyzQ9'], '[SECRET]"'),
    ],
)
def test_literals_beyond_base_spans(spark, text, spans, clean):
    assert sorted(text[a:b] for a, _, b in secrets.all_spans(text)) == sorted(spans)
    assert {tuple(x) for x in secrets.base_spans(text)} <= set(secrets.all_spans(text))
    assert secrets.redacted(spark.createDataFrame([(text,)], "text string")).first()["text"] == clean


def test_secrets_odd(spark):
    rows = secrets.find_secrets(odd(spark, [*ODD, (9, "é token=abcdefgh1 " * 3, None)])).collect()
    assert len(rows) == len(ODD) + 1
    by = {x["doc_id"]: x["secrets"] for x in rows}
    assert by[1] == by[2] == [] and [tuple(s) for s in by[9]] == [("assign", 2 + 18 * i, 17 + 18 * i) for i in range(3)]
    clean = secrets.redacted(odd(spark, [*ODD, (9, "a token=abcdefgh1 b", None)])).collect()
    assert {x["doc_id"]: x["text"] for x in clean}[9] == "a [SECRET] b" and clean[0]["text"] is None
    assert secrets.find_secrets(odd(spark, ODD).limit(0)).collect() == []
