"""Phrases of a corpus by a weighted de Bruijn graph.

Nodes are runs of ``longest − 1`` words, edges are runs of ``longest`` words from the node of their first to that of their last words; an
edge's weight is how often it occurs. Texts give only the longest run that begins at each word: an edge, or, where the piece
ends before, the shorter end of a piece. All shorter counts follow: a node occurs as often as its edges leave it, plus
the pieces that end with it, and so on down to words. Chains of nodes with one way in and one way out are compacted to paths.

A first pass counts pairs of words under 64-bit hashes and marks the frequent ones in a bit map of fixed size. A run is also
ended where the next pair is not marked: no phrase that holds such a pair is frequent, so all frequent counts stay exact,
and the graph holds little else. Hashes that clash, or a full map, only add edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitweave.llm.common import small_batches, utf8, written

SLOTS = 1 << 20  # of 64 bits: 8 MB
PART = 4 << 20  # bytes that are cut into words at once
SEGMENT = 1024  # edges of a path in one row

# What ends a piece, what separates words.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)], KIND[list(BREAKS)] = 1, 2


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of one part of a batch: codes into a dictionary, the group of each, and whether the next word goes on in its piece."""

    def __init__(self, data: np.ndarray, at: np.ndarray, groups: np.ndarray):
        word = KIND[data] == 0
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = at[(at > 0) & (at < len(data))]  # a row's first byte begins a word, the byte before it ends one
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
        text = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[word]]))
        coded = text.dictionary_encode()
        self.words, self.codes = coded.dictionary, np.asarray(coded.indices, np.int64)
        row = np.searchsorted(at, starts, "right") - 1
        self.group = groups[row]
        piece = np.cumsum(KIND[data] == 2, dtype=np.int64)[starts] + row
        self.on = np.r_[(piece[1:] == piece[:-1]) & (row[1:] == row[:-1]), False] if len(starts) else np.empty(0, bool)

    def pairs(self, seeds: np.ndarray) -> np.ndarray:
        """A hash of each word, the next one and the group; of any use only where the piece goes on."""
        own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words.cast(pa.binary()).to_pylist()), np.uint64, len(self.words))[self.codes]
        return mixed(own * np.uint64(0x9E3779B97F4A7C15) + np.roll(own, -1) * np.uint64(0xC2B2AE3D27D4EB4F) + seeds[self.group])


def parts(batch: pa.RecordBatch) -> Iterator[tuple[Words, pa.Array, np.ndarray]]:
    """The words of a batch (group, text) in parts of some MB, cut at the ends of rows and pieces; the groups; a seed for each."""
    coded = batch.column(0).dictionary_encode()
    groups = np.asarray(coded.indices, np.int64)
    seeds = np.fromiter((xxhash.xxh3_64_intdigest(g) for g in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    data, at = utf8(batch.column(1))
    start = 0
    while start < len(data):
        stop = min(len(data), start + PART)
        if stop < len(data):
            row_end = at[np.searchsorted(at, stop, "right") - 1]
            if row_end > start:
                stop = int(row_end)
            else:  # inside one long text: behind the last end of a piece, or the first one after a long piece
                cut = np.flatnonzero(KIND[data[start:stop]] == 2)
                while not len(cut) and stop < len(data):
                    begin, stop = stop, min(len(data), stop + PART)
                    cut = np.flatnonzero(KIND[data[begin:stop]] == 2)[:1] + (begin - start)
                stop = int(start + cut[-1] + 1) if len(cut) else stop
        low, high = np.searchsorted(at, start, "right") - 1, np.searchsorted(at, stop, "left")
        yield Words(data[start:stop], np.maximum(at[low:high], start) - start, groups[low:high]), coded.dictionary, seeds
        start = stop


def counted(table: pa.Table, keys: list[str]) -> pa.Table:
    return table.group_by(keys, use_threads=False).aggregate([([], "count_all")])


def frequent_pairs(rows: DataFrame, least: int) -> np.ndarray:
    """A bit for the hash of every pair of words that occurs ``least`` times or more in a group; 8 MB whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, _, seeds in parts(b):
                h, n = np.unique(words.pairs(seeds)[words.on], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    often = rows.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    slot, bit = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(SLOTS - 1)), F.col("h").bitwiseAND(F.lit(63)).cast("int")
    marked = often.groupBy(slot.alias("slot")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")).toArrow()
    bits = np.zeros(SLOTS, np.int64)
    bits[np.asarray(marked.column("slot"))] = np.asarray(marked.column("bits"))
    return bits.view(np.uint64)


def runs(rows: DataFrame, bits: np.ndarray, longest: int) -> DataFrame:
    """(group, run, n): the longest run that begins at each word, cut at the end of its piece or before an unmarked pair."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)  # 8 MB, fixed

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, groups, seeds in parts(b):
                h = words.pairs(seeds)
                slot = shared.value[(h >> np.uint64(6)) & np.uint64(SLOTS - 1)]
                on = words.on & ((slot >> (h & np.uint64(63))) & np.uint64(1)).astype(bool)
                columns, going = {"group": words.group, "w0": words.codes}, np.ones(len(on), bool)
                for k in range(1, longest):
                    going = going & np.r_[on[k - 1 :], np.zeros(min(k - 1, len(on)), bool)][: len(on)]
                    columns[f"w{k}"] = np.where(going, np.roll(words.codes, -k), -1)
                found = counted(pa.table(columns), list(columns))
                codes = [found.column(f"w{k}").combine_chunks() for k in range(longest)]
                text = [words.words.take(pc.if_else(pc.less(c, 0), None, c)) for c in codes]
                run = pc.binary_join_element_wise(*text, " ", null_handling="skip")
                yield pa.RecordBatch.from_arrays([groups.take(found.column("group").combine_chunks()), run, found.column("count_all").combine_chunks()], ["group", "run", "n"])

    return rows.mapInArrow(work, "group string, run string, n long").groupBy("group", "run").agg(F.sum("n").alias("n"))


def head(run: Column | str, words: Column | int) -> Column:
    return F.call_function("substring_index", F.col(run) if isinstance(run, str) else run, F.lit(" "), F.lit(words) if isinstance(words, int) else words)


def size(run: str) -> Column:
    return F.length(run) - F.length(F.replace(F.col(run), F.lit(" "), F.lit(""))) + 1


def ranked(joints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edge, head, hops): each edge's way back to the first edge of its path; (edge, least) of the edges on cycles.

    ``joints``: edge and before. Every round doubles the distance that each edge has looked back, so rounds grow with the logarithm
    of the longest path. When no edge finds its head any more and no least edge changes, what is left are cycles.
    """
    state = written(joints.select("edge", F.col("before").alias("head"), F.lit(1).cast("long").alias("hops"), F.least("edge", "before").alias("least"), F.lit(False).alias("done"), F.lit(True).alias("news")), "hops")
    open_ = state.count()
    while open_:
        back = state.select(F.col("edge").alias("head"), F.col("head").alias("next"), F.col("hops").alias("more"), F.col("least").alias("other"), F.col("done").alias("ends"))
        far = F.coalesce(F.least("least", "other"), F.col("least"))
        moved = state.where("not done").join(back, "head", "left").select(
            "edge", F.coalesce("next", "head").alias("head"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), far.alias("least"),
            F.coalesce("ends", F.lit(True)).alias("done"), (far != F.col("least")).alias("news"),
        )
        state = written(state.where("done").union(moved), "hops")
        still, news = state.where("not done").agg(F.count("*"), F.count_if("news")).first()
        if still == open_ and not news:
            break
        open_ = still
    return state.where("done").select("edge", "head", "hops"), state.where("not done").select("edge", "least")


def compacted(edges: DataFrame) -> DataFrame:
    """(group, start, words, weights): edges (group, run, n) along chains of nodes with one way in and one way out.

    ``start`` is the run of the first edge, ``words`` the last word of every edge, ``weights`` how often each occurs. Every edge is
    in one path. Paths of more than SEGMENT edges come as several rows. A cycle begins at its least edge.
    """
    node = lambda run: F.concat_ws("\t", "group", run)
    named = edges.select(F.concat_ws("\t", "group", "run").alias("edge"), "group", "run", "n")
    width = size("run")
    ends = named.select(node(F.expr("substring_index(run, ' ', -(length(run) - length(replace(run, ' ', ''))))")).alias("node"), "edge", F.lit(None).cast("string").alias("out"))
    ends = ends.union(named.select(node(head("run", width - 1)).alias("node"), F.lit(None).cast("string"), "edge"))
    joints = ends.groupBy("node").agg(F.count("edge").alias("in_"), F.count("out").alias("out_"), F.max("edge").alias("before"), F.max("out").alias("edge"))
    joints = written(joints.where("in_ = 1 and out_ = 1 and before <> edge").select("edge", "before"), "joints")
    places, cycles = ranked(joints)
    cycles = written(cycles, "cycles")
    if cycles.count():
        opened, _ = ranked(joints.join(cycles.where("edge <> least").select("edge"), "edge", "left_semi"))
        places = places.union(opened)
    placed = named.join(places, "edge", "left").select("group", "run", "n", F.coalesce("head", "edge").alias("head"), F.coalesce("hops", F.lit(0)).alias("hops"))
    row = F.struct("hops", F.substring_index("run", " ", -1).alias("word"), "n", "run")
    paths = placed.groupBy("group", "head", F.floor(F.col("hops") / SEGMENT).alias("part")).agg(F.array_sort(F.collect_list(row)).alias("e"))
    return paths.select("group", F.col("e")[0]["run"].alias("start"), F.col("e.word").alias("words"), F.col("e.n").alias("weights"))


def path_edges(paths: DataFrame, longest: int) -> DataFrame:
    """(group, run, n) of every edge of the paths."""
    whole = F.concat(F.slice(F.split("start", " "), 1, longest - 1), F.col("words"))
    at = F.posexplode("weights").alias("i", "n")
    return paths.select("group", whole.alias("all"), at).select("group", F.array_join(F.slice("all", F.col("i") + 1, longest), " ").alias("run"), "n")


def run_counts(docs: DataFrame, least: int = 30, longest: int = 4, group: str = "lang", text: str = "text", no_group: str = "und") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, totals, paths): (group, phrase, size, n) of all phrases of at most ``longest`` words that occur ``least`` times or more
    in a group; (group, n) of all words; the graph of the edges that occur so often, compacted."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(no_group)).alias("group"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = written(runs(rows, frequent_pairs(rows, least), longest).withColumn("size", size("run")), "runs")
    totals = found.groupBy("group").agg(F.sum("n").alias("n"))
    level = found.where(F.col("size") == longest).select("group", "run", "n")
    paths = written(compacted(level.where(F.col("n") >= least)), "paths")  # rarer edges only flow into their nodes
    kept = [path_edges(paths, longest).select("group", F.col("run").alias("phrase"), F.lit(longest).alias("size"), "n")]
    for k in range(longest - 1, 0, -1):
        flow = level.select("group", head("run", k).alias("run"), "n").union(found.where(F.col("size") == k).select("group", "run", "n"))
        level = written(flow.groupBy("group", "run").agg(F.sum("n").alias("n")), f"flow{k}")
        kept.append(level.select("group", F.col("run").alias("phrase"), F.lit(k).alias("size"), "n").where(F.col("n") >= least))
    counts = kept[0]
    for k in kept[1:]:
        counts = counts.union(k)
    return written(counts, "counts"), totals, paths


def wide(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def phrases(
    docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, inside: int = 80, scale: int = 2_000_000,
    group: str = "lang", text: str = "text", no_group: str = "und",
) -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words of each group.

    Texts (null: empty) are lower-cased in A-Z and split at ``.,;:!?`` and line ends into pieces, these at blanks and tabs into words. a
    is the phrase's occurrences, ``least`` or more. Of its cuts into two parts, with l and r occurrences, the one with the least
    score floor(scale · a / (l + r)) counts, of equal ones the first. Phrases inside a longer one that occurs at least ``inside`` in a hundred
    times as often are dropped. Order: score, then a, both descending, then the phrase by its bytes. n: all words of the group. A
    null group is ``no_group``, together with a group of that name. An empty table gives no rows; other columns are ignored;
    repeated rows count as often as they occur. All counts are exact.
    """
    counts, totals, _ = run_counts(docs, least, longest, group, text, no_group)
    known = counts.where("size > 1").select("group", "phrase", "size", F.col("n").alias("a"))
    cuts = known.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", head("phrase", F.col("k")).alias("left_part"), F.expr("substring_index(phrase, ' ', k - size)").alias("right_part"))
    of = lambda name, n: counts.select("group", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(of("left_part", "l"), ["group", "left_part"]).join(of("right_part", "r"), ["group", "right_part"])
    score = F.expr(f"(cast({int(scale)} as decimal(16,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("group", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(0, size - m), i -> array_join(slice(split(phrase, ' '), i + 1, m), ' '))))"
    )
    longer = known.where("size > 2").select("group", F.explode(spans).alias("phrase"), "a").groupBy("group", "phrase").agg(F.max("a").alias("longer"))
    gone = F.coalesce(F.lit(100) * wide("longer") >= F.lit(inside) * wide("a"), F.lit(False))
    kept = best.join(longer, ["group", "phrase"], "left").where(~gone).select("group", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "group").select("group", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
