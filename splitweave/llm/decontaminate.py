"""Benchmark decontamination by spaced seeds: hashes of word windows that ignore fixed positions, so that substituted
words don't break a match; hits are verified along their alignment."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitweave.llm.common import ragged, slabs, small_batches, utf8, written

# Which words of a window count. Every stretch of 13 words or more of which 4 in 5 are equal has a place where one of MASKS fits.
MASKS = ("11011111", "11010100111", "1110010010011", "11100011011", "111010010101", "10001110111")
# The same for whole items of at most 6, 9 and 12 words.
SHORT = {6: ("1111", "10111", "11011", "11101"), 9: ("11111", "110111", "111011"), 12: ("1101111", "11110011", "110011011", "10101111", "11110101")}
LEAST_WORDS = 5
FILTER_BITS = 26
REACH = 64
SLAB = 2 << 20

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_random = np.random.default_rng(42)
BYTE_VALUES = _random.integers(1, 2**64, 256, dtype=np.uint64)
PLACES = _random.integers(1, 2**64, 4096, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts in ``data`` (lower-cased UTF-8), and where each text's words begin among them.

    A word is a run of ASCII letters and digits and of bytes above 127.
    """
    inside = WORD_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = at[:-1][at[:-1] < at[1:]]
    begins[first] = inside[first]
    flat = np.flatnonzero(inside)
    if not len(flat):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    starts = np.flatnonzero(begins[flat])
    lengths = np.diff(np.r_[starts, len(flat)])
    powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(lengths.max() - 1, BASE)])
    values = BYTE_VALUES[data[flat]] * powers[ragged(np.zeros(len(starts), np.int64), lengths)]
    return stirred(np.add.reduceat(values, starts)), np.searchsorted(flat[starts], at)


def windows(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the mask's words at every place where the window fits."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, int(mask, 2), np.uint64) * PLACES[-len(mask)]
    for i, counts in enumerate(mask):
        if counts == "1":
            total += hashes[i : i + n] * PLACES[i]
    return stirred(total)


def seeds(n: int) -> list[str]:
    """The masks for a test item of ``n`` words; none below LEAST_WORDS."""
    return [] if n < LEAST_WORDS else list(next((SHORT[most] for most in SHORT if n <= most), MASKS))


def probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - bits)).astype(np.int64), (h & np.uint64((1 << bits) - 1)).astype(np.int64)


def item_hashes(items: DataFrame) -> DataFrame:
    """(item_id, tie, hash, pos, mask): a row for each window of each item; tie tells items apart that share an id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, first = words(*utf8(b.column(1)))
            for i, (item, tie) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)):
                own = h[first[i] : first[i + 1]]
                for m in seeds(len(own)):
                    w = windows(own, m).view(np.int64)
                    kinds = (pa.array([item] * len(w), pa.int64()), pa.array([tie] * len(w), pa.int64()), pa.array(w), pa.array(np.arange(len(w), dtype=np.int32)), pa.array([m] * len(w), pa.string()))
                    yield pa.RecordBatch.from_arrays(list(kinds), ["item_id", "tie", "hash", "pos", "mask"])

    return items.mapInArrow(work, "item_id long, tie long, hash long, pos int, mask string")


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, tie, item_words array<long>): the hashed words of each item, once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, first = words(*utf8(b.column(1)))
            own = pa.ListArray.from_arrays(pa.array(np.asarray(first, np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), own], ["item_id", "tie", "item_words"])

    return items.mapInArrow(work, "item_id long, tie long, item_words array<long>").dropDuplicates(["item_id", "tie"])


def presence(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit map of 2^bits bits that has both probes of every test hash; its size doesn't depend on the table."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(probes(b.column(0).to_numpy().view(np.uint64), bits)))
            word, bit = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], ["word", "bit"])

    got = hashes.select("hash").mapInArrow(gather, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got.column("word").to_numpy()] = got.column("bit").to_numpy()
    return out.view(np.uint8)


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, ratio: float = 0.8, id_column: str = "doc_id", item_column: str = "item_id", text: str = "text", item_text: str | None = None) -> DataFrame:
    """(doc_id, item_id, matched, aligned, start): documents that hold a passage of a benchmark item, one row for each pair.

    A hit is a window of a document whose counted words equal those of a window of an item. Around a hit, document and item
    are laid side by side; a stretch of at least ``min_words`` words, or as long as the item if that is shorter, must have
    ``ratio`` of its words equal. With the given limits no such stretch is without a hit; lower ones may miss some. Of the
    stretches that meet both the one with the most equal words is told, the shortest and first of these; ``start`` is its first
    word in the document. Items of fewer than five words are no evidence and match nothing. Words are compared in lower case.

    Null and empty texts and items match nothing, empty tables give no rows, rows without an id are left out, repeated
    rows of an id count once for each pair, other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    prepared = lambda df, c, t: df.select(F.col(c).cast("long").alias("id"), F.lower(F.coalesce(F.col(t), F.lit(""))).alias("text")).where("id is not null")
    items = prepared(benchmark, item_column, item_text or text).withColumn("tie", F.xxhash64("text"))
    tests = written(item_hashes(items), "tests")
    shown = {r["mask"] for r in tests.select("mask").distinct().collect()}  # the fixed masks and at most one for each short length
    bitmap = spark.sparkContext.broadcast(presence(tests, FILTER_BITS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for b in batches:
            data, at = utf8(b.column(1))
            ids, out = b.column(0).to_numpy(), []
            for i, j in slabs(at, SLAB):
                h, first = words(data[at[i] : at[j]], at[i : j + 1] - at[i])
                out += regions(ids[i:j], h, first, hits(h, first, shown, bits))
            names = ["doc_id", "region", "words", "hits"]
            hit_kind = pa.list_(pa.struct([("at", pa.int32()), ("hash", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64()), hit_kind))], names)

    regions_ = prepared(docs, id_column, text).mapInArrow(scan, "doc_id long, region long, words array<long>, hits array<struct<at:int,hash:long>>")
    # Rows that share an id are told apart by the words around their hits.
    found = written(regions_.withColumn("own", F.xxhash64("words")), "regions")
    place = ["doc_id", "region", "own"]
    hit = found.select(*place, F.explode("hits").alias("hit")).select(*place, "hit.at", "hit.hash")
    lined = hit.join(tests.select("hash", "item_id", "tie", "pos"), "hash").select(*place, "item_id", "tie", (F.col("at") - F.col("pos")).alias("shift")).distinct()
    both = lined.join(found.select(*place, "words").dropDuplicates(place), place).join(item_words(items), ["item_id", "tie"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = lambda c: (b.column(c).flatten().to_numpy(), np.r_[0, np.cumsum(b.column(c).value_lengths().to_numpy())])
            (w, wa), (t, ta) = flat("words"), flat("item_words")
            rows = []
            for k, (doc, region, item, shift) in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc_id", "region", "item_id", "shift")), strict=True)):
                got = stretch(w[wa[k] : wa[k + 1]], t[ta[k] : ta[k + 1]], shift, min_words, ratio)
                if got:
                    rows.append((doc, item, got[1], got[2], region + got[0]))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(5)], ["doc_id", "item_id", "matched", "aligned", "start"])

    rows = both.select("doc_id", "region", "item_id", "shift", "words", "item_words").mapInArrow(verify, "doc_id long, item_id long, matched long, aligned long, start long")
    best = rows.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", -F.col("aligned"), -F.col("start"))).alias("b"))
    return best.select("doc_id", "item_id", "b.matched", (-F.col("b.col2")).alias("aligned"), (-F.col("b.col3")).alias("start"))


def hits(h: np.ndarray, first: np.ndarray, masks: set[str], bits: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each mask: places and hashes of the windows that the bit map may know, and the mask's length."""
    out = []
    for m in sorted(masks):
        w = windows(h, m)
        a, b = probes(w, FILTER_BITS)
        at = np.flatnonzero((bits[a >> 3] >> (a & 7)) & 1)
        at = at[((bits[b[at] >> 3] >> (b[at] & 7)) & 1).astype(bool)]
        end = first[np.searchsorted(first, at, "right")] if len(at) else at
        at = at[at + len(m) <= end]
        out.append((at, w[at], len(m)))
    return out


def regions(ids: np.ndarray, h: np.ndarray, first: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, int]]) -> list[tuple]:
    """(id, first word, words, hits) of the stretches around hits; hits closer than twice REACH share one."""
    at = np.concatenate([a for a, _, _ in found]) if found else np.empty(0, np.int64)
    if not len(at):
        return []
    value, span = np.concatenate([v for _, v, _ in found]), np.concatenate([np.full(len(a), n) for a, _, n in found])
    order = np.argsort(at, kind="stable")
    at, value, span = at[order], value[order].view(np.int64), span[order]
    doc = np.searchsorted(first, at, "right") - 1
    breaks = np.flatnonzero((np.diff(at) > 2 * REACH) | (np.diff(doc) != 0)) + 1
    out = []
    for a, b in zip(np.r_[0, breaks], np.r_[breaks, len(at)], strict=True):
        d = doc[a]
        low, high = max(first[d], at[a] - REACH), min(first[d + 1], (at[a:b] + span[a:b]).max() + REACH)
        own = [{"at": int(p - low), "hash": int(v)} for p, v in zip(at[a:b], value[a:b], strict=True)]
        out.append((int(ids[d]), int(low - first[d]), h[low:high].view(np.int64), own))
    return out


def stretch(words_: np.ndarray, item: np.ndarray, shift: int, min_words: int = 13, ratio: float = 0.8) -> tuple[int, int, int] | None:
    """(first word, equal words, length) of the stretch of the item laid at ``shift`` that has the most equal words, if one is long and equal enough."""
    low, high = max(0, shift), min(len(words_), shift + len(item))
    least, share = min(min_words, len(item)), Fraction(str(ratio))
    if high - low < least:
        return None
    equal = words_[low:high] == item[low - shift : high - shift]
    count = np.r_[0, np.cumsum(equal)]
    if count[-1] * share.denominator < least * share.numerator:
        return None
    over = count * share.denominator - np.arange(len(count)) * share.numerator
    lowest = np.minimum.accumulate(over)
    start = np.searchsorted(-lowest, -over)  # for each end, the first start from which enough is equal
    end = np.arange(len(count))
    start, end = start[end - start >= least], end[end - start >= least]
    if not len(end):
        return None
    first = np.minimum.accumulate(np.where(np.r_[equal, True], np.arange(len(count)), len(count))[::-1])[::-1]  # the next equal word
    start = np.minimum(first[start], end - least)
    matched = count[end] - count[start]
    best = np.lexsort((start, end - start, -matched))[0]
    return low + int(start[best]), int(matched[best]), int(end[best] - start[best])
