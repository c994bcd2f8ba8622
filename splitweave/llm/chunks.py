"""Substring deduplication: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splitweave.llm.common import small_batches, utf8

WINDOW = 16  # bytes: each step shifts a 32-bit hash by two bits
GEAR = np.random.default_rng(42).integers(0, 2**32, 256, dtype=np.uint32)
SLAB = 4 << 20


def gear(data: np.ndarray) -> np.ndarray:
    """h[i] = (h[i − 1] << 2) + GEAR[data[i]], for all positions at once: sums over 1, 2, 4, 8, 16 bytes."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):
        more = h.copy()
        more[k:] += h[:-k] << np.uint32(2 * k)
        h = more
    return h


def raw_cuts(data: np.ndarray, average: int) -> np.ndarray:
    """Positions whose hash is below the limit and which end a character; the first ones lack a full window and are none."""
    limit, found = np.uint32(2**32 // average), []
    for at in range(0, len(data), SLAB):
        low = max(0, at - WINDOW + 1)
        part = data[low : at + SLAB]
        hit = np.flatnonzero(gear(part) < limit) + low
        found.append(hit[hit >= max(at, WINDOW - 1)])
    cuts = np.concatenate(found) if found else np.empty(0, np.int64)
    cuts = cuts[cuts < len(data) - 1]
    return cuts[(data[cuts + 1] & 0xC0) != 0x80]


def boundaries(data: np.ndarray, average: int = 24, least: int = 8, most: int = 2048) -> np.ndarray:
    """Where the chunks of one text begin, and its end.

    A cut is kept if no other raw cut lies in the ``least`` bytes before it. That looks at nearby bytes only, so chunks after
    an insertion are the same as without it. Stretches without a cut are divided every ``most`` bytes.
    """
    if not len(data):
        return np.zeros(1, np.int64)
    cuts = raw_cuts(data, average)
    cuts = cuts[np.diff(cuts, prepend=-least - 1) > least]
    edges = np.r_[0, cuts + 1, len(data)]
    if np.diff(edges).max() <= most:
        return edges
    out = [np.zeros(1, np.int64)]
    for a, b in itertools.pairwise(edges.tolist()):
        while b - a > most:
            a += most
            while (data[a] & 0xC0) == 0x80:
                a -= 1
            out.append(np.array([a]))
        out.append(np.array([b]))
    return np.concatenate(out)


def chunk_rows(data: np.ndarray, average: int, least: int, most: int) -> tuple[np.ndarray, ...]:
    """Of every chunk of a text: start and length in characters, words that begin in it, and the two halves of its digest."""
    edges = boundaries(data, average, least, most)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    words = np.add.reduceat(begins, edges[:-1], dtype=np.int32)
    chars = np.add.reduceat((data & 0xC0) != 0x80, edges[:-1], dtype=np.int32)
    view, digest = memoryview(data), xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join([digest(view[a:b]) for a, b in itertools.pairwise(edges.tolist())]), "<i8").reshape(-1, 2)
    return np.cumsum(chars) - chars, chars, words, both[:, 0], both[:, 1]


def text_chunks(docs: DataFrame, average: int = 24, least: int = 8, most: int = 2048, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, words, d1, d2) of every chunk of every text; null and empty texts have none."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, (data, at) = b.column(0).to_numpy(), utf8(b.column(1))
            rows = [(i, *chunk_rows(data[s:e], average, least, most)) for i, (s, e) in zip(ids, itertools.pairwise(at), strict=True) if e > s]
            if rows:
                parts = [np.concatenate(c) for c in zip(*(r[1:] for r in rows), strict=True)]
                own = np.repeat([r[0] for r in rows], [len(r[1]) for r in rows])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (own, parts[0].astype(np.int32), *parts[1:])], ["doc_id", "start", "length", "words", "d1", "d2"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("doc_id is not null")
    return rows.mapInArrow(work, "doc_id long, start int, length int, words int, d1 long, d2 long")


def repeated_spans(docs: DataFrame, min_words: int = 12, average: int = 24, least: int = 8, most: int = 2048, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, words, first_doc_id, first_start): passages that stand elsewhere too, but for their first place.

    A chunk's first place is the smallest (doc_id, start) of its digest; the chunks at all other places are duplicates.
    Neighbouring duplicates form one span, counted in characters; spans in which at least ``min_words`` words begin are
    returned, with the first place of their first chunk. A passage loses up to a few words at either end, so a span of the
    default length lies inside any repeat of over 50 words but for about one in a hundred of the shortest.

    Documents without a repeat give no row, nor do null and empty texts and an empty table. Rows without an id are left
    out, rows repeated with their id count as one document. Other columns are ignored.
    """
    chunks = text_chunks(docs, average, least, most, id_column, text)
    firsts = chunks.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("first")).where("n > 1")
    firsts = firsts.select("d1", "d2", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"))
    again = chunks.join(firsts, ["d1", "d2"]).where("doc_id <> first_doc_id or start <> first_start").drop("d1", "d2")
    by_place = Window.partitionBy("doc_id").orderBy("start")
    end = F.lag(F.col("start") + F.col("length")).over(by_place)
    same = F.lag("start").over(by_place) == F.col("start")  # a repeated row of the document
    runs = again.select("*", F.coalesce(same, F.lit(False)).alias("same"), F.when(end >= F.col("start"), 0).otherwise(1).alias("fresh")).where("not same")
    runs = runs.withColumn("run", F.sum("fresh").over(by_place))
    spans = runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.sum("length").alias("length"), F.sum("words").alias("words"),
        F.min(F.struct("start", "first_doc_id", "first_start")).alias("head"),
    )
    return spans.where(F.col("words") >= min_words).select("doc_id", "start", "length", "words", "head.first_doc_id", "head.first_start")


def without_spans(docs: DataFrame, spans: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the spans cut out of their texts; ids must be unique, spans must not overlap."""
    cuts = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length")))).alias("_cuts"))
    edge = lambda i: F.when(i == 0, 0).otherwise(F.col("_cuts")[i - 1]["start"] + F.col("_cuts")[i - 1]["length"])
    till = lambda i: F.when(i < F.size("_cuts"), F.get("_cuts", i)["start"]).otherwise(F.length(text))
    kept = F.array_join(F.transform(F.sequence(F.lit(0), F.size("_cuts")), lambda i: F.col(text).substr((edge(i) + 1).cast("int"), (till(i) - edge(i)).cast("int"))), "")
    joined = docs.join(cuts.withColumnRenamed("doc_id", "_id"), F.col(id_column) == F.col("_id"), "left")
    return joined.withColumn(text, F.when(F.col("_cuts").isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)
