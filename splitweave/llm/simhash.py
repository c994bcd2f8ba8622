"""Near duplicates by SimHash: fingerprints are split into blocks, pairs that share blocks are joined and verified.

The 64-bit form is exact: with m blocks and a distance of at most d, two fingerprints agree in at least m − d blocks, so a
join on every choice of m − d blocks finds each pair. m grows with the number of fingerprints, which keeps the chance
matches per fingerprint few.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitweave.llm.common import small_batches, utf8, with_small, written
from splitweave.llm.components import components

SEED = 42
PART = 8192  # shingles whose bits are counted at once
FEW = 16  # largest group of one key that is compared beside others
TILE = 2048  # rows of a larger group that meet in one task


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 of every run of ``k`` words, repeats included; fewer words make one run, no word none."""
    words = text.lower().split()  # bytes: A-Z and the ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(k, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - k + 1)


def mixed(h: np.ndarray, turn: int) -> np.ndarray:
    """Another 64 bits from each hash; turn 0 is the hash itself."""
    if turn:
        h = h + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


def fingerprint(hashes: np.ndarray, words: int = 1) -> np.ndarray:
    """A bit is set if it is set in over half of the hashes; 64 bits for each of ``words``."""
    out = np.zeros(words, np.uint64)
    for j in range(words):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), PART):
            part = np.ascontiguousarray(mixed(hashes[at : at + PART], j), dtype="<u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[j] = np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, words: int = 1, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp array<long>, text_hash) of every row with an id; null text counts as empty, its fingerprint is zero."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column(1))
            prints = [fingerprint(shingle_hashes(data[s:e].tobytes(), shingle), words) for s, e in itertools.pairwise(at)]
            flat = np.concatenate(prints).view(np.int64) if prints else np.empty(0, np.int64)
            fp = pa.ListArray.from_arrays(pa.array(np.arange(len(prints) + 1, dtype=np.int32) * words), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), fp, b.column(2)], ["doc_id", "fp", "text_hash"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash")).where("doc_id is not null")
    return rows.mapInArrow(work, "doc_id long, fp array<long>, text_hash long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """The 64-bit masks of all choices of ``blocks − distance`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(single, blocks - distance)]


def planned_blocks(rows: int, distance: int, chance: float = 16) -> int:
    """The fewest blocks with which a fingerprint meets at most ``chance`` others by accident, over all keys."""
    m = distance + 1
    while math.comb(m, distance) * rows / 2.0 ** (64 * (m - distance) / m) > chance and m < 16:
        m += 1
    return m


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def exact_keys(rows: int, distance: int) -> Column:
    """Array of the keys of the column fp, 64 bits: a hash of the table's number and the bits of its blocks."""
    masks = block_masks(planned_blocks(rows, distance), distance)
    return F.array(*[F.xxhash64(F.lit(t), F.col("fp")[0].bitwiseAND(F.lit(signed(m)))) for t, m in enumerate(masks)])


def links(prints: DataFrame, keys: Column, words: int, distance: int) -> DataFrame:
    """Links (a, b) that connect the ids of all fingerprints which pairs sharing a key and differing in at most ``distance`` bits connect.

    ``prints``: id and fp, each fp once. Groups of a key with at most FEW members are compared side by side in key order. A larger
    group is dealt into tiles, each pair of tiles is one task's work and is compared in full there. Either way only enough links
    are returned to connect what is connected, at most one for each row. So no link between components is lost, no task gets a
    whole large group, and rows out don't grow with its square.
    """
    flat = prints.select("id", *[F.col("fp")[w].alias(f"f{w}") for w in range(words)], F.explode(keys).alias("key"))
    columns = ["key", "id", *[f"f{w}" for w in range(words)]]
    large = written(flat.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > FEW), "large")
    few = with_small(flat, large.select("key"), "key", "left_anti").select(*columns)

    def side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for b in batches:
            rows = np.stack([c.to_numpy() for c in b.columns], axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0], "left")) if len(rows) else 0  # its group may go on
            held = rows[last:]
            yield small_groups(rows[:last], distance)
        if held is not None:
            yield small_groups(held, distance)

    near = few.repartition("key").sortWithinPartitions("key", "id").mapInArrow(side_by_side, "a long, b long")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    dense = with_small(flat, large, "key", "inner").withColumn("own", F.pmod(F.xxhash64("id"), tiles).cast("int"))
    dense = dense.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1))).select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *columns)

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        return spanning(rows["id"].to_numpy(np.int64), np.ascontiguousarray(rows[columns[2:]].to_numpy(np.int64)).view(np.uint64), distance)

    return near.union(dense.groupBy("key", "i", "j").applyInPandas(connect, "a long, b long")).distinct()


def small_groups(rows: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links of each row to the smallest id that its group connects it with; rows (key, id, fingerprint) in order of key and id."""
    key, prints = rows[:, 0], rows[:, 2:].view(np.uint64)
    near: list[tuple[np.ndarray, np.ndarray]] = []
    for o in range(1, FEW):
        at = np.flatnonzero(key[o:] == key[:-o])
        if not len(at):
            break
        close = np.bitwise_count(prints[at] ^ prints[at + o]).sum(axis=1) <= distance
        near.append((at[close], at[close] + o))
    low, high = (np.concatenate([np.empty(0, np.int64), *(n[i] for n in near)]) for i in (0, 1))
    label = np.arange(len(rows))
    while (label[low] != label[high]).any():
        least = np.minimum(label[low], label[high])
        np.minimum.at(label, low, least)
        np.minimum.at(label, high, least)
    moved = np.flatnonzero(label != np.arange(len(rows)))
    return pa.RecordBatch.from_arrays([pa.array(rows[moved, 1]), pa.array(rows[label[moved], 1])], ["a", "b"])


def spanning(ids: np.ndarray, prints: np.ndarray, distance: int) -> pd.DataFrame:
    """Links that connect all rows which are connected through pairs within the distance: breadth first, no pair listed."""
    left, a, b = np.arange(len(ids)), [], []
    while len(left):
        root, front, left = ids[left[0]], left[:1], left[1:]
        while len(front) and len(left):
            close = np.bitwise_count(prints[left] ^ prints[front[0]]).sum(axis=1) <= distance
            found = left[close]
            a.append(np.full(len(found), root))
            b.append(ids[found])
            front, left = np.r_[front[1:], found], left[~close]
    empty = np.empty(0, np.int64)
    return pd.DataFrame({"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])})


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash, class_id) of every row with an id: exact 64-bit form.

    The fingerprint is 16 lowercase hex digits, component_id the smallest doc_id reachable over links of at most ``distance``
    differing bits, the row's own included. Null and empty texts have fingerprint zero and are linked like any other. Fewer
    words than a shingle form one shingle. Rows without an id are left out; repeated rows come back repeated; rows that share an id
    but not their fingerprint belong together only if links say so, and text_hash (XXH64 of the text, null as empty) tells them
    apart; class_id numbers what is linked, also where ids repeat. An empty table gives no rows; other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle, 1, id_column, text), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).select(F.col("fp")[0].alias("id"), "fp", "doc_id"), "classes")
    found = written(components(links(classes.select("id", "fp"), exact_keys(classes.count(), distance), 1, distance)), "components")
    joined = found.join(classes.select(F.col("id").alias("node"), "doc_id"), "node")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    moved = found.join(least, "component").select(F.col("node").alias("id"), "component", "component_id")
    labelled = classes.join(moved, "id", "left").select("fp", F.coalesce("component", "id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))
    rows = prints.join(labelled, "fp")
    return rows.select("doc_id", F.lpad(F.lower(F.hex(F.col("fp")[0])), 16, "0").alias("fingerprint"), "component_id", "text_hash", "class_id")
