"""Best-fit packing by bin completion over the counts of lengths.

Pieces of one length are alike, so what is packed is a table of at most ``capacity`` counts, whatever the number of
documents. Best-fit decreasing on these counts gives the incumbent. If it exceeds the lower bound, a branch-and-bound search
fills the bin of the largest remaining length with undominated completions, the least waste first, and gives up a branch when
its waste leaves no room for an improvement. The plan is a list of patterns; Spark numbers the pieces of each length and
looks up their places.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splitweave.llm.common import slabs, small_batches, utf8, written
from splitweave.llm.tokens import encoder

NODES = 2000  # bins that the search may open before it keeps the best plan so far
FILLINGS = 6  # completions tried for one bin, the least waste first
TRIES = 400  # steps spent on finding completions of one bin
GROUP_ROWS = 500_000

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # how many sequences; (length, pieces of it in each)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The bound of Martello and Toth: what does not fit beside the large pieces needs sequences of its own."""
    n = np.zeros(capacity + 1, np.int64)
    for length, c in counts.items():
        n[length] = c
    size = n * np.arange(capacity + 1)
    number, weight = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(size)]  # of lengths below i
    half = capacity // 2
    best = -(-int(weight[-1]) // capacity)
    for k in range(half + 1):
        above, middle = int(number[-1] - number[capacity - k + 1]), int(number[capacity - k + 1] - number[half + 1])
        room = middle * capacity - int(weight[capacity - k + 1] - weight[half + 1])
        best = max(best, above + middle + max(0, -(-(int(weight[half + 1] - weight[k]) - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing; sequences with equal contents are kept as one group."""
    room: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []

    def add(left: int, n: int, filled: tuple) -> None:
        if left not in room:
            room[left] = []
            bisect.insort(rooms, left)
        room[left].append((n, filled))

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                left = rooms[i]
                n, filled = room[left].pop()
                if not room[left]:
                    del room[left], rooms[i]
                each = left // length  # the next piece of this length fits best where the last one went
                full = min(n, todo // each)
                part = todo - full * each if full < n else 0
                if full:
                    add(left - each * length, full, (*filled, (length, each)))
                if part:
                    add(left - part * length, 1, (*filled, (length, part)))
                if n > full + bool(part):
                    add(left, n - full - bool(part), filled)
                todo -= full * each + part
            else:
                add(capacity, -(-todo // (capacity // length)), ())
    return [(n, filled) for groups in room.values() for n, filled in groups]


def completions(
    counts: dict[int, int], lengths: list[int], room: int, fillings: int | None = FILLINGS, tries: int | None = TRIES
) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Undominated fillings of ``room`` by the remaining pieces, as (waste, pieces), the least waste first.

    A filling is dominated if it is not maximal, or if a single piece that fits is larger than all of it together. At most
    ``fillings`` are returned, found in ``tries`` steps; with None for both it is all of them.
    """
    every = fillings is None or tries is None
    fillings, tries = (math.inf if x is None else x for x in (fillings, tries))
    fits = [x for x in lengths if x <= room and counts[x]]
    if not fits:
        return [(room, ())]
    single, found, steps = fits[0], {}, 0

    def grow(i: int, left: int, filled: tuple) -> None:
        nonlocal steps
        steps += 1
        while i < len(fits) and fits[i] > left:
            i += 1
        if i == len(fits) or left == 0:
            used = dict(filled)
            if room - left >= single and not any(counts[x] > used.get(x, 0) for x in fits if x <= left):
                found[filled] = left
            return
        x = fits[i]
        for u in range(min(counts[x], left // x), -1, -1):
            if steps > tries or len(found) >= 4 * fillings or (len(found) >= fillings and min(found.values()) == 0):
                return
            grow(i + 1, left - u * x, (*filled, (x, u)) if u else filled)

    if every:
        grow(0, room, ())
        return sorted((w, f) for f, w in found.items())
    near = bisect.bisect_left([-x for x in fits], -room)
    for start in [near, *range(near + 1, min(len(fits), near + fillings))]:  # begin with the largest, then without it
        grow(start, room, ())
        for x in fits[start:]:  # pairs that fill the room
            if counts.get(room - x, 0) > (room - x == x) and room - x >= 1:
                pair = ((x, 2),) if room - x == x else ((max(x, room - x), 1), (min(x, room - x), 1))
                found[pair] = 0
                break
    return sorted((w, f) for f, w in found.items())[:fillings]


def complete(
    counts: dict[int, int], capacity: int, incumbent: list[Pattern], bound: int, nodes: int | None, fillings: int | None = FILLINGS, tries: int | None = TRIES
) -> tuple[list[Pattern], bool]:
    """Depth-first bin completion: the best plan found, and whether no other can be shorter.

    A step fills as many sequences alike as the counts allow. Without any limit (None) it fills one at a time with every undominated
    filling; when that search ends, its plan is proved.
    """
    every = nodes is None and fillings is None and tries is None
    nodes = math.inf if nodes is None else nodes
    best, total = sum(n for n, _ in incumbent), sum(x * c for x, c in counts.items())
    plan, path = incumbent, []  # path: (remaining counts, wasted, sequences used, untried fillings, the pattern chosen)
    left, wasted, used = dict(counts), 0, 0
    while nodes > 0:
        lengths = sorted((x for x, c in left.items() if c), reverse=True)
        if not lengths:
            if used < best:
                best, plan = used, [p[4] for p in path]
                if best <= bound:
                    return plan, True
            options: list = []
        elif wasted > (best - 1) * capacity - total or used + (-(-sum(x * left[x] for x in lengths) // capacity)) >= best:
            options = []
        else:
            top = lengths[0]
            left[top] -= 1
            options = [(w, f, top) for w, f in completions(left, lengths, capacity - top, fillings, tries)]
            left[top] += 1
        if options:
            path.append([left, wasted, used, options, None])
        while path and not path[-1][3]:
            path.pop()
        if not path:
            return plan, every
        nodes -= 1
        before, wasted, used, options, _ = path[-1]
        w, filling, top = options.pop(0)
        need = dict(filling)
        need[top] = need.get(top, 0) + 1
        times = 1 if every else min(before[x] // u for x, u in need.items())
        path[-1][4] = (times, tuple(sorted(need.items(), reverse=True)))
        left = {x: c - times * need.get(x, 0) for x, c in before.items() if c > times * need.get(x, 0)}
        wasted, used = wasted + times * w, used + times
    return plan, False


def proved_plan(counts: dict[int, int], capacity: int, nodes: int | None = NODES, fillings: int | None = FILLINGS, tries: int | None = TRIES) -> tuple[list[Pattern], bool]:
    """As few sequences as the search finds for so many pieces of each length, and whether there can be no fewer."""
    bound, plan = lower_bound(counts, capacity), best_fit(counts, capacity)
    return (plan, True) if sum(n for n, _ in plan) <= bound else complete(counts, capacity, plan, bound, nodes, fillings, tries)


def plan_of(counts: dict[int, int], capacity: int, nodes: int | None = NODES, fillings: int | None = FILLINGS, tries: int | None = TRIES) -> list[Pattern]:
    return proved_plan(counts, capacity, nodes, fillings, tries)[0]


def places(plan: list[Pattern]) -> dict[str, np.ndarray]:
    """The plan by length and number: pieces ``low``… of a length go, ``each`` to a sequence, to ``sequence``…, from ``offset`` on."""
    rows, taken, sequence = [], {}, 0
    for n, filled in plan:
        offset = 0
        for length, each in filled:
            low = taken.get(length, 0)
            rows.append((length, low, each, sequence, offset))
            taken[length] = low + n * each
            offset += length * each
        sequence += n
    rows.sort()
    return dict(zip(("length", "low", "each", "sequence", "offset"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def token_pieces(docs: DataFrame, vocabulary: str, layout: str, end: tuple[int, ...], capacity: int, id_column: str, text: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, cut where they exceed the capacity; the first piece is the short one."""
    small_batches(docs.sparkSession)
    tail = np.array(end, "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, layout)
        for b in batches:
            texts, at, rows = b.column(1), utf8(b.column(1))[1], []
            for i, j in slabs(at, 1 << 20):
                for doc, ids in zip(b.column(0)[i:j].to_pylist(), enc.encode(texts[i:j].to_pylist()), strict=True):
                    ids += tail
                    n = len(ids) // 4
                    first = n - capacity * max(0, -(-n // capacity) - 1)
                    edges = [0, *range(first, n + 1, capacity)]
                    rows += [(doc, k, s, e - s, zlib.crc32(ids[4 * s : 4 * e])) for k, (s, e) in enumerate(zip(edges, edges[1:], strict=False))]
            kinds = (b.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(
    docs: DataFrame, vocabulary: str, layout: str = "spaced", capacity: int = 2048, end: tuple[int, ...] = (0,), id_column: str = "doc_id", text: str = "text",
    nodes: int | None = NODES, fillings: int | None = FILLINGS, tries: int | None = TRIES, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): all documents in as few sequences of ``capacity`` ids as found.

    Only documents longer than a sequence are cut. Null and empty texts are the end ids alone. Repeated rows are packed each
    for itself, null ids are carried along, an empty table gives no rows, other columns are ignored. ``nodes``, ``fillings`` and ``tries``
    limit the search, not what is packed; without them (None) it goes on until the plan is proved, which takes long for many lengths.
    """
    pieces = written(token_pieces(docs, vocabulary, layout, end, capacity, id_column, text), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    at = places(plan_of(counts, capacity, nodes, fillings, tries))
    groups = max(1, math.ceil(max(counts.values(), default=0) / group_rows))
    dealt = pieces.withColumn("_g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "_g").agg(F.count("*").alias("n")).select("length", "_g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_g").orderBy("doc_id", "piece", "start", "ids_crc32")  # ties are equal rows: a rerun task numbers alike
    numbered = dealt.withColumn("_own", F.row_number().over(own) - 1).join(base, ["length", "_g"]).withColumn("_number", F.col("_own") + F.col("_base"))
    sent = docs.sparkSession.sparkContext.broadcast(at)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for b in batches:
            length, number = (b.column(c).to_numpy() for c in ("length", "_number"))
            first, last = np.searchsorted(p["length"], length, "left"), np.searchsorted(p["length"], length, "right")
            row = first.copy()
            for value in np.unique(length):
                mine = length == value
                f, e = first[mine][0], last[mine][0]
                row[mine] = f + np.searchsorted(p["low"][f:e], number[mine], "right") - 1
            inside, each = number - p["low"][row], p["each"][row]
            sequence, offset = p["sequence"][row] + inside // each, p["offset"][row] + inside % each * length
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(look, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
