"""Near duplicates of vectors by an exact metric range join.

Cosine ``c`` of two vectors is the distance sqrt(2 − 2c) of their directions, so ``cosine >= t`` is a range join with radius r.
Pivots partition the directions: each belongs to the cell of its nearest pivot. A direction also visits every other cell that
may hold something within r of it. By the triangle inequality that is no cell whose farthest member is more than r
nearer to its pivot than the visitor, and none on whose side of the bisector of both pivots the visitor would get only after more than r. Of two
cells one visits the other, by a fixed rule. Members within r/2 of their pivot are within r of each other, again by the triangle inequality:
they are counted, not compared.

Vectors are dealt out once: a cell, in order of the distance from its pivot, becomes blocks, each one row of a table. Tasks read pairs of
blocks from that table, so nothing else is written or shuffled, however many cells a vector visits. Two blocks are compared
in the few dimensions that hold most of the sample, with the length of the rest as one more: by the inequality of Cauchy and Schwarz that product
is no less than the cosine. What reaches the threshold is compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitweave.llm.common import small_batches, written
from splitweave.llm.components import components

SLACK = 1e-6  # on distances, more than the error of their computation
HELD = 4096  # vectors that a block holds
STREAMED = 65_536  # about as many vectors are in a file of blocks
BLOCK_BYTES = 2 << 20  # of a block's vectors; blocks of wide vectors hold fewer
KEPT_BYTES = 64 << 20  # of blocks that a task keeps prepared
TILE = 256  # rows compared at once with a block
UNVISITED = 9.0  # more than any distance of directions, with any radius added


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column, padded with zeros to ``width``."""
    at, values = np.asarray(column.offsets, np.int64), np.asarray(column.values, np.float64)
    size = np.diff(at)
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(at[-1] - at[0]) - np.repeat(at[:-1] - at[0], size)] = values[at[0] : at[-1]]
    return out


def directions(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that no square overflows or vanishes. Rows have a component other than zero."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def farthest_first(u: np.ndarray, pivots: int) -> np.ndarray:
    """Pivots of a sample of directions, each the farthest from those before it."""
    if not len(u):
        return u
    chosen, near = [0], u @ u[0]
    while len(chosen) < min(pivots, len(u)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, u @ u[chosen[-1]])
    return u[chosen]


def distances(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (u @ pivots.T)))


def visits(d: np.ndarray, own: np.ndarray, between: np.ndarray, radius: float) -> np.ndarray:
    """Which cells each direction must visit, by the bisector bound and the rule for the two cells' order."""
    p, at = d.shape[1], np.arange(len(d))
    gap = d * d - (d[at, own] ** 2)[:, None]
    near = gap <= 2 * (radius + SLACK) * between[own] + SLACK
    order = np.arange(p)
    turn = (order[None, :] < order[:, None]) ^ ((order[None, :] + order[:, None]) % 2 == 1)  # [own, other]: who visits whom
    near &= turn[own]
    near[at, own] = False
    return near


def ordered_bytes(column: pa.Array, kind: str) -> tuple[pa.Array, pa.Array]:
    """Vectors as bytes that sort as the vectors do, null for those that link with nothing; and their lengths, 0 for null."""
    at, values = np.asarray(column.offsets, np.int64), np.asarray(column.values, kind) + 0.0  # no negative zeros
    values, at = values[at[0] : at[-1]], at - at[0]
    row = np.repeat(np.arange(len(column)), np.diff(at))
    good = np.bincount(row, ~np.isfinite(values), len(column)) == 0
    good &= np.bincount(row, values != 0, len(column)) > 0
    bits = values.view(f"u{values.itemsize}")
    sign = bits >> bits.dtype.type(8 * values.itemsize - 1)
    bits = bits ^ (bits.dtype.type(1 << (8 * values.itemsize - 1)) | (bits.dtype.type(0) - sign))
    raw, ends = bits.astype(f">u{values.itemsize}").tobytes(), at * values.itemsize
    told = pa.array([raw[s:e] if ok else None for s, e, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), good.tolist(), strict=True)], pa.binary())
    return told, pa.array(np.where(good, np.diff(at), 0).astype(np.int32))


def of_ordered(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """The vectors of ``ordered_bytes``, none null, padded with zeros to ``width``."""
    told = column.to_pylist()
    size = np.array([len(v) for v in told]) // np.dtype(kind).itemsize
    bits = np.frombuffer(b"".join(told), f">u{kind[-1]}").astype(f"u{kind[-1]}")
    top = bits.dtype.type(1 << (8 * bits.itemsize - 1))
    bits = np.where(bits & top, bits ^ top, ~bits)
    out = np.zeros((len(size), width), kind)
    out[np.arange(width) < size[:, None]] = bits.view(kind)
    return out


def narrow_basis(seen: np.ndarray, threshold: float) -> np.ndarray | None:
    """The directions that hold most of a sample, as few as leave one pair of the sample in 256 or fewer to compare in vain."""
    width = seen.shape[1]
    if not len(seen):
        return None
    basis = np.linalg.eigh(seen.T @ seen)[1][:, ::-1]
    some = seen[:1024]
    most = np.count_nonzero(some @ some.T >= threshold) + len(some) ** 2 / 256
    for k in (16, 32, 64, 128, 256):
        if 2 * k > width:
            return None
        narrow = narrowed(some, basis[:, : k - 1])
        if np.count_nonzero(narrow @ narrow.T >= threshold) <= most:
            return np.ascontiguousarray(basis[:, : k - 1])
    return None


def narrowed(u: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    """Directions in the dimensions of a basis and the length of what is left: their products are no less than the cosines."""
    if basis is None:
        return u.astype(np.float32)
    v = u @ basis
    return np.c_[v, np.sqrt(np.maximum(0.0, 1.0 - (v * v).sum(axis=1)))].astype(np.float32)


def one_row_each(rows: DataFrame, few: int = 200_000) -> DataFrame:
    """One row for each id, with its largest vector; only vectors of repeated ids are shuffled if these are few."""
    repeated = written(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    n, largest = repeated.count(), F.max("v").alias("v")
    if not n:
        return rows
    if n > few:
        return rows.groupBy("vec_id").agg(largest)
    return rows.join(F.broadcast(repeated), "vec_id", "left_anti").union(rows.join(F.broadcast(repeated), "vec_id", "left_semi").groupBy("vec_id").agg(largest))


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector: str = "embedding",
    cell_rows: int = 2048, most_pivots: int = 1024, sample: int = 4096,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every id: links join vectors whose cosine is ``threshold`` or more, in double precision.

    Vectors that are null, zero or hold a null or non-finite component link with nothing: n_links 0, component_id their own id.
    A repeated id counts once, with its largest usable vector; rows without an id are left out. Equal vectors in a block are one
    node that counts as often as it occurs. Shorter vectors count as padded with zeros. An empty table gives no rows;
    other columns are ignored. ``threshold`` lies above 0 and is at most 1.

    Pivots come from ``sample`` vectors at most (those with the smallest hash), one for ``cell_rows`` vectors and ``most_pivots`` at
    most; every vector is joined. The result is the same for any pivots.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and be at most 1")
    spark, radius = vectors.sparkSession, math.sqrt(2 - 2 * threshold)
    element, kind = ("float", "<f4") if vectors.schema[vector].dataType.elementType.typeName() == "float" else ("double", "<f8")  # what is shuffled; computed is in doubles
    small_batches(spark)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *ordered_bytes(b.column(1), kind)], ["vec_id", "v", "size"])

    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{element}>").alias("v")).where("vec_id is not null")
    rows = written(rows.mapInArrow(coded, "vec_id long, v binary, size int"), "vectors")
    n, width = rows.agg(F.count_if(F.col("size") > 0), F.coalesce(F.max("size"), F.lit(0))).first()
    each, by_hash = one_row_each(rows.select("vec_id", "v")), F.xxhash64("vec_id")
    some = each.where("v is not null").where(by_hash <= min(2**63 - 1, 2**65 * sample // max(1, n) - 2**63))
    picked = some.orderBy(by_hash, "vec_id").limit(sample).select("v").toArrow()
    seen = np.unique(of_ordered(picked.column(0).combine_chunks(), width, kind).astype(np.float64), axis=0) if picked.num_rows else np.empty((0, width))
    seen = np.random.default_rng(1).permutation(directions(seen) if len(seen) else seen)
    pivots, basis = farthest_first(seen, min(most_pivots, max(1, math.ceil(n / cell_rows)))), narrow_basis(seen, threshold)
    between = distances(pivots, pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = of_ordered(b.column(1), width, kind)
            u = directions(x.astype(np.float64))
            own = distances(u, pivots).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.astype(np.int32)), pa.array(own_distance(u, pivots[own])), pa.array([v.tobytes() for v in x], pa.binary())], ["vec_id", "cell", "far", "v"])

    held = max(1, min(HELD, BLOCK_BYTES // max(1, width * np.dtype(kind).itemsize)))
    files = max(spark.sparkContext.defaultParallelism, math.ceil(n / max(1, STREAMED * held // HELD)))
    placed = each.where("v is not null").mapInArrow(assign, "vec_id long, cell int, far double, v binary")
    placed = placed.repartitionByRange(files, "cell", "far", "vec_id").sortWithinPartitions("cell", "far", "v", "vec_id")
    blocks = written(placed.mapInArrow(lambda batches: blocks_of(batches, held, width, kind, pivots, between, radius), BLOCK), "blocks")
    mine, other = ("block", "cell", "core", "lo", "hi", "lows", "node", "w", "v"), "other_"
    left, right = blocks.select(*mine), blocks.select(*(F.col(c).alias(other + c) for c in mine))
    visited = lambda a, b: F.element_at(f"{a}lows", F.col(f"{b}cell") + 1) <= F.col(f"{b}hi") + F.lit(radius + SLACK)
    shells = (F.col("lo") <= F.col("other_hi") + F.lit(radius + SLACK)) & (F.col("other_lo") <= F.col("hi") + F.lit(radius + SLACK)) & ~(F.col("core") & F.col("other_core"))
    once = ((F.col("block") < F.col("other_block")) != ((F.col("block") + F.col("other_block")) % 2 == 1)) | (F.col("block") == F.col("other_block"))
    meet = once & F.when(F.col("cell") == F.col("other_cell"), shells).otherwise(visited("", other) | visited(other, ""))
    near = left.hint("shuffle_replicate_nl").join(right, meet)  # no shuffle: a task reads two files of blocks
    compared = [c for c in mine if c not in ("core", "lows")]
    near = near.select(*compared, *(other + c for c in compared)).mapInArrow(lambda batches: joined(batches, width, threshold, kind, pivots, between, basis), "a long, b long, n long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)  # pairs of blocks, some MB each
    found = written(near, "found")
    small_batches(spark)
    members = blocks.select("cell", "core", "node", "w", "more", "of").mapInArrow(unpacked, "vec_id long, node long, w long, cell int, core boolean")
    core = blocks.where("core").groupBy("cell").agg(F.min("least").alias("least"), F.sum("total").alias("total"))
    within = members.where("core and vec_id = node").select("node", "w", "cell").join(F.broadcast(core), "cell")  # one row for each pivot
    counts = found.where("b is null").select(F.col("a").alias("node"), "n").union(within.select("node", F.col("total") - F.col("w")))
    links = found.where("b is not null").select("a", "b").union(within.where("node <> least").select("node", "least"))
    counted = counts.groupBy("node").agg(F.sum("n").alias("n"))
    groups = components(links)
    told = members.select("vec_id", "node", "w").join(counted, "node", "left").join(groups, "node", "left")
    told = told.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    unusable = each.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return told.union(unusable).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def own_distance(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each direction from the pivot in the same row, the same for equal ones."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", u, pivots)))


BLOCK = "block long, cell int, core boolean, lo double, hi double, lows array<double>, least long, total long, node binary, w binary, v binary, more binary, of binary"


def blocks_of(batches: Iterator[pa.RecordBatch], held: int, width: int, kind: str, pivots: np.ndarray, between: np.ndarray, radius: float) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors in order of cell and distance, each of one cell, and of core members or others only.

    lo and hi: the least and greatest distance from the pivot. lows: the least distance from each pivot whose cell a member visits.
    more, of: ids that share a node's vector, and the node.
    """
    first, made = TaskContext.get().partitionId() << 32, 0

    def block(ids: np.ndarray, cell: int, core: bool, far: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        starts = np.r_[True, (x[1:] != x[:-1]).any(axis=1)]
        at = np.flatnonzero(starts)
        node = ids[at][np.cumsum(starts) - 1]  # ids of equal vectors ascend
        d = distances(directions(x[at].astype(np.float64)), pivots)
        near = visits(d, np.full(len(at), cell), between, radius)
        lows = np.where(near, d, UNVISITED).min(axis=0)
        values = [first + made, cell, core, far.min(), far.max(), lows, ids[at].min(), len(ids), ids[at].tobytes(), np.diff(np.r_[at, len(ids)]).tobytes(), x[at].tobytes(), ids[~starts].tobytes(), node[~starts].tobytes()]
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], [c.split()[0] for c in BLOCK.split(", ")])

    def cut(wait: list[tuple[np.ndarray, ...]], last: bool) -> Iterator[tuple]:
        """Rows of full blocks; what is left over stays in ``wait``."""
        ids, cell, far, x = (np.concatenate(c) for c in zip(*wait, strict=True))
        core = 2 * far <= radius - SLACK
        ends = [*(np.flatnonzero((cell[1:] != cell[:-1]) | (core[1:] != core[:-1])) + 1), len(ids)]
        s = 0
        for e in ends:
            while s < e and (last or e < len(ids) or e - s >= held):
                to = min(e, s + held)
                yield ids[s:to], int(cell[s]), bool(core[s]), far[s:to], x[s:to]
                s = to
        wait[:] = [(ids[s:], cell[s:], far[s:], x[s:])] if s < len(ids) else []

    wait: list[tuple[np.ndarray, ...]] = []
    for b in batches:
        if b.num_rows:
            x = np.frombuffer(b"".join(b.column(3).to_pylist()), kind).reshape(-1, width)
            wait.append((*(np.asarray(b.column(i)) for i in range(3)), x))
            if sum(len(c[0]) for c in wait) >= 2 * held:
                for rows in cut(wait, False):
                    yield block(*rows)
                    made += 1
    for rows in cut(wait, True) if wait else ():
        yield block(*rows)
        made += 1


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each id of blocks: its node, how many ids that has, and where it lies."""
    for b in batches:
        for cell, core, *parts in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            node, w, more, of = (np.frombuffer(c, np.int64) for c in parts)
            order = np.argsort(node)
            ids, own, n = np.r_[node, more], np.r_[node, of], np.r_[w, w[order][np.searchsorted(node[order], of)]]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(own), pa.array(n), pa.array(np.full(len(ids), cell, np.int32)), pa.array(np.full(len(ids), core))], ["vec_id", "node", "w", "cell", "core"])


class Block:
    """The nodes of a block, and what has been found between them and those of others."""

    def __init__(self, told: tuple, width: int, kind: str, pivots: np.ndarray, basis: np.ndarray | None):
        self.key, self.cell, self.lo, self.hi, node, w, v = told
        self.node, self.w, self.x = np.frombuffer(node, np.int64), np.frombuffer(w, np.int64), np.frombuffer(v, kind).reshape(-1, width)
        self.u = directions(self.x.astype(np.float64))
        self.far, self.narrow, self.wide = own_distance(self.u, pivots[[self.cell]]), narrowed(self.u, basis), None
        self.n, self.label = np.zeros(len(self.node), np.int64), np.arange(len(self.node))

    def single(self) -> np.ndarray:
        """The directions in single precision."""
        if self.wide is None:
            self.wide = self.u.astype(np.float32)
        return self.wide

    def may_meet(self, other: Block, pivots: np.ndarray, between: np.ndarray, radius: float) -> np.ndarray:
        """Places of the members that may lie within the radius of a member of another block."""
        if self.cell == other.cell:
            may, d = True, self.far
        else:
            d = distances(self.u, pivots[[other.cell]])[:, 0]
            may = d * d - self.far**2 <= 2 * (radius + SLACK) * between[self.cell, other.cell] + SLACK
        return np.flatnonzero(may & (d >= other.lo - radius - SLACK) & (d <= other.hi + radius + SLACK))

    def meet(self, other: Block, pivots: np.ndarray, between: np.ndarray, threshold: float, basis: np.ndarray | None) -> list[tuple[np.ndarray, ...]]:
        """Links and counts of another block's nodes; of its own are kept until the end."""
        radius = math.sqrt(2 - 2 * threshold)
        mine = self.may_meet(other, pivots, between, radius)
        theirs = other.may_meet(self, pivots, between, radius)
        counts, first = np.zeros(len(other.node), np.int64), np.full(len(other.node), -1)
        for row, col in near_pairs(self, mine, other, theirs, threshold, basis) if len(mine) and len(theirs) else ():
            if self.key == other.key:
                row, col = row[row != col], col[row != col]
            self.n += np.bincount(row, other.w[col], len(self.node)).astype(np.int64)
            if self.key == other.key:
                self.unite(row, col)
                continue
            counts += np.bincount(col, self.w[row], len(other.node)).astype(np.int64)
            new = first[col] < 0
            first[col[new]] = row[new]
            self.unite(row, first[col])
        some = np.flatnonzero(first >= 0)
        return [(other.node[some], self.node[first[some]], counts[some])] if len(some) else []

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        """Members that link with each other, or with the same node of another block, belong together."""
        while True:
            bad = np.flatnonzero(self.label[a] != self.label[b])
            if not len(bad):
                return
            low, high = np.minimum(self.label[a[bad]], self.label[b[bad]]), np.maximum(self.label[a[bad]], self.label[b[bad]])
            np.minimum.at(self.label, high, low)
            np.minimum.at(self.label, a[bad], low)
            np.minimum.at(self.label, b[bad], low)
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]

    def end(self) -> list[tuple[np.ndarray, ...]]:
        some, moved = np.flatnonzero(self.n), np.flatnonzero(self.label != np.arange(len(self.node)))
        return [(self.node[some], None, self.n[some]), (self.node[moved], self.node[self.label[moved]], None)]


def near_pairs(a: Block, rows: np.ndarray, b: Block, cols: np.ndarray, threshold: float, basis: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in both blocks of the pairs whose cosine is the threshold or more, of the given rows and columns; a tile at a time."""
    error = (a.x.shape[1] + 8) * 2.0**-23
    least = np.float32(threshold - error)
    chosen = lambda x, at: x if len(at) == len(x) else x[at]
    narrow, against, full = chosen(a.narrow, rows), chosen(b.narrow, cols).T, None
    for s in range(0, len(rows), TILE):
        close, sure = narrow[s : s + TILE] @ against, basis is None
        hit = found_true((close >= least).ravel())
        if basis is not None and len(hit) > close.size / 32:  # so many that all are compared in full
            full = chosen(b.single(), cols).T if full is None else full
            close, sure = a.single()[rows[s : s + TILE]] @ full, True
            hit = found_true((close >= least).ravel())
        if len(hit):
            row, col = hit // len(cols), hit % len(cols)
            doubt = np.flatnonzero(close[row, col] <= threshold + error) if sure else np.arange(len(hit))
            row, col = rows[s + row], cols[col]
            keep = np.ones(len(hit), bool)
            for i in range(0, len(doubt), 65_536):
                at = doubt[i : i + 65_536]
                keep[at] = at_least(a, row[at], b, col[at], threshold)
            yield row[keep], col[keep]


def found_true(flags: np.ndarray) -> np.ndarray:
    """Where flags are set; few are expected, so eight are looked at in one."""
    whole = len(flags) // 8 * 8
    words = np.flatnonzero(flags[:whole].view(np.uint64) != 0)
    if len(words) > whole / 64:
        return np.flatnonzero(flags)
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    return np.r_[at[flags[at]], whole + np.flatnonzero(flags[whole:])]


def at_least(a: Block, row: np.ndarray, b: Block, col: np.ndarray, threshold: float) -> np.ndarray:
    """Which cosines of pairs are the threshold or more: in doubles, and exactly where these can't tell."""
    cosine = np.einsum("ij,ij->i", a.u[row], b.u[col])
    near = cosine >= threshold
    doubt = np.flatnonzero(np.abs(cosine - threshold) <= (a.x.shape[1] + 16) * 2.0**-51)
    near[doubt] = exact_cosines(a.x[row[doubt]].astype(np.float64), b.x[col[doubt]].astype(np.float64)) >= threshold
    return near


def exact_cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines in double precision, each product sum rounded once; 1 for equal vectors."""
    out = np.empty(len(x))
    for i, (a, b) in enumerate(zip(x, y, strict=True)):
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        out[i] = 1.0 if (a == b).all() else math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b)))
    return out


def result(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (a, null, n) count links of a; rows (a, b, null) are links that connect what is connected."""
    for a, b, n in parts:
        if n is not None:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()), pa.array(n)], ["a", "b", "n"])
        if b is not None:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "n"])


def joined(batches: Iterator[pa.RecordBatch], width: int, threshold: float, kind: str, pivots: np.ndarray, between: np.ndarray, basis: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """All pairs of blocks of a partition, those of one block in a row: it is held, the others are met."""
    block: Block | None = None
    known: dict[int, Block] = {}
    for b in batches:
        for i in range(b.num_rows):
            if block is None or block.key != b.column(0)[i].as_py():
                if block is not None:
                    yield from result(block.end())
                block = Block(tuple(b.column(k)[i].as_py() for k in range(7)), width, kind, pivots, basis)
            key = b.column(7)[i].as_py()
            other = known.get(key) or Block(tuple(b.column(k)[i].as_py() for k in range(7, 14)), width, kind, pivots, basis)
            if sum(2 * x.u.nbytes for x in known.values()) < KEPT_BYTES:  # the same ones come again with the next block
                known[key] = other
            yield from result(block.meet(other, pivots, between, threshold, basis))
    if block is not None:
        yield from result(block.end())
