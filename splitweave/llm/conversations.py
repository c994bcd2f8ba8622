"""Conversation structure repair by rank-convergence parallel Viterbi.

The cheapest edits that make the roles follow ``(s?(ua)+)?`` are a shortest path over four states: nothing yet, after a system
turn, after a user turn, after an assistant turn. Rows are put in order by range and cut into chunks of bounded size.
Every chunk runs backwards from a speculative cost vector, that of the end. Fix-up passes rerun the chunks whose
successor began with another vector, until all vectors differ from what was assumed by a constant only, which changes no
decision. A pass carries vectors on through spans of chunks that double each time, so passes grow with the logarithm of the
chunks even where vectors don't converge. Chunks then map each state at their start to that at their end; the maps, one
small row for each chunk, are stitched in order, and every chunk traces the edits whose letters are least among the cheapest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splitweave.llm.common import small_batches, with_small, written

ITEMS = 4096  # of a chunk
BYTES = 4 << 20  # of a chunk's texts, unless one text is longer

# Costs, white space, ends of a sentence, roles.
RETYPE, DELETE, INSERT, CUT = 1, 2, 5, 5
WHITE, STOPS = " \t\n\x0b\x0c\r", ".!?"
USER, ASSISTANT = "user", "assistant"
LEGAL = {"su", "ua", "au"}

GONE = 8  # symbol of a run of rows that must be deleted; others: role class (s, u, a, other), 4 more if truncated
KEEPS = [{0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {}]  # state after keeping a row of each class
ADDS = {0: (2, USER), 1: (2, USER), 3: (2, USER), 2: (3, ASSISTANT)}  # state and role of the turn that may come next
Vector = tuple[int, int, int, int]


def with_inserts(v: list[int]) -> list[int]:
    """Costs to go if turns may be inserted first."""
    for _ in range(3):
        for s, (t, _role) in ADDS.items():
            v[s] = min(v[s], INSERT + v[t])
    return v


END: Vector = tuple(with_inserts([0, 1 << 40, 1 << 40, 0]))  # type: ignore[assignment]


class Steps:
    """Backward steps on cost vectors relative to the first state; few vectors occur, so each step is computed once."""

    def __init__(self):
        self.known: dict[tuple[Vector, int], Vector] = {}

    def before(self, after: Vector, symbol: int) -> Vector:
        found = self.known.get((after, symbol))
        if found is None:
            extra, keeps = CUT * (symbol >> 2), KEEPS[symbol & 3]
            v = [min(DELETE + after[s], RETYPE + extra + after[ADDS[s][0]], extra + after[keeps[s]] if s in keeps else 1 << 60) for s in range(4)]
            with_inserts(v)
            found = self.known[after, symbol] = (0, v[1] - v[0], v[2] - v[0], v[3] - v[0])
        return found

    def start(self, symbols: bytes, end: Vector) -> Vector:
        for symbol in reversed(symbols):
            if symbol != GONE:
                end = self.before(end, symbol)
        return end

    def choice(self, after: Vector, symbol: int, state: int) -> tuple[str, int]:
        """The least letter of a cheapest edit before or of a row, and the state behind it."""
        extra, keeps = CUT * (symbol >> 2), KEEPS[symbol & 3]
        here = [min(DELETE + after[s], RETYPE + extra + after[ADDS[s][0]], extra + after[keeps[s]] if s in keeps else 1 << 60) for s in range(4)]
        best = with_inserts(list(here))
        added = ADDS[state][0]
        if DELETE + after[state] == best[state]:
            return "D", state
        if INSERT + best[added] == best[state]:
            return "I", added
        if state in keeps and extra + after[keeps[state]] == best[state]:
            return "K", keeps[state]
        return "R", added

    def trace(self, symbols: bytes, runs: list[int], state: int, end: Vector, last: bool) -> Iterator[tuple[str, int, int]]:
        """(letter, times, state behind it) of each edit, from a state at the start of a chunk."""
        live = bytes(s for s in symbols if s != GONE)
        behind = [end]
        for symbol in reversed(live):
            behind.append(self.before(behind[-1], symbol))
        at, run = len(live) - 1, 0
        for symbol in symbols:
            if symbol == GONE:
                yield "D", runs[run], state
                run += 1
                continue
            letter = "I"
            while letter == "I":
                letter, state = self.choice(behind[at], symbol, state)
                yield letter, 1, state
            at -= 1
        while last and state in (1, 2):
            state = ADDS[state][0]
            yield "I", 1, state


CHUNK = (
    "_c string, _k long, symbols binary, runs array<long>, roles array<string>, texts array<string>, "
    "blank long, duplicate long, truncated long, illegal long, first string, last string"
)


class Chunk:
    def __init__(self, conversation: str):
        self.conversation, self.symbols, self.runs, self.roles, self.texts = conversation, bytearray(), [], [], []
        self.counts, self.first, self.last, self.bytes = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), None, "", 0

    def full(self, more: int, items: int) -> bool:
        return len(self.symbols) >= items or bool(self.texts) and self.bytes + more > BYTES

    def seen(self, role: str, times: int) -> None:
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.counts["illegal"] += times - 1  # equal neighbours
        self.last = initial

    def row(self, number: int) -> tuple:
        return (self.conversation, number, bytes(self.symbols), self.runs, self.roles, self.texts, *self.counts.values(), self.first or "", self.last)


def chunked(rows: DataFrame, items: int) -> DataFrame:
    """Rows in order (range partitions, sorted) as chunks; _k puts them in order over all partitions."""
    schema = pa.schema(
        [("_c", pa.string()), ("_k", pa.int64()), ("symbols", pa.binary()), ("runs", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
        + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")] + [("first", pa.string()), ("last", pa.string())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        chunk, ready, size, live = None, [], 0, None
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for key in zip(*columns, strict=True):
                conversation, turn, role, digest, kind, text, symbol, times, blank = key
                place = key[:4]
                if chunk is None or chunk.conversation != conversation or kind == 0 and chunk.full(len(text), items) or kind == 1 and place != live and chunk.full(0, items):
                    if chunk is not None:
                        ready.append(chunk.row(base + number))
                        size, number = size + chunk.bytes, number + 1
                    chunk = Chunk(conversation)
                    if len(ready) >= 512 or size > 4 * BYTES:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in ready], schema)
                        ready, size = [], 0
                if kind == 0:
                    live = place
                    chunk.symbols.append(symbol)
                    chunk.roles.append(role)
                    chunk.texts.append(text)
                    chunk.bytes += len(text)
                    chunk.counts["truncated"] += symbol >> 2
                    chunk.seen(role, 1)
                    continue
                times -= place == live  # the live row itself
                if times:
                    chunk.symbols.append(GONE)
                    chunk.runs.append(times)
                    chunk.counts["blank" if blank else "duplicate"] += times
                    chunk.seen(role, times)
        if chunk is not None:
            ready.append(chunk.row(base + number))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in ready], schema)

    return rows.mapInArrow(work, CHUNK)


def settled(chunks: DataFrame) -> DataFrame:
    """(_c, _k, start, end, last) of the chunks of conversations that have several: start state, and costs to go behind the chunk."""
    order = Window.partitionBy("_c").orderBy("_k")
    lean = written(chunks.select("_c", "_k", "symbols", (F.row_number().over(order) - 1).alias("i"), F.lead("_k").over(order).isNull().alias("last")), "lean")
    schema = "_c string, _k long, symbols binary, i int, last boolean, end array<long>, begin array<long>"

    def speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, end = Steps(), pa.list_(pa.int64())
        for b in batches:
            begin = [steps.start(s, END) for s in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([END] * len(begin), end), pa.array(begin, end)], [*b.schema.names, "end", "begin"])

    state, passes = written(lean.mapInArrow(speculate, schema), "vectors"), 0
    while True:
        told = state.withColumn("next", F.lead("begin").over(Window.partitionBy("_c").orderBy("i")))
        if not told.where("next is not null and next <> end").take(1):
            break

        def fix_up(batches: Iterator[pa.RecordBatch], span: int = passes) -> Iterator[pa.RecordBatch]:
            steps, behind, vectors = Steps(), None, pa.list_(pa.int64())
            for b in batches:
                out: list[tuple] = []
                for c, i, symbols, end, begin, after in zip(*(b.column(k).to_pylist() for k in ("_c", "i", "symbols", "end", "begin", "next")), strict=True):
                    new = behind[2] if behind is not None and behind[:2] == (c, i + 1) and (i + 1) >> span == i >> span else after
                    if new is not None and new != end:
                        end, begin = new, list(steps.start(symbols, tuple(new)))
                    behind = (c, i, begin)
                    out.append((end, begin))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k) for k in ("_c", "_k", "symbols", "i", "last")), pa.array([o[0] for o in out], vectors), pa.array([o[1] for o in out], vectors)],
                    ["_c", "_k", "symbols", "i", "last", "end", "begin"],
                )

        spans = told.withColumn("_s", F.shiftright("i", passes)).repartition("_c", "_s").sortWithinPartitions("_c", F.desc("i")).drop("_s")
        state, passes = written(spans.mapInArrow(fix_up, schema), "vectors"), passes + 1

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for b in batches:
            out = []
            for symbols, end in zip(b.column("symbols").to_pylist(), b.column("end").to_pylist(), strict=True):
                runs = [1] * symbols.count(GONE)
                out.append([([s, *(t for _, _, t in steps.trace(symbols, runs, s, tuple(end), False))])[-1] for s in range(4)])
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("_c", "_k", "i", "last", "end")), pa.array(out, pa.list_(pa.int32()))], ["_c", "_k", "i", "last", "end", "to"])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, at = None, 0
        for b in batches:
            starts = []
            for c, to in zip(b.column("_c").to_pylist(), b.column("to").to_pylist(), strict=True):
                at = at if c == conversation else 0
                starts.append(at)
                conversation, at = c, to[at]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("_c", "_k", "end", "last")), pa.array(starts, pa.int32())], ["_c", "_k", "end", "last", "start"])

    maps = state.mapInArrow(ends, "_c string, _k long, i int, last boolean, end array<long>, to array<int>")
    return maps.repartition("_c").sortWithinPartitions("_c", "i").mapInArrow(stitch, "_c string, _k long, end array<long>, last boolean, start int")


PIECE = "_c string, _k long, alone boolean, audit string, cost long, turns array<struct<role:string,text:string>>, " + CHUNK[CHUNK.index("blank") :]


def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = Steps()
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for b in batches:
        audits, costs, turns, alone = [], [], [], []
        for symbols, runs, roles, texts, start, end, last in zip(*(b.column(k).to_pylist() for k in ("symbols", "runs", "roles", "texts", "start", "end", "last")), strict=True):
            live = iter(zip(bytes(s for s in symbols if s != GONE), roles, texts, strict=True))
            audit, cost, out, removed = [], 0, [], iter(symbols)
            for letter, times, state in steps.trace(symbols, runs, start or 0, tuple(end) if end else END, last is not False):
                audit.append(letter * times)
                if letter == "I":
                    out.append({"role": USER if state == 2 else ASSISTANT, "text": ""})
                    cost += INSERT
                    continue
                if next(removed) == GONE:
                    cost += DELETE * times
                    continue
                symbol, role, text = next(live)
                if letter == "D":
                    cost += DELETE
                else:
                    out.append({"role": role if letter == "K" else USER if state == 2 else ASSISTANT, "text": text})
                    cost += CUT * (symbol >> 2) + RETYPE * (letter == "R")
            audits.append("".join(audit))
            costs.append(cost)
            turns.append(out)
            alone.append(start is None)
        rest = ["blank", "duplicate", "truncated", "illegal", "first", "last_role"]
        yield pa.RecordBatch.from_arrays(
            [b.column("_c"), b.column("_k"), pa.array(alone), pa.array(audits, pa.string()), pa.array(costs, pa.int64()), pa.array(turns, turn), *(b.column(k) for k in rest)],
            ["_c", "_k", "alone", "audit", "cost", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last"],
        )


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", items: int = ITEMS) -> DataFrame:
    """Pieces of repaired conversations: their repaired turns, the audit of edits, its cost and the faults that were found.

    Rows are taken by turn (nulls first); rows of one turn by role and then the SHA-256 of the text. Null roles and texts count as one
    space, a null conversation is one of its own. A row's first fault counts: blank (nothing but white space), duplicate (role and
    text occur earlier), truncated (the last character that isn't white space is none of ``.!?``). Edits, one letter a row or inserted turn:
    K keeps (0), R makes the role user or assistant (1), D deletes (2; the only one for blanks and duplicates), I inserts an empty
    turn (5); a truncated row that stays costs 5 more. Roles other than s…, u…, a… can't be kept. Of the cheapest edits that give
    role initials ``(s?(ua)+)?`` those with the least letters are taken. illegal counts neighbours (before the edits) that are not su, ua, au
    within the piece. Pieces of a conversation come in order of ``_k``; alone: there is no other. Repeated rows are duplicates;
    other columns are ignored; an empty table gives no pieces.
    ``items``: rows of a piece at most; the result is the same for any.
    """
    small_batches(rows.sparkSession)
    c = F.coalesce(F.concat(F.lit("="), F.col(conversation).cast("string")), F.lit(""))
    own = rows.select(
        c.alias("_c"), F.col(turn).cast("long").alias("_t"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("_r"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("_x")
    ).withColumn("_d", F.sha2("_x", 256))
    ends = F.right(F.rtrim("_x", F.lit(WHITE)), F.lit(1))
    own = own.withColumn("_e", ends)
    kind = F.substring("_r", 1, 1)
    role_class = F.when(kind == "s", 0).when(kind == "u", 1).when(kind == "a", 2).otherwise(3)
    symbol = (role_class + F.when(F.col("_e").isin(*STOPS), 0).otherwise(4)).cast("int")
    # Of rows equal in role and text only the first is a turn; its text is all that is shuffled.
    first = own.where("_e <> ''").groupBy("_c", "_r", "_d").agg(F.min(F.struct(F.col("_t").isNotNull().alias("known"), F.col("_t").alias("t"))).alias("at"), F.first("_x").alias("_x"), F.first("_e").alias("_e"))
    none = F.lit(None).cast("string")
    live = first.select("_c", F.col("at.t").alias("_t"), "_r", "_d", F.lit(0).alias("kind"), "_x", symbol.alias("symbol"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("blank"))
    places = own.groupBy("_c", "_t", "_r", "_d").agg(F.count("*").alias("n"), F.max(F.col("_e") == "").alias("blank"))
    places = places.select("_c", "_t", "_r", "_d", F.lit(1).alias("kind"), none.alias("_x"), F.lit(GONE).alias("symbol"), "n", "blank")
    order = ["_c", "_t", "_r", "_d"]
    ordered = live.union(places).repartitionByRange(*order).sortWithinPartitions(*order, "kind")
    chunks = written(chunked(ordered, items), "chunks")
    several = written(chunks.groupBy("_c").agg(F.count("*").alias("n")).where("n > 1").select("_c"), "several")
    known = written(settled(with_small(chunks.select("_c", "_k", "symbols"), several, "_c", "left_semi")), "settled")
    ready = with_small(chunks.withColumnRenamed("last", "last_role"), known, ["_c", "_k"], "left")
    pieces = ready.mapInArrow(traced, PIECE)
    id_type = rows.schema[conversation].dataType
    return pieces.select(F.when(F.col("_c") != "", F.expr("substring(_c, 2)").cast(id_type)).alias("conv_id"), *pieces.columns[1:])


def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, streamed into one row for each conversation."""
    names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    now: dict | None = None

    def finished(x: dict) -> pa.RecordBatch:
        rows = [x["conv_id"], *(x[k] for k in names[1:6]), "".join(x["audit"]), x["hash"].hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(rows, [x["type"], *[pa.int64()] * 5, pa.string(), pa.string()], strict=True)], names)

    for b in batches:
        out = []
        for row in b.to_pylist():
            if now is None or now["conv_id"] != row["conv_id"]:
                if now is not None:
                    out.append(finished(now))
                now = {"conv_id": row["conv_id"], "type": b.schema.field("conv_id").type, "audit": [], "hash": hashlib.sha256(), "none": True, "last": None} | dict.fromkeys(names[1:6], 0)
            for k in names[1:6]:
                now[k] += row[k]
            if now["last"] is not None and now["last"] + row["first"] not in LEGAL:
                now["illegal"] += 1
            now["last"] = row["last"]
            now["audit"].append(row["audit"])
            for turn in row["turns"]:
                now["hash"].update((("" if now["none"] else "\n") + turn["role"] + ":" + turn["text"]).encode())
                now["none"] = False
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if now is not None:
        yield finished(now)


def summaries(pieces: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row for each conversation.

    The digest is of ``role:text`` of the repaired turns, joined by new lines. A digest has to read its conversation in order, so the pieces
    of a long one stream through one task, a piece at a time; conversations of one piece are not shuffled.
    """
    schema = f"conv_id {pieces.schema['conv_id'].dataType.simpleString()}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    whole = pieces.where("alone").mapInArrow(told, schema)
    cut = pieces.where("not alone").repartition("conv_id").sortWithinPartitions("conv_id", "_k").mapInArrow(told, schema)
    return whole.union(cut)


def gaps(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, gaps): turn numbers missing between the least and the greatest of a conversation; nulls don't count."""
    t = F.col(turn).cast("long")
    return rows.groupBy(F.col(conversation).alias("conv_id")).agg(F.coalesce(F.max(t) - F.min(t) + 1 - F.count_distinct(t), F.lit(0)).cast("long").alias("gaps"))
