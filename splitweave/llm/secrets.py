"""Secret scan: fixed patterns, and an assignment-aware lexer that pairs names with literals.

The lexer reads source and configuration syntax line by line: ``name = "…"``, ``name: …``, ``"name": "…"``, ``name := …``,
``name => …``, ``export NAME=…``. A name bound to a literal is a constant; a later assignment of that name to another, or of a sum of
literals and constants, passes the literal on. A literal is reported if its target's name is sensitive and it looks like a secret.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from splitweave.llm.common import small_batches

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is a whole match of [0-9a-f]+
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "literal")

# What makes a name sensitive: one word of the first kind, or one of the second beside "key".
TELLING = {"password", "passwd", "passphrase", "passcode", "pwd", "pass", "secret", "secrets", "token", "tokens", "credential", "credentials", "apikey", "privatekey", "secretkey", "accesskey", "authkey"}
PASSES = {"password", "passwd", "passphrase", "passcode", "pwd", "pass"}
BESIDE_KEY = {"api", "private", "access", "auth", "signing", "encryption", "master", "service", "account", "storage", "shared", "client", "deploy", "license", "session", "crypt", "hmac"}
STEMS = ("pass", "pwd", "secret", "token", "credential", "key")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me.*|your[_-].*|example.*|placeholder.*|todo|none|null|true|false|undefined|redacted|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|\$[a-z_]+)$")
LEAST_LITERAL = 8
LEAST_OPAQUE = 10  # characters of a quoted literal of one kind
LEAST_WORDS = 4  # of a passphrase
LEAST_SCORE = 1.0

TOKEN = re.compile(r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`)|(?P<op>:=|=>|==|!=|<=|>=|[=:+])|(?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z0-9_$]+)*)|(?P<end>\n|;|,|\#|//)|(?P<bare>[^\s"'`=:+,;\#(){}<>\[\]]+)""")
ASSIGNS = ("=", ":", ":=", "=>")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    words = [w.lower() for w in WORD.findall(name)]
    if any(w in TELLING for w in words):
        return 1.0
    return 0.9 if "key" in words and any(w in BESIDE_KEY for w in words) else 0.0


def spread_score(counts: Counter, length: int) -> float:
    """Grows with the kinds of characters and with their entropy; 0 for one kind."""
    kinds = sum((any(c.islower() for c in counts), any(c.isupper() for c in counts), any(c.isdigit() for c in counts), any(not c.isalnum() for c in counts)))
    entropy = -sum(n / length * math.log2(n / length) for n in counts.values())
    return 0.0 if kinds < 2 else min(1.5, 0.25 * kinds + entropy / 4)


def literal_score(text: str) -> float:
    """0 for placeholders, short and plain words; grows with the kinds of characters and with their entropy."""
    if len(text) < LEAST_LITERAL or PLACEHOLDER.match(text) or len(set(text)) < 4 or any(c.isspace() for c in text):
        return 0.0
    return spread_score(Counter(text), len(text))


def opaque(name: str, text: str) -> bool:
    """Whether a quoted literal of a name that tells by itself is a secret though it has one kind of character: no word of such names, many
    different characters, or, for a password, plain words in a row."""
    if PLACEHOLDER.match(text) or any(s in text.lower() for s in STEMS):
        return False
    if any(c.isspace() for c in text):
        said = {w.lower() for w in WORD.findall(name)}
        return bool(said & PASSES) and len(text.split()) >= LEAST_WORDS and all(w.isalpha() and w.islower() for w in text.split())
    return len(text) >= LEAST_OPAQUE and len(set(text)) >= 7


Literal = tuple[int, int, str]  # start and end of the text between the quotes; what it says


class Value:
    """What is assigned: literals and earlier values, in order. An earlier value is shared, not copied, so that no chain of
    assignments grows faster than the text; what its characters add up to is known at once."""

    __slots__ = ("parts", "counts", "length", "blank", "many", "told")

    def __init__(self):
        self.parts: list[Literal | Value] = []
        self.told = False

    def close(self) -> None:
        self.counts, self.length, self.blank, self.many = Counter(), 0, False, len(self.parts) > 1
        for p in self.parts:
            if isinstance(p, Value):
                self.counts.update(p.counts)
                self.length, self.blank, self.many = self.length + p.length, self.blank or p.blank, self.many or p.many
            else:
                self.counts.update(p[2])
                self.length, self.blank = self.length + len(p[2]), self.blank or any(c.isspace() for c in p[2])

    def score(self) -> float:
        if self.many:
            return 0.0 if self.blank or self.length < LEAST_LITERAL or len(self.counts) < 4 else spread_score(self.counts, self.length)
        first = self.parts[0]
        return first.score() if isinstance(first, Value) else literal_score(first[2])

    def literals(self) -> Iterator[Literal]:
        """Every literal that reaches the value and was not told before."""
        todo = [self]
        while todo:
            v = todo.pop()
            if not v.told:
                v.told = True
                for p in v.parts:
                    if isinstance(p, Value):
                        todo.append(p)
                    else:
                        yield p


def assignments(text: str) -> Iterator[tuple[str, Value]]:
    """Every assigned name with what is assigned, constants followed."""
    constants: dict[str, Value] = {}
    name: str | None = None
    target: str | None = None
    value = Value()

    def touches(start: int) -> bool:
        return bool(value.parts) and not isinstance(value.parts[-1], Value) and value.parts[-1][1] == start

    def longer(end: int, said: str) -> None:
        start, _, before = value.parts[-1]
        value.parts[-1] = (start, end, before + said)

    for m in TOKEN.finditer(text + "\n"):
        kind, said = m.lastgroup, m[0]
        if kind == "end":
            if target is not None and value.parts:
                value.close()
                constants[target] = value
                yield target, value
            name, target, value = None, None, Value()
        elif kind == "op" and target is None:
            target = name if said in ASSIGNS else None
            name = None
        elif kind == "op" and touches(m.start()):  # part of a bare value
            longer(m.end(), said)
        elif kind == "op" and said in ("=", ":="):  # what stood before it was a type or a further name
            value = Value()
        elif kind == "string" and target is not None:
            value.parts.append((m.start() + 1, m.end() - 1, said[1:-1]))
        elif kind == "string":
            name = said[1:-1]
        elif target is None:
            name = said if kind == "name" else name
        elif kind == "name" and said in constants:
            value.parts.append(constants[said])
        elif touches(m.start()):
            longer(m.end(), said)
        elif not value.parts:
            value.parts = [(m.start(), m.end(), said)]


def lexed(text: str) -> set[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name and look like secrets."""
    out = set()
    for name, value in assignments(text):
        score = name_score(name)
        if score and score * value.score() >= LEAST_SCORE:
            out |= {(a, b) for a, b, _ in value.literals()}
        elif score == 1.0 and len(value.parts) == 1 and not isinstance(value.parts[0], Value):
            a, b, t = value.parts[0]
            if text[a - 1 : a] in ("'", '"', "`") and opaque(name, t):
                out.add((a, b))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; leftmost matches of a kind that don't overlap, without the short ones."""
    low = text.lower()
    out = []
    if any(s in low for s in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def all_spans(text: str) -> list[tuple[int, int, int]]:
    """The base spans, and the lexer's that none of them holds wholly, by start and kind."""
    base = base_spans(text)
    low = text.lower()
    if not (any(s in low for s in STEMS) and ("=" in text or ":" in text)):
        return base
    if not (found := sorted(lexed(text))):
        return base
    # Of the base spans that begin at or before a literal, the one that reaches farthest holds it if any does.
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))
    held = lambda a, b: (k := bisect_right(starts, a)) > 0 and reach[k - 1] >= b
    return sorted(base + [(a, 3, b) for a, b in found if not held(a, b)])


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """The documents with one more column: array of (kind, start, end), code points, end exclusive, by start and kind.

    Null and empty texts have an empty array. Repeated rows and null ids are rows like any other; all columns are kept,
    one that has the new column's name is replaced; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(into)
    schema = StructType([*docs.schema.fields, StructField(into, SPANS)])
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(t.as_py() or "")] for t in b.column(place)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], schema.names)

    return docs.mapInArrow(work, schema)


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret in their texts replaced by the mark; all columns kept, overlapping spans replaced as one."""
    small_batches(docs.sparkSession)
    names, place = docs.columns, docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [t if t is None else cut(t, all_spans(t), mark) for t in (x.as_py() for x in b.column(place))]
            yield pa.RecordBatch.from_arrays([*b.columns[:place], pa.array(new, pa.string()), *b.columns[place + 1 :]], names)

    return docs.mapInArrow(work, docs.schema)


def cut(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]]) if spans else text
