"""URL filter: a trie over reversed host labels and path segments, sent to every task; the longest match decides."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MAX_RULES = 1_000_000

Rule = tuple[str, str, str]  # host, path, verdict


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/ ? #`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


class Node:
    """Children by label or segment; ``ends``: rules by the last segment of their path, which may be cut short; ``path``: root of the paths."""

    __slots__ = ("children", "ends", "path")

    def __init__(self) -> None:
        self.children: dict[str, Node] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        self.path: Node | None = None


def build(rules: Iterable[Rule]) -> Node:
    """The trie. Where both verdicts are given for one host and path, block wins."""
    root = Node()
    for host, path, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r}")
        node = root
        for label in reversed(host.translate(str.maketrans(UPPER, LOWER)).split(".")):
            node = node.children.setdefault(label, Node())
        node.path = node = node.path or Node()
        *segments, last = path.split("/")
        for segment in segments:
            node = node.children.setdefault(segment, Node())
        if node.ends.get(last, ("", "allow"))[1] == "allow":
            node.ends[last] = (host + path, verdict)
    return root


def longest_path(node: Node, path: str) -> tuple[str, str] | None:
    best = None
    for segment in path.split("/"):
        if node.ends:
            for n in range(len(segment), -1, -1):
                if (hit := node.ends.get(segment[:n])) is not None:
                    best = hit
                    break
        node = node.children.get(segment)
        if node is None:
            break
    return best


def match(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """The rule with the longest host that fits, among those the one with the longest path."""
    node, best = root, None
    for label in reversed(host.split(".")):
        node = node.children.get(label)
        if node is None:
            break
        if node.path is not None:
            best = longest_path(node.path, path) or best
    return best


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", id_column: str = "page_id", url: str = "url", max_rules: int = MAX_RULES) -> DataFrame:
    """(id, host, path, rule, verdict) of every row, null and malformed urls included (host and path empty: the default).

    A rule fits its host and all subdomains of it if the path starts with the rule's path; the longest host wins, then the
    longest path. ``default`` holds where no rule fits; ``rule`` is null then. At most ``max_rules`` rules, each of them short,
    are sent to the tasks as a trie; longer lists are joined by ``judge_by_join``. Repeated rows are judged one by one, other
    columns are ignored, an empty table gives no rows.
    """
    if len(rules) > max_rules:
        frame = pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
        return judge_by_join(pages, frame, default, id_column, url)
    trie = pages.sparkSession.sparkContext.broadcast(list(rules))
    kind = pages.schema[id_column].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = build(trie.value)
        for b in batches:
            hits = [match(root, h, p) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            rule, verdict = pa.array([h and h[0] for h in hits], pa.string()), pa.array([h[1] if h else default for h in hits], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, rule, verdict], [id_column, "host", "path", "rule", "verdict"])

    parts = pages.select(F.col(id_column), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return parts.mapInArrow(look, f"`{id_column}` {kind}, host string, path string, rule string, verdict string")


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id", url: str = "url") -> DataFrame:
    """The same by a join on the host's suffixes, for rule lists too long to send: distinct (host, path) pairs are matched once."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("_suffix"), F.col("path").alias("_path"), F.concat("host", "path").alias("rule"), "verdict")
    pages = pages.select(F.col(id_column), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = pages.select("host", "path").distinct().withColumn("_suffix", F.explode(suffixes))
    fits = each.join(rules, "_suffix").where(F.startswith("path", "_path"))
    order = F.struct(F.length("_suffix"), F.length("_path"), F.col("verdict") == "block")
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), order).alias("_best"))
    return pages.join(best, ["host", "path"], "left").select(id_column, "host", "path", "_best.rule", F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
