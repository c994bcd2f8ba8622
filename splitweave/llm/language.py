"""Language of texts: script ranges narrow a word's candidates, letter trigrams score it, and a Viterbi path with a switching
penalty labels the spans of mixed texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from splitweave.llm.common import slabs, small_batches, utf8, written

# Scripts by ranges of code points. Letters outside them share one more script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "burmese": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "mongolian": [(0x1800, 0x18AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
NAMES = ["none", *SCRIPTS, "other"]
BUCKET_BITS = 17
PENALTY = 6.0
SMOOTHING = 0.1
SCRIPT_SHARE = 0.01
SLAB = 2 << 20
UNKNOWN = "und"
_tables: list[np.ndarray] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the script's number, 0 for what is no letter, and the lower-case letter."""
    if not _tables:
        script = np.zeros(0x110000, np.uint8)
        script[[c for c in range(0x110000) if chr(c).isalpha()]] = len(NAMES) - 1
        for k, name in enumerate(SCRIPTS, 1):
            for a, b in SCRIPTS[name]:
                part = script[a : b + 1]
                part[part > 0] = k
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in np.flatnonzero(script).tolist():
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
        _tables.extend([script, lower])
    return _tables[0], _tables[1]


class Words:
    """The words of some texts: runs of letters of one script. Places count code points from the first text's start."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        script, lower = tables()
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        lead = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        self.texts = lead[at]  # where each text begins, and the end
        kind = script[points]
        fresh = np.ones(len(points), bool)
        fresh[1:] = kind[1:] != kind[:-1]
        fresh[self.texts[:-1][self.texts[:-1] < len(points)]] = True
        low = np.where(kind > 0, lower[points], 0).astype(np.uint64)
        before, after = np.zeros_like(low), np.zeros_like(low)
        before[1:], after[:-1] = np.where(fresh[1:], 0, low[:-1]), np.where(fresh[1:], 0, low[1:])
        mixed = before * np.uint64(0x9E3779B97F4A7C15) + low * np.uint64(0xC2B2AE3D27D4EB4F) + after * np.uint64(0x165667B19E3779F9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        letters = np.flatnonzero(kind)
        self.buckets = (mixed[letters] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)  # of the trigram around each letter
        self.first = np.flatnonzero(fresh[letters])  # each word's first letter
        self.sizes = np.diff(np.r_[self.first, len(letters)])
        self.starts = letters[self.first]
        self.scripts = kind[self.starts]
        self.of_text = np.searchsorted(self.starts, self.texts)  # each text's first word


def learn(docs: DataFrame, label: str = "lang", text: str = "text") -> DataFrame:
    """(lang, bucket, n): letter trigrams of all texts with a label, by hashed bucket; letters of a script at −1 − its number."""
    small_batches(docs.sparkSession)
    width = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            (data, at), labels = utf8(b.column(1)), b.column(0).to_pylist()
            for i, j in slabs(at, SLAB):
                w = Words(data[at[i] : at[j]], at[i : j + 1] - at[i])
                letter = np.r_[w.first, len(w.buckets)][w.of_text]
                for k in range(j - i):
                    total = seen.setdefault(labels[i + k], np.zeros(width + len(NAMES), np.int64))
                    own = slice(letter[k], letter[k + 1])
                    np.add.at(total, w.buckets[own], 1)
                    words = slice(w.of_text[k], w.of_text[k + 1])
                    np.add.at(total, width + w.scripts[words].astype(np.int64), w.sizes[words])
        for lang, total in seen.items():
            at = np.flatnonzero(total)
            bucket = np.where(at < width, at, width - 1 - at)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(bucket), pa.array(total[at])], ["lang", "bucket", "n"])

    rows = docs.select(F.col(label).cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("lang is not null")
    return rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities of trigram buckets by language, and which languages are written in which script."""

    def __init__(self, counts: pa.Table) -> None:
        langs, bucket, n = counts.column("lang").to_pylist(), counts.column("bucket").to_numpy(), counts.column("n").to_numpy()
        self.langs = sorted(set(langs))
        which = np.searchsorted(self.langs, langs) if langs else np.empty(0, np.int64)
        grams = np.zeros((len(self.langs), 1 << BUCKET_BITS))
        letters = np.zeros((len(NAMES), len(self.langs)))
        is_gram = bucket >= 0
        grams[which[is_gram], bucket[is_gram]] = n[is_gram]
        letters[-1 - bucket[~is_gram], which[~is_gram]] = n[~is_gram]
        smooth = grams + SMOOTHING
        self.scores = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
        written_in = letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0))
        self.excluded = ~(written_in | ~written_in.any(axis=1, keepdims=True))  # a script of no language excludes none


def word_scores(model: Model, w: Words) -> np.ndarray:
    """(word, language): the sum of the trigrams' log-probabilities; languages not written in the word's script are out."""
    if not len(w.first):
        return np.empty((0, len(model.langs)), np.float32)
    out = np.stack([np.add.reduceat(row[w.buckets], w.first) for row in model.scores], axis=1)
    out[model.excluded[w.scripts]] = -1e6
    return out


def best_paths(scores: np.ndarray, of_text: np.ndarray, penalty: float) -> np.ndarray:
    """The label of every word on its text's best path, where each change of label costs the penalty. All texts advance together."""
    counts = np.diff(of_text)
    order = np.argsort(-counts, kind="stable")
    begin, active = of_text[:-1][order], np.searchsorted(-counts[order], -np.arange(counts.max(initial=0)), "left")
    stay, top = np.ones(scores.shape, bool), np.zeros(len(scores), np.int64)
    total = np.zeros((len(counts), scores.shape[1]))
    for t, n in enumerate(active.tolist()):
        at, own = begin[:n] + t, total[:n]
        if t:
            lead = own.argmax(axis=1)
            change = own[np.arange(n), lead] - penalty
            stay[at] = own >= change[:, None]
            top[at] = lead
            np.maximum(own, change[:, None], out=own)
        own += scores[at]
    labels = np.zeros(len(scores), np.int64)
    now = total.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        labels[at] = now[:n]
        now[:n] = np.where(stay[at, now[:n]], now[:n], top[at])
    return labels


def label_slab(model: Model, w: Words, penalty: float) -> tuple[list[str], np.ndarray, pa.Array]:
    """For each text its language, the share of letters that have it, and its spans."""
    texts = len(w.texts) - 1
    if not model.langs:
        labels = np.zeros(0, np.int64)
        w.of_text, w.sizes, w.starts = np.zeros(texts + 1, np.int64), w.sizes[:0], w.starts[:0]
    else:
        labels = best_paths(word_scores(model, w), w.of_text, penalty)
    owner = np.repeat(np.arange(texts), np.diff(w.of_text))
    share = np.zeros((texts, max(1, len(model.langs))))
    np.add.at(share, (owner, labels), w.sizes)
    sums, best = share.sum(axis=1), share.argmax(axis=1)
    langs = [model.langs[k] if s else UNKNOWN for k, s in zip(best.tolist(), sums.tolist(), strict=True)]
    score = share.max(axis=1) / np.maximum(1, sums)
    heads = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])][: len(labels)])
    tails = np.r_[heads[1:], len(labels)] - 1 if len(heads) else heads
    base = w.texts[:-1][owner[heads]]
    start, end = w.starts[heads] - base, w.starts[tails] + w.sizes[tails] - base
    names = pa.array([model.langs[k] for k in labels[heads].tolist()], pa.string())
    spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64)), names], ["start", "end", "lang"])
    offsets = pa.array(np.searchsorted(owner[heads], np.arange(texts + 1)).astype(np.int32))
    return langs, score, pa.ListArray.from_arrays(offsets, spans)


SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("lang", StringType())]))


def identify(docs: DataFrame, training: Column, label: str = "lang", text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """The documents with lang_pred, score and spans (start, end, lang; code points).

    Learns from all rows that fulfil ``training`` and have a label; each row's prediction uses its text alone. lang_pred has most of the
    text's letters on the best path, score is its share of them (0 to 1). Texts that are null or have no letter are ``und``
    with score 0 and no span, as all texts are when there is nothing to learn from. Ties go to the language first in order.
    Repeated rows and null ids are rows like any other; an empty table gives no rows; all columns are kept, but those
    named lang_pred, score and spans are replaced.

    The model has 2^17 buckets for each language, whatever the number of documents.
    """
    spark = docs.sparkSession
    counts = learn(docs.where(F.coalesce(training, F.lit(False))), label, text)
    sent = spark.sparkContext.broadcast(written(counts, "trigrams").toArrow())
    docs = docs.drop("lang_pred", "score", "spans")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("spans", SPANS)])
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(sent.value)
        for b in batches:
            data, at = utf8(b.column(place).fill_null(""))
            langs, scores, spans = [], [], []
            for i, j in slabs(at, SLAB):
                got = label_slab(model, Words(data[at[i] : at[j]], at[i : j + 1] - at[i]), penalty)
                langs += got[0]
                scores.append(got[1])
                spans.append(got[2])
            if langs:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs), pa.array(np.concatenate(scores)), pa.concat_arrays(spans)], schema.names)

    return docs.mapInArrow(work, schema)
