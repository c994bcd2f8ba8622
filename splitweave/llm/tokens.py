"""Token ids by the tokenizers library, with a cache of word pieces.

Splitting a long text into pieces where the tokenizer splits anyway gives the same ids as encoding it whole, and each distinct
piece is encoded once. Latin words and the marks behind them go to the model of a tokenizer known to split and normalise them so;
other pieces, and those of other tokenizers, go through all its steps. Two layouts of pieces are known:

* ``spaced``: byte-level BPE whose words carry the space before them. Such a tokenizer never joins a character that isn't white
  space with white space after it, so a text may be cut before any space or line end that follows such a character.
* ``dropped``: BPE whose normaliser makes white space one space and whose words leave it out; cut at spaces and line ends.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

CACHED = 800_000
LONGEST_CACHED = 48
AT_ONCE = 2048
JOINED = 256
DROPPED_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
DOUBLE_SPACE = re.compile(r"\s[ \n]")
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n\t\r])")
# A word of Latin letters (of which each is lower-cased to one) and the marks behind it; an apostrophe may belong to what follows.
LETTERS, MARKS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]", r"[!-&(-/:-@\[-`{-~]"
LATIN = re.compile(f"({LETTERS}+)({MARKS}*)")
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}  # the public alphabet of byte-level BPE
_loaded: dict[tuple[str, str], Encoder] = {}


class Encoder:
    def __init__(self, vocabulary: str, layout: str) -> None:
        from tokenizers import Tokenizer

        if layout not in ("spaced", "dropped"):
            raise ValueError(layout)
        self.tokenizer, self.layout = Tokenizer.from_file(vocabulary), layout
        self.after_space: dict[str, bytes] = {}  # of pieces with the space before them left out
        self.literal: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}  # of runs of marks behind words
        self.lowers = _cuts_words(json.loads(self.tokenizer.to_str()), layout)
        if self.lowers is not None:
            self.model, self.id_bytes = self.tokenizer.model, [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]

    def _encode_latin(self, pieces: list[str], into: dict[str, bytes]) -> list[str]:
        """Latin words, with marks behind them or not, by the tokenizer's model, without the steps before it; returns the other pieces."""
        tokenize, id_bytes, match, others = self.model.tokenize, self.id_bytes, LATIN.fullmatch, []
        before = "\u0120" if self.layout == "spaced" else ""
        for p in pieces:
            if p.isascii() and p.isalpha():
                word, marks = p, ""
            elif m := match(p):
                word, marks = m.groups()
            else:
                others.append(p)
                continue
            if (ids := into.get(word)) is None:
                low = word.lower() if self.lowers else word
                letters = low if low.isascii() else low.encode().decode("latin-1").translate(BYTE_LETTERS)
                ids = b"".join([id_bytes[t.id] for t in tokenize(before + letters)])
                if not marks or len(word) <= LONGEST_CACHED:
                    into[word] = ids
            if marks:
                if (more := self.marks.get(marks)) is None:
                    more = b"".join([id_bytes[t.id] for t in tokenize(marks)])
                    if len(marks) <= LONGEST_CACHED and len(self.marks) < CACHED:
                        self.marks[marks] = more
                into[p] = ids + more
        return others

    def _encode(self, pieces: list[str], prefix: str, into: dict[str, bytes]) -> None:
        """Encode pieces one by one, or, those after a space, many in one text whose tokens are dealt out by their places."""
        if prefix or self.layout == "dropped":
            if self.lowers is not None:
                pieces = self._encode_latin(pieces, into)
            words = [p for p in pieces if p.isalpha()]
            for at in range(0, len(words), JOINED):
                self._encode_words(words[at : at + JOINED], into)
            plain = [p for p in pieces if p and not p[-1].isspace() and p not in into]
            for at in range(0, len(plain), JOINED):
                self._encode_joined(plain[at : at + JOINED], into)
            pieces = [p for p in pieces if p not in into]
        for at in range(0, len(pieces), AT_ONCE):
            part = pieces[at : at + AT_ONCE]
            for piece, e in zip(part, self.tokenizer.encode_batch([p if p[:1] == "\n" else prefix + p for p in part], add_special_tokens=False), strict=True):
                into[piece] = np.array(e.ids, "<u4").tobytes()

    def _encode_words(self, pieces: list[str], into: dict[str, bytes]) -> None:
        """Pieces of letters alone: the tokenizer makes each a word, and tells which word a token is of without its places in the text."""
        before = " " if self.layout == "spaced" else ""
        e = self.tokenizer.encode(before + " ".join(pieces), add_special_tokens=False)
        owner, ids = np.array(e.word_ids, np.float64), np.array(e.ids, "<u4")
        edges = np.r_[0, np.flatnonzero(np.diff(owner)) + 1, len(owner)].tolist()
        if len(edges) != len(pieces) + 1 or not (np.diff(owner) >= 0).all():
            return  # a word was cut, or a token is of no word: the caller encodes these by places
        for k, p in enumerate(pieces):
            into[p] = ids[edges[k] : edges[k + 1]].tobytes()

    def _encode_joined(self, pieces: list[str], into: dict[str, bytes]) -> None:
        whole = [p if p[0] == "\n" else " " + p for p in pieces]
        starts = np.cumsum([0, *map(len, whole[:-1])])
        e = self.tokenizer.encode("".join(whole), add_special_tokens=False)
        ids = np.array(e.ids, "<u4")
        owner = np.searchsorted(starts, np.array([o[0] for o in e.offsets], np.int64), "right") - 1
        if len(ids) and (owner[1:] < owner[:-1]).any():
            return  # places out of order: the caller encodes these one by one
        edges = np.searchsorted(owner, np.arange(len(pieces) + 1)).tolist()
        for k, p in enumerate(pieces):
            into[p] = ids[edges[k] : edges[k + 1]].tobytes()

    def _split(self, text: str) -> tuple[list[str], list[str]]:
        """Pieces to encode as they are, then pieces to encode after a space."""
        if self.layout == "dropped":
            return [], text.replace("\n", " ").split(" ")
        if DOUBLE_SPACE.search(text):
            return SAFE_CUT.split(text), []
        head, *rest = text.replace("\n", " \n").split(" ")
        return [head], rest

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split, long = [self._split(t) for t in texts], []
        for pieces, prefix, known in ((0, "", self.literal), (1, " " if self.layout == "spaced" else "", self.after_space)):
            if len(known) > CACHED:
                known.clear()
            missing = list(set().union(*(s[pieces] for s in split)).difference(known))
            if prefix == "":
                missing = [m for m in missing if m]
                known[""] = b""
            self._encode(missing, prefix, known)
            long += [(known, p) for p in missing if len(p) > LONGEST_CACHED]
        out = [b"".join([*map(self.literal.__getitem__, a), *map(self.after_space.__getitem__, b)]) for a, b in split]
        for known, p in long:
            known.pop(p, None)
        return out


def _cuts_words(parts: dict, layout: str) -> bool | None:
    """Whether the tokenizer lower-cases, if it is known to give its BPE model Latin words and runs of marks as they are; else None."""
    added = any(re.fullmatch(f"{LETTERS}*{MARKS}*", t["content"].strip()) for t in parts["added_tokens"])  # may lie in such a piece
    bpe = parts["model"]["type"] == "BPE" and not parts["model"].get("dropout") and not added
    cut = parts["pre_tokenizer"] or {}
    if bpe and layout == "spaced" and parts["normalizer"] is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
        return False
    steps, normal = cut.get("pretokenizers", []), [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
    if bpe and layout == "dropped" and normal == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in steps] == ["Split", "ByteLevel"]:
        space, (split, level) = parts["normalizer"]["normalizers"][1], steps
        known = split["pattern"] == {"Regex": DROPPED_WORDS} and split["behavior"] == "Removed" and split["invert"]
        if known and space["pattern"] == {"Regex": r"\s+"} and space["content"] == " " and not level["use_regex"] and not level["add_prefix_space"]:
            return True
    return None


def encoder(vocabulary: str, layout: str) -> Encoder:
    """One for each Python worker."""
    if (vocabulary, layout) not in _loaded:
        _loaded[vocabulary, layout] = Encoder(vocabulary, layout)
    return _loaded[vocabulary, layout]
