"""BPE encoding and decoding with forced boundaries.

A pair of bytes that never stands inside a token of the vocabulary can never be
merged across, so the text is certainly cut there. Fragments between such cuts
(and between the words of the tokenizer's pattern) are encoded on their own
and their ids concatenated. Fragments repeat, so a task keeps those it has seen
in a bounded table (a full one becomes the old one, from which what still occurs is taken over).

Results: a NULL or empty text has no ids and decodes to the empty text. Texts
are encoded whole. A NULL doc_id and repeated rows pass through. An empty
table gives no rows.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfcast.llm.common import keyed, prepare_python
from shelfcast.llm.tokencount import KEPT_BYTES, KEPT_LETTERS, SPACE, byte_letters, entry_bytes, merges_needed

WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
# White space next to a blank: there a cut before the blank is not certain.
TOUCHING = re.compile(f"[{SPACE}] | [{SPACE}]")
MARKS = frozenset(".,;:!?")
NO_RANK = 1 << 62


class Codec(dict):
    """Ids (little-endian, four bytes each) of a piece of text, by piece; the first piece of a text has no blank before it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        byte = {c: b for b, c in byte_letters().items()}
        raw = self.ids = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
        merges = [tuple(bytes(byte[c] for c in part) for part in pair) for pair in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        # rank and id of what a pair of ids becomes, as one number
        self.pairs = {raw[a] << 32 | raw[b]: i << 32 | raw[a + b] for i, (a, b) in enumerate(merges)}
        self.byte_ids = [raw.get(bytes([b]), -1) for b in range(256)]
        self.joined = {t[i:i + 2] for t in raw for i in range(len(t) - 1)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {k: i.to_bytes(4, "little") for k, i in special.items()}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.words = regex.compile(WORDS)
        self.fragments: dict[bytes, bytes] = {}
        self.old, self.old_fragments = {}, {}
        self.room = self.fragment_room = KEPT_BYTES
        self.texts = {i: t for t, i in raw.items()} | {i: k.encode() for k, i in special.items()}

    def cuts(self, word: bytes) -> list[bytes]:
        """``word`` split at the pairs that no token holds."""
        at = [0, *(i + 1 for i in range(len(word) - 1) if word[i:i + 2] not in self.joined), len(word)]
        return [word[a:b] for a, b in zip(at, at[1:])]

    def fragment(self, piece: bytes) -> bytes:
        found = self.fragments.get(piece)
        if found is None:
            found = self.old_fragments.get(piece)
            if found is None:
                found = array("I", self.merge([self.byte_ids[b] for b in piece])).tobytes()
            if len(piece) <= KEPT_LETTERS:
                if self.fragment_room <= 0:
                    self.fragments, self.old_fragments, self.fragment_room = {}, self.fragments, KEPT_BYTES
                self.fragments[piece] = found
                self.fragment_room -= entry_bytes(piece, found)
        return found

    def merge(self, ids: list[int]) -> list[int]:
        """Byte-pair merging of a fragment, given one id a byte: the leftmost pair of lowest rank, until no pair has a rank."""
        if len(ids) > 256:
            parts = [self.texts[i] for i in ids]
            merges_needed(parts, self.ranks, b"")  # the shared heap
            return [self.ids[p] for p in parts if p]
        pair = self.pairs.get
        ranks = [pair(a << 32 | b, NO_RANK) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NO_RANK:
            i = ranks.index(least)
            ids[i] = one = least & 0xFFFFFFFF
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = pair(ids[i - 1] << 32 | one, NO_RANK)
            if i < len(ranks):
                ranks[i] = pair(one << 32 | ids[i + 1], NO_RANK)
        return ids

    def run(self, text: str) -> bytes:
        """Ids of a text without special strings, word by word."""
        return b"".join(self.fragment(f) for w in self.words.findall(text) for f in self.cuts(w.encode()))

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            if piece.isalpha():  # letters need no search, nor does one mark behind them
                found = b"".join(map(self.fragment, self.cuts(b" " + piece.encode())))
            elif piece[-1:] in MARKS and piece[:-1].isalpha():
                found = self[piece[:-1]] + self.fragment(piece[-1].encode())
            else:
                found = self.run(" " + piece)
        if len(piece) <= KEPT_LETTERS:
            if self.room <= 0:
                self.old, self.room = dict(self), KEPT_BYTES
                self.clear()
            self[piece] = found
            self.room -= entry_bytes(piece, found)
        return found

    def plain(self, text: str) -> bytes:
        if TOUCHING.search(text) or text[:1] == " " or text[-1:] == " ":
            return self.run(text)
        first, *rest = text.split(" ")
        return self.run(first) + b"".join(map(self.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return self.plain(text)
        return b"".join(self.special.get(t) or self.plain(t) for t in self.specials.split(text) if t)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.texts.__getitem__, array("I", ids))).decode("utf-8", "replace")


@lru_cache(1)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids): the ids of every document, four little-endian bytes each."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for b in batches:
            ids = pa.array([c.encode(t) for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])

    return keyed(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text): the text of each sequence of ids; bytes that are no UTF-8 become the replacement character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for b in batches:
            texts = pa.array([c.decode(i) for i in b.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), texts], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
