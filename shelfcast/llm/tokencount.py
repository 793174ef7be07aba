"""Token counts by heap-and-linked-list byte-pair merging, without identifiers.

A word starts as one symbol per byte. A heap holds the adjacent pairs by rank
and place; the lowest is popped, its symbols are joined in a linked list and
the new neighbour pairs are pushed, until no pair has a rank. The count is the
number of initial symbols minus the merges. Words repeat, so each task keeps
the counts of words it has seen in tables bounded in bytes.

Results: a NULL or empty text has 0 bytes and 0 tokens. Texts are counted
whole. A NULL doc_id and repeated rows pass through. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import keyed, prepare_python

# White space of the tokenizers' expressions; Python's own also takes 1C to 1F.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
EXTRA = re.compile("[\x1c-\x1f]")
SPLIT = re.compile(f"[{SPACE}]+")
# Tables of what has been seen: pieces of more letters are not kept (a text without blanks is one piece),
# and a table is full at so many bytes, by an estimate of what an entry takes.
KEPT_LETTERS, KEPT_BYTES = 64, 64 << 20


def entry_bytes(key, value) -> int:
    return 180 + 2 * len(key) + (len(value) if isinstance(value, bytes) else 0)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def merges_needed(symbols: list, ranks: dict, gone: str | bytes = "") -> int:
    """Number of merges that byte-pair encoding makes in ``symbols``; merged-away places hold ``gone`` afterwards."""
    n = len(symbols)
    if n < 2:
        return 0
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merged = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if j < 0 or symbols[i] != a or symbols[j] != b:
            continue  # one of the two has been merged since
        merged += 1
        symbols[i], symbols[j] = a + b, gone
        k = right[i] = right[j]
        right[j] = -1
        if k >= 0:
            left[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
        if (h := left[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
    return merged


class Pieces(dict):
    """What a tokenizer that drops white space makes of the pieces of a text between it, by piece.

    Pieces and words repeat, so both are kept, in bounded tables: a full one
    becomes the old one, from which what still occurs is taken over. A subclass
    says what a word and a special string give, and how the words of a piece add up.
    """

    def __init__(self, path: str, kept: int | None = None) -> None:
        self.kept = KEPT_BYTES if kept is None else kept
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        pattern = self.spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}"))
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.by_word: dict = {}
        self.old, self.old_words = {}, {}
        self.room = self.word_room = self.kept

    def make(self, word: str):
        raise NotImplementedError

    def make_special(self, text: str):
        raise NotImplementedError

    def total(self, parts):
        raise NotImplementedError

    def word(self, word: str):
        found = self.by_word.get(word)
        if found is None:
            found = self.old_words.get(word)
            found = self.make(word) if found is None else found
            if len(word) <= KEPT_LETTERS:
                if self.word_room <= 0:
                    self.by_word, self.old_words, self.word_room = {}, self.by_word, self.kept
                self.by_word[word] = found
                self.word_room -= entry_bytes(word, found)
        return found

    def plain(self, piece: str):
        if piece.isascii():  # letters, perhaps with one mark behind them, need no search
            if piece.isalpha():
                return self.word(piece.lower())
            if piece[:-1].isalpha() and not piece[-1].isdigit():
                return self.total((self.word(piece[:-1].lower()), self.word(piece[-1])))
        piece = unicodedata.normalize("NFC", piece)
        piece = "".join(c.lower() for c in piece) if "Σ" in piece else piece.lower()
        return self.total(map(self.word, self.words.findall(piece)))

    def __missing__(self, piece: str):
        found = self.old.get(piece)
        if found is not None:
            pass
        elif "<|" in piece:
            found = self.total(self.make_special(p) if p in self.special else self.plain(p) for p in self.specials.split(piece))
        else:
            found = self.plain(piece)
        if len(piece) <= KEPT_LETTERS:
            if self.room <= 0:
                self.old, self.room = dict(self), self.kept
                self.clear()
            self[piece] = found
            self.room -= entry_bytes(piece, found)
        return found

    def text(self, text: str):
        pieces = SPLIT.split(text) if EXTRA.search(text) else text.split()
        return self.total(map(self.__getitem__, pieces))


class WordCounts(Pieces):
    """Number of tokens."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.suffix = self.spec["model"]["end_of_word_suffix"] or ""
        self.ranks = {(a, b): i for i, (a, b) in enumerate(self.spec["model"]["merges"])}
        self.letters = byte_letters()

    def make(self, word: str) -> int:
        symbols = [self.letters[b] for b in word.encode()]
        symbols[-1] += self.suffix
        return len(symbols) - merges_needed(symbols, self.ranks)

    def make_special(self, text: str) -> int:
        return 1

    def total(self, parts) -> int:
        return sum(parts)


@lru_cache(1)
def word_counts(path: str) -> WordCounts:
    return WordCounts(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(tokenizer)
        for b in batches:
            n = pa.array([counts.text(t) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    rows = keyed(docs).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
