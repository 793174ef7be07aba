"""Fill-in-middle transformation: cuts located by rank queries on a wavelet matrix over character classes.

A text is a row of UTF-8 bytes. Each byte has one of six classes: blank, the
last blank of a text that ends blank, and for other bytes whether it begins a
code point and whether it ends a word. Every unit that a text can be cut into
is a set of classes, so one matrix answers all counts:

* units up to a place = ranks of the classes that end a unit, added up;
* code points up to a place = ranks of the classes that begin one, added up.

The matrix stands over a whole Arrow batch of texts, a text being a range of
it. The place behind the k-th unit comes from a bisection on the combined
ranks, for both cuts of all texts of the batch at once. No text is scanned
token by token, and no exchange is needed.

Results: a NULL or empty text has no unit and stays plain, as does one that holds a
marker (the output could not be read back). A NULL doc_id draws like an empty
number. Equal ids draw equally, so repeated rows give repeated rows. Texts are
processed whole; only doc_id and text are read, so further columns cannot
clash. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import prepare_python

# fixed values: markers before the prefix, the suffix and the middle
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLANKS = b" \t\n\x0b\x0c\r"
# Classes of bytes.
BLANK, FINAL_BLANK, FIRST, FURTHER, FIRST_END, FURTHER_END = range(6)
LEVELS = 3
# A token is blanks with the word behind them; blanks at the end of the text are one too.
UNITS = {
    "token": (FINAL_BLANK, FIRST_END, FURTHER_END),
    "code_point": (BLANK, FINAL_BLANK, FIRST, FIRST_END),
}
DRAWS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class WaveletMatrix:
    """Ranks of symbols below 2**levels in a row of symbols."""

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.bits, self.counts, self.zeros = [], [], []
        for level in reversed(range(levels)):
            ones = (symbols >> level & 1).astype(bool)
            packed = np.zeros(len(symbols) // 64 * 8 + 8, np.uint8)
            packed[:(len(symbols) + 7) // 8] = np.packbits(ones, bitorder="little")
            words = packed.view("<u8")
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(len(symbols) - int(self.counts[-1][-1]))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.starts = {c: self._descend(c, np.zeros(1, np.int64)) for c in range(1 << levels)}

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a level before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.bits[level][word] & mask)

    def _descend(self, symbol: int, at: np.ndarray) -> np.ndarray:
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level, at)
            at = zeros + ones if symbol >> (len(self.zeros) - 1 - level) & 1 else at - ones
        return at

    def rank(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of ``symbols`` stand before each place."""
        return sum(self._descend(c, at) - self.starts[c] for c in symbols)

    def behind(self, symbols: tuple[int, ...], k: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least place in [low, high] with ``k`` of ``symbols`` before it, by bisection on ranks."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.rank(symbols, middle) >= k
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low


def classes(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of each byte of texts laid end to end; ``ends`` are the places behind each text."""
    blank = np.isin(raw, np.frombuffer(BLANKS, np.uint8))
    closes = np.ones(len(raw), bool)  # a blank or the end of the text follows
    closes[:-1] = blank[1:]
    last = ends[ends > np.concatenate([[0], ends[:-1]])] - 1  # the last bytes of texts that have any
    closes[last] = True
    further = (raw & 0xC0) == 0x80
    out = np.where(closes, FIRST_END, FIRST).astype(np.uint8) + further
    out[blank] = BLANK
    out[last[blank[last]]] = FINAL_BLANK
    return out


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column laid end to end, and the place behind each text."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets[1:] - offsets[0]


def draws(seed: int = 42) -> list[Column]:
    """Four unsigned 32-bit numbers of a row: the first hex digits of SHA-256 over seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, unit: str = "token", rate: int = 50, spm_share: int = 80, seed: int = 42) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    ``n`` counts the units. Of each hundred draws ``rate`` are transformed, and
    ``spm_share`` of each hundred of those put the suffix first.
    """
    known_by = UNITS[unit]  # by its last byte, but a code point by its first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
        for b in batches:
            raw, end = _bytes(b.column("text"))
            start = np.concatenate([[0], end[:-1]]) if len(end) else end
            matrix = WaveletMatrix(classes(raw, end), LEVELS)
            before = matrix.rank(known_by, start)
            n = matrix.rank(known_by, end) - before
            h = [b.column(f"h{i}").to_numpy() for i in range(1, 5)]
            cuts = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)]), 0)
            if unit == "code_point":  # the k-th ends where the next one begins
                behind = [np.where(k < n, matrix.behind(known_by, before + k + 1, start, end) - 1, end) for k in cuts]
            else:
                behind = [matrix.behind(known_by, before + k, start, end) for k in cuts]
            chars = [matrix.rank(UNITS["code_point"], at) for at in (start, *behind)]
            sizes = [chars[1] - chars[0], chars[2] - chars[1]]
            changed = (n > 0) & (h[2] % 100 < rate)
            data = raw.tobytes()
            form, output = [], []
            for i, (a, p, m, z) in enumerate(zip(start.tolist(), behind[0].tolist(), behind[1].tolist(), end.tolist())):
                text = data[a:z]
                if not changed[i] or any(x in text for x in marks):
                    changed[i] = False
                    form.append("plain")
                    output.append(text)
                    continue
                prefix, middle, suffix = marks[0] + data[a:p], marks[2] + data[p:m], marks[1] + data[m:z]
                first = h[3][i] % 100 < spm_share
                form.append("spm" if first else "psm")
                output.append((suffix + prefix if first else prefix + suffix) + middle)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(form, pa.string()), *(pa.array(s, mask=~changed) for s in sizes),
                 pa.array(output, pa.binary()).cast(pa.string())], [c.split()[0] for c in DRAWS.split(", ")])

    prepare_python(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *draws(seed)).mapInArrow(run, DRAWS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``transform`` was made from: its parts stand between markers that the text does not hold."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix, suffix = F.when(form == "spm", parts[2]).otherwise(parts[1]), F.when(form == "spm", parts[1]).otherwise(parts[2])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))
