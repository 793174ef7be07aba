"""Best-fit packing: a configuration linear program over the length histogram, solved by multiplicative weights.

Documents become pieces of at most ``capacity`` tokens. The histogram of piece
lengths (one number per length, whatever the rows) is packed on the driver:

* Neighbouring lengths form classes of about equal counts, each as long as its
  longest; the shortest pieces, about a sixth of all tokens, are kept as filling.
* A configuration is a multiset of classes that fits one sequence; the linear
  program asks for the fewest sequences that cover the classes.
* Multiplicative weights: a class's weight falls as it is covered. Each round
  prices configurations by knapsack dynamic programming over the capacity,
  takes for every class the best configuration through it if its value is
  within ``eps`` of the best, and raises all of them together.
* Weight is then shifted between the configurations found, never to more
  sequences, until no more of them than classes are left; further shifts follow while one saves sequences.
* Their amounts are rounded down to whole sequences, whose places the real
  pieces of the classes take. What remains, filling included, goes best fit, longest first, into the room of
  these sequences and into new ones.

Every piece gets its rank among the pieces of its length from counts per part
of the stored piece table, and its place from the plan by rank. Pieces are
never collected and no exchange is keyed by a length alone.

Results: a NULL or empty text is the end id alone. A NULL doc_id passes
through; repeated rows are packed as often as they occur. An empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from shelfcast.llm.common import keyed, materialize, prepare_python
from shelfcast.llm.tokencount import KEPT_BYTES, SPACE, Pieces, byte_letters

CAPACITY, END = 4096, 1
ROUNDS, EPS, STEP = 60, 0.1, 1.0
# At most so many classes, and so many sequences for each; share of all tokens in the pieces kept as filling, and how much of it configurations leave room for.
CLASSES, FEW_CLASSES, PER_CLASS, FILLING, RESERVE = 192, 16, 8, 0.16, 1.06
PIECES = "doc_id long, th long, piece int, start long, length long, ids binary, ids_crc32 long, part int, rank long"
# Bytes of text whose ids are made at once: different pieces are looked up once in each.
SLICE_BYTES = 16 << 20

Config = tuple[tuple[int, int], ...]  # (length, copies), longest first


# --- ids ----------------------------------------------------------------------------------


class PieceIds(Pieces):
    """Ids, little-endian and four bytes each; the library's model merges every word that is not known yet."""

    def __init__(self, path: str) -> None:
        super().__init__(path, 2 * KEPT_BYTES)
        self.model = Tokenizer.from_file(path).model
        self.letters = byte_letters()

    def make(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, word.encode())))]).tobytes()

    def make_special(self, text: str) -> bytes:
        return self.special[text].to_bytes(4, "little")

    def total(self, parts) -> bytes:
        return b"".join(parts)

    def column(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, ``end`` after each, and the place behind each text.

        Each different piece of the texts is looked up once.
        """
        parts = pc.split_pattern_regex(texts, f"[{SPACE}]+")
        coded = parts.flatten().dictionary_encode()
        found = [self[p] for p in coded.dictionary.to_pylist()]
        pool = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        at = coded.indices.to_numpy(zero_copy_only=False)
        many = np.concatenate([[0], np.cumsum(size[at])]) if len(at) else np.zeros(1, np.int64)
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        ends = many[offsets[1:]] + np.arange(1, len(texts) + 1)
        ids = np.full(int(many[-1]) + len(texts), end, "<u4")
        body = np.ones(len(ids), bool)
        body[ends - 1] = False
        ids[body] = pool[np.repeat(first[at] - many[:-1], size[at]) + np.arange(many[-1])]
        return ids, ends


@lru_cache(1)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def _slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text is alone."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def _gathered(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``most`` bytes of text."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column("text").nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True) -> DataFrame:
    """Stored table of pieces with ids (NULL if not asked for), checksum, and rank among the pieces of equal length of the same part."""
    prepare_python(docs.sparkSession)
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, part = piece_ids(tokenizer), Counter(), TaskContext.get().partitionId()
        most = SLICE_BYTES // 4 if with_ids else SLICE_BYTES  # ids that are kept take memory beside the text
        for b in _gathered(batches, most):
            for lo, hi in _slices(b.column("text"), most):
                rows = b.slice(lo, hi - lo)
                ids, ends = encoder.column(rows.column("text"), end)
                size = np.diff(ends, prepend=0)
                cuts = -(-size // capacity)
                row = np.repeat(np.arange(len(rows)), cuts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * capacity
                length = np.minimum(capacity, size[row] - start)
                at = (ends - size)[row] + start
                raw, rank = memoryview(ids.tobytes()), []
                for n in length.tolist():
                    rank.append(seen[n])
                    seen[n] += 1
                cut = [raw[4 * a:4 * (a + n)] for a, n in zip(at.tolist(), length.tolist())]
                offsets = pa.py_buffer(np.append(4 * at, 4 * len(ids)).astype(np.int32).tobytes())  # pieces lie end to end
                kept = pa.Array.from_buffers(pa.binary(), len(row), [None, offsets, pa.py_buffer(raw)]) if with_ids else pa.nulls(len(row), pa.binary())
                of = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(of), rows.column("th").take(of), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), kept,
                     pa.array([zlib.crc32(c) for c in cut], pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(rank, pa.int64())], names)

    return materialize(keyed(docs).select("doc_id", "th", "text").mapInArrow(run, PIECES), "pieces")


# --- plan for a histogram -----------------------------------------------------------------


def price(weights: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack with repeats: best value of each capacity, and the index of a length that reaches it (-1: leave one token free)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = fits[c]
        best[c] = best[c - 1]
        if k:
            value = best[c - lengths[:k]] + weights[:k]
            i = k - 1 - int(value[::-1].argmax())  # at a tie the longest, so that configurations share few lengths
            if value[i] > best[c]:
                best[c], pick[c] = value[i], i
    return best, pick


def trace(first: np.ndarray, pick: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """One row per item of ``first``: the indices of the best configuration that holds it, padded with -1."""
    # A capacity at which nothing is taken stands for the next lower one at which something is.
    down = np.maximum.accumulate(np.where(pick >= 0, np.arange(len(pick)), 0))
    rows, room = [first], down[capacity - lengths[first]]
    while room.any():
        i = np.where(room > 0, pick[room], -1)
        rows.append(i)
        room = np.where(i >= 0, down[np.maximum(room - lengths[i], 0)], 0)
    return np.stack(rows, 1)


def configurations(demand: np.ndarray, lengths: np.ndarray, capacity: int, rounds: int = ROUNDS, eps: float = EPS, step: float = STEP) -> dict[bytes, float]:
    """Fractional solution: amounts of configurations (indices of lengths, int32); no length is covered beyond its demand.

    A round raises all configurations priced within ``eps`` of the best, so that
    the cover of no length grows by more than ``step`` of its demand.
    """
    covered, amounts = np.zeros(len(lengths)), Counter()
    sharp = np.log(len(lengths) + 1.0)
    for _ in range(rounds):
        share = covered / demand
        left = share < 1 - 1e-6
        if not left.any():
            break
        weights = np.where(left, np.exp(-sharp * (share - share[left].min())) * lengths, 0.0)
        best, pick = price(weights, lengths, capacity)
        value = np.where(left, weights + best[capacity - lengths], 0.0)
        chosen = trace(np.flatnonzero(value >= (1 - eps) * best[capacity]), pick, lengths, capacity)
        chosen.sort(axis=1)
        real = chosen >= 0
        used = np.bincount(chosen[real], minlength=len(lengths))
        room = np.minimum(step * demand, demand - covered) / np.maximum(used, 1)
        x = np.where(real, room[chosen], np.inf).min(1)
        covered += np.bincount(chosen[real], weights=np.broadcast_to(x[:, None], chosen.shape)[real], minlength=len(lengths))
        for row, ok, amount in zip(chosen.astype(np.int32), real, x):
            amounts[row[ok].tobytes()] += amount
    return amounts


def few_configurations(amounts: dict[bytes, float], demand: np.ndarray, lengths: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """The solution with at most as many configurations (copies of each length) as lengths, in no more sequences.

    Starts from sequences of one length for what the solution leaves uncovered. A
    configuration more is a mix of those held; moving along that mix, in the
    direction that costs no sequences, empties one of them. At the end mixes that save sequences are taken up.
    """
    n = len(lengths)
    held = np.diag((capacity // lengths).astype(float))
    rows = [np.bincount(np.frombuffer(r, np.int32), minlength=n).astype(float) for r in amounts]
    columns = np.array(rows).reshape(len(rows), n)
    extra = np.array(list(amounts.values()))
    x = np.maximum(0.0, demand - extra @ columns) / np.diag(held)
    inverse = np.linalg.inv(held)

    def enter(j: int, mix: np.ndarray, amount: float, sign: float) -> float:
        """Move column j by sign; returns the amount that it keeps outside of the held ones."""
        nonlocal inverse
        down = sign * mix
        limits = np.where(down > 1e-9, x / np.where(down > 1e-9, down, 1.0), np.inf)
        i = int(limits.argmin())
        most = min(limits[i], amount if sign < 0 else np.inf)
        if sign < 0 and amount <= limits[i]:
            x[:] = np.maximum(0.0, x - amount * down)
            return 0.0
        x[:] = np.maximum(0.0, x - most * down)
        x[i] = amount + sign * most
        held[:, i] = columns[j]
        inverse[i] /= mix[i]
        others = np.arange(n) != i
        inverse[others] -= np.outer(mix[others], inverse[i])
        return 0.0

    for j in range(len(columns)):
        if extra[j] <= 0:
            continue
        if j % 256 == 255:
            inverse = np.linalg.inv(held)
        mix = inverse @ columns[j]
        extra[j] = enter(j, mix, extra[j], 1.0 if mix.sum() > 1 else -1.0)
    for _ in range(2 * n if len(columns) else 0):
        inverse = np.linalg.inv(held)
        saved = columns @ inverse.sum(0) - 1
        j = int(saved.argmax())
        if saved[j] < 1e-7:
            break
        enter(j, inverse @ columns[j], 0.0, 1.0)
    return [(held[:, i].round().astype(int), float(x[i])) for i in range(n) if x[i] > 1e-9]


def classes_of(histogram: dict[int, int], capacity: int) -> tuple[list[list[int]], dict[int, int], int]:
    """Neighbouring lengths as classes of about equal counts, shortest first; the filling left out of them; room of a configuration.

    Configurations leave room for the filling if its pieces fit that room, and a length beyond theirs is in no class: it has only one, itself.
    """
    filling, kept, tokens = {}, [], sum(n * c for n, c in histogram.items())
    room = FILLING * tokens
    for n in sorted(histogram):
        if not kept and room >= n * histogram[n]:
            room -= n * histogram[n]
            filling[n] = histogram[n]
        else:
            kept.append(n)
    whole = capacity - int(capacity * RESERVE * sum(n * c for n, c in filling.items()) / tokens)
    if filling and max(filling) > capacity - whole:  # it would not fit the room left for it
        kept, filling, whole = [*filling, *kept], {}, capacity
    kept = [n for n in kept if n <= whole]
    many = max(1, min(CLASSES, max(FEW_CLASSES, tokens // (capacity * PER_CLASS))))
    per, groups, held = sum(histogram[n] for n in kept) / many, [], 0
    for n in kept:
        if not groups or held >= per * len(groups):
            groups.append([])
        groups[-1].append(n)
        held += histogram[n]
    return groups, filling, whole


def planned(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[Config, int]], dict[int, int]]:
    """Sequences that the linear program places, with their real pieces, and what remains of the histogram."""
    if not histogram:
        return [], {}
    groups, rest, whole = classes_of(histogram, capacity)
    plan = [(((n, 1),), c) for n, c in histogram.items() if n > whole]
    if not groups:
        return plan, rest
    lengths = np.array([g[-1] for g in groups], np.int64)
    demand = np.array([sum(histogram[n] for n in g) for g in groups], float)
    found = few_configurations(configurations(demand, lengths, whole), demand, lengths, whole)
    queues = [[[n, histogram[n]] for n in g] for g in groups]  # the longest at the end is taken first
    left = demand.astype(int)
    for copies, x in sorted(found, key=lambda f: -f[1]):
        used = np.flatnonzero(copies)
        m = min([int(x + 1e-6), *(left[used] // copies[used]).tolist()])
        if m < 1:
            continue
        left[used] -= m * copies[used]
        slots = [_taken(queues[i], m) for i in used for _ in range(copies[i])]
        cuts = sorted({c for slot in slots for c, _ in slot})
        for lo, hi in zip([0, *cuts], cuts):
            config = Counter(next(n for c, n in slot if c >= hi) for slot in slots)
            plan.append((tuple(sorted(config.items(), reverse=True)), hi - lo))
    for q in queues:
        for n, c in q:
            if c:
                rest[n] = rest.get(n, 0) + c
    return plan, rest


def _taken(queue: list[list[int]], m: int) -> list[tuple[int, int]]:
    """``m`` pieces from a queue of (length, count) as runs (place behind the run, length)."""
    runs, at = [], 0
    while at < m:
        n, c = queue[-1]
        take = min(c, m - at)
        at += take
        runs.append((at, n))
        queue[-1][1] -= take
        if not queue[-1][1]:
            queue.pop()
    return runs


def best_fit(histogram: dict[int, int], capacity: int, started: list[tuple[Config, int]] = ()) -> list[tuple[Config, int]]:
    """Best fit, longest first, on groups of equal sequences: groups with the least room that is enough take the next length."""
    groups: dict[int, Counter] = {}
    rooms = np.zeros(capacity + 1, bool)
    for config, m in started:
        _add(groups, rooms, capacity - sum(n * c for n, c in config), config, m)
    for n in sorted(histogram, reverse=True):
        todo = histogram[n]
        while todo:
            fit = np.flatnonzero(rooms[n:])
            if not len(fit):
                per = capacity // n
                full, rest = divmod(todo, per)
                for copies, m in ((per, full), (rest, 1)):
                    if copies and m:
                        _add(groups, rooms, capacity - copies * n, ((n, copies),), m)
                break
            room = int(fit[0]) + n
            config = next(iter(groups[room]))
            m = groups[room].pop(config)
            if not groups[room]:
                rooms[room] = False
            per = min(room // n, todo)
            take = min(m, todo // per)
            _add(groups, rooms, room - per * n, config + ((n, per),), take)
            if m > take:
                _add(groups, rooms, room, config, m - take)
            todo -= take * per
    return [(config, m) for g in groups.values() for config, m in g.items()]


def _add(groups: dict[int, Counter], rooms: np.ndarray, room: int, config: Config, m: int) -> None:
    groups.setdefault(room, Counter())[config] += m
    rooms[room] = True


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Config, int]]:
    """(configuration, number of sequences) that hold exactly the pieces of the histogram."""
    placed, left = planned(histogram, capacity)
    return best_fit(left, capacity, placed)


# --- places -------------------------------------------------------------------------------


def blocks(plan: list[tuple[Config, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, copies), by length and rank: where the pieces of each length go."""
    rank, sequence, rows = Counter(), 0, []
    for config, m in plan:
        offset = 0
        for n, copies in config:
            rows.append((n, rank[n], sequence, offset, copies))
            rank[n] += m * copies
            offset += n * copies
        sequence += m
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True) -> DataFrame:
    """(doc_id, th, piece, start, length, ids, ids_crc32, sequence_id, offset) of every piece; ids are NULL if not asked for."""
    cut = pieces(docs, tokenizer, capacity, end, with_ids)
    counts = materialize(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    table = blocks(plan_sequences(histogram, capacity))
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("earlier"))
    starts = table[:, 0] * (1 << 44) + table[:, 1]

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        row = table[np.searchsorted(starts, n * (1 << 44) + r, side="right") - 1].reshape(-1, 5)
        at = r - row[:, 1]
        return pa.StructArray.from_arrays(
            [pa.array(row[:, 2] + at // row[:, 4]), pa.array(row[:, 3] + at % row[:, 4] * n)], ["sequence_id", "offset"])

    placed = cut.join(materialize(earlier, "length-offsets"), ["part", "length"])
    placed = placed.withColumn("at", place("length", F.col("rank") + F.col("earlier")))
    return placed.select("doc_id", "th", "piece", "start", "length", "ids", "ids_crc32", "at.sequence_id", "at.offset")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the ids of whole sequences; each holds at most the capacity."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(F.col("parts"), F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return placed.groupBy("sequence_id").agg(ordered.alias("parts"), F.sum("length").alias("length")).select(
        "sequence_id", "length", ids.alias("ids"))
