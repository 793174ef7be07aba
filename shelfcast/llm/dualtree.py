"""Vector code compression: product codes whose codebooks come from dual-tree Lloyd rounds in integers.

Components become integers floor(4096 * x) and vectors are cut into equal
parts; a codebook per part position starts as the parts of the least vec_ids.

* Trees over parts: rows are gathered into chunks, and every part position of
  a chunk gets a balanced tree of bounding boxes with the sum of each node.
  Chunks are stored once, in tree order, and read in each round.
* Trees over entries: one per codebook and round, of the same kind.
* A round descends both together. The distances between two boxes bound all
  distances between their members, so pairs of nodes that cannot hold a nearest
  entry are dropped. A node of parts that one entry is left for is assigned whole, by
  its cached sum. Leaves with several are decided part by part on integers, so the
  result is that of plain Lloyd.
* Spark adds the sums up; only (entries x dimension) numbers reach the driver.

Integers beyond 2**26 in size are kept as Python integers, off the trees, and
their sums travel in limbs, so no size of a component loses a digit.

Results: vectors that are NULL or hold NULL or non-finite components are
dropped. The commonest length (at a tie the longer one) is coded; rows of
another length have NULL code, error and label_error unless their label has coded
rows. A length that the number of parts does not divide is filled up with zeros.
Equal vec_ids start codebooks in the order of their vectors; a NULL vec_id comes last. With fewer
rows than entries there are as many entries as rows. An error beyond a long is
NULL, and so is the label_error of its label. NULL labels count as one label. Repeated rows are rows of their
own; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import LAST_ID, materialize, prepare_python

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK_ROWS, CHUNK_NUMBERS, LEAF = 8192, 1 << 19, 16
SMALL, LIMB = 1 << 26, 40
LONGEST = 2**63 - 1


# --- integers -----------------------------------------------------------------------------


def whole(x: float) -> int:
    return int(x) * SCALE if abs(x) >= 2**52 else math.floor(x * SCALE)


def to_parts(v: np.ndarray, parts: int) -> np.ndarray:
    """Rows of numbers as (parts, rows, width), filled up with zeros."""
    width = max(1, -(-v.shape[1] // parts))
    v = np.pad(v, ((0, 0), (0, width * parts - v.shape[1])))
    return np.ascontiguousarray(v.reshape(len(v), parts, width).transpose(1, 0, 2))


def integer_parts(v: np.ndarray, parts: int) -> np.ndarray:
    """``v`` as integer parts; as Python integers if one is not small."""
    if len(v) and np.abs(v).max(initial=0.0) * SCALE > SMALL:
        return to_parts(np.array([[whole(x) for x in row] for row in v.tolist()], object).reshape(v.shape), parts)
    return to_parts(np.floor(v * SCALE).astype(np.int64), parts)


# --- trees --------------------------------------------------------------------------------


def depth_of(n: int, leaf: int) -> int:
    """Levels below the root until leaves hold ``leaf`` rows or fewer."""
    leaf = max(2, leaf)
    return math.ceil(math.log2(n / leaf)) if n > leaf else 0


def bounds(n: int, level: int) -> np.ndarray:
    """First rows of the nodes of a level, and n: nodes of a level are as equal as can be."""
    return (np.arange((1 << level) + 1) * n) >> level


def tree_order(points: np.ndarray, depth: int) -> np.ndarray:
    """Order of the rows of each (rows, width) plane in a balanced tree: nodes are halved across their widest side."""
    parts, n, _ = points.shape
    order = np.tile(np.arange(n), (parts, 1))
    for level in range(depth):
        at = bounds(n, level)
        held = np.take_along_axis(points, order[:, :, None], 1)
        low, high = np.minimum.reduceat(held, at[:-1], 1), np.maximum.reduceat(held, at[:-1], 1)
        node = np.repeat(np.arange(1 << level), np.diff(at))
        side = (high - low).argmax(2)[:, node]
        value = np.take_along_axis(held, side[:, :, None], 2)[:, :, 0]
        base = np.take_along_axis(low[:, node], side[:, :, None], 2)[:, :, 0]
        new = np.argsort((node << 28) + (value - base), 1, kind="stable")
        order = np.take_along_axis(order, new, 1)
    return order


@dataclass
class Level:
    """Boxes of all nodes of a level, planes of all parts laid end to end: (parts * nodes, width)."""

    low: np.ndarray
    high: np.ndarray
    total: np.ndarray
    count: np.ndarray


def levels(points: np.ndarray, depth: int) -> list[Level]:
    """Boxes, sums and counts of the nodes over ``points`` in tree order."""
    parts, n, width = points.shape
    at = bounds(n, depth)
    found = [np.minimum.reduceat(points, at[:-1], 1), np.maximum.reduceat(points, at[:-1], 1), np.add.reduceat(points, at[:-1], 1)]
    count, out = np.diff(at), []
    for level in range(depth, -1, -1):
        out.append(Level(*(x.reshape(-1, width) for x in found), np.tile(count, parts)))
        if level:
            pair = [x.reshape(parts, -1, 2, width) for x in found]
            found = [pair[0].min(2), pair[1].max(2), pair[2].sum(2)]
            count = count.reshape(-1, 2).sum(1)
    return out[::-1]


@dataclass
class EntryTree:
    """Boxes over the entries of each part: levels[k] has (parts, 2**k) boxes; ``index`` names the entries of the last level."""

    levels: list[tuple[np.ndarray, np.ndarray]]
    index: np.ndarray
    entries: np.ndarray

    @classmethod
    def over(cls, entries: np.ndarray) -> EntryTree:
        """``entries``: (parts, entries, width). Fewer entries than a power of two: the last one stands repeatedly."""
        parts, m, width = entries.shape
        depth = max(0, (m - 1).bit_length())
        index = tree_order(entries, min(depth, int(math.log2(m))))
        index = np.concatenate([index, np.repeat(index[:, -1:], (1 << depth) - m, 1)], 1)
        low = high = np.take_along_axis(entries, index[:, :, None], 1)
        found = [(low, high)]
        for _ in range(depth):
            low, high = low.reshape(parts, -1, 2, width).min(2), high.reshape(parts, -1, 2, width).max(2)
            found.append((low, high))
        return cls(found[::-1], index, entries)


def nearest(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Index of the nearest entry of each row of one part, ties to the least; for integers of any size."""
    best, least = np.zeros(len(points), np.int64), None
    for e in range(len(entries)):
        d = ((points - entries[e]) ** 2).sum(1)
        if least is None:
            least = d
        else:
            closer = d < least
            best[closer], least = e, np.where(closer, d, least)
    return best


@dataclass
class Work:
    """What the descents did: pairs of nodes compared, parts assigned by whole nodes, integer distances of single parts."""

    pairs: int = 0
    by_node: int = 0
    distances: int = 0


def assign(points: np.ndarray, tree: EntryTree, leaf: int = LEAF, work: Work | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (parts, rows) of ``points`` in tree order, and per part and entry the sums and counts of its parts.

    Descends both trees: the boxes of a level of parts against boxes of entries, which get
    smaller along with them. ``points`` are small integers.
    """
    parts, n, width = points.shape
    m = tree.entries.shape[1]
    depth = depth_of(n, leaf)
    nodes = levels(points, depth)
    codes = np.zeros((parts, n), np.int64)
    sums, counts = np.zeros((parts, m, width), np.int64), np.zeros((parts, m), np.int64)
    last = len(tree.levels) - 1
    node, entry, at_entry = np.arange(parts), np.zeros(parts, np.int64), 0  # pairs; a node is numbered part * 2**level + place
    for level in range(depth + 1):
        box = nodes[level]
        while True:
            node, entry = _prune(box, node, entry, tree.levels[at_entry], level, width, work)
            if at_entry == last or (level < depth and at_entry > level):
                break
            at_entry += 1  # each box of entries opens into its two
            node, entry = np.repeat(node, 2), np.stack([2 * entry, 2 * entry + 1], 1).ravel()
        if at_entry == last:
            part = node >> level
            name = tree.index[part, entry]
            node, entry, name = _beaten(box, node, entry, name, tree.entries, level)
            alone = np.bincount(node, minlength=parts << level) == 1
            done = alone[node]
            if done.any():
                who, e = node[done], name[done]
                np.add.at(sums, (who >> level, e), box.total[who])
                np.add.at(counts, (who >> level, e), box.count[who])
                span = bounds(n, level)
                for w, x in zip(who.tolist(), e.tolist()):
                    place = w & ((1 << level) - 1)
                    codes[w >> level, span[place]:span[place + 1]] = x
                if work:
                    work.by_node += int(box.count[who].sum())
                node, entry = node[~done], entry[~done]
        if not len(node):
            return codes, sums, counts
        if level < depth:
            node, entry = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([entry, entry])
            order = np.lexsort((entry, node))
            node, entry = node[order], entry[order]
    _uncertain(points, tree, node, tree.index[node >> depth, entry], depth, codes, sums, counts, work)
    return codes, sums, counts


def _prune(box: Level, node, entry, boxes, level: int, width: int, work: Work | None):
    """Drop pairs whose least distance is beyond what another box of entries surely gives every part of the node."""
    low, high = boxes
    part = node >> level
    el, eh = low[part, entry], high[part, entry]
    nl, nh = box.low[node], box.high[node]
    gap = np.maximum(0, np.maximum(nl - eh, el - nh))
    reach = np.maximum(nh - el, eh - nl)
    nearest_, farthest = (gap * gap).sum(1), (reach * reach).sum(1)
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    bound = np.repeat(np.minimum.reduceat(farthest, first), np.diff(np.append(first, len(node))))
    if work:
        work.pairs += len(node)
    keep = nearest_ <= bound
    return node[keep], entry[keep]


def _beaten(box: Level, node, entry, name, entries: np.ndarray, level: int):
    """Drop entries that lie farther than the node's best one from every place of its box, and second namings of an entry."""
    part = node >> level
    order = np.lexsort((name, node))
    node, entry, name, part = node[order], entry[order], name[order], part[order]
    once = np.concatenate([[True], (node[1:] != node[:-1]) | (name[1:] != name[:-1])])
    node, entry, name, part = node[once], entry[once], name[once], part[once]
    e = entries[part, name]
    middle = box.low[node] + box.high[node] - 2 * e
    off = (middle * middle).sum(1)
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    size = np.diff(np.append(first, len(node)))
    best = np.lexsort((name, off, node))[first]
    rival = np.repeat(best, size)
    step = 2 * (e - e[rival])
    # distance to the best less distance to this entry is linear in the place: its greatest value is at a corner
    most = (e[rival] ** 2).sum(1) - (e ** 2).sum(1) + np.where(step > 0, step * box.high[node], step * box.low[node]).sum(1)
    keep = (rival == np.arange(len(node))) | (most > 0) | ((most == 0) & (name < name[rival]))
    return node[keep], entry[keep], name[keep]


def _uncertain(points, tree: EntryTree, node, name, depth: int, codes, sums, counts, work: Work | None) -> None:
    """Leaves with several entries left: integer distances of their parts to these entries."""
    parts, n, width = points.shape
    order = np.lexsort((name, node))
    node, name = node[order], name[order]
    leaves, first, many = np.unique(node, return_index=True, return_counts=True)
    span = bounds(n, depth)
    place, part = leaves & ((1 << depth) - 1), leaves >> depth
    size = span[place + 1] - span[place]
    owner = np.repeat(np.arange(len(leaves)), size)
    row = span[place][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    held, best, least = points[part[owner], row], np.zeros(len(owner), np.int64), None
    for c in range(int(many.max())):
        on = np.flatnonzero(many[owner] > c)
        e = name[first[owner[on]] + c]
        diff = held[on] - tree.entries[part[owner[on]], e]
        d = (diff * diff).sum(1)
        if work:
            work.distances += len(on)
        if least is None:
            best, least = e.copy(), d
        else:
            closer = d < least[on]  # names ascend, so a tie stays with the lesser
            best[on[closer]], least[on[closer]] = e[closer], d[closer]
    codes[part[owner], row] = best
    np.add.at(sums, (part[owner], best), held)
    np.add.at(counts, (part[owner], best), 1)


# --- rounds -------------------------------------------------------------------------------


def chunks(rows: DataFrame, parts: int, leaf: int = LEAF) -> DataFrame:
    """Stored chunks of rows (vec_id, label, v): small ones as integers in the order of a tree per part, others as they are."""
    kind = dict(rows.dtypes)["label"]
    schema = f"vec_ids array<long>, labels array<{kind}>, size int, ranks binary, points binary, large array<array<double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            v = table.column("v").combine_chunks()
            v = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
            large = np.abs(v).max(1, initial=0.0) * SCALE > SMALL
            order = np.argsort(large, kind="stable")  # those off the trees come last
            table = table.take(pa.array(order))
            n = int(len(v) - large.sum())
            points = integer_parts(v[order[:n]], parts)
            ranks = tree_order(points, depth_of(n, leaf))
            points = np.take_along_axis(points, ranks[:, :, None], 1).astype("<i4")
            rest = v[order[n:]].tolist()
            one = lambda c: pa.ListArray.from_arrays([0, len(v)], table.column(c).combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [one("vec_id"), one("label"), pa.array([n], pa.int32()), pa.array([ranks.astype("<i4").tobytes()]), pa.array([points.tobytes()]),
                 pa.array([rest], pa.list_(pa.list_(pa.float64())))], ["vec_ids", "labels", "size", "ranks", "points", "large"])

    prepare_python(rows.sparkSession)
    return materialize(rows.mapInArrow(run, schema), "vector-chunks")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of a task gathered into chunks, bounded by rows and by numbers."""
    held, n, numbers = [], 0, 0
    for b in batches:
        held.append(b)
        n, numbers = n + len(b), numbers + len(b.column("v").flatten())
        while n and (n >= CHUNK_ROWS or numbers >= CHUNK_NUMBERS):
            take = min(n, CHUNK_ROWS, max(1, CHUNK_NUMBERS * n // max(1, numbers)))
            table = pa.Table.from_batches(held)
            yield table.slice(0, take)
            held = table.slice(take).to_batches()
            n, numbers = n - take, numbers - numbers * take // n
    if n:
        yield pa.Table.from_batches(held)


def _unpacked(b: pa.RecordBatch, i: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks and points of the trees of a stored chunk, and the parts off the trees."""
    n = b.column("size")[i].as_py()
    ranks = np.frombuffer(b.column("ranks")[i].as_py(), "<i4").reshape(parts, n)
    points = np.frombuffer(b.column("points")[i].as_py(), "<i4")
    large = b.column("large")[i].as_py()
    return ranks, points.reshape(parts, n, -1).astype(np.int64) if n else points, integer_parts(np.array(large, float), parts) if large else None


def assign_chunk(points: np.ndarray, large: np.ndarray | None, book: np.ndarray, leaf: int, work: Work | None = None):
    """Codes of the tree rows and of the large rows of a chunk, and the sums (Python integers) and counts per part and entry."""
    parts, m, width = book.shape
    sums, counts = np.zeros((parts, m, width), object), np.zeros((parts, m), np.int64)
    codes = np.zeros((parts, points.shape[1] if points.ndim == 3 else 0), np.int64)
    others = np.zeros((parts, 0 if large is None else large.shape[1]), np.int64)
    fits = np.array([all(abs(x) <= SMALL for x in book[p].ravel().tolist()) for p in range(parts)])
    if codes.shape[1]:
        if fits.any():
            codes[fits], s, k = assign(points[fits], EntryTree.over(book[fits].astype(np.int64)), leaf, work)
            sums[fits] += s.astype(object)
            counts[fits] += k
        for p in np.flatnonzero(~fits):
            codes[p] = nearest(points[p].astype(object), book[p])
            _add(sums[p], counts[p], codes[p], points[p].astype(object))
    for p in range(parts if large is not None else 0):
        others[p] = nearest(large[p].astype(object), book[p])
        _add(sums[p], counts[p], others[p], large[p].astype(object))
    return codes, others, sums, counts


def _add(sums: np.ndarray, counts: np.ndarray, codes: np.ndarray, points: np.ndarray) -> None:
    for e in np.unique(codes):
        own = codes == e
        sums[e] += points[own].sum(0)
        counts[e] += int(own.sum())


def limbs(x: int) -> list[tuple[int, int]]:
    """``x`` as (place, digit) in base 2**LIMB with the sign of ``x``; no digit of zero."""
    out, place, sign, x = [], 0, -1 if x < 0 else 1, abs(x)
    while x:
        if digit := x & ((1 << LIMB) - 1):
            out.append((place, sign * digit))
        x >>= LIMB
        place += 1
    return out


def next_book(stored: DataFrame, book: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """One round: parts to their nearest entries, used entries to the mean of their parts, rounded down."""
    parts, m, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, m, width), object), np.zeros((parts, m), np.int64)
        for b in batches:
            for i in range(len(b)):
                _, points, large = _unpacked(b, i, parts)
                _, _, s, k = assign_chunk(points, large, book, leaf)
                sums, counts = sums + s, counts + k
        out = [(p * m + e, width, 0, int(counts[p, e])) for p, e in zip(*np.nonzero(counts))]
        out += [(p * m + e, d, place, digit) for p, e in zip(*np.nonzero(counts)) for d in range(width) for place, digit in limbs(int(sums[p, e, d]))]
        columns = zip(*out) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["entry", "at", "place", "digit"])

    added = stored.select("size", "ranks", "points", "large").mapInArrow(run, "entry long, at long, place long, digit long")
    totals, counts = np.zeros((parts * m, width), object), np.zeros(parts * m, object)
    for r in added.groupBy("entry", "at", "place").agg(F.sum("digit").alias("digit")).collect():  # entries x dimension x limbs at most
        if r["at"] == width:
            counts[r["entry"]] = r["digit"]
        else:
            totals[r["entry"], r["at"]] += r["digit"] << (LIMB * r["place"])
    new = book.copy().reshape(parts * m, width)
    for e in np.flatnonzero(counts):
        new[e] = [int(t) // int(counts[e]) for t in totals[e]]
    return new.reshape(book.shape)


def coded(stored: DataFrame, book: np.ndarray, leaf: int = LEAF) -> DataFrame:
    """(vec_id, label, code, error) of every row of the chunks."""
    parts = len(book)
    kind = dict(stored.dtypes)["labels"].removeprefix("array<")[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                ranks, points, large = _unpacked(b, i, parts)
                codes, others, _, _ = assign_chunk(points, large, book, leaf)
                n = codes.shape[1]
                error = np.zeros(n, object)
                by_row = np.zeros((parts, n), np.int64)
                for p in range(parts if n else 0):
                    entries = book[p][codes[p]]
                    small = all(abs(x) <= SMALL for x in book[p].ravel().tolist())
                    diff = points[p] - (entries.astype(np.int64) if small else entries)
                    error[ranks[p]] += (diff * diff).sum(1).astype(object)
                    by_row[p, ranks[p]] = codes[p]
                rest = np.zeros(others.shape[1], object)
                for p in range(parts if len(rest) else 0):
                    rest += ((large[p].astype(object) - book[p][others[p]]) ** 2).sum(1)
                text = [bytes(row).hex() for row in np.concatenate([by_row, others], 1).T.astype(np.uint8)]
                values = [int(x) if x <= LONGEST else None for x in [*error, *rest]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_ids")[i].values, b.column("labels")[i].values, pa.array(text, pa.string()), pa.array(values, pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return stored.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, leaf: int = LEAF,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row, and the codebooks (parts, entries, width)."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    kept = vectors.where(F.forall(numbers, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", numbers.alias("v"))
    found = kept.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    size = found["size"] if found else 0
    rows = kept.where(F.size("v") == size)
    first = rows.orderBy(F.coalesce("vec_id", F.lit(LAST_ID)), "v").select("v").limit(entries).collect()  # as many rows as entries
    start = integer_parts(np.array([r["v"] for r in first], float).reshape(len(first), size), parts)
    book = start.astype(object)
    stored = chunks(rows, parts, leaf)
    for _ in range(rounds if len(first) else 0):
        book = next_book(stored, book, leaf)
    out = coded(stored, book, leaf)
    if found:
        other = kept.where(F.size("v") != size).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        out = out.union(other)
    out = materialize(out, "vector-codes")
    short = F.count_if(F.col("code").isNotNull() & F.col("error").isNull()) > 0
    by_label = materialize(
        out.groupBy("label").agg(F.when(~short, F.try_sum("error")).alias("label_error")).withColumnRenamed("label", "of_label"), "label-errors")
    digest = hashlib.sha256(",".join(str(int(x)) for x in book.ravel()).encode()).hexdigest()
    joined = out.join(by_label, out["label"].eqNullSafe(by_label["of_label"]), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), book
