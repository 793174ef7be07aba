"""Sharding by histogram sort: count bytes below candidate boundaries, refine the candidates, then exchange once.

Rows are ordered by (hash of the text, doc_id), so equal texts stand together
in the order. Per round every task counts the bytes of its rows between
candidate boundaries; the counts give each wanted boundary a narrower bracket
with new candidates inside, until one lies within the tolerance. A boundary
beside a group of equal texts keeps the group whole; only a group of more than
a tenth of a shard is cut, at a doc_id. Boundaries are
few numbers (``shards`` times ``parts``), whatever the rows; texts move once,
by range, and the slot of a row is its rank in its part plus the counts of the
earlier parts.

Results: a NULL text has size 1 and checksum 0. A NULL doc_id ranks behind
all other ids. Repeated rows are ranked in any order. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.llm.common import free_name, hash_of, id_of, materialize, prepare_python

Key = tuple[int, int]
LOW: Key = (-(2**63), -(2**63))
TOP: Key = (2**63 - 1, 2**63 - 1)
PROBES = 33


@dataclass
class Bracket:
    """A wanted boundary lies between the keys ``low`` and ``high`` (exclusive), under which ``below`` and ``upto`` bytes lie."""

    want: int
    low: Key
    below: int
    high: Key
    upto: int
    inside: bool = False  # in a group of equal hashes, which may be cut


def _flat(key: Key) -> int:
    return ((key[0] + 2**63) << 64) | (key[1] + 2**63)


def _key(flat: int) -> Key:
    return (flat >> 64) - 2**63, (flat & (2**64 - 1)) - 2**63


def _probes(b: Bracket, n: int = PROBES) -> list[Key]:
    """Candidates inside a bracket: even steps, and close steps where even density would put the boundary.

    Outside a group of equal hashes they are first keys of a hash.
    """
    low, high = _flat(b.low), _flat(b.high)
    guess = low + (high - low) * (b.want - b.below) // max(1, b.upto - b.below)
    width = max(1, (high - low) // (n * n))
    spots = {low + (high - low) * i // (n + 1) for i in range(1, n + 1)} | {guess + width * i for i in range(-n // 2, n // 2)}
    if not b.inside:
        spots = {s >> 64 << 64 for s in spots}
    return [_key(s) for s in sorted(spots) if low < s < high]


def _sortable(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Pairs of signed numbers as byte strings of the same order."""
    flip = np.uint64(1 << 63)
    pair = np.empty((len(k1), 2), ">u8")
    pair[:, 0] = k1.view(np.uint64) ^ flip
    pair[:, 1] = k2.view(np.uint64) ^ flip
    return np.ascontiguousarray(pair).view("S16").ravel()


def histogram(rows: DataFrame, bounds: list[Key]) -> dict[int, tuple[int, Key, Key]]:
    """Of the rows (k1, k2, size) from each of the ascending ``bounds`` to the next: exact sum of sizes, first and last key.

    Numbered from 0, the rows below the first bound; every task sends one row per number at most.
    """
    edges = _sortable(np.array([b[0] for b in bounds], np.int64), np.array([b[1] for b in bounds], np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, ends = Counter(), {}
        for b in batches:
            k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
            keys = _sortable(k1, k2)
            order = np.argsort(keys)
            at = np.searchsorted(edges, keys[order], side="right")
            bins, first = np.unique(at, return_index=True)
            last = [*first[1:] - 1, len(at) - 1]
            for n, lo, hi, total in zip(bins, order[first], order[last], np.add.reduceat(b.column("size").to_numpy()[order], first) if len(at) else []):
                lowest, highest = (int(k1[lo]), int(k2[lo])), (int(k1[hi]), int(k2[hi]))
                old = ends.get(n, (lowest, highest))
                size[n] += int(total)
                ends[n] = min(old[0], lowest), max(old[1], highest)
        out = [(int(n), size[n], *ends[n][0], *ends[n][1]) for n in size]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 6)], ["bin", "size", "a1", "a2", "z1", "z2"])

    bins = rows.select("k1", "k2", "size").mapInArrow(count, "bin long, size long, a1 long, a2 long, z1 long, z2 long")
    summed = bins.groupBy("bin").agg(
        F.sum("size").alias("size"), F.min(F.struct("a1", "a2")).alias("first"), F.max(F.struct("z1", "z2")).alias("last"))
    return {r["bin"]: (r["size"], tuple(r["first"]), tuple(r["last"])) for r in summed.collect()}  # few rows, whatever the table


def boundaries(rows: DataFrame, wants: list[int], slack: int, keep: int) -> list[Key]:
    """For each of the ascending ``wants`` a key below which as many bytes lie, to within ``slack`` or as near as the rows allow.

    A boundary falls between groups of equal hashes. Only a group of more than
    ``keep`` bytes is cut inside, by the second key.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    open_ = {i: Bracket(want, LOW, 0, TOP, total) for i, want in enumerate(wants)}
    found: dict[int, Key] = {}
    while open_:
        probes = sorted({p for b in open_.values() for p in (*_probes(b), b.low, b.high)})
        bins = histogram(rows, probes)
        spans, below = [], 0
        for n in sorted(bins):
            size, first, last = bins[n]
            spans.append((below, below + size, first, last))
            below += size
        for i, b in list(open_.items()):
            span = next((s for s in spans if s[0] <= b.want < s[1]), None)
            if span is None:  # nothing, or no more, lies below
                found[i] = TOP if b.want else LOW
            else:
                lo, hi, first, last = span
                one = first == last if b.inside else first[0] == last[0]
                after = _key(_flat(last) + 1) if b.inside else (last[0] + 1, LOW[1])
                if min(b.want - lo, hi - b.want) <= slack or (one and (b.inside or first == last or hi - lo <= keep)):
                    found[i] = first if b.want - lo <= hi - b.want else after
                else:
                    open_[i] = Bracket(b.want, first, lo, after, hi, b.inside or one)
            if i in found:
                del open_[i]
    return [found[i] for i in range(len(wants))]


def splitters(rows: DataFrame, shards: int, per: int = 1, tolerance: float = 0.005, keep: float = 0.1) -> list[Key]:
    """Boundaries of ``shards * per`` ranges (a row at or above boundary i lies in range i + 1 or later).

    Those of shards lie within ``tolerance`` of a shard's size of the even
    cut, between groups of equal texts unless a group exceeds the share ``keep`` of a shard.
    Those of the ranges inside a shard only even out tasks.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    part = total / shards
    outer = boundaries(rows, [total * i // shards for i in range(1, shards)], int(part * tolerance), int(part * keep))
    inner = [i for i in range(1, shards * per) if i % per]
    inner = dict(zip(inner, boundaries(rows, [total * i // (shards * per) for i in inner], int(part / per * 0.05), 0)))
    ends = [LOW, *outer, TOP]
    cut = []
    for i in range(1, shards * per):
        s = i // per
        cut.append(ends[s] if i % per == 0 else min(max(inner[i], ends[s]), ends[s + 1]))
    return cut


def shard_by_size(docs: DataFrame, shards: int = 16, parts: int | None = None, tolerance: float = 0.005, keep: float = 0.1) -> DataFrame:
    """``docs`` with size, shard and slot (gapless from 0 in each shard), stored by shard in the order of the keys.

    ``parts`` is the number of range partitions of the exchange; a multiple of
    ``shards``, by default at least the session's shuffle partitions.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    wanted = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    per = max(1, -(-wanted // shards))
    n = {c: free_name(docs, c) for c in ("k1", "k2", "size", "part", "shard", "slot")}
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    sizes = materialize(docs.select(hash_of(docs).alias("k1"), id_of(docs).alias("k2"), size.alias("size")), "sizes")
    bounds = splitters(sizes, shards, per, tolerance, keep)
    edges = _sortable(np.array([b[0] for b in bounds], np.int64), np.array([b[1] for b in bounds], np.int64))

    @F.arrow_udf("int")
    def part_of(k1: pa.Array, k2: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, _sortable(k1.to_numpy(), k2.to_numpy()), side="right").astype(np.int32))

    dealt = (
        docs.withColumns({n["k1"]: hash_of(docs), n["k2"]: id_of(docs), n["size"]: size})
        .withColumn(n["part"], part_of(n["k1"], n["k2"])).repartitionById(shards * per, F.col(n["part"]))
    )
    rank = Window.partitionBy(n["part"]).orderBy(n["k1"], n["k2"])
    stored = materialize(dealt.withColumn(n["slot"], F.row_number().over(rank) - 1), "shards")
    counts = stored.groupBy(n["part"]).agg(F.count(F.lit(1)).alias("rows"))
    shard = F.floor(F.col(n["part"]) / per).cast("int")
    earlier = F.sum("rows").over(Window.partitionBy(shard).orderBy(n["part"]).rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select(n["part"], F.coalesce(earlier, F.lit(0)).alias("before"))
    return stored.join(F.broadcast(before), n["part"]).select(
        *docs.columns, n["size"], shard.alias(n["shard"]), (F.col(n["slot"]) + F.col("before")).cast("long").alias(n["slot"]))
