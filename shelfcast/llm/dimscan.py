"""Approximate nearest neighbours by largest inner product: adaptive dimension scan inside probed lists.

* Vectors are rotated pseudo-randomly, so any block of coordinates tells about
  the whole inner product. Centroids of lists come from a bounded sample; every
  vector belongs to the list whose centroid is nearest. Lists are cut into chunks by hash, so a
  hot list is many chunks, and a chunk is stored as column blocks of ``BLOCK`` dimensions.
* A query probes its lists in the order of their centroids' inner products. How
  many is calibrated on the sample, where its neighbours are known; a query
  goes on until its lists hold enough rows, whatever the calibration says.
* The best list is scanned first; its k-th score is the bar of the query in all
  other lists. Queries of a list meet its chunks in groups of bounded size.
* A scan adds one column block after the other. After each, a hypothesis test
  asks whether a candidate with so small a part of the sum could still reach
  the bar, were the rotation random: the part of d of D dimensions has the mean
  d/D of the whole and a variance that lengths bound. Candidates that fail at
  ``Z`` deviations are left; the certain bound by the lengths of what is not summed leaves others.
  The bar rises with what is found. Survivors are scored on the original vectors, in
  double precision.

Equal rows (id and vector) are one with a count. Results hold the rows of highest score, ties to the smaller
vec_id. Vectors that are NULL, empty, zero or hold NULL or non-finite components take no
part. A vector shorter than the longest counts as filled up with zeros. A NULL vec_id is no query and
as a neighbour stands behind its ties. Repeated rows are queries and candidates of their own. Scores
beyond double precision are infinite; one that is not a number stands last. Other columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import LAST_ID, materialize, prepare_python, runs
from shelfcast.llm.vectors import hadamard

K, EVERY = 20, 20
SAMPLE, PROBES, LISTS, RECALL = 16_384, 256, 2048, 0.97
BLOCK, Z = 16, 2.5
CHUNK_BYTES, QUERIES, STEP = 2 << 20, 512, 1024
SEED = 12


def rotate(x: np.ndarray) -> np.ndarray:
    """A pseudo-random rotation of the rows, filled up to a power of two (``BLOCK`` at least)."""
    n = max(BLOCK, 1 << max(0, x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    for signs in np.random.default_rng([SEED, n]).choice([-1.0, 1.0], (3, n)):
        x = hadamard(x * signs)
    return x


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of ``width``, short ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


# --- index --------------------------------------------------------------------------------


@dataclass
class Index:
    """What tasks need to know: ``shift`` scales components to at most one, ``centroids`` are rotated."""

    width: int
    shift: int
    centroids: np.ndarray
    probes: int

    def rotated(self, v: np.ndarray) -> np.ndarray:
        return rotate(np.ldexp(v, -self.shift))

    def lists(self, r: np.ndarray) -> np.ndarray:
        """Nearest centroid of each row."""
        return (r @ self.centroids.T - (self.centroids ** 2).sum(1) / 2).argmax(1)

    def order(self, r: np.ndarray) -> np.ndarray:
        """Lists of each row as a query, best first."""
        return np.argsort(-(r @ self.centroids.T), 1, kind="stable")


def centroids(x: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """Means of ``n`` groups of the rows by Lloyd's rounds; a group that empties keeps its mean."""
    c = x[np.random.default_rng(SEED).permutation(len(x))[:n]].copy()
    for _ in range(rounds):
        own = (x @ c.T - (c ** 2).sum(1) / 2).argmax(1)
        used, at = np.unique(own, return_index=False, return_inverse=True)
        sums = np.zeros((len(used), x.shape[1]))
        np.add.at(sums, at, x)
        c[used] = sums / np.bincount(at)[:, None]
    return c


def calibrated(index: Index, x: np.ndarray, k: int, recall: float) -> int:
    """Least number of lists that hold ``recall`` of the neighbours of some sample rows among the sample."""
    own = index.lists(x)
    q = x[:PROBES]
    score = q @ x.T
    score[np.arange(len(q)), np.arange(len(q))] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return 1
    best = np.argpartition(-score, k - 1, 1)[:, :k]
    rank = np.argsort(index.order(q), 1)  # place of each list in the order of a query
    place = np.sort(np.take_along_axis(rank, own[best], 1).ravel())
    return int(place[min(len(place) - 1, math.ceil(recall * len(place)) - 1)]) + 1


def usable(vectors: DataFrame) -> DataFrame:
    """Stored distinct rows (id, rid, copies, v) of the vectors that take part; ``rid`` tells rows of one id apart."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("id"), numbers.alias("v")).where(
        finite & F.exists("v", lambda x: x != 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    same = rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    return materialize(same.select("id", F.xxhash64(F.lit(SEED), "id", "v").alias("rid"), "copies", "v"), "search-rows")


def fit(rows: DataFrame, k: int, sample: int = SAMPLE, recall: float = RECALL) -> Index | None:
    """Index from at most ``sample`` rows, chosen by hash; None if there are no rows."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    if not size["n"]:
        return None
    few = rows if size["n"] <= sample else rows.where(F.pmod(F.xxhash64(F.lit(SEED + 1), "rid"), F.lit(2**31)) < int(2**31 * min(1.0, 2 * sample / size["n"])))
    drawn = few.orderBy(F.xxhash64(F.lit(SEED + 2), "rid"), "id").limit(sample).select("v").toArrow()
    index = Index(size["width"], math.frexp(size["top"])[1], np.zeros((1, 1)), 1)
    x = index.rotated(matrix(drawn.column("v"), index.width))
    index.centroids = centroids(x, max(1, min(LISTS, len(x) // 8, math.isqrt(size["n"]) // 4)))
    index.probes = calibrated(index, x, k, recall)
    return index


def listed(rows: DataFrame, index: Index) -> DataFrame:
    """Stored ``rows`` with list, the list of nearest centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = index.lists(index.rotated(matrix(b.column("v"), index.width))) if len(b) else np.zeros(0)
            yield b.append_column("list", pa.array(own.astype(np.int32)))

    return materialize(rows.select("id", "rid", "copies", "v").mapInArrow(run, "id long, rid long, copies long, v array<double>, list int"), "listed-rows")


def stored_chunks(rows: DataFrame, index: Index, sizes: dict[int, int]) -> tuple[DataFrame, list[int]]:
    """Stored chunks of the lists as column blocks with the lengths of what follows them, and the number of chunks by list."""
    width = max(BLOCK, 1 << max(0, index.width - 1).bit_length())
    most = max(16, CHUNK_BYTES // (4 * width + 8 * index.width))
    many = [max(1, -(-sizes.get(c, 0) // most)) for c in range(len(index.centroids))]
    chunk = F.pmod(F.xxhash64(F.lit(SEED + 3), "rid"), F.element_at(F.lit(many), F.col("list") + 1)).cast("int")
    spread = rows.withColumn("chunk", chunk).repartition("list", "chunk").sortWithinPartitions("list", "chunk", "id", "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (own, part), held in runs(batches, ["list", "chunk"]):
            v = matrix(held.column("v"), index.width)
            r = index.rotated(v).astype("<f4")
            blocks = [np.ascontiguousarray(r[:, at:at + BLOCK].T).tobytes() for at in range(0, width, BLOCK)]
            rest = np.sqrt(np.cumsum((r.astype(float) ** 2)[:, ::-1], 1)[:, ::-1][:, ::BLOCK]).T  # before each block
            raw = [held.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "rid", "copies")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own], pa.int32()), pa.array([part], pa.int32()), *(pa.array([x]) for x in raw), pa.array([blocks]),
                 pa.array([np.ascontiguousarray(rest).astype("<f8").tobytes()]), pa.array([v.astype("<f8").tobytes()])],
                ["list", "chunk", "ids", "rids", "copies", "blocks", "rest", "v"])

    schema = "list int, chunk int, ids binary, rids binary, copies binary, blocks array<binary>, rest binary, v binary"
    return materialize(spread.mapInArrow(run, schema), "search-chunks"), many


# --- scan ---------------------------------------------------------------------------------


@dataclass
class Scan:
    """What a scan did: coordinates summed, and those of a scan of all."""

    summed: int = 0
    all: int = 0


@dataclass
class Chunk:
    ids: np.ndarray
    rids: np.ndarray
    copies: np.ndarray
    blocks: list[np.ndarray]
    rest: np.ndarray
    v: np.ndarray

    @classmethod
    def of(cls, row: dict, width: int) -> Chunk:
        ids, rids, copies = (np.frombuffer(row[c], "<i8") for c in ("ids", "rids", "copies"))
        n = len(ids)
        return cls(ids, rids, copies, [np.frombuffer(b, "<f4").reshape(BLOCK, n) for b in row["blocks"]],
                   np.frombuffer(row["rest"], "<f8").reshape(-1, n), np.frombuffer(row["v"], "<f8").reshape(n, width))


def scan(chunk: Chunk, q: np.ndarray, v: np.ndarray, own: np.ndarray, bars: np.ndarray, k: int, shift: int, done: Scan | None = None):
    """(query, candidate, score) of what may be among the ``k`` best of each query.

    ``q`` are rotated queries, ``v`` the originals, ``own`` their rids, ``bars`` the
    least original score that is still of use (minus infinity if unknown).
    """
    dims = BLOCK * len(chunk.blocks)
    lengths = np.sqrt((q ** 2).sum(1))
    left = np.sqrt(np.cumsum((q ** 2)[:, ::-1], 1)[:, ::-1][:, ::BLOCK])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    best: list[np.ndarray] = [np.empty(0) for _ in q]
    bars = bars.copy()
    for lo in range(0, len(chunk.ids), STEP):
        hi = min(lo + STEP, len(chunk.ids))
        first = q[:, :BLOCK].astype(np.float32) @ chunk.blocks[0][:, lo:hi]  # the first block of all queries at once
        for i in range(len(q)):
            at = np.arange(lo, hi)
            part = first[i].astype(float)
            bar = math.ldexp(bars[i], -2 * shift) if np.isfinite(bars[i]) else -np.inf
            if done:
                done.all += dims * len(at)
                done.summed += BLOCK * len(at)
            for d in range(1, len(chunk.blocks) + 1):
                if np.isfinite(bar):
                    share = d * BLOCK / dims
                    slack = 1e-5 * lengths[i] * chunk.rest[0, at]  # of single precision
                    if share < 1:
                        spread = np.sqrt(share * (1 - share) * ((lengths[i] * chunk.rest[0, at]) ** 2 + bar * bar) / (dims + 2))
                        keep = (part + slack >= share * bar - Z * spread) & (part + left[i, d] * chunk.rest[d, at] + slack >= bar)
                    else:
                        keep = part + slack >= bar
                    at, part = at[keep], part[keep]
                if d == len(chunk.blocks) or not len(at):
                    break
                part = part + q[i, d * BLOCK:(d + 1) * BLOCK] @ chunk.blocks[d][:, at]
                if done:
                    done.summed += BLOCK * len(at)
            copies = chunk.copies[at] - (chunk.rids[at] == own[i])
            at, copies = at[copies > 0], copies[copies > 0]
            if not len(at):
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                score = (chunk.v[at] * v[i]).sum(1)
            score = np.where(np.isnan(score), -np.inf, score)
            high = score >= bars[i]
            at, score, copies = at[high], score[high], copies[high]
            out.append((np.full(len(at), i), at, score))
            seen = np.concatenate([best[i], np.repeat(score, np.minimum(copies, k))])
            if len(seen) >= k:  # the k-th score so far is the new bar
                best[i] = -np.partition(-seen, k - 1)[:k]
                bars[i] = max(bars[i], best[i].min())
            else:
                best[i] = seen
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, at, score = (np.concatenate(x) for x in zip(*out))
    keep = score >= bars[row]
    return row[keep], at[keep], score[keep]


FOUND = "query long, query_rid long, id long, rid long, copies long, score double"


def scanned(copies: DataFrame, chunks: DataFrame, many: list[int], index: Index, k: int) -> DataFrame:
    """Stored results of queries (id, rid, v, bar, list) on all chunks of their lists, in groups of ``QUERIES``."""
    spark = copies.sparkSession
    counted = {r["list"]: r["n"] for r in copies.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # lists at most
    groups = [max(1, -(-counted.get(c, 0) // QUERIES)) for c in range(len(many))]
    if not counted:
        return spark.createDataFrame([], FOUND)
    # Equal group sizes by a running number would need an order; a hash is even enough.
    asked = copies.withColumn("group", F.pmod(F.xxhash64(F.lit(SEED + 4), "rid"), F.element_at(F.lit(groups), F.col("list") + 1)).cast("int"))
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.element_at(F.lit(many), F.col("list") + 1) - 1)))
    wanted = F.array_contains(F.lit(sorted(counted)), F.col("list"))
    held = chunks.where(wanted).withColumn("group", F.explode(F.sequence(F.lit(0), F.element_at(F.lit(groups), F.col("list") + 1) - 1)))
    by = ["list", "chunk", "group"]
    width, shift = index.width, index.shift

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = pa.schema([(n, pa.float64() if n == "score" else pa.int64()) for n in (c.split()[0] for c in FOUND.split(", "))])
        if not len(left) or not len(right):
            return kinds.empty_table()
        chunk = Chunk.of({c: right.column(c)[0].as_py() for c in ("ids", "rids", "copies", "blocks", "rest", "v")}, width)
        v = matrix(left.column("v"), width)
        rid, ids = left.column("rid").to_numpy(), left.column("id").to_numpy()
        row, at, score = scan(chunk, index.rotated(v), v, rid, left.column("bar").to_numpy(), k, shift)
        copies_ = chunk.copies[at] - (chunk.rids[at] == rid[row])
        return pa.table([ids[row], rid[row], chunk.ids[at], chunk.rids[at], copies_, score], schema=kinds)

    found = asked.select("id", "rid", "v", "bar", *by).groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(run, FOUND)
    return materialize(found, "found-neighbours")


def neighbours(vectors: DataFrame, k: int = K, every: int = EVERY, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each query, a row whose vec_id ``every`` divides."""
    spark = vectors.sparkSession
    prepare_python(spark)
    rows = usable(vectors)
    index = fit(rows, k, sample, recall)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = listed(rows, index)
    by_list = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum(F.least("copies", F.lit(k + 1))).alias("copies")).collect()  # lists at most
    sizes = {r["list"]: r["n"] for r in by_list}
    chunks, many = stored_chunks(rows, index, sizes)
    queries = probed(rows.where((F.col("id") % every == 0) & (F.col("id") != LAST_ID)), index, {r["list"]: r["copies"] for r in by_list}, k)
    best = scanned(queries.select("id", "rid", "v", F.lit(float("-inf")).alias("bar"), F.col("lists")[0].alias("list")), chunks, many, index, k)
    bars = materialize(_ranked(best, k).groupBy("query", "query_rid").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bar")), "bars")
    others = queries.join(bars, (queries["id"] == bars["query"]) & (queries["rid"] == bars["query_rid"]), "left").select(
        "id", "rid", "v", F.coalesce("bar", F.lit(float("-inf"))).alias("bar"), F.explode(F.slice("lists", 2, F.greatest(F.size("lists") - 1, F.lit(0)))).alias("list"))
    rest = scanned(materialize(others, "probes"), chunks, many, index, k)
    ranked = _ranked(best.union(rest), k).join(
        queries.select(F.col("id").alias("query"), F.col("rid").alias("query_rid"), F.col("copies").alias("askers")), ["query", "query_rid"])
    return ranked.withColumn("asker", F.explode(F.sequence(F.lit(1), F.col("askers")))).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.when(F.col("id") != LAST_ID, F.col("id")).alias("vec_id"), "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; a row with copies takes as many ranks."""
    asked = Window.partitionBy("query", "query_rid").orderBy(F.desc("score"), "id", "rid")
    few = found.withColumn("place", F.row_number().over(asked)).where(F.col("place") <= k)
    each = few.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    every = Window.partitionBy("query", "query_rid").orderBy("place", "copy")
    return each.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k).drop("place", "copy")


def probed(rows: DataFrame, index: Index, sizes: dict[int, int], k: int) -> DataFrame:
    """Stored ``rows`` with lists: those a query probes, best first, until the calibrated number and ``k`` rows besides its own."""
    held = np.array([sizes.get(c, 0) for c in range(len(index.centroids))], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            order = index.order(index.rotated(matrix(b.column("v"), index.width)))
            enough = (np.cumsum(held[order], 1) >= k + 1)
            need = np.where(enough.any(1), enough.argmax(1) + 1, order.shape[1])
            lists = [row[:max(index.probes, m)].astype(np.int32) for row, m in zip(order, need.tolist())]
            lists = [row[held[row] > 0] for row in lists]
            yield b.append_column("lists", pa.array(lists, pa.list_(pa.int32())))

    schema = "id long, rid long, copies long, v array<double>, lists array<int>"
    return materialize(rows.select("id", "rid", "copies", "v").mapInArrow(run, schema), "queries")
