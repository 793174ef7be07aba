"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe, verified pairs.

Vectors are compared inside their label. Equal vectors are one representative
with a count. Per table a representative is rotated (sign flips and Hadamard
transforms, three times); its bucket is the nearest vertex of the
cross-polytope in each of four parts of the coordinates. It also
probes the buckets of the next best vertices, so a pair that a vertex border
separates still meets. Members of a bucket are compared exactly, in double precision. A
bucket is cut into chunks of ``CHUNK`` rows and each pair of chunks is a task's
work of its own, so a bucket of any size is compared whole and never in one task.
A pair that meets in several buckets counts in the least of them only.

Only counts of links and a spanning set of links leave a chunk pair, not its pairs.

Results: vectors that are NULL, empty, zero or hold NULL or non-finite
components, and those with a NULL label, have no links. Vectors of other length
do not link. A NULL vec_id ranks behind all others and its component is NULL only if it has no other
member. Repeated rows are vectors of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import LAST_ID, materialize, prepare_python, runs
from shelfcast.llm.components import components, spanning

TABLES, PROBES, PARTS, CHUNK = 6, 8, 4, 512
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two long), scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    """A pseudo-random rotation of the rows, padded with zeros to a power of two."""
    n = max(PARTS, 1 << int(x.shape[1] - 1).bit_length())
    signs = np.random.default_rng([SEED, table, n]).choice([-1.0, 1.0], (3, n))
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    for s in signs:
        x = hadamard(x * s)
    return x


def probes(x: np.ndarray, table: int, n: int = PROBES) -> np.ndarray:
    """Buckets of each row in a table: its own and those that the cheapest changes of a vertex reach.

    The rotated vector is cut into ``PARTS`` parts, each hashed to its nearest
    vertex (largest absolute coordinate and its sign). Besides the bucket
    itself, those with one or two vertices replaced by the next best are
    probed, in the order of how far the vertices fall short.
    """
    r = rotate(x, table)
    width = r.shape[1] // PARTS
    rows = np.arange(len(x))
    base, ranks, gaps = np.zeros(len(x), np.int64), [], []
    for at in range(PARTS):
        part = r[:, at * width:(at + 1) * width]
        both = np.concatenate([part, -part], 1)
        order = np.argsort(-both, 1, kind="stable")[:, :3]
        value = np.take_along_axis(both, order, 1)
        unit = (2 * width) ** at
        base += order[:, 0] * unit
        ranks.append((order[:, 1:] - order[:, :1]) * unit)
        gaps.append((value[:, :1] - value[:, 1:]) ** 2)
    change, cost = np.concatenate(ranks, 1), np.concatenate(gaps, 1)
    moves, prices = [np.zeros((len(x), 1), np.int64), change], [np.zeros((len(x), 1)), cost]
    for a in range(change.shape[1]):
        for b in range(a + 1, change.shape[1]):
            if a // 2 != b // 2:  # two changes, of different parts
                moves.append((change[:, a] + change[:, b])[:, None])
                prices.append((cost[:, a] + cost[:, b])[:, None])
    moves, prices = np.concatenate(moves, 1), np.concatenate(prices, 1)
    best = np.argsort(prices, 1, kind="stable")[:, :n]
    return base[:, None] + moves[rows[:, None], best]


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (id, vec_id, label, v; v is NULL if the vector is unusable) and classes of equal ones (rep, label, v, n, first)."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    usable = F.col("label").isNotNull() & finite & F.exists(numbers, lambda x: x != 0)
    rows = vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"), F.when(usable, F.transform(numbers, lambda x: x + F.lit(0.0))).alias("v"))
    classes = rows.where("v is not null").groupBy("label", "v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    return rows, classes.withColumn("rep", F.xxhash64("first", "label", "v"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Equally long lists as the rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows with a largest component of about one, by powers of two: cosines stay and cannot overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def hashed(classes: DataFrame, tables: int = TABLES, n: int = PROBES) -> DataFrame:
    """``classes`` with size (of the vector) and keys (the probed buckets of all tables, ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.diff(b.column("v").offsets.to_numpy())
            for size in np.unique(sizes):
                part = b.take(pa.array(np.flatnonzero(sizes == size)))
                x = _scaled(_matrix(part.column("v")))
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = np.concatenate([probes(x, t, n) + (t << 48) for t in range(tables)], 1)
                keys.sort(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rep", "label", "v", "n", "first")), pa.array(np.full(len(part), size, np.int32)),
                     pa.array(list(keys), pa.list_(pa.int64()))], ["rep", "label", "v", "n", "first", "size", "keys"])

    prepare_python(classes.sparkSession)
    return classes.select("rep", "label", "v", "n", "first").mapInArrow(
        run, "rep long, label long, v array<double>, n long, first long, size int, keys array<long>")


def compare(x: dict, y: dict, key: int, least: float, same: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of a chunk pair of bucket ``key``: (reps, number of vectors linked to each, one rep of its component here).

    A pair that shares a lesser bucket counts there and not here.
    """
    dot = x["v"] @ y["v"].T
    hit = dot / (x["norm"][:, None] * y["norm"]) >= least
    earlier = np.unique(np.concatenate([k["keys"][k["keys"] < key] for k in (x, y)]))
    if len(earlier):
        a, b = (_held(k["keys"], earlier) for k in (x, y))
        hit &= (a @ b.T) == 0
    if same:
        np.fill_diagonal(hit, False)
    # A vector is a row and a column of one chunk, which the diagonal ties together.
    rows, columns = spanning(hit | np.eye(len(hit), dtype=bool) if same else hit)
    out = [(x["rep"], hit @ y["n"], x["rep"][rows])]
    return out if same else [*out, (y["rep"], hit.T @ x["n"], x["rep"][np.minimum(columns, len(rows) - 1)])]


def _held(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """1 where a row holds a wanted key."""
    at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    out = np.zeros((len(keys), len(wanted)), np.float32)
    row, column = np.nonzero(wanted[at] == keys)
    out[row, at[row, column]] = 1
    return out


def linked(stored: DataFrame, least: float = 0.98, chunk: int = CHUNK) -> DataFrame:
    """(rep, n, root): per chunk pair the vectors linked to a class, and a class that links connect it to."""
    bucket = ["label", "size", "key"]
    entries = stored.select("rep", "label", "size", F.explode("keys").alias("key"))
    shared = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    chunks = F.ceil(F.col("members") / chunk).cast("int")
    own = F.pmod(F.xxhash64(F.lit(SEED), "rep"), chunks).cast("int")
    dealt = entries.join(materialize(shared, "shared-buckets"), bucket).select(
        "rep", *bucket, own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
    pair = dealt.select("rep", *bucket, "own", F.least("own", "other").alias("ca"), F.greatest("own", "other").alias("cb"))
    group = [*bucket, "ca", "cb"]
    rows = pair.join(stored.select("rep", "v", "n", "keys"), "rep").repartition(*group).sortWithinPartitions(*group, "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, both in runs(batches, group):
            v, own_ = _scaled(_matrix(both.column("v").combine_chunks())), both.column("own").to_numpy()
            whole = {"v": v, "norm": np.linalg.norm(v, axis=1), "keys": _matrix(both.column("keys").combine_chunks()),
                     "rep": both.column("rep").to_numpy(), "n": both.column("n").to_numpy()}
            first = own_ == key[3]
            x = {c: a[first] for c, a in whole.items()}
            y = x if key[3] == key[4] else {c: a[~first] for c, a in whole.items()}
            if not len(x["rep"]) or not len(y["rep"]):
                continue
            for rep, n, root in compare(x, y, key[2], least, key[3] == key[4]):
                used = n > 0
                if used.any():
                    yield pa.RecordBatch.from_arrays([pa.array(a[used]) for a in (rep, n, root)], ["rep", "n", "root"])

    return rows.mapInArrow(run, "rep long, n long, root long")


def near_duplicates(vectors: DataFrame, least: float = 0.98, tables: int = TABLES, n: int = PROBES, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    rows, classes = distinct_vectors(vectors)
    stored = materialize(hashed(classes, tables, n), "hashed-vectors")
    found = materialize(linked(stored, least, chunk), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("linked"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (
        stored.select("rep", "label", "v", "n", "first").join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(counts, "rep", "left")
        .select("label", "v", "first", F.coalesce("root", "rep").alias("root"), (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("links"))
    )
    named = materialize(named, "vector-classes")
    least_id = named.groupBy("root").agg(F.min("first").alias("least"))
    classes = named.join(least_id, "root").select("label", "v", "least", "links")
    out = rows.join(classes, ["label", "v"], "left").withColumn("component", F.coalesce("least", "id"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("component") != LAST_ID, F.col("component")).alias("component_id"), (F.col("component") == F.col("id")).alias("kept"))
