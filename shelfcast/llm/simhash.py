"""SimHash near-dedup: pigeonhole blocks, join on blocks, Hamming check, connected components.

A fingerprint is split into four blocks of 16 bits. Two fingerprints that
differ in at most two bits agree in at least two blocks, so every pair of
blocks is a join key of 32 bits: six keys per distinct fingerprint. Copies
share a fingerprint and take part once. Buckets of up to ``BUCKET`` members
are joined with themselves and checked by bit count. A fuller bucket is linked
through the fingerprints at one bit's distance instead: two members differ in
at most two bits exactly if such a centre is common to both, and a centre has
65 members at most. So a bucket of any size costs a fixed number of rows per
member and loses no link.

Results: a NULL or empty text, or one of blanks alone, has fingerprint zero,
linked like any other. A text of fewer words than a shingle is one shingle. A
NULL doc_id ranks behind all other ids and its component is NULL only if it has
no other member. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.llm.common import LAST_ID, free_name, hash_of, id_of, keyed, materialize, prepare_python, runs
from shelfcast.llm.components import components, spanning

PARTS = [0xFFFF << s for s in (0, 16, 32, 48)]
KEYS = [a | b for a, b in combinations(PARTS, 2)]
BUCKET, PAIRED, CHUNK, TEXTS = 64, 6, 2048, 128
SEED = 42
# Bands of least shingle hashes: texts of a Jaccard similarity j agree in none of them with a chance of (1 - j**DEPTH)**BANDS,
# which is 5e-8 at 0.8, whatever the length of the texts and wherever they differ.
BANDS, DEPTH = 32, 4
_FLIPS, _ODD = (np.array([xxhash.xxh64_intdigest(f"{n} {i}", SEED) | 1 for i in range(BANDS * DEPTH)], "<u8") for n in ("flip", "odd"))


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def simhash(text: bytes, words: int = 3, distinct: bool = False) -> int:
    """Fingerprint as a signed 64-bit number: a bit is set if over half of the shingle hashes (of the distinct ones) have it."""
    parts = text.lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        shingles = [b" ".join(parts)]
    else:
        shingles = list(map(b" ".join, zip(*[parts[i:] for i in range(words)])))
    if distinct:
        shingles = set(shingles)
    return _majority(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8"))


def _majority(hashes: np.ndarray) -> int:
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, distinct: bool = False) -> DataFrame:
    """(id, th, doc_id, fp) of every document."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([simhash(t, words, distinct) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), b.column("doc_id"), fps], ["id", "th", "doc_id", "fp"])

    rows = keyed(docs).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(run, "id long, th long, doc_id long, fp long")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint_and_bands(text: bytes, words: int) -> tuple[int, np.ndarray]:
    """``simhash(text, 1, distinct=True)``, and the band keys of the shingles of ``words`` words (none without a word)."""
    parts = text.lower().split()
    if not parts:
        return 0, np.zeros(0, np.int64)
    known = {p: xxhash.xxh64_intdigest(p, SEED) for p in set(parts)}
    each = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    shingles = _mixed(sum(each[i:len(each) - size + 1 + i] * _ODD[i] for i in range(size)))
    least = np.full(BANDS * DEPTH, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 1 << 12):
        np.minimum(least, ((shingles[at:at + (1 << 12), None] ^ _FLIPS) * _ODD).min(0), out=least)
    bands = (_mixed(least).reshape(BANDS, DEPTH) * _ODD[:DEPTH]).sum(1, dtype=np.uint64) + _FLIPS[:BANDS]
    return _majority(np.fromiter(known.values(), np.uint64, len(known))), _mixed(bands).view(np.int64)


def word_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(id, th, fp, bands) of every document: the fingerprint of its distinct words and the band keys of its shingles."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint_and_bands(t, words) for t in b.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(k) for _, k in found)], dtype=np.int32)
            keys = np.concatenate([np.zeros(0, np.int64), *(k for _, k in found)])
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))
            fps = pa.array([f for f, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), fps, bands], ["id", "th", "fp", "bands"])

    rows = keyed(docs).select("id", "th", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, th long, fp long, bands array<long>")


def band_links(rows: DataFrame) -> DataFrame:
    """(a, b): links that connect the fingerprints of ``rows`` (fp, bands) whose texts share a band key: stars around the least."""
    keys = rows.select("fp", F.explode("bands").alias("key"))
    least = F.min("fp").over(Window.partitionBy("key"))
    return keys.select(least.alias("a"), F.col("fp").alias("b")).where("a <> b").distinct()


def _shared(entries: DataFrame) -> DataFrame:
    """Exploded ``entries`` (k, v, fp) of keys that several of them have, with their number n.

    Merged by key: Spark sizes exploded rows as if they were the rows before, so it would broadcast many times what it allows.
    """
    sizes = entries.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return entries.hint("merge").join(sizes, ["k", "v"])


def links(fps: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links of distinct fingerprints ``fps`` (fp) that connect all pairs at ``distance`` bits or fewer, and no others."""
    if distance not in (0, 1, 2):
        raise ValueError("four blocks of which two agree find up to two differing bits")
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for i, m in enumerate(KEYS)
    ])).alias("key")
    blocks = fps.select("fp", keys).select("key.k", "key.v", "fp")
    blocks = materialize(_shared(blocks), "simhash-blocks")
    few = blocks.where(F.col("n") <= bucket).select("k", "v", F.col("fp").alias("a"))
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    joined = few.join(few.withColumnRenamed("a", "b"), ["k", "v"]).where((F.col("a") < F.col("b")) & (differ <= distance)).select("a", "b")
    full = blocks.where(F.col("n") > bucket).select("fp").distinct()
    ones = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    centres = full.select("fp", F.explode(ones).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    members = centres.groupBy("centre").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    if distance == 2:  # any two members of a centre are linked: a star joins them all
        around = members.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    else:
        around = members.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    around = around.where((F.col("a") != F.col("b")) & (differ <= distance))
    return joined.union(around)


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(id, th, doc_id, fp, component_id) of every document; component_id is the smallest doc_id reachable by links."""
    rows = materialize(fingerprints(docs, words), "fingerprints")
    first = materialize(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = components(links(first.select("fp"), distance, bucket))
    member = first.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    member = materialize(member, "members")
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    out = rows.join(named, "fp")
    return out.select("id", "th", "doc_id", "fp", F.when(F.col("component_id") != LAST_ID, F.col("component_id")).alias("component_id"))


def block_masks(blocks: int, agree: int) -> list[int]:
    """Bits of every choice of ``agree`` of ``blocks`` equal blocks."""
    width = 64 // blocks
    each = [((1 << width) - 1) << (width * i) for i in range(blocks)]
    return [sum(c) for c in combinations(each, agree)]


def wide_links(fps: DataFrame, distance: int, blocks: int, agree: int, bucket: int = PAIRED, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fps`` (fp) at ``distance`` bits or fewer that agree in ``agree`` blocks.

    Up to ``blocks - agree`` differing bits that is certain. Buckets of a few
    are joined with themselves; larger ones are cut into chunks, every pair of
    chunks is compared as a matrix, and its links are returned as stars around
    least members, so a group of near copies gives few links, not all its pairs.
    """
    prepare_python(fps.sparkSession)
    masks = block_masks(blocks, agree)
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for i, m in enumerate(masks)
    ])).alias("key")
    entries = fps.select("fp", keys).select("key.k", "key.v", "fp")
    stored = materialize(_shared(entries), "wide-blocks")
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    few = stored.where(F.col("n") <= bucket).select("k", "v", F.col("fp").alias("a"))
    joined = few.join(few.withColumnRenamed("a", "b"), ["k", "v"]).where((F.col("a") < F.col("b")) & (differ <= distance)).select("a", "b")
    pairs = _chunk_pairs(stored.where(F.col("n") > bucket), ["k", "v"], "fp", chunk)
    group = ["k", "v", "ca", "cb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in runs(batches, group):
            fp, own = rows.column("fp").to_numpy(), rows.column("own").to_numpy()
            x = fp[own == key[2]]
            y = x if key[2] == key[3] else fp[own == key[3]]
            if len(x) and len(y):
                hit = np.bitwise_count(x[:, None].view(np.uint64) ^ y[None].view(np.uint64)) <= distance
                yield _star(hit, x, y)

    full = pairs.repartition(*group).sortWithinPartitions(*group, "fp").mapInArrow(run, "a long, b long")
    return joined.union(full).distinct()


def _chunk_pairs(rows: DataFrame, by: list[str], member: str, chunk: int) -> DataFrame:
    """Rows of groups (``by``, size n) dealt to chunks ``own``, once for each pair (ca, cb) of chunks that holds them."""
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64(F.lit(SEED), member), chunks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return dealt.withColumns({"ca": F.least("own", "other"), "cb": F.greatest("own", "other")}).drop("other", "n")


def _star(hit: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Links (a, b) that connect what the matrix of links connects."""
    rows, columns = spanning(hit)
    used = columns < len(x)
    a, b = np.concatenate([x, y[used]]), np.concatenate([x[rows], x[columns[used]]])
    return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])


def shingle_ids(text: bytes, words: int) -> np.ndarray:
    """Ascending distinct hashes of the shingles of a text."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.int64)
    shingles = map(b" ".join, zip(*[parts[i:] for i in range(words)])) if len(parts) > words else [b" ".join(parts)]
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in set(shingles)], "<u8").view(np.int64))


def shared_counts(x: list[np.ndarray], y: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """Matrix of the numbers of hashes that each of ``x`` shares with each of ``y``."""
    both = np.intersect1d(*(np.unique(np.concatenate(s)) for s in (x, y)), assume_unique=True)
    total = np.zeros((len(x), len(y)), np.float32)
    for at in range(0, len(both), width):
        total += _incidence(x, both[at:at + width]) @ _incidence(y, both[at:at + width]).T
    return total


def _incidence(sets: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(wanted)), np.float32)
    for i, s in enumerate(sets):
        out[i, np.searchsorted(wanted, s[np.isin(s, wanted, assume_unique=True)])] = 1
    return out


def verified_links(texts: DataFrame, least: float, words: int, chunk: int = TEXTS) -> DataFrame:
    """(a, b): links of texts (root, n texts of the root, th, text) that connect, inside each root, those of a Jaccard similarity of ``least`` or more.

    Exact, on the distinct shingles of the whole texts; chunk pairs of a root are compared apart.
    """
    prepare_python(texts.sparkSession)
    group = ["root", "ca", "cb"]
    pairs = _chunk_pairs(texts, ["root"], "th", chunk).withColumn("text", F.col("text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in runs(batches, group):
            th, own = rows.column("th").to_numpy(), rows.column("own").to_numpy()
            sets = [shingle_ids(t.as_py(), words) for t in rows.column("text")]
            i = np.flatnonzero(own == key[1])
            j = i if key[1] == key[2] else np.flatnonzero(own == key[2])
            if not len(i) or not len(j):
                continue
            x, y = [sets[a] for a in i], [sets[b] for b in j]
            both = shared_counts(x, y)
            union = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y]) - both
            yield _star((both >= least * union - 1e-6), th[i], th[j])

    return pairs.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "a long, b long")


def near_copies(
    docs: DataFrame, least: float = 0.8, words: int = 5, distance: int = 10, blocks: int = 8, agree: int = 3,
) -> DataFrame:
    """(id, th) of the documents to keep: one of each group of near copies, by SimHash candidates and an exact check.

    Candidates are fingerprints of the distinct words, which change little with
    a small edit, and texts that share a band of least shingle hashes, which
    finds what the blocks miss (cut or appended text, short texts); texts that
    candidates connect are then compared by the Jaccard similarity of their
    shingles of ``words`` words. Equal texts are one.
    """
    rows = materialize(word_fingerprints(docs, words), "word-fingerprints")
    texts = materialize(rows.groupBy("th").agg(F.min("fp").alias("fp"), F.min("id").alias("first")), "distinct-texts")
    close = wide_links(texts.select("fp").distinct(), distance, blocks, agree)
    roots = components(close.union(band_links(rows)))
    grouped = texts.join(roots, F.col("fp") == F.col("node"), "left").select("th", "first", F.coalesce("root", "fp").alias("root"))
    grouped = materialize(grouped, "candidate-groups")
    # Stored, so that the join's own exchanges can be split at a large group.
    sizes = materialize(grouped.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "group-sizes")
    asked = materialize(grouped.join(sizes, "root"), "candidate-texts")
    whole = keyed(docs).select("id", "th", "text").join(asked.select("th", F.col("first").alias("id"), "root", "n"), ["id", "th"])
    whole = whole.select("root", "n", "th", "text")
    found = components(verified_links(whole, least, words))
    named = texts.join(found, F.col("th") == F.col("node"), "left").select("th", "first", F.coalesce("root", "th").alias("root"))
    best = named.groupBy("root").agg(F.min(F.struct("first", "th")).alias("best"))
    return best.select(F.col("best.first").alias("id"), F.col("best.th").alias("th"))


def drop_near_duplicates(docs: DataFrame, least: float = 0.8, words: int = 5) -> DataFrame:
    """``docs`` with one row of each group of near copies: of the smallest doc_id; of repeated rows one."""
    n = {c: free_name(docs, f"keep_{c}") for c in ("id", "th", "row")}
    keep = near_copies(docs, least, words).toDF(n["id"], n["th"])
    order = Window.partitionBy(n["id"], n["th"]).orderBy(n["id"])
    once = docs.withColumns({n["id"]: id_of(docs), n["th"]: hash_of(docs)}).withColumn(n["row"], F.row_number().over(order))
    return once.where(F.col(n["row"]) == 1).join(keep, [n["id"], n["th"]], "left_semi").select(*docs.columns)
