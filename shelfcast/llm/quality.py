"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and word pairs are hashed to ``BUCKETS`` buckets. The raw model counts
every document; the target model counts those of a bounded sample of labelled
rows (``SAMPLE``, the least hashes of the id) that are good and not toxic. A
document's log weight is the sum over its n-grams of log(target / raw), brought
to a common length of ``LENGTH`` n-grams so that long texts do not win by
length; ``SHORT`` n-grams of ratio 1 are added, so a few odd words do not
condemn a short text. Gumbel noise from a hash of the row makes the k largest
keys a sample without replacement, proportional to the weights. Half of the
sample fits the model, the other half says which k keeps ``keep`` of the good rows.

Results: a NULL or empty text has log weight 0. Labels with NULL id or quality
are no labels; of several for one id the worst counts. Without good labelled
rows in both halves nothing is rejected. Repeated rows share key and decision;
ties at the k-th key stay together. Of several held-out rows with one labelled id
the least key says which k is needed. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import free_name, hash_of, id_of, keyed, materialize, prepare_python
from shelfcast.llm.sharding import boundaries

BUCKETS = 1 << 16
SAMPLE = 40_000
LENGTH, SHORT = 200.0, 20.0
MIX, NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def ngram_buckets(text: bytes) -> np.ndarray:
    """Buckets of all words and pairs of neighbouring words of a text."""
    words = text.lower().split()
    h = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)).astype(np.uint64) * MIX
    grams = np.concatenate([h, h[:-1] * NEXT + h[1:]])
    return (grams >> np.uint64(64 - 16)).astype(np.int64)


def labelled_sample(labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """(label_id, good, fits): a bounded sample of labelled rows, half of them to fit and half to calibrate."""
    one = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.min(F.when(F.coalesce(F.col("toxic"), F.lit(0)) == 0, F.col("quality")).otherwise(0)).alias("good"))
    one = one.withColumn("h", F.xxhash64("label_id")).orderBy("h", "label_id").limit(rows)
    return one.select("label_id", (F.col("good") == 1).alias("good"), (F.pmod("h", F.lit(2)) == 0).alias("fits"))


def _counts(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Exact n-gram counts per bucket: of the target half of the sample, and of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for text, hit in zip(b.column("text").to_pylist(), b.column("hit").to_pylist()):
                buckets, n = np.unique(ngram_buckets(text), return_counts=True)
                raw[buckets] += n
                if hit:
                    target[buckets] += n
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(raw[used], pa.int64()), pa.array(target[used], pa.int64())], ["bucket", "raw", "target"])

    prepare_python(docs.sparkSession)
    fits = sample.where("good and fits").select(F.col("label_id").alias("id"), F.lit(True).alias("hit"))
    rows = keyed(docs).join(F.broadcast(fits), "id", "left")  # at most SAMPLE ids
    rows = rows.select(F.col("text").cast("binary").alias("text"), F.coalesce("hit", F.lit(False)).alias("hit"))
    summed = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in summed.collect():  # one row per bucket at most
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(target / raw) per bucket; the target model is smoothed towards the raw one where it has seen little."""
    p = (raw + 1.0) / (raw.sum() + BUCKETS)
    if not target.sum():
        return np.zeros(BUCKETS)
    prior = 0.05 * target.sum() + 1.0
    q = (target + prior * p) / (target.sum() + prior)
    return np.log(q / p)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> tuple[np.ndarray, DataFrame]:
    """Log ratio of each bucket, and the sample that was used."""
    sample = materialize(labelled_sample(labels, rows), "label-sample")
    return log_ratios(*_counts(docs, sample)), sample


def log_weight(ratios: np.ndarray, text: Column) -> Column:
    """Log importance weight of a text, at the common length."""

    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            grams = ngram_buckets(t)
            out.append(float(np.round(LENGTH * ratios[grams].sum() / (len(grams) + SHORT), 9)))
        return pa.array(out, pa.float64())

    return weigh(F.coalesce(text, F.lit("")).cast("binary"))


def gumbel(id_: Column, th: Column, seed: int) -> Column:
    """Standard Gumbel noise that a row always gets again."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_, th), 11)
    return -F.log(-F.log((bits.cast("double") + 0.5) / 2.0**53))


def ordered(key: Column) -> Column:
    """A finite double as a long of the same order, to 1e-9."""
    return F.round(key * 1e9).cast("long")


def score(docs: DataFrame, ratios: np.ndarray, seed: int = 17) -> DataFrame:
    """``docs`` with log_weight and sort_key (with a ``_`` where the name is taken)."""
    w, k = free_name(docs, "log_weight"), free_name(docs, "sort_key")
    out = docs.withColumn(w, log_weight(ratios, docs["text"]))
    return out.withColumn(k, ordered(F.col(w) + gumbel(id_of(out), hash_of(out), seed)))


def calibrated_k(keys: DataFrame, sample: DataFrame, keep: float = 0.995) -> int:
    """How many rows of ``keys`` (id, k1) the top k must hold so that ``keep`` of the held-out good rows are among them."""
    held = keys.join(F.broadcast(sample.where("good and not fits")), F.col("id") == F.col("label_id")).groupBy("id").agg(F.min("k1").alias("k1"))
    values = np.sort([r["k1"] for r in held.collect()])  # one row per label, at most SAMPLE
    if not len(values):
        return keys.count()
    least = int(values[int((1 - keep) * len(values))])
    return keys.where(F.col("k1") >= least).count()


def top_k_key(keys: DataFrame, k: int) -> tuple[int, int]:
    """The key (k1, k2) from which on ``k`` rows lie (more at a tie), found by counting between candidate keys."""
    total = keys.count()
    if k >= total:
        return (-(2**63), -(2**63))
    return boundaries(keys.withColumn("size", F.lit(1).cast("long")), [total - k], 0, 1)[0]


def _weighed(
    docs: DataFrame, labels: DataFrame, k: int | None, keep: float, seed: int,
) -> tuple[np.ndarray, DataFrame, tuple[int, int]]:
    """Log ratios, the stored (doc_id, id, log_weight, k1, k2) of every row, and the key from which on rows are kept."""
    ratios, sample = fit(docs, labels)
    scored = score(docs, ratios, seed)
    w, s = scored.columns[-2:]
    keys = materialize(scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), id_of(scored).alias("id"), F.col(w).alias("log_weight"), F.col(s).alias("k1"),
        hash_of(scored).alias("k2")), "quality-keys")
    return ratios, keys, top_k_key(keys.select("id", "k1", "k2"), calibrated_k(keys, sample, keep) if k is None else k)


def at_least(k1: Column, k2: Column, cut: tuple[int, int]) -> Column:
    return (k1 > cut[0]) | ((k1 == cut[0]) & (k2 >= cut[1]))


def decisions(docs: DataFrame, labels: DataFrame, k: int | None = None, keep: float = 0.995, seed: int = 17) -> DataFrame:
    """(doc_id, log_weight, sort_key, kept) of every row, without its text: each text is weighed once."""
    _, keys, cut = _weighed(docs, labels, k, keep, seed)
    return keys.select("doc_id", "log_weight", F.col("k1").alias("sort_key"), at_least(F.col("k1"), F.col("k2"), cut).alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, keep: float = 0.995, seed: int = 17) -> DataFrame:
    """``docs`` with log_weight, sort_key and kept (with a ``_`` where a name is taken); k rows are kept, by default the calibrated number.

    Texts are weighed again for the result: an exchange of whole texts with their stored keys would cost more.
    """
    ratios, _, cut = _weighed(docs, labels, k, keep, seed)
    scored = score(docs, ratios, seed)
    return scored.withColumn(free_name(scored, "kept"), at_least(F.col(scored.columns[-1]), hash_of(scored), cut))
