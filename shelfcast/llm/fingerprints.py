"""Document fingerprints: bottom-k sketches of shingle hashes, mergeable, for resemblance, containment and distinct counts.

A fingerprint is the ascending array of the ``k`` smallest distinct 64-bit
hashes of a text's shingles of five words. It holds every shingle when there
are at most k of them, and all figures are then exact. Everything is DataFrame
functions on the main path.

Results: a NULL or empty text, or one of blanks alone, has the empty
fingerprint; two empty ones resemble each other by 1, an empty and another by
0. A text of fewer than five words is one shingle. Equal texts have equal
fingerprints. Words are lower-cased and split at blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.common import LAST_ID, keyed, materialize

WORDS, K = 5, 128
SPAN = 2.0**64


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all shingles of a text, repeats included."""
    parts = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    hashed = F.transform(parts, lambda w: F.xxhash64(w))
    # Each step of the sequence reads the same array of word hashes.
    runs = F.transform(F.array(hashed), lambda h: F.when(
        F.size(h) >= words,
        F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)])),
    ).when(F.size(h) > 0, F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " ")))).otherwise(F.array().cast("array<bigint>")))
    return F.get(runs, F.lit(0))


def fingerprint(text: Column, words: int = WORDS, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Fingerprint of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_fingerprints(df: DataFrame, by: list[str], column: str = "fingerprint", k: int = K) -> DataFrame:
    """Fingerprint of each group of ``by``: the k least hashes of its members' fingerprints.

    Members are first merged within salted parts of the group, whose distinct
    hashes a window cuts to k, so that no task holds all hashes of a large group.
    """
    salt = df.select(*by, F.explode(column).alias("h")).withColumn("salt", F.pmod("h", F.lit(64)))
    least = Window.partitionBy(*by, "salt").orderBy("h")
    part = salt.distinct().withColumn("r", F.row_number().over(least)).where(F.col("r") <= k)
    return part.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias(column))


def distinct_count(a: Column, k: int = K) -> Column:
    """Distinct shingles: exact below k, else (k - 1) over the share of hash space that the k least fill."""
    share = (F.element_at(a, -1).cast("double") + SPAN / 2) / SPAN
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Jaccard similarity of the shingle sets: the share of the k least of the union that both hold."""
    union = F.array_union(a, b)
    least = F.when((F.size(a) < k) & (F.size(b) < k), union).otherwise(F.slice(F.sort_array(union), 1, k))
    both = F.size(F.array_intersect(least, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(least))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of the shingles of ``a`` that ``b`` holds too."""
    union = distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_count(a, k)))


def successors(ids: DataFrame) -> DataFrame:
    """(id, next_id) of the distinct ids in ascending order, the last followed by the first; other columns stay.

    Ids are range-partitioned; inside a partition the next id comes from a
    window, and the last id of a partition is followed by the first of the next
    one that has rows: a table with one row per partition.
    """
    parts = materialize(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "ordered-ids")
    firsts = parts.groupBy("part").agg(F.min("id").alias("first"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(Window.orderBy("part")), F.min("first").over(every)).alias("after"))
    inside = F.lead("id").over(Window.partitionBy("part").orderBy("id"))
    return parts.withColumn("inside", inside).join(F.broadcast(after), "part").select(
        *ids.columns, F.coalesce("inside", "after").alias("next_id"))


def edited_pairs(docs: DataFrame, words: int = WORDS, k: int = K, share: int = 4) -> DataFrame:
    """Every document with its edited text: the last n/share code points replaced by the first of the next document.

    (doc_id, n_chars, text, edited, fingerprint, next_fingerprint). Texts are
    exchanged once, by id; the next document sends the prefix that is needed
    and its fingerprint. Of rows with one id, the one of least text is the next
    document of the id before. Both sides read the same exchange of (id, text).
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed(docs).select("id", "text").repartition(parts, "id")
    lengths = keyed(docs).groupBy("id").agg(F.max(F.length("text")).alias("n_chars"))
    order = materialize(successors(materialize(lengths, "lengths")), "successors")
    before = order.select(
        F.col("id").alias("for_id"), F.floor(F.col("n_chars") / share).cast("int").alias("need"), F.col("next_id").alias("id"))
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("text"))).where("r = 1")
    sent = first.join(before, "id").select(
        F.col("for_id").alias("id"), F.substring("text", F.lit(1), F.col("need")).alias("prefix"),
        fingerprint(F.col("text"), words, k).alias("next_fingerprint"))
    n = F.length("text")
    cut = F.floor(n / share).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("prefix", F.lit(1), cut))
    return rows.join(sent, "id").select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), n.cast("long").alias("n_chars"), "text", edited.alias("edited"),
        fingerprint(F.col("text"), words, k).alias("fingerprint"), "next_fingerprint")
