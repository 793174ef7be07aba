"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position.

All steps are DataFrame functions. Only hashes and positions are exchanged for
the counting; a line that a third of all documents hold is pre-aggregated per
task for its count and split by the skew join when its holders are looked up.

Results: a NULL or empty text is one empty line. Keys shorter than
``min_chars`` code points stay always. A NULL doc_id ranks behind all other
ids. Rows repeated with one doc_id count as one document, so none of them
loses a line to the other. A document whose lines all go has the empty text.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import free_name, hash_of, id_of, keyed, materialize

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(id, th, dropped): positions of the lines that a document loses; documents that lose none are absent."""
    exploded = keyed(docs).select("id", "th", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    hashed = (
        exploded.select("id", "th", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
        .select("id", "th", "pos", F.unhex(F.sha2("key", 256)).alias("h"))
    )
    rows = materialize(hashed, "line-hashes")
    holders = (
        rows.groupBy("h").agg(F.count_distinct("id").alias("n"), F.min("id").alias("first"))
        .where(F.col("n") >= min_docs).select("h", "first")
    )
    holders = materialize(holders, "line-holders")  # stored, so the join's own exchanges can be split at a hot line
    lost = rows.join(holders, "h").where(F.col("id") != F.col("first"))
    return lost.groupBy("id", "th").agg(F.collect_set("pos").alias("dropped"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with the text that stays, and the columns n_lines and n_dropped (with a ``_`` where the name is taken)."""
    lost = repeated_lines(docs, min_chars, min_docs)
    names = {name: free_name(docs, name) for name in ("n_lines", "n_dropped", "line_id", "line_th", "line_lost")}
    lost = lost.toDF(names["line_id"], names["line_th"], names["line_lost"])
    dropped, lines = F.col(names["line_lost"]), lines_of(F.coalesce(docs["text"], F.lit("")))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    text = F.when(dropped.isNull(), F.coalesce(docs["text"], F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    joined = docs.join(lost, (id_of(docs) == lost[names["line_id"]]) & (hash_of(docs) == lost[names["line_th"]]), "left")
    return joined.select(
        *[text.alias(c) if c == "text" else docs[c] for c in docs.columns],
        F.size(lines).cast("long").alias(names["n_lines"]),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias(names["n_dropped"]),
    )
