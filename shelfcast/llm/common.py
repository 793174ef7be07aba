"""Shared pieces: keyed documents, Arrow batches of texts, durable intermediate tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.session import materialize

__all__ = ["LAST_ID", "documents", "free_name", "hash_of", "id_of", "keyed", "materialize", "prepare_python", "runs", "table"]

# Takes the place of a NULL id inside the operators, so such a row sorts behind all others.
LAST_ID = 2**63 - 1
_sent: dict[str, tempfile.TemporaryDirectory] = {}
# Rows and bytes of one Arrow batch: a batch of long texts has to fit a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def prepare_python(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers, and send them this package once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId not in _sent:
        _sent[sc.applicationId] = kept = tempfile.TemporaryDirectory(prefix="shelfcast-code-", ignore_cleanup_errors=True)
        root = Path(__file__).resolve().parents[2]
        archive = Path(kept.name, "shelfcast.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.glob("shelfcast/**/*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(archive))


def keyed(docs: DataFrame) -> DataFrame:
    """(id, th, doc_id, text): only what the operators read, so extra columns cannot clash.

    ``id`` replaces a NULL doc_id, ``text`` is never NULL and ``th`` tells
    apart texts that share an id; (id, th) is the key of a document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("th"),
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name`` or a longer one that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def id_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID))


def hash_of(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal ``by`` in sorted batches; a run may span batches."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for b in batches:
        if not len(b):
            continue
        columns = [b.column(c).to_numpy() for c in by]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(b)]):
            key = tuple(int(c[lo]) for c in columns)
            if held and key != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield at, pa.Table.from_batches(held)
