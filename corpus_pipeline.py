"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import linededup, packing, quality, simhash
from shelfcast.llm.common import documents, materialize, table
from shelfcast.llm.queries import WORD_BPE

ORACLE_SQL = None  # n-gram models, fingerprints and tokenizers are beyond SQL


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labelled ones keeps."""
    scored = quality.resample(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col(scored.columns[-1])).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows the text."""
    kept = linededup.drop_repeated_lines(docs)
    return kept.select(*[F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in sequences of 4096 tokens."""
    return packing.pack(docs, WORD_BPE).select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", keep_good_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
