"""Connected components: of a link table by randomised contraction, of a small link matrix in memory."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b long): nodes reach one another exactly if they have one root.

    In each round every node moves to its neighbour of least hash (or stays),
    links are renamed and inner ones fall away. The hash differs per round, so
    a chain shrinks by a constant share too, and the rounds grow with the
    logarithm of the size. Tables are written per round, so a lost executor
    costs a re-read. Only the test for remaining links reaches the driver.
    """
    moves: list[DataFrame] = []
    links = materialize(_tidy(links.select(F.col("a").cast("long"), F.col("b").cast("long"))), "links")
    while not links.isEmpty():
        ends = links.select("a", "b").union(links.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(moves)), F.col(c)).alias("p"), F.col(c).alias("n"))
        move = materialize(
            ends.groupBy("a").agg(F.min(rank("b")).alias("best"))
            .select(F.col("a").alias("node"), F.least(F.col("best"), rank("a"))["n"].alias("root")), "moves")
        moves.append(move)
        at = move.select(F.col("node").alias("a"), F.col("root").alias("to"))
        links = links.join(at, "a").select(F.col("to").alias("a"), "b")
        at = at.toDF("b", "to")
        links = materialize(_tidy(links.join(at, "b").select("a", F.col("to").alias("b"))), "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    whole = moves.pop()
    while moves:
        later = whole.select(F.col("node").alias("root"), F.col("root").alias("last"))
        whole = materialize(
            moves.pop().join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "roots")
    return whole


def _tidy(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def spanning(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and columns of a link matrix; a row and a column share one if links join them."""
    i, j = np.nonzero(hit)
    a, b = np.arange(hit.shape[0]), np.full(hit.shape[1], hit.shape[0])
    while True:
        before = a.copy()
        np.minimum.at(b, j, a[i])
        np.minimum.at(a, i, b[j])
        if (before == a).all():
            return a, b
