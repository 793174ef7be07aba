"""Fill-in-middle cuts against a scan by regular expression, and the wavelet matrix against counting."""

import re

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import fillmiddle as fim, queries as q

ODD = {
    1: None, 2: "", 3: " ", 4: " \n\t ", 5: "one", 6: " one ", 7: "x" * 70_000, 8: "word " * 30_000, 9: "a <P> b", 10: "a <S>", 11: "<M>",
    12: "<P <S <M > ends < P", 13: "Straße ΣΑΣ\x1c naïve café 👍🏽 日本語 ①½ é", 14: "日本語" * 40, 15: "a\x0bb\x0cc\rd", 16: "same text here", 17: "same text here",
    18: "\x00 nul \x00", -(2**63): "least id here", 2**62: "large id here", 19: "<<P", 20: "<P", 21: "tail blank \n",
}


def test_whole_table_matches_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in q.QUERIES["op13_wavelet_fill_middle"](spark, sf).collect()}
    want = {d: brute.fill_middle(d, t) for d, t in docs.items()}
    assert got == {d: (*w[:4], brute.sha(w[4]), brute.sha(docs[d] or "")) for d, w in want.items()}
    assert {w[1] for w in want.values()} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("rate, spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_odd_texts(spark, rate, spm):
    rows = [(d, t, "x", 3, 4) for d, t in ODD.items()] + [(None, "null id text", "x", 3, 4), (16, "same text here", "x", 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int, h1 int").repartition(3)
    cut = fim.transform(docs, rate=rate, spm_share=spm)
    got = cut.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((str(d), *map(str, brute.fill_middle(d, t, rate, spm)), t or "") for d, t, *_ in rows)
    assert sorted((str(r[0]), *map(str, r[1:6]), r[6]) for r in got) == want


def test_code_points_as_units(spark):
    docs = spark.createDataFrame(list(ODD.items()), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in fim.transform(docs, unit="code_point", rate=100).collect()}
    assert got == {d: brute.fill_middle(d, t, 100, unit=re.compile("(?s).")) for d, t in ODD.items()}


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300), st.lists(st.integers(0, 300), min_size=1, max_size=9), st.sets(st.integers(0, 7), min_size=1))
def test_ranks_and_bisection(symbols, places, wanted):
    row, at, wanted = np.array(symbols, np.uint8), np.array(places) % (len(symbols) + 1), tuple(wanted)
    matrix = fim.WaveletMatrix(row, 3)
    hit = np.isin(row, wanted)
    assert matrix.rank(wanted, at).tolist() == [int(hit[:p].sum()) for p in at]
    k = np.arange(int(hit.sum()) + 1)
    found = matrix.behind(wanted, k, np.zeros(len(k), np.int64), np.full(len(k), len(row), np.int64))
    assert found.tolist() == [0, *(np.flatnonzero(hit) + 1)]


def test_no_shuffle(spark, sf):
    assert "Exchange" not in q.QUERIES["op13_wavelet_fill_middle"](spark, sf)._jdf.queryExecution().toString()
