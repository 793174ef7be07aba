"""Importance resampling against a plain version, with odd, long, tied and repeated texts and clashing columns."""

import math
import zlib
from collections import Counter

import pytest
import xxhash

from shelfcast.llm import quality, queries as q

MASK = 2**64 - 1


def hashed(*values, seed=42):
    """Spark's chained 64-bit hash: integers of four bytes given as ``("i", n)``, longs, texts; signed."""
    for v in values:
        data = v[1].to_bytes(4, "little") if isinstance(v, tuple) else v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v.encode()
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - 2**64 if seed >= 2**63 else seed


def grams(text):
    h = [zlib.crc32(w) * 0x9E3779B97F4A7C15 & MASK for w in text.encode().lower().split()]
    return [x >> 48 for x in h] + [(a * 0xC2B2AE3D27D4EB4F + b & MASK) >> 48 for a, b in zip(h, h[1:])]


def plain(docs, labels, k=None, keep=0.995, seed=17):
    """[(doc_id, log_weight, sort_key, kept)] in the order of ``docs``."""
    worst = {}
    for d, quality_, toxic in labels:
        if d is not None and quality_ is not None:
            worst[d] = min(worst.get(d, 9), 0 if toxic else quality_)
    good = {d for d, v in worst.items() if v == 1}
    fits = {d for d in good if hashed(d) % 2 == 0}
    raw, target = Counter(), Counter()
    for d, t in docs:
        raw.update(grams(t or ""))
        if d in fits:
            target.update(grams(t or ""))
    n_raw, n_target = raw.total(), target.total()
    prior = 0.05 * n_target + 1

    def ratio(b):
        if not n_target:
            return 0.0
        p = (raw[b] + 1) / (n_raw + 65536)
        return math.log((target[b] + prior * p) / (n_target + prior) / p)

    out = []
    for d, t in docs:
        g = grams(t or "")
        w = round(200 * math.fsum(map(ratio, g)) / (len(g) + 20), 9)
        th, i = hashed(t or ""), 2**63 - 1 if d is None else d
        u = (((hashed(("i", seed), i, th) & MASK) >> 11) + 0.5) / 2**53
        out.append((d, w, round((w - math.log(-math.log(u))) * 1e9), th))
    if k is None:
        held = {}
        for d, _, s, _ in out:
            if d in good - fits:
                held[d] = min(s, held.get(d, s))
        values = sorted(held.values())
        k = sum(s >= values[int((1 - keep) * len(values))] for _, _, s, _ in out) if values else len(out)
    ranked = sorted(((s, th) for _, _, s, th in out), reverse=True)
    cut = ranked[k - 1] if k < len(ranked) else (-(2**63), -(2**63))
    return [(d, w, s, (s, th) >= cut) for d, w, s, th in out]


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[1] == pytest.approx(w[1], abs=2e-9) and abs(g[2] - w[2]) <= 20 and g[3] == w[3], (g, w)


def test_query_equals_plain_version(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = q.QUERIES["op5_importance_resampling"](spark, sf).select("doc_id", "log_weight", "sort_key", "kept").collect()
    want = plain(docs, labels)
    same([tuple(r) for r in got], want)
    assert {r[3] for r in want} == {True, False}


def test_odd_texts_ties_and_clashing_names(spark):
    docs = [(i, f"good words of a fine text {i % 7}") for i in range(40)] + [(100 + i, "bad bad worse spam") for i in range(20)]
    docs += [(None, None), (None, ""), (None, "good words"), (200, " \n\t "), (201, "long " * 30_000 + "tail"), (202, "Żółć ÄÖ \x00 日本"), (3, docs[3][1])]
    labels = [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(20)] + [(None, 1, 0), (5, None, 0), (6, 1, 1), (7, 1, None), (9999, 1, 0)]
    frame = spark.createDataFrame([(d, t, -1.0, "x", 5) for d, t in docs], "doc_id long, text string, log_weight double, kept string, sort_key int").repartition(3)
    label_rows = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for k in (None, 0, 1, 25, 1000):
        found = quality.resample(frame, label_rows, k=k)
        assert found.columns == ["doc_id", "text", "log_weight", "kept", "sort_key", "log_weight_", "sort_key_", "kept_"]
        rows = found.collect()
        assert all(r["log_weight"] == -1.0 and r["kept"] == "x" and r["sort_key"] == 5 for r in rows)
        got = [(r["doc_id"], r["log_weight_"], r["sort_key_"], r["kept_"]) for r in rows]
        if k:
            assert sum(r[3] for r in got) in (min(k, len(got)), min(k, len(got)) + 1)  # row 3 stands twice
        if k == 0:
            assert not any(r[3] for r in got)
        else:
            same(got, plain(docs, labels, k))
        same([tuple(r) for r in quality.decisions(frame, label_rows, k=k).collect()], got)


def test_no_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.decisions(docs.limit(0), labels).collect() == []
    assert all(r["kept"] and r["log_weight"] == 0 for r in quality.decisions(docs, labels).collect())
