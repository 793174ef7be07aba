"""Dual-tree codes against plain Lloyd in Python integers."""

import random

import brute
import numpy as np
import pytest

from shelfcast.llm import dualtree as dt, queries as q

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def shown(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], SCHEMA).repartition(parts)


def test_whole_table_matches_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute.lloyd([(r["vec_id"], r["embedding"], r["label"]) for r in table])
    assert shown(q.QUERIES["op11_dual_tree_codes"](spark, sf)) == want


def clustered(n, d, seed, spread=0.01):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    return (centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, d))).tolist()


@pytest.mark.parametrize("name", ["clusters", "ties", "few", "uneven", "hot", "large", "all_large", "one"])
def test_shapes(spark, name):
    rng = random.Random(7)
    vectors = {
        "clusters": clustered(400, 16, 1), "ties": [[rng.choice([0.0, 0.5, 1.0]) for _ in range(8)] for _ in range(300)],
        "few": clustered(9, 16, 2, 1.0), "uneven": clustered(60, 11, 3, 0.5), "hot": clustered(20, 16, 4, 1.0) + [[0.25] * 16] * 200,
        "large": clustered(60, 16, 5, 1.0) + [[1e200 * rng.random() for _ in range(16)] for _ in range(3)] + [[rng.random() * 1e5 for _ in range(16)] for _ in range(5)],
        "all_large": [[rng.uniform(-1, 1) * 1e30 for _ in range(16)] for _ in range(40)], "one": [[1.5] * 8],
    }[name]
    rows = [(i if i % 9 else None, v, [1, 2, None][i % 3]) for i, v in enumerate(vectors)]
    if name == "large":  # a large vector among the first entries as well
        rows.append((-5, [-3e18] * 16, 2))
    rows += [(1000, None, 1), (1001, [None] * len(vectors[0]), 1), (1002, [float("nan")] * len(vectors[0]), 1), (-9, [float("inf")] * len(vectors[0]), 1)]
    rows += rows[1:4]  # repeated rows
    assert shown(dt.compress(frame(spark, rows), leaf=4)[0]) == brute.lloyd(rows)


def test_other_lengths_and_empty(spark):
    rows = [(i, [float(i)] * 8, 1) for i in range(5)] + [(9, [1.0] * 3, 1), (10, [1.0, 2.0], 7), (11, [], 7)]
    got = {r["vec_id"]: r for r in dt.compress(frame(spark, rows))[0].collect()}
    want = {w[0]: w for w in brute.lloyd(rows[:5])}
    assert len(got) == 8 and all(tuple(got[i])[:4] == want[i][:4] for i in range(5))
    assert all(got[i]["code"] is None and got[i]["error"] is None for i in (9, 10, 11)) and got[10]["label_error"] is None
    assert dt.compress(frame(spark, []))[0].collect() == []
    assert shown(dt.compress(frame(spark, [(1, [], 1), (2, [], None)]))[0]) == brute.lloyd([(1, [], 1), (2, [], None)])


@pytest.mark.parametrize("spread", [0.001, 1.0])
@pytest.mark.parametrize("m", [1, 5, 16])
def test_assignment_equals_brute_force(spread, m):
    points = np.floor(4096 * np.array(clustered(3000, 16, 6, spread))).astype(np.int64)
    points = dt.to_parts(points, 8)
    order = dt.tree_order(points, dt.depth_of(3000, dt.LEAF))
    points = np.take_along_axis(points, order[:, :, None], 1)
    entries = points[:, :m].copy()
    work = dt.Work()
    codes, sums, counts = dt.assign(points, dt.EntryTree.over(entries), work=work)
    for p in range(8):
        want = dt.nearest(points[p], entries[p])
        assert (codes[p] == want).all() and (counts[p] == np.bincount(want, minlength=m)).all()
        assert all((sums[p, e] == points[p][want == e].sum(0)).all() for e in range(m))
    if m == 16 and spread == 0.001:  # tight groups: most parts go by whole nodes, few distances are computed
        assert work.by_node > 0.8 * 8 * 3000 and work.distances < 0.1 * 8 * 3000 * m


def test_chunks_of_a_task_are_bounded(spark, monkeypatch):
    rows = [(i, v, 1) for i, v in enumerate(clustered(50, 8, 8, 1.0))]
    table = frame(spark, rows, 1).selectExpr("vec_id", "label", "embedding v").toArrow()
    monkeypatch.setattr(dt, "CHUNK_ROWS", 16)
    sizes = [len(t) for t in dt._gathered(iter(table.to_batches(max_chunksize=7)))]
    assert sum(sizes) == 50 and max(sizes) <= 16
    monkeypatch.setattr(dt, "CHUNK_NUMBERS", 40)
    assert max(len(t) for t in dt._gathered(iter(table.to_batches()))) <= 5
