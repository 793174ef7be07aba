"""Adaptive dimension scan against brute force: recall, ranks, scores, ties, repeated rows, odd vectors."""

import numpy as np
import pytest

from shelfcast.llm import dimscan as ds, queries as q

SCHEMA = "vec_id long, embedding array<double>, label int, score double, list int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 0.5, 3) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k=20, every=20):
    """query place -> best places, by brute force; rows: (id, vector)"""
    use = [j for j, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max([len(rows[j][1]) for j in use], default=0)
    x = np.array([rows[j][1] + [0.0] * (width - len(rows[j][1])) for j in use]).reshape(len(use), width)
    rank = np.array([2**63 - 1 if rows[j][0] is None else rows[j][0] for j in use])
    out = {}
    for a, j in enumerate(use):
        if rows[j][0] is not None and rows[j][0] % every == 0:
            with np.errstate(over="ignore", invalid="ignore"):
                s = (x * x[a]).sum(1)
            s = np.where(np.isnan(s), -np.inf, s)
            order = [b for b in np.lexsort((rank, -s)) if b != a][:k]
            out[j] = [(rows[use[b]][0], float(s[b])) for b in order]
    return out


def found(spark, rows, **kw):
    got = {}
    for r in ds.neighbours(frame(spark, rows), **kw).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {i: [x[1:] for x in sorted(v, key=lambda x: x[0])] for i, v in got.items()}


def recall(got, want, rows):
    hit = sum(len(set(got[rows[j][0]]) & set(w)) for j, w in want.items())
    return hit / max(1, sum(len(w) for w in want.values()))


def test_whole_table(spark, sf):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows), {}
    for r in q.QUERIES["op12_dimension_scan"](spark, sf).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {rows[j][0] for j in want}
    for j, w in want.items():
        mine = sorted(got[rows[j][0]])
        assert [m[0] for m in mine] == list(range(1, 21)) and rows[j][0] not in {m[1] for m in mine}
        assert mine == [(i + 1, *m[1:]) for i, m in enumerate(sorted(mine, key=lambda m: (-m[2], m[1])))]
        x = dict(rows)
        assert all(s == pytest.approx(float(np.dot(x[rows[j][0]], x[v])), rel=1e-12) for _, v, s in mine)
    assert sum(len({m[1] for m in got[rows[j][0]]} & {i for i, _ in w}) for j, w in want.items()) >= 0.95 * sum(map(len, want.values()))


@pytest.mark.parametrize("kind", ["random", "clusters", "lengths"])
def test_recall(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 48))
    if kind == "clusters":
        x = rng.normal(size=(40, 48))[rng.integers(0, 40, 6000)] + 0.2 * x
    if kind == "lengths":
        x *= rng.lognormal(0, 1, (6000, 1))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    want = brute(rows, every=40)
    assert recall(found(spark, rows, every=40), want, rows) >= 0.95
    assert recall(found(spark, rows, every=40, sample=800), want, rows) >= 0.9  # an index from a part of the rows still holds all rows


@pytest.mark.parametrize("n", [1, 2, 15, 21, 22])
def test_fewer_rows_than_neighbours(spark, n):
    rows = [(i * 20, v) for i, v in enumerate(np.random.default_rng(n).normal(size=(n, 5)).tolist())]
    want = {rows[j][0]: w for j, w in brute(rows).items() if w}
    got = found(spark, rows)
    assert {i: [x[0] for x in v] for i, v in got.items()} == {i: [x[0] for x in v] for i, v in want.items()}


def test_ties_repeated_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(1, 60)] + [(None, [1.0, 2.0, 2.0]), (None, [1.0, 2.0, 2.0])]
    rows += [(40, [1.0, 2.0, 2.0]), (20, [-1.0, 0.0, 0.5]), (80, None), (100, []), (120, [0.0, 0.0, 0.0]), (140, [float("nan"), 1.0, 1.0]),
             (160, [None, 1.0, 1.0]), (180, [float("inf"), 1.0, 1.0]), (-20, [3.0, 1.0]), (200, [0.5]), (61, [-0.0, 2.0, 2.0])]
    rows += [(i, v) for i, v in enumerate(rng.normal(size=(30, 3)).tolist(), 1000)]
    want, got = brute(rows), {}
    for r in ds.neighbours(frame(spark, rows), recall=1.0).collect():  # calibrated on all rows: exact
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    expected = {}
    for j, w in want.items():
        expected.setdefault(rows[j][0], []).extend((i + 1, *x) for i, x in enumerate(w))
    assert {i: sorted(v, key=str) for i, v in got.items()} == {i: sorted(v, key=str) for i, v in expected.items()}


def test_huge_and_tiny_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v) for i, v in enumerate((rng.normal(size=(120, 6)) * 10.0 ** rng.integers(-200, 100, (120, 1))).tolist())]
    rows += [(500, [1e308] * 6), (520, [-1e308, 1e308, 1e308, 1e308, 1e308, 1e308])]
    got, want = found(spark, rows), brute(rows)
    assert {i: len(v) for i, v in got.items()} == {rows[j][0]: len(w) for j, w in want.items()}
    assert recall(got, want, rows) >= 0.9


def test_empty_table(spark):
    assert ds.neighbours(frame(spark, [])).collect() == []
    assert ds.neighbours(frame(spark, [(20, None), (40, [0.0])])).collect() == []


def test_hot_list_is_split(spark, monkeypatch):
    """Near copies that all fall into one list: chunks and groups stay bounded, results whole."""
    monkeypatch.setattr(ds, "CHUNK_BYTES", 16_000)
    monkeypatch.setattr(ds, "QUERIES", 16)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(1500, 16)), rng.normal(size=16) * 3 + 0.001 * rng.normal(size=(1500, 16))])
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    assert recall(found(spark, rows), want := brute(rows), rows) >= 0.95 and len(want) == 150


def test_scan_leaves_candidates_early():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 128))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = ds.Index(128, 0, np.zeros((1, 128)), 1)
    r = index.rotated(x)
    rest = np.sqrt(np.cumsum((r ** 2)[:, ::-1], 1)[:, ::-1][:, ::ds.BLOCK]).T
    chunk = ds.Chunk(np.arange(4000), np.arange(4000), np.ones(4000, int), [np.ascontiguousarray(r[:, a:a + ds.BLOCK].T).astype("f4") for a in range(0, 128, ds.BLOCK)], rest, x)
    s = x[:50] @ x.T
    s[np.arange(50), np.arange(50)] = -9
    bars = np.sort(s, 1)[:, -20]
    work = ds.Scan()
    row, at, score = ds.scan(chunk, r[:50], x[:50], np.arange(50), bars, 20, 0, work)
    assert work.summed < 0.6 * work.all
    hit = sum(len(set(at[row == i]) & set(np.argsort(-s[i])[:20])) for i in range(50))
    assert hit >= 0.95 * 1000 and (score >= bars[row]).all()
