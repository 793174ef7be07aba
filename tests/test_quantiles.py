import numpy as np
import pandas as pd
import pytest

from shelfcast.functions.quantiles import exact_quantiles


def _frame(seed, rows=20_000):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(rows) < 0.35, 0, rng.integers(1, 5, rows))  # one group holds over a third
    return pd.DataFrame({"g": hot, "v": np.round(rng.lognormal(4, 2, rows), 2)})


@pytest.mark.parametrize("buffered", [2_000_000, 0])
def test_deciles_per_group_match_pandas(spark, buffered):
    pdf = _frame(1)
    got = exact_quantiles(spark.createDataFrame(pdf), "v", by=["g"], parts=10, buffered_rows=buffered).toPandas()
    assert len(got) == pdf.g.nunique()
    for _, row in got.iterrows():
        want = pdf[pdf.g == row.g].v.quantile([i / 10 for i in range(11)]).to_numpy()
        np.testing.assert_allclose(row.edges, want, rtol=1e-12)


@pytest.mark.parametrize("buffered", [2_000_000, 0])
def test_global_probabilities_with_a_dominant_value(spark, buffered):
    pdf = _frame(2)
    pdf.loc[: len(pdf) // 2, "v"] = 7.0
    probs = [0.01, 0.25, 0.5, 0.75, 0.99, 0.999]
    got = exact_quantiles(spark.createDataFrame(pdf), "v", probs=probs, buffered_rows=buffered).first()["edges"]
    np.testing.assert_allclose(got, pdf.v.quantile(probs).to_numpy(), rtol=1e-12)


@pytest.mark.parametrize("buffered", [2_000_000, 0])
def test_small_groups_use_fewer_parts_and_ignore_missing(spark, buffered):
    rows = [(1, 5.0), (1, 5.0), (2, 1.0), (2, 3.0), (2, None), (2, float("nan")), (3, 1.0), (3, 2.0), (3, 2.0)]
    got = exact_quantiles(spark.createDataFrame(rows, "g int, v double"), "v", by=["g"], parts=10, buffered_rows=buffered)
    edges = {r["g"]: list(r["edges"]) for r in got.collect()}
    assert edges[2] == [1.0, 2.0, 3.0]
    assert edges[3] == [1.0, 2.0, 2.0]


def test_wrong_brackets_still_give_exact_ranks(spark):
    """A coarse sketch misses the rank; the count notices and the whole group is searched."""
    pdf = _frame(3, 5_000)
    got = exact_quantiles(spark.createDataFrame(pdf), "v", probs=[0.3, 0.7], accuracy=20, buffered_rows=0).first()["edges"]
    np.testing.assert_allclose(got, pdf.v.quantile([0.3, 0.7]).to_numpy(), rtol=1e-12)


def test_both_roads_give_equal_bits(spark):
    pdf = _frame(4, 50_021)
    pdf["v"] = pdf.v * 1.1
    df = spark.createDataFrame(pdf)
    probs = [0.01, 0.1, 0.25, 0.333, 0.5, 0.75, 0.9, 0.99, 0.999]
    one, two = (exact_quantiles(df, "v", probs=probs, buffered_rows=b).first()["edges"] for b in (2_000_000, 0))
    assert one == two
    one, two = ({r["g"]: r["edges"] for r in exact_quantiles(df, "v", by=["g"], parts=10, buffered_rows=b).collect()} for b in (2_000_000, 0))
    assert one == two
