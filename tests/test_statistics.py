import datetime as dt
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import facts, statistics as stats
from shelfcast.plans import jobs
from shelfcast.session import materialize

D = dt.date


def test_outlier_filter(spark):
    values = list(np.random.default_rng(1).normal(100, 10, 500)) + [1e6, -1e6]
    df = spark.createDataFrame([(float(v),) for v in values], "y double")
    q1, q3 = np.quantile(values, [0.25, 0.75])
    want = sum(q1 - 3 * (q3 - q1) <= v <= q3 + 3 * (q3 - q1) for v in values)
    assert stats.iqr_filter(df, "y").count() == want == 500


@pytest.mark.parametrize("rows", [60, 61, 997])
def test_folds_by_time(spark, rows):
    rng = np.random.default_rng(rows)
    # one day holds over a third of all rows
    day = [D(2024, 1, 5) if rng.random() < 0.4 else D(2024, 1, 1) + dt.timedelta(days=int(rng.integers(0, 20))) for _ in range(rows)]
    df = materialize(spark.createDataFrame([(d, i * 7) for i, d in enumerate(day)], "VisitDate date, PointID long"), "t")
    order = sorted(((d, int(hashlib.md5(str(i * 7).encode()).hexdigest()[:3], 16), i * 7) for i, d in enumerate(day)))
    size = rows // 6
    want = {p: 0 if k < rows - 5 * size else 1 + (k - (rows - 5 * size)) // size for k, (_, _, p) in enumerate(order)}
    got = {r["PointID"]: r["block"] for r in stats.time_series_folds(df, "VisitDate", ["PointID"]).collect()}
    assert got == want


def test_kfold_is_stable_and_balanced(spark):
    df = spark.range(5000)
    a = stats.kfold(df, ["id"]).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in a) == [0, 1, 2, 3, 4] and all(800 < r["count"] < 1200 for r in a)
    assert stats.kfold(df, ["id"]).exceptAll(stats.kfold(df.repartition(3), ["id"])).count() == 0


def test_sanitise(spark):
    values = [-5.0, float("nan"), float("inf"), None, 10.0, 2e6, 3.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    got = [r["p"] for r in stats.sanitise_forecasts(df, "p").orderBy("i").collect()]
    usual = [0.0, 0.0, 0.0, 10.0, 2e6, 3.0]
    replaced = [0.0, 0.0, np.quantile(usual, 0.99), 0.0, 10.0, 2e6, 3.0]
    limit = max(np.quantile(replaced, 0.999), 1e6)
    np.testing.assert_allclose(got, np.minimum(replaced, limit))
    small = spark.createDataFrame([(-1.0,), (5.0,)], "p double")
    assert sorted(r[0] for r in stats.sanitise_forecasts(small, "p").collect()) == [0.0, 5.0]


def test_confidence(spark):
    error = spark.createDataFrame([(2.0, 10.0)], "mae double, mean_actual double")
    df = spark.createDataFrame([(1.0,), (3.0,)], "p double")
    got = sorted(r[1] for r in stats.add_confidence(df, "p", error).collect())
    np.testing.assert_allclose(got, [0.8 * math.exp(-0.5)] * 2)
    same = spark.createDataFrame([(3.0,), (3.0,)], "p double")
    assert [round(r[1], 12) for r in stats.add_confidence(same, "p", error).collect()] == [0.8, 0.8]
    poor = spark.createDataFrame([(20.0, 10.0)], "mae double, mean_actual double")
    assert {r[1] for r in stats.add_confidence(same, "p", poor).collect()} == {0.0}


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 3.0, 3.0), (2, 2.0, 2.0)], "fold int, y double, p double")
    rows = {r["fold"]: r for r in stats.regression_metrics(df, "y", "p", ["fold"]).collect()}
    assert (rows[1]["mae"], rows[1]["rmse"], rows[1]["r2"]) == (0.5, math.sqrt(0.5), 0.5)
    assert rows[2]["r2"] is None
    over = stats.metrics_over_folds(stats.regression_metrics(df, "y", "p", ["fold"])).first()
    assert (over["mae_mean"], over["mae_std"]) == (0.25, 0.25)


def test_bias_ratio(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 2.0)], "y double, p double")
    assert tuple(stats.bias_ratio(df, "y", "p").first()) == (1.5, 0.5)
    assert stats.bias_ratio(df.withColumn("p", F.lit(0.0)), "y", "p").first()["bias_ratio"] == 0.0


def test_dates_are_checked():
    assert jobs.checked_dates("2024-01-01", dt.datetime(2024, 2, 1, 5)) == (D(2024, 1, 1), D(2024, 2, 1))
    with pytest.raises(ValueError):
        jobs.checked_dates("2024-02-01", "2024-01-01")
    with pytest.raises(ValueError):
        jobs.checked_dates("01.02.2024", "2024-01-01")


def test_three_months_before():
    assert facts.three_months_before(D(1998, 4, 1)) == D(1998, 1, 1)
    assert facts.three_months_before(D(2024, 5, 31)) == D(2024, 2, 29)
    assert facts.three_months_before(D(2024, 1, 15)) == D(2023, 10, 15)
    assert facts.three_months_before(D(2024, 3, 31)) == D(2023, 12, 31)


def test_grid_and_coordinates(spark):
    faces = spark.createDataFrame([(1, 9, 1, 1), (2, 9, 1, 1), (3, 9, 1, 0), (4, 9, 2, 1)], "fid long, distid int, ftype int, factiveflag int")
    attrs = spark.createDataFrame(
        [(1, 360, "52,61", 1), (1, 361, " 39, 017", 1), (1, 602, "A", 0), (2, 360, "x", 1), (2, 361, "-0,01", 1)],
        "fid long, attrid int, attrtext string, activeflag int")
    rows = {r["PointID"]: r for r in facts.point_features(faces, attrs).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["Lat"], rows[1]["Lon"], rows[1]["PointClass"], rows[1]["MicroRegionID"]) == (52.61, 39.017, "Unknown", "52.596_39.015")
    assert (rows[2]["Lat"], rows[2]["MicroRegionID"]) == (0.0, "0_-0.027")
