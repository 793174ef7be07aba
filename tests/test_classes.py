import numpy as np
import pandas as pd
import pytest

from shelfcast.operators import classes
from shelfcast.session import materialize


def _category(spark, values):
    df = spark.createDataFrame([(i, 1, float(v)) for i, v in enumerate(values)], "pointid long, categoryid int, category_sales double")
    got = classes.category_class(materialize(df, "t")).orderBy("pointid").collect()
    return [r["point_category_class"] for r in got]


def _total(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "pointid long, total_sales double")
    got = classes.total_class(materialize(df, "t")).orderBy("pointid").collect()
    return [r["point_total_class"] for r in got]


def test_ties_share_a_class(spark):
    assert _category(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 10]) == [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9]


def test_single_outlet_in_category(spark):
    assert _category(spark, [42]) == [1]


def test_constant_total_falls_into_the_middle_bin(spark):
    assert _total(spark, [3, 3, 3, 3]) == [5, 5, 5, 5]


def test_skewed_total_uses_equal_width_bins(spark):
    assert _total(spark, [0] * 95 + [1, 2, 3, 4, 5]) == [1] * 95 + [2, 4, 6, 8, 10]


@pytest.mark.parametrize("seed", range(3))
def test_total_class_matches_pandas(spark, seed):
    values = np.round(np.random.default_rng(seed).lognormal(3, 1, 997), 1)
    want = (pd.qcut(values, 10, labels=False, duplicates="drop") + 1).tolist()
    assert _total(spark, values) == want


def test_sales_value_without_price_is_zero_and_nulls_count_as_zero(spark):
    sales = spark.createDataFrame(
        [(1, 1, 7, 2.0), (1, 1, 7, None), (1, 1, 8, 5.0), (None, 1, 7, 9.0)], "pointid long, categoryid int, brand int, brand_amount double")
    rules = spark.createDataFrame([(1, 7, 10.0)], "categoryid int, brand int, avgprice double")
    assert [tuple(r) for r in classes.pair_sales_value(sales, rules).collect()] == [(1, 1, 20.0)]
    assert [tuple(r) for r in classes.pair_sales_value(sales, None).collect()] == [(1, 1, 7.0)]
