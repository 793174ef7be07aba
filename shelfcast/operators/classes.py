"""Sales classes of outlets: decile of total sales, and decile within each category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.quantiles import attach, exact_quantiles
from shelfcast.session import broadcast_if_small

PARTS = 10
_DIGITS = 6  # both values and edges are compared after rounding to this many places


def pair_sales_value(sales: DataFrame, rules: DataFrame | None) -> DataFrame:
    """Value sold per outlet and category: quantity times the rule price.

    Quantities are summed per brand first, so the price join sees one row per
    outlet and brand. Without prices the quantity itself is the value.
    """
    known = sales.where("pointid is not null and categoryid is not null")
    quantity = known.groupBy("pointid", "categoryid", "brand").agg(
        F.coalesce(F.sum("brand_amount"), F.lit(0.0)).alias("amount")
    )
    if rules is None or "avgprice" not in rules.columns:
        valued = quantity.withColumn("value", F.col("amount"))
    else:
        prices = broadcast_if_small(rules.select("categoryid", "brand", "avgprice"))
        valued = quantity.join(prices, ["categoryid", "brand"], "left").withColumn(
            "value", F.col("amount") * F.coalesce("avgprice", F.lit(0.0))
        )
    return valued.groupBy("pointid", "categoryid").agg(F.round(F.sum("value"), _DIGITS).alias("category_sales"))


def point_sales_value(pair_values: DataFrame) -> DataFrame:
    return pair_values.groupBy("pointid").agg(F.round(F.sum("category_sales"), _DIGITS).alias("total_sales"))


def _edges_below(value: Column, edges: Column, count: int) -> Column:
    """How many of the distinct edges lie strictly below the value."""
    terms = [F.coalesce((F.get(edges, F.lit(i)) < value).cast("int"), F.lit(0)) for i in range(count)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _rounded_distinct(edges: str) -> Column:
    return F.array_distinct(F.transform(edges, lambda e: F.round(e, _DIGITS)))


def total_class(point_values: DataFrame) -> DataFrame:
    """Decile of total sales over all outlets; give a stored frame, it is read several times.

    When ties leave fewer than two classes, ten bins of equal width replace the
    deciles; the class then counts the bin bounds below the value. A constant
    column falls into the middle bin.
    """
    edges = exact_quantiles(point_values, "total_sales", probs=[i / PARTS for i in range(PARTS + 1)], stored=True)
    edges = edges.select(_rounded_distinct("edges").alias("e"))
    span = edges.select("e", F.array_min("e").alias("lo"), F.array_max("e").alias("hi"), F.size("e").alias("m"))
    with_edges = attach(point_values, span, [], "s")
    x = F.col("total_sales")
    by_quantile = F.greatest(F.lit(1), _edges_below(x, F.col("s.e"), PARTS + 1))
    step = (F.col("s.hi") - F.col("s.lo")) / PARTS
    bounds = F.array(*[F.round(F.col("s.lo") + step * i, _DIGITS) for i in range(1, PARTS)])
    by_width = F.lit(1) + _edges_below(x, bounds, PARTS - 1)
    middle = F.lit(PARTS // 2)
    klass = (
        F.when(F.col("s.m") > 2, by_quantile)
        .when(F.col("s.lo") == F.col("s.hi"), middle)
        .otherwise(by_width)
    )
    return with_edges.select("pointid", "total_sales", klass.cast("int").alias("point_total_class"))


def category_class(pair_values: DataFrame) -> DataFrame:
    """Quantile class within the category on a scale of 1 … q, q at most ten; give a stored frame."""
    edges = exact_quantiles(pair_values, "category_sales", by=["categoryid"], parts=PARTS, stored=True)
    edges = edges.select("categoryid", _rounded_distinct("edges").alias("e"))
    with_edges = attach(pair_values, edges, ["categoryid"], "s")
    klass = F.greatest(F.lit(1), _edges_below(F.col("category_sales"), F.col("s.e"), PARTS + 1))
    return with_edges.select("pointid", "categoryid", "category_sales", klass.cast("int").alias("point_category_class"))


def class_gap(total: DataFrame, category: DataFrame) -> DataFrame:
    """Total class minus category class per outlet and category, with the budget factor."""
    gap = (F.col("point_total_class") - F.col("point_category_class")).alias("class_gap")
    return (
        category.join(total.select("pointid", "point_total_class"), "pointid", "left")
        .select("pointid", "categoryid", "point_total_class", "point_category_class", gap)
        .withColumn("adjustment_factor", budget_factor(F.col("class_gap")))
    )


def budget_factor(gap: Column) -> Column:
    """Ten per cent more budget for each class the outlet stands above the category."""
    return F.when(gap > 0, F.lit(1.0) + gap * F.lit(0.10)).otherwise(F.lit(1.0))
