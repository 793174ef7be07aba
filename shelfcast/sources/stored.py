"""Queries that serve the stored forecasts, rules and recommendations."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfcast.functions import files
from shelfcast.functions.columns import lower_columns


def load_predictions(
    predictions: DataFrame, point_id: int | None = None, category_id: int | None = None, clip: bool = True
) -> DataFrame:
    """Stored forecasts with optional outlet and category, in the recommender's names."""
    df = _narrow(predictions, "PointID", point_id, "CategoryID", category_id)
    # greatest() would turn an unknown forecast into 0
    value = F.when(F.col("predict_new") < 0, F.lit(0.0)).otherwise(F.col("predict_new")) if clip else F.col("predict_new")
    return df.select(
        F.col("PointID").alias("pointid"), F.col("CategoryID").alias("categoryid"),
        value.alias("predicted_category_sum"), F.col("DaysNextVisit").alias("days_until_next_visit"),
        F.col("VisitDate").alias("visitdate"),
    )


def clipped_count(predictions: DataFrame) -> DataFrame:
    """How many forecasts are zero after clipping."""
    return predictions.agg(F.count_if(F.col("predict_new") <= 0).alias("clipped"), F.count(F.lit(1)).alias("forecasts"))


def _narrow(df: DataFrame, point: str, point_id: int | None, category: str, category_id: int | None) -> DataFrame:
    if point_id is not None:
        df = df.where(F.col(point) == point_id)
    if category_id is not None:
        df = df.where(F.col(category) == category_id)
    return df


def rules_of(rules: DataFrame, category_id: int | None = None) -> DataFrame:
    return rules if category_id is None else rules.where(F.col("categoryid") == category_id)


def sales_of(sales: DataFrame, point_id: int | None = None, category_id: int | None = None) -> DataFrame:
    return _narrow(sales, "pointid", point_id, "categoryid", category_id)


def recommendations_by_point(
    stored: DataFrame, point_id: int, category_id: int | None = None, from_date: dt.date | None = None, limit: int = 100
) -> DataFrame:
    """Newest stored recommendations of an outlet, highest priority first."""
    df = _narrow(stored, "PointId", point_id, "CategoryId", category_id)
    if from_date is not None:
        df = df.where(F.col("ReferenceDate") >= F.lit(from_date))
    newest = df.orderBy(F.desc("ReferenceDate"), "CategoryId", F.desc("Priority"), "BrandId").limit(limit)
    return lower_columns(newest)


def _eligible(stored: DataFrame, category_id: int | None, included_only: bool) -> DataFrame:
    df = _narrow(stored, "PointId", None, "CategoryId", category_id)
    return df.where("Included = 1") if included_only else df


def latest_recommendations(stored: DataFrame, category_id: int | None = None, included_only: bool = True) -> DataFrame:
    """One row per outlet and category: of the newest date, the brand of highest priority.

    Spark drops rows of a lower rank before the shuffle, so a pair with a long
    history does not travel whole.
    """
    order = Window.partitionBy("PointId", "CategoryId").orderBy(F.desc("ReferenceDate"), F.desc("Priority"), "BrandId")
    ranked = _eligible(stored, category_id, included_only).withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return lower_columns(ranked.orderBy("PointId", "CategoryId", F.desc("Priority")))


def latest_batch(stored: DataFrame, category_id: int | None = None, included_only: bool = True) -> DataFrame:
    """All rows of each pair's newest date."""
    order = Window.partitionBy("PointId", "CategoryId").orderBy(F.desc("ReferenceDate"))
    ranked = _eligible(stored, category_id, included_only).withColumn("rn", F.rank().over(order)).where("rn = 1").drop("rn")
    return lower_columns(ranked)


def load_params(spark: SparkSession, path: str) -> dict | None:
    """Stored parameters, or None when the file is absent or unreadable."""
    if not files.exists(spark, path):
        return None
    text = spark.read.option("wholetext", "true").text(path).first()
    try:
        return json.loads(text[0]) if text else None
    except ValueError:
        return None


def load_category_params(spark: SparkSession, path: str) -> dict[int, dict]:
    """Stored parameters per category; empty when absent or unreadable."""
    return {int(k): v for k, v in (load_params(spark, path) or {}).items()}


class InputCache:
    """Loaded inputs kept for the next call with the same reference date."""

    def __init__(self) -> None:
        self._kept: dict[str, tuple[object, DataFrame]] = {}

    def get(self, name: str, key: object, load, force_refresh: bool = False) -> DataFrame:
        kept = self._kept.get(name)
        if kept is None or kept[0] != key or force_refresh:
            if kept is not None:
                kept[1].unpersist()
            kept = self._kept[name] = (key, load().persist())
        return kept[1]

    def clear(self) -> None:
        for _, df in self._kept.values():
            df.unpersist()
        self._kept.clear()
