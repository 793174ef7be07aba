"""Outlet features and the two sales facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import text_to_double
from shelfcast.schemas import BRAND_SALES_COLUMNS, DAILY_COLUMNS
from shelfcast.session import broadcast_if_small
from shelfcast.sources.testdata import SourceTables

# fixed values: attribute numbers of the source system, and the grid step of 3 km in degrees
BRAND_ATTR, LAT_ATTR, LON_ATTR, CLASS_ATTR, TYPE_ATTR = 635, 360, 361, 602, 555
GRID_STEP = 0.027


def item_map(items: DataFrame, item_attrs: DataFrame, attr_values: DataFrame) -> DataFrame:
    """Active items with their category and brand."""
    brand = item_attrs.where(f"activeflag = 1 and attrid = {BRAND_ATTR}").select(
        F.col("id").alias("iid"), "attrvalueid"
    )
    return (
        items.where("activeflag = 1 and itid is not null").select("iid", "itid")
        .join(brand, "iid")
        .join(attr_values, "attrvalueid")
        .select(
            "iid",
            F.col("attrvalueid").cast("int").alias("brand"),
            F.col("attrvaluename").alias("brand_name"),
            F.col("itid").cast("int").alias("CategoryID"),
        )
    )


def _grid_text(coordinate: Column) -> Column:
    """South-west corner of the cell on one axis, without trailing zeros."""
    corner = F.round(F.floor(coordinate / GRID_STEP) * GRID_STEP, 3).cast("decimal(9,3)").cast("string")
    return F.regexp_replace(corner, r"\.?0+$", "")


def micro_region(lat: Column, lon: Column) -> Column:
    return F.concat_ws("_", _grid_text(lat), _grid_text(lon))


def point_features(faces: DataFrame, face_attrs: DataFrame) -> DataFrame:
    """Pivot the attribute rows of active outlets and place each outlet on the grid.

    The attribute rows are reduced to one row per outlet before the join, so
    the join moves one row per outlet however many attributes it has.
    """

    def attr(number: int, value: Column) -> Column:
        return F.max(F.when(F.col("attrid") == number, value))

    wide = (
        face_attrs.where(F.col("activeflag") == 1)
        .where(F.col("attrid").isin(LAT_ATTR, LON_ATTR, CLASS_ATTR, TYPE_ATTR))
        .groupBy("fid")
        .agg(
            attr(LAT_ATTR, text_to_double("attrtext")).alias("lat"),
            attr(LON_ATTR, text_to_double("attrtext")).alias("lon"),
            attr(CLASS_ATTR, F.col("attrtext")).alias("klass"),
            attr(TYPE_ATTR, F.col("attrtext")).alias("kind"),
        )
    )
    active = faces.where("ftype = 1 and factiveflag = 1").select("fid", "distid").distinct()
    lat, lon = F.coalesce("lat", F.lit(0.0)), F.coalesce("lon", F.lit(0.0))
    return active.join(wide, "fid", "left").select(
        F.col("fid").alias("PointID"),
        F.col("distid").alias("BranchID"),
        F.coalesce("klass", F.lit("Unknown")).alias("PointClass"),
        F.coalesce("kind", F.lit("Unknown")).alias("PointType"),
        lat.alias("Lat"),
        lon.alias("Lon"),
        micro_region(lat, lon).alias("MicroRegionID"),
    )


def _sales(src: SourceTables, start: dt.date | None, end: dt.date, keys: list[str], measure: str, out: str) -> DataFrame:
    """Sum a measure of the order lines per outlet, day and ``keys``, with outlet features.

    The sum runs before the outlet features are joined: its map-side part
    shrinks an outlet that owns a large share of all lines, and the join then
    sees one row per outlet, day and key.
    """
    wanted = src.orders.where(F.col("ortype") == 1).where(F.col("ordate") < F.lit(end))
    if start is not None:
        wanted = wanted.where(F.col("ordate") >= F.lit(start))
    items = item_map(src.items, src.item_attrs, src.attr_values).select("iid", *keys)
    if "brand" not in keys:
        items = items.distinct()  # an item of two brands still sells once
    sums = (
        src.order_items.select("masterfid", "orid", "iid", measure)
        .join(wanted.select("masterfid", "orid", "mfid", "ordate"), ["masterfid", "orid"])
        .join(broadcast_if_small(items), "iid")
        .groupBy(F.col("mfid").alias("PointID"), F.to_date("ordate").alias("VisitDate"), *keys)
        .agg(F.sum(measure).alias(out))
    )
    points = point_features(src.faces, src.face_attrs)
    return sums.join(broadcast_if_small(points, counted=src.faces), "PointID")


def brand_sales(src: SourceTables, end: dt.date, start: dt.date | None = None) -> DataFrame:
    """Quantity per outlet, day, category and brand for ``[start, end)``."""
    fact = _sales(src, start, end, ["CategoryID", "brand", "brand_name"], "amount", "brand_amount")
    return fact.withColumnRenamed("PointID", "PointId").select(*BRAND_SALES_COLUMNS)


def three_months_before(day: dt.date) -> dt.date:
    """Same day three months earlier, or the last day of that month."""
    month = (day.year * 12 + day.month - 1) - 3
    year, month = divmod(month, 12)
    following = dt.date(year + (month + 1) // 12, (month + 1) % 12 + 1, 1)
    return dt.date(year, month + 1, min(day.day, (following - dt.timedelta(days=1)).day))


def recent_brand_sales(src: SourceTables, end: dt.date) -> DataFrame:
    """Brand sales of the three months before ``end``."""
    return brand_sales(src, end, three_months_before(end))


def daily_sales(src: SourceTables, start: dt.date, end: dt.date) -> DataFrame:
    """Roubles per outlet, day and category for ``[start, end)``; one row per such key."""
    return _sales(src, start, end, ["CategoryID"], "roubles", "SumRoubles").select(*DAILY_COLUMNS)


def region_stats(fact: DataFrame) -> DataFrame:
    """Sales and number of outlets per grid cell."""
    return fact.groupBy("MicroRegionID").agg(
        F.sum("SumRoubles").alias("SumRoubles"), F.countDistinct("PointID").alias("points")
    )


def category_totals(fact: DataFrame, multiplier: float = 1.2) -> DataFrame:
    """Sales per category, largest first, with an illustrative revenue column."""
    return (
        fact.groupBy("CategoryID").agg(F.sum("SumRoubles").alias("SumRoubles"))
        .withColumn("Revenue", F.col("SumRoubles") * F.lit(multiplier))
        .orderBy(F.desc("SumRoubles"))
    )
