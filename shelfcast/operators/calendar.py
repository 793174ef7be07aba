"""Calendar features through a small day dimension."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.functions.columns import first_present, iso_weekday
from shelfcast.schemas import DATE_NAMES

# fixed values: public holidays as (month, day)
FIXED_HOLIDAYS = [
    (1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (1, 7), (1, 8),
    (2, 23), (3, 8), (5, 1), (5, 9), (6, 12), (11, 4),
]
# Bound that makes the day dimension safe to broadcast (a few MB).
MAX_CALENDAR_DAYS = 100_000
NEAR_DAYS = 3
SEARCH_DAYS = 365


def fixed_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per holiday of the fixed list; replace it by any table with a ``holiday`` date."""
    days = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d")) for m, d in FIXED_HOLIDAYS])
    return (
        spark.range(first_year, last_year + 1)
        .select(F.col("id").cast("int").alias("y"), F.explode(days).alias("md"))
        .select(F.make_date("y", "md.m", "md.d").alias("holiday"))
    )


def date_bounds(df: DataFrame, date_col: str) -> tuple[dt.date, dt.date] | None:
    """First and last day of a frame (one row to the driver), None when empty."""
    row = df.agg(F.min(F.to_date(date_col)), F.max(F.to_date(date_col))).first()
    return None if row[0] is None else (row[0], row[1])


def dim_calendar(spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day from ``start`` to ``end`` with its holiday flag and neighbours.

    The previous and next holiday are strict: a holiday is not its own
    neighbour. Holidays are read a year beyond both ends, so days at the edge
    keep their neighbours. The as-of lookup runs on this dimension only; facts
    reach it by an equality join on the day.
    """
    days = (end - start).days + 1
    if days > MAX_CALENDAR_DAYS:
        raise ValueError(f"calendar of {days} days from {start} to {end}: check the dates")
    first_year, last_year = max(start.year - 1, 1), min(end.year + 1, 9999)
    if holidays is None:
        holidays = fixed_holidays(spark, first_year, last_year)
    known = holidays.where(F.year("holiday").between(first_year, last_year))
    listed = known.agg(F.sort_array(F.collect_set("holiday"))).scalar()
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return (
        spark.range(days).select(day.alias("day"), listed.alias("listed"))
        .select(
            "day",
            F.array_contains("listed", F.col("day")).alias("is_holiday"),
            F.array_max(F.filter("listed", lambda h: h < F.col("day"))).alias("prev_holiday"),
            F.array_min(F.filter("listed", lambda h: h > F.col("day"))).alias("next_holiday"),
            F.array_contains("listed", F.date_sub("day", 1)).alias("holiday_before"),
            F.array_contains("listed", F.date_add("day", 1)).alias("holiday_after"),
        )
    )


def calendar_for(df: DataFrame, date_col: str, holidays: DataFrame | None, bounds: tuple[dt.date, dt.date] | None) -> DataFrame:
    spark = df.sparkSession
    bounds = bounds or date_bounds(df, date_col) or (dt.date(2000, 1, 1), dt.date(2000, 1, 1))
    return dim_calendar(spark, bounds[0], bounds[1], holidays)


def _join_days(df: DataFrame, date_col: str, days: DataFrame) -> DataFrame:
    """Left join of the day dimension, whose size ``dim_calendar`` has checked."""
    return df.join(F.broadcast(days), F.to_date(F.col(date_col)) == F.col("day"), "left").drop("day")


def _weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def calendar_days_v1(calendar: DataFrame) -> DataFrame:
    """First-generation features, one row per day."""
    day = F.col("day")

    def capped(distance: Column) -> Column:
        return F.least(F.coalesce(distance, F.lit(SEARCH_DAYS)), F.lit(SEARCH_DAYS))

    return calendar.select(
        "day",
        F.weekday(day).alias("day_of_week"),
        _weekend(day).alias("is_weekend"),
        (F.weekday(day) == 0).alias("is_monday"),
        (F.weekday(day) == 4).alias("is_friday"),
        (F.weekday(day) == 5).alias("is_saturday"),
        (F.weekday(day) == 6).alias("is_sunday"),
        "is_holiday",
        (F.col("holiday_after") | _weekend(F.date_add(day, 1))).alias("is_pre_holiday"),
        (F.col("holiday_before") | _weekend(F.date_sub(day, 1))).alias("is_post_holiday"),
        capped(F.datediff("next_holiday", day)).alias("days_to_holiday"),
        capped(F.datediff(day, "prev_holiday")).alias("days_from_holiday"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
    )


def calendar_days_v2(calendar: DataFrame) -> DataFrame:
    """Second-generation features, one row per day; flags are 0/1."""
    day = F.col("day")
    dow, dom, length = iso_weekday(day), F.dayofmonth(day), F.dayofmonth(F.last_day(day))
    month_end = (dom >= length - 2) | ((dom <= 2) & (dow >= 5)) | ((dow == 6) & (dom + 7 > length))
    ahead, behind = F.datediff("next_holiday", day), F.datediff(day, "prev_holiday")

    def near(distance: Column) -> Column:
        return F.coalesce((distance <= NEAR_DAYS).cast("int"), F.lit(0))

    # fixed values: period of each cyclic feature
    cycles = {"DayOfYear": 366, "Month": 12, "DayOfWeek": 7, "WeekOfYear": 53, "Quarter": 4}
    plain = calendar.select(
        "day",
        dow.alias("DayOfWeek"),
        (dow == 5).cast("int").alias("IsFriday"),
        (dow == 1).cast("int").alias("IsMonday"),
        F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.weekofyear(day).alias("WeekOfYear"),
        dom.alias("DayOfMonth"),
        F.dayofyear(day).alias("DayOfYear"),
        month_end.cast("int").alias("isEndOfMonth"),
        ahead.alias("DaysToNextHoliday"),
        behind.alias("DaysSinceLastHoliday"),
        near(ahead).alias("IsPreHoliday"),
        near(behind).alias("IsPostHoliday"),
    )
    waves = []
    for name, period in cycles.items():
        angle = F.lit(2 * math.pi) * F.col(name) / F.lit(period)
        waves += [F.sin(angle).alias(f"{name}_sin"), F.cos(angle).alias(f"{name}_cos")]
    return plain.select("*", *waves)


def add_calendar_v1(
    df: DataFrame, holidays: DataFrame | None = None, bounds: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """Add the first-generation features; a frame without a date column is returned as it is."""
    date_col = first_present(df, DATE_NAMES)
    if date_col is None:
        return df
    return _join_days(df, date_col, calendar_days_v1(calendar_for(df, date_col, holidays, bounds)))


def add_calendar_v2(
    df: DataFrame, date_col: str = "VisitDate", holidays: DataFrame | None = None,
    bounds: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    return _join_days(df, date_col, calendar_days_v2(calendar_for(df, date_col, holidays, bounds)))
