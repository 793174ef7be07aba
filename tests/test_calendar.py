import datetime as dt

import pytest

from shelfcast.operators import calendar

D = dt.date


def _v2(spark, *days, **kw):
    df = spark.createDataFrame([(d,) for d in days], "VisitDate date")
    return {r["VisitDate"]: r for r in calendar.add_calendar_v2(df, **kw).collect()}


def test_holiday_neighbours_skip_the_day_itself(spark):
    row = _v2(spark, D(2024, 1, 1))[D(2024, 1, 1)]
    assert (row["DaysToNextHoliday"], row["DaysSinceLastHoliday"], row["IsPreHoliday"], row["IsPostHoliday"]) == (1, 58, 1, 0)


def test_month_end(spark):
    days = [D(2024, 2, 27), D(2024, 2, 24), D(2024, 3, 1), D(2024, 5, 1)]
    rows = _v2(spark, *days)
    assert [rows[d]["isEndOfMonth"] for d in days] == [1, 1, 1, 0]


def test_iso_week(spark):
    assert _v2(spark, D(2024, 12, 30))[D(2024, 12, 30)]["WeekOfYear"] == 1


def test_other_holidays_replace_the_fixed_list(spark):
    own = spark.createDataFrame([(D(2024, 7, 10),)], "holiday date")
    row = _v2(spark, D(2024, 7, 8), holidays=own)[D(2024, 7, 8)]
    assert (row["DaysToNextHoliday"], row["DaysSinceLastHoliday"], row["IsPreHoliday"], row["IsPostHoliday"]) == (2, None, 1, 0)


def test_first_generation_caps_distance_and_keeps_frames_without_date(spark):
    own = spark.createDataFrame([(D(2020, 1, 1),)], "holiday date")
    df = spark.createDataFrame([(D(2024, 7, 8), 1)], "date date, x int")
    row = calendar.add_calendar_v1(df, holidays=own).first()
    assert (row["days_to_holiday"], row["days_from_holiday"]) == (365, 365)
    plain = spark.createDataFrame([(1,)], "x int")
    assert calendar.add_calendar_v1(plain).columns == ["x"]


def test_absurd_range_is_refused(spark):
    with pytest.raises(ValueError):
        calendar.dim_calendar(spark, D(1, 1, 1), D(9999, 1, 1))
