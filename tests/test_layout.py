"""Lookups in a laid-out table read a small share of its rows: proven by the rows that leave the scan."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.session import scratch_path
from shelfcast.sinks import tables as sink


def _read(df) -> tuple[int, int]:
    """Rows of the result, and rows that the scan let through."""
    found = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return found, leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark):
    first = dt.date(2024, 1, 1)
    n = 400_000
    rows = spark.range(n).select(
        F.date_add(F.lit(first), (F.col("id") % 8).cast("int")).alias("VisitDate"), (F.hash("id") % 20_000).cast("long").alias("PointID"),
        (F.col("id") % 3).cast("int").alias("CategoryID"), F.rand(1).alias("predict_new"))
    path = scratch_path(spark, "lookups")
    sink.write_for_lookups(rows, path, row_group_bytes=64 * 1024)
    stored = spark.read.parquet(path)
    assert stored.count() == n
    wanted = rows.first()["PointID"]
    by_day, seen = _read(stored.where(F.col("VisitDate") == F.lit(first)))
    assert by_day == n / 8 and seen < n / 4
    point, seen = _read(stored.where((F.col("PointID") == wanted) & (F.col("VisitDate") == F.lit(first))))
    assert point > 0 and seen < n / 20
    alone, seen = _read(stored.where(F.col("PointID") == wanted))
    assert alone == rows.where(F.col("PointID") == wanted).count() and seen < n / 4
    none, seen = _read(stored.where(F.col("PointID") == 999_999_999))
    assert (none, seen) == (0, 0)


def test_nulls_and_empty_tables(spark):
    path = scratch_path(spark, "lookups")
    some = spark.createDataFrame([(None, 1, 1, float("nan")), (dt.date(2024, 1, 1), None, 2, 1.0)], "VisitDate date, PointID long, CategoryID int, predict_new double")
    sink.write_for_lookups(some, path)
    assert sorted((r[0] is None, r[1], r[3]) for r in spark.read.parquet(path).collect()) == [(False, None, 1.0), (True, 1, None)]
    sink.write_for_lookups(some.limit(0), path)
    assert spark.read.schema(some.schema).parquet(path).count() == 0
