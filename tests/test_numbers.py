import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from shelfcast.session import scratch_path
from shelfcast.sinks import numbers, tables as sink

STAMP = dt.datetime(2024, 5, 1, 12)


def test_numbers_have_no_gaps_over_appends(spark):
    path = scratch_path(spark, "numbered")
    written = [sink.append_export(spark.range(n).repartition(p), path, STAMP) for n, p in ((1000, 7), (0, 1), (1, 1), (333, 5))]
    assert written == [1000, 0, 1, 333]
    assert [r["ID"] for r in spark.read.parquet(path).orderBy("ID").collect()] == list(range(1334))


def test_empty_parts_and_skew(spark):
    df = spark.range(5000).repartition(40, F.when(F.col("id") < 4000, 0).otherwise(F.col("id")))
    got, n = numbers.numbered(df, "k")
    assert n == 5000 and sorted(r["k"] for r in got.collect()) == list(range(5000))
    again = {r["id"]: r["k"] for r in got.collect()}  # places are stored: a second read gives the same numbers
    assert again == {r["id"]: r["k"] for r in got.collect()}


def test_two_writers_never_share_a_block(spark):
    path = scratch_path(spark, "claims")
    with ThreadPoolExecutor(8) as pool:
        starts = list(pool.map(lambda i: numbers.claim(spark, path, 10 + i), range(24)))
    blocks = sorted((s, s + 10 + i) for i, s in enumerate(starts))
    assert blocks[0][0] == 1 and all(b[0] == a[1] for a, b in zip(blocks, blocks[1:]))


def test_a_table_without_counter_goes_on_after_its_highest(spark):
    path = scratch_path(spark, "older")
    spark.range(3).withColumn("ID", F.col("id") + 40).select(F.col("ID").cast("long"), F.lit(1).alias("v"), F.lit(STAMP).alias("ExportedAt")).write.parquet(path)
    sink.append_export(spark.range(2).select(F.lit(1).alias("v")), path, STAMP)
    assert sorted(r["ID"] for r in spark.read.parquet(path).collect()) == [40, 41, 42, 43, 44]
    assert sink.append_export(spark.range(2).select(F.lit(1).alias("v")), path, STAMP, drop_existing=True) == 2
    assert sorted(r["ID"] for r in spark.read.parquet(path).collect()) == [0, 1]


def test_a_failed_write_leaves_a_block_unused(spark):
    path = scratch_path(spark, "failing")
    sink.append_export(spark.range(5), path, STAMP)
    numbers.claim(spark, path, 7)  # its writer never comes back
    sink.append_export(spark.range(2), path, STAMP)
    assert sorted(r["ID"] for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4, 12, 13]
