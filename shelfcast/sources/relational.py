"""Source and stored tables that live in a relational database, over JDBC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from shelfcast.sources.testdata import SourceTables

BATCH_ROWS = 10_000


def read_split(
    spark: SparkSession, url: str, name: str, column: str, low: int | dt.date, high: int | dt.date, parts: int,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table in ``parts`` concurrent ranges of a numeric or date column; filters are pushed to the database."""
    return (
        spark.read.format("jdbc").options(**(options or {}))
        .options(url=url, dbtable=name, partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
        .load()
    )


def source_tables(
    spark: SparkSession, url: str, names: dict[str, str], splits: dict[str, tuple[str, int | dt.date, int | dt.date, int]],
    options: dict[str, str] | None = None,
) -> SourceTables:
    """The seven source tables; ``names`` gives the database's name of each, ``splits`` column, bounds and number of parts."""

    def load(field: str) -> DataFrame:
        df = read_split(spark, url, names[field], *splits[field], options=options)
        return df.toDF(*[c.lower() for c in df.columns])

    return SourceTables(**{field: load(field) for field in names})


def writer(df: DataFrame, url: str, name: str, mode: str = "append", options: dict[str, str] | None = None) -> DataFrameWriter:
    """Writer that inserts from all partitions in batches; call ``save()`` on it."""
    return df.write.format("jdbc").mode(mode).options(**(options or {})).options(url=url, dbtable=name, batchsize=str(BATCH_ROWS))
