"""Stored tables as date-partitioned parquet.

Writes keep the partitioning of their input: a date slice is written by all
tasks at once, and rows are sorted inside each task so that readers can skip
row groups by outlet and category.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from shelfcast.functions import files
from shelfcast.functions.columns import finite_or_null
from shelfcast.schemas import PREDICTION_COLUMNS_V1, RECOMMENDATIONS
from shelfcast.sinks import numbers, swap

READ_ORDER = ["PointID", "CategoryID"]
# Order of a table laid out for lookups, and the column whose values each row group can be asked for.
LOOKUP_ORDER, LOOKUP_COLUMN = ["VisitDate", "PointID", "CategoryID"], "PointID"


# --- types --------------------------------------------------------------------------


def null_unusable(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL in every floating column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(c) for c in floats}) if floats else df


def sql_types(schema: T.StructType, bits: bool = True, precise_time: bool = False) -> dict[str, str]:
    """Column types of a relational copy of the table.

    ``bits`` keeps booleans as BIT, otherwise they fall to text like every
    type without a mapping.
    """

    def mapped(kind: T.DataType) -> str:
        if isinstance(kind, T.IntegralType):
            return "BIGINT"
        if isinstance(kind, T.FractionalType):
            return "FLOAT"
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "DATETIME2" if precise_time else "DATETIME"
        if bits and isinstance(kind, T.BooleanType):
            return "BIT"
        return "NVARCHAR(MAX)"

    return {f.name: mapped(f.dataType) for f in schema}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a canonical table: its columns, types and comments; absent columns are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in schema
    ])


def add_missing_columns(df: DataFrame, schema: T.StructType, names: list[str]) -> DataFrame:
    """Add the named columns of a canonical table as NULL where they are absent; safe to repeat."""
    absent = [schema[n] for n in names if n not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else df


# --- reading back ----------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a stored table. With a canonical schema, files lacking a later column give NULL."""
    swap.recover(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def _stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Columns of all files of a stored table, None when it is absent or has no files yet."""
    if not files.exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException:
        return None


# --- writers -----------------------------------------------------------------------------


def _sorted(df: DataFrame) -> DataFrame:
    order = [c for c in READ_ORDER if c.lower() in {x.lower() for x in df.columns}]
    return df.sortWithinPartitions(*order) if order else df


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write the frame as the whole table: all of it or, if that fails, nothing."""
    new = swap.aside(path)
    writer = _sorted(null_unusable(df)).write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(new)
    swap.commit(df.sparkSession, path, [("replace", new, path)])


def write_for_lookups(
    df: DataFrame, path: str, order: Sequence[str] = LOOKUP_ORDER, column: str = LOOKUP_COLUMN, row_group_bytes: int | None = None
) -> None:
    """Write the frame as the whole table in ranges of ``order``, with a Bloom filter on ``column`` in each row group.

    One exchange by range over the cluster, then a sort inside each range:
    lookups by day, or by day and outlet, skip row groups by their least and
    greatest values, lookups by outlet alone by the filter. A key that fills many
    ranges is cut by the columns after it. NULL keys come first.
    """
    new = swap.aside(path)
    rows = null_unusable(df).repartitionByRange(*order).sortWithinPartitions(*order)
    writer = rows.write.option(f"parquet.bloom.filter.enabled#{column}", "true")
    (writer.option("parquet.block.size", row_group_bytes) if row_group_bytes else writer).parquet(new)
    swap.commit(df.sparkSession, path, [("replace", new, path)])


def append_export(df: DataFrame, path: str, exported_at: dt.datetime, drop_existing: bool = False) -> int:
    """Append rows with a running ``ID`` and ``ExportedAt``; returns how many were written.

    Identifiers run on over appends without gaps.
    """
    spark = df.sparkSession
    if drop_existing:
        files.delete(spark, path)
    rows, n = numbers.numbered(null_unusable(df), "ID")
    start = _claimed(spark, path, "ID", n, 0)
    rows.withColumn("ID", F.col("ID") + start).withColumn("ExportedAt", F.lit(exported_at)).write.mode("append").parquet(path)
    return n


def _claimed(spark: SparkSession, path: str, column: str, n: int, first: int) -> int:
    """The first of ``n`` numbers for rows to append; a table without a counter is scanned once for its highest."""
    after = None
    if not numbers.has_claims(spark, path) and _stored_schema(spark, path) is not None:
        after = spark.read.parquet(path).agg(F.max(column)).first()[0]
    return numbers.claim(spark, path, n, first, after)


def _slice_dir(path: str, day: dt.date) -> str:
    return f"{path}/VisitDate={day.isoformat()}"


def prepare_slice(spark: SparkSession, path: str, day: dt.date) -> str:
    """Make room for a day's forecasts: says whether the table was absent, dropped or cleaned.

    A table none of whose files has the forecast column is of an older kind and
    is dropped. ``replace_slice`` needs no room made: call this only for a day
    that shall be empty, or once the new rows are stored elsewhere.
    """
    schema = _stored_schema(spark, path)
    if schema is None:
        return "absent"
    if "predict_new" not in schema.names:
        files.delete(spark, path)
        return "dropped"
    files.delete(spark, _slice_dir(path, day))
    return "cleaned"


def is_older_kind(spark: SparkSession, path: str) -> bool:
    """A stored table none of whose files has the forecast column."""
    schema = _stored_schema(spark, path)
    return schema is not None and "predict_new" not in schema.names


def replace_slice(df: DataFrame, path: str, day: dt.date | None, recreate_on_mismatch: bool = False) -> None:
    """Replace one day of a stored table, leaving other days alone.

    Columns new to the table are added, columns the frame lacks become NULL.
    With ``recreate_on_mismatch`` a set of columns other than that of all
    stored files instead replaces the whole table. Rows of other days are
    appended beside the stored ones, as are all rows without a day; a frame of
    the day alone can be written again without change. All of that happens or,
    if the write fails, nothing.
    """
    spark = df.sparkSession
    swap.recover(spark, path)
    rows = _sorted(null_unusable(df))
    schema = _stored_schema(spark, path)
    if schema is not None and set(schema.names) != set(df.columns):
        if recreate_on_mismatch:
            replace_table(df, path, "VisitDate")
            return
        rows = add_missing_columns(rows, schema, schema.names)
    new = swap.aside(path)
    rows.write.partitionBy("VisitDate").parquet(new)
    moves: list[swap.Move] = []
    if day is not None:
        there = files.exists(spark, _slice_dir(new, day))
        moves.append(("replace", _slice_dir(new, day), _slice_dir(path, day)) if there else ("delete", "", _slice_dir(path, day)))
    swap.commit(spark, path, [*moves, ("add", new, path)])


def append_predictions(df: DataFrame, path: str, created_at: dt.datetime, model_version: str = "catboost_v1") -> None:
    """Append first-generation forecasts: the known columns the frame has, stamped."""
    present = [c for c in PREDICTION_COLUMNS_V1 if c in df.columns]
    rows = null_unusable(df.select(*present)).withColumn("CreatedAt", F.lit(created_at)).withColumn(
        "ModelVersion", F.lit(model_version))
    _sorted(rows).write.mode("append").partitionBy("VisitDate").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """Tuned parameters completed with the fixed ones, as JSON; ``model`` says which kind they were tuned for."""
    # fixed values: defaults and constants of the stored parameter set
    full = {
        "variance_power": params.get("variance_power", 1.4), "iterations": params.get("iterations", 3000),
        "learning_rate": params.get("learning_rate", 0.01), "depth": params.get("depth", 6),
        "random_seed": 42, "grow_policy": "Lossguide", "l2_leaf_reg": 1, "max_leaves": 31,
    } | {"model": params.get("model", "tweedie")}
    spark.createDataFrame([(json.dumps(full),)], "value string").coalesce(1).write.mode("overwrite").text(path)


# --- recommendations -------------------------------------------------------------------------


def recommendation_rows(recommended: DataFrame, reference_date: dt.date, model_version: str | None = None) -> DataFrame:
    """Stored form of recommended brands, before the casts of the table.

    The stored weight is the priority without its bonuses; the stored forecast
    is the budget after the class adjustment.
    """
    top = F.col("is_top_local").cast("int")
    return recommended.select(
        F.col("pointid").alias("PointId"), F.col("categoryid").alias("CategoryId"),
        F.col("extended_sum").alias("ForecastAmount"), F.col("days_until_visit").alias("DaysUntilVisit"),
        F.lit(reference_date).alias("ReferenceDate"), F.lit(reference_date.isoweekday()).alias("TargetDayOfWeek"),
        F.col("brand_id").alias("BrandId"), F.col("brand_name").alias("BrandName"), F.col("quantum").alias("BrandQuantum"),
        F.col("importance_label").alias("ImportanceLabel"),
        (F.col("priority") - 5 * F.when(F.col("is_turbo") != 0, 1).otherwise(0) - 2 * top).alias("PriorityWeight"),
        F.col("is_turbo").alias("IsTurboBrand"), F.col("avg_price").alias("AvgPrice"),
        top.alias("IsTopLocal"), F.col("avg_daily_sales").alias("AvgDailySales"), F.col("raw_need").alias("RawNeed"),
        F.col("priority").alias("Priority"), F.col("recommended_qty").alias("RecommendedQty"),
        F.col("estimated_cost").alias("EstimatedCost"), F.col("included").cast("int").alias("Included"),
        F.lit(model_version).cast("string").alias("ModelVersion"),
        F.col("predicted_sum").alias("PredictedSum"), F.col("extended_sum").alias("ExtendedSum"),
        F.col("comment").alias("Comment"),
    )


def save_recommendations(
    recommended: DataFrame, path: str, reference_date: dt.date, created_at: dt.datetime, model_version: str | None = None,
    point_id: int | None = None, category_id: int | None = None,
) -> int:
    """Append recommendations in one write (all, or one outlet's or pair's); returns the row count.

    Money is rounded to the two or four places of the table here, and only here.
    """
    if point_id is not None:
        recommended = recommended.where(F.col("pointid") == point_id)
    if category_id is not None:
        recommended = recommended.where(F.col("categoryid") == category_id)
    rows = recommendation_rows(recommended, reference_date, model_version)
    rows = rows.withColumn("AvgDailySales", F.round("AvgDailySales", 2))
    spark = recommended.sparkSession
    stamped, n = numbers.numbered(conform(rows, RECOMMENDATIONS), "RecommendationId")
    start = _claimed(spark, path, "RecommendationId", n, 1)
    stamped = stamped.withColumn("RecommendationId", F.col("RecommendationId") + start).withColumn("CreatedAt", F.lit(created_at))
    _sorted(stamped).write.mode("append").partitionBy("ReferenceDate").parquet(path)
    return n
