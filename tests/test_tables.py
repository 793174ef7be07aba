import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import files
from shelfcast.schemas import (
    FEATURES, PREDICTION_COLUMNS_V1, PREDICTIONS, RECOMMENDATIONS, RECOMMENDATIONS_ADDED, categorical_indexes,
)
from shelfcast.session import materialize, scratch_path, scratch_root, scratch_scope
from shelfcast.sinks import tables as sink
from shelfcast.sources import stored

D = dt.date
STAMP = dt.datetime(2024, 5, 1, 10, 0)


@pytest.fixture
def predictions(spark):
    rows = [(D(2024, 5, d), p, c, float(10 * d + p)) for d in (1, 2, 3) for p in (1, 2) for c in (1, 2)]
    return spark.createDataFrame(rows, "VisitDate date, PointID long, CategoryID int, predict_new double")


def _dates(df):
    return {r["VisitDate"].day: r["n"] for r in df.groupBy("VisitDate").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_slice_replacement_is_idempotent(spark, predictions):
    path = scratch_path(spark, "t")
    sink.replace_slice(predictions, path, None)
    new = predictions.where("VisitDate = date '2024-05-02' and PointID = 1").withColumn("predict_new", F.lit(7.0))
    for _ in range(2):
        sink.replace_slice(new, path, D(2024, 5, 2))
        assert _dates(spark.read.parquet(path)) == {1: 4, 2: 2, 3: 4}
    assert {r[0] for r in spark.read.parquet(path).where("VisitDate = date '2024-05-02'").select("predict_new").collect()} == {7.0}


def test_empty_slice_clears_its_day(spark, predictions):
    path = scratch_path(spark, "t")
    sink.replace_slice(predictions, path, None)
    sink.replace_slice(predictions.where("false"), path, D(2024, 5, 2))
    assert _dates(spark.read.parquet(path)) == {1: 4, 3: 4}


def test_prepare_slice(spark, predictions):
    path = scratch_path(spark, "t")
    assert sink.prepare_slice(spark, path, D(2024, 5, 2)) == "absent"
    sink.replace_slice(predictions, path, None)
    assert sink.prepare_slice(spark, path, D(2024, 5, 2)) == "cleaned"
    assert _dates(spark.read.parquet(path)) == {1: 4, 3: 4}
    old = scratch_path(spark, "t")
    predictions.withColumnRenamed("predict_new", "predict_advanced").write.partitionBy("VisitDate").parquet(old)
    assert sink.prepare_slice(spark, old, D(2024, 5, 2)) == "dropped" and not files.exists(spark, old)


def test_structure_mismatch(spark, predictions):
    path = scratch_path(spark, "t")
    sink.replace_slice(predictions, path, None)
    wider = predictions.where("VisitDate = date '2024-05-02'").drop("CategoryID").withColumn("extra", F.lit("x"))
    sink.replace_slice(wider, path, D(2024, 5, 2))
    back = sink.read_table(spark, path)
    assert _dates(back) == {1: 4, 2: 4, 3: 4} and back.where("extra is null").count() == 8 and back.where("CategoryID is null").count() == 4
    sink.replace_slice(wider.drop("predict_new"), path, D(2024, 5, 2), recreate_on_mismatch=True)
    assert _dates(spark.read.parquet(path)) == {2: 4}


def test_export_appends_with_fresh_identifiers(spark, predictions):
    path = scratch_path(spark, "t")
    assert sink.append_export(predictions, path, STAMP) == 12
    assert sink.append_export(predictions, path, STAMP) == 12
    back = spark.read.parquet(path)
    assert back.count() == 24 and back.select("ID").distinct().count() == 24
    assert sink.append_export(predictions, path, STAMP, drop_existing=True) == 12
    assert spark.read.parquet(path).count() == 12


def test_unusable_numbers_become_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (1.5, 3)], "x double, y int")
    assert [r["x"] for r in sink.null_unusable(df).orderBy("y").collect()] == [None, None, 1.5]


def test_relational_types(spark):
    schema = spark.createDataFrame([], "a int, b bigint, c double, d date, e timestamp, f boolean, g string").schema
    assert list(sink.sql_types(schema).values()) == ["BIGINT", "BIGINT", "FLOAT", "DATETIME", "DATETIME", "BIT", "NVARCHAR(MAX)"]
    assert sink.sql_types(schema, bits=False, precise_time=True)["f"] == "NVARCHAR(MAX)"
    assert sink.sql_types(schema, precise_time=True)["e"] == "DATETIME2"


def test_recommendations_are_stored_and_served(spark, sf):
    from shelfcast.checks import queries as q

    rows = q.recommended(spark, sf).persist()
    path = scratch_path(spark, "t")
    total = rows.count()
    assert sink.save_recommendations(rows, path, D(2024, 5, 1), STAMP, "a") == total
    point = rows.first()["pointid"]
    mine = rows.where(F.col("pointid") == point).count()
    assert sink.save_recommendations(rows, path, D(2024, 5, 8), STAMP, "b", point_id=point) == mine
    back = spark.read.parquet(path)
    assert back.count() == total + mine and back.select("RecommendationId").distinct().count() == total + mine
    assert {f.name for f in RECOMMENDATIONS} <= set(back.columns)
    assert str(back.schema["EstimatedCost"].dataType) == "DecimalType(18,2)"
    latest = stored.latest_recommendations(back).where(F.col("pointid") == point).collect()
    assert {r["referencedate"] for r in latest} == {D(2024, 5, 8)} and len(latest) == len({r["categoryid"] for r in latest})
    best = rows.where(F.col("pointid") == point).groupBy("categoryid").agg(F.max("priority").alias("p")).collect()
    assert {(r["categoryid"], r["priority"]) for r in latest} == {(r["categoryid"], r["p"]) for r in best}
    category = latest[0]["categoryid"]
    assert {r["categoryid"] for r in stored.latest_recommendations(back, category).collect()} == {category}
    top = stored.recommendations_by_point(back, point, category, D(2024, 5, 2), limit=2).collect()
    assert len(top) <= 2 and {r["referencedate"] for r in top} == {D(2024, 5, 8)}
    rows.unpersist()


def test_added_columns_keep_existing_values(spark):
    df = spark.createDataFrame([(1, "kept")], "PointId long, Comment string")
    out = sink.add_missing_columns(sink.add_missing_columns(df, RECOMMENDATIONS, RECOMMENDATIONS_ADDED), RECOMMENDATIONS, RECOMMENDATIONS_ADDED)
    assert out.columns == ["PointId", "Comment", "PredictedSum", "ExtendedSum"] and out.first()["Comment"] == "kept"


def test_parameters_round_trip(spark):
    path = scratch_path(spark, "t")
    assert stored.load_params(spark, path) is None
    sink.save_params(spark, {"variance_power": 1.2, "depth": 8}, path)
    params = stored.load_params(spark, path)
    assert params["variance_power"] == 1.2 and params["depth"] == 8 and params["iterations"] == 3000 and params["max_leaves"] == 31 and params["model"] == "tweedie"
    cut_short = scratch_path(spark, "t")
    spark.createDataFrame([("{",)], "value string").write.text(cut_short)
    assert stored.load_category_params(spark, cut_short) == {}
    per_category = scratch_path(spark, "t")
    spark.createDataFrame([(json.dumps({"11": {"depth": 4}}),)], "value string").coalesce(1).write.text(per_category)
    assert stored.load_category_params(spark, per_category) == {11: {"depth": 4}}


def test_accessors_and_cache(spark, predictions):
    loaded = stored.load_predictions(predictions.withColumn("DaysNextVisit", F.lit(3)).withColumn("predict_new", F.lit(-1.0)), point_id=1, category_id=2)
    assert loaded.count() == 3 and {r["predicted_category_sum"] for r in loaded.collect()} == {0.0}
    rules = spark.createDataFrame([(1, 1), (2, 1)], "categoryid int, brand int")
    assert stored.rules_of(rules, 2).count() == 1 and stored.rules_of(rules).count() == 2
    sales = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "pointid int, categoryid int")
    assert stored.sales_of(sales, 1, 2).count() == 1
    calls, cache = [], stored.InputCache()
    load = lambda: calls.append(1) or rules
    for key, fresh in ((1, False), (1, False), (2, False), (2, True)):
        cache.get("rules", key, load, fresh)
    assert len(calls) == 3
    cache.clear()


def test_canonical_predictions(spark, predictions):
    assert {*PREDICTION_COLUMNS_V1, "CreatedAt", "ModelVersion"} == set(PREDICTIONS.names)
    out = sink.conform(predictions, PREDICTIONS)
    assert out.schema == PREDICTIONS and out.schema["predict_new"].metadata["comment"]
    assert out.where("predict_new > 0 and Lat is null").count() == 12


def test_feature_vector():
    assert len(FEATURES) == 35 and categorical_indexes() == [0, 1, 2, 3, 4, 7, 8, 9, 10, 11, 12, 13, 16, 19, 20, 34]


def test_scope_deletes_only_its_own_tables(spark, predictions):
    kept = materialize(predictions, "kept")
    with scratch_scope(spark):
        inside = materialize(predictions, "inside")
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert inside.count() == 12 and files.exists(spark, path)
    assert not files.exists(spark, path) and kept.count() == 12


def test_scratch_folder_follows_the_session(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "hdfs:///shared" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert scratch_root(Session()) == "hdfs:///shared"

    class Bare:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://host"
            applicationId = "x"

    with pytest.raises(RuntimeError):
        scratch_root(Bare())
