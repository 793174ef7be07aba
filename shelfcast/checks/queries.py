"""Registered queries: each runs one operator or job over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.functions.columns import lower_columns
from shelfcast.operators import calendar, classes, encoding, facts, grouped, history_v1, history_v2, learning, recommend as rec, state as state_features, statistics as stats
from shelfcast.plans import jobs
from shelfcast.schemas import RECOMMENDATIONS, RECOMMENDATIONS_ADDED, RULE_SYNONYMS
from shelfcast.session import materialize, scratch_path
from shelfcast.sinks import tables as sink
from shelfcast.sources import stored, testdata as td
from shelfcast.sources.inputs import StoredInputs

REF = dt.date(1998, 4, 1)
START = dt.date(1998, 1, 1)
# The first day of the published orders, and the day after them: forecasts are for it.
FIRST = dt.date(1995, 1, 1)
LAST = dt.date(2002, 1, 1)
WEEKDAY = REF.isoweekday()
STAMP = dt.datetime(1998, 4, 1, 12, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- shared inputs ------------------------------------------------------------------------


def span(spark: SparkSession, sf: str) -> tuple[dt.date, dt.date]:
    """First day of the orders and the day after their last; of an empty table, a day without rows."""
    day = F.to_date("o_orderdate")
    first, last = td.table(spark, sf, "orders").agg(F.min(day), F.max(day)).first()
    return (LAST, LAST) if first is None else (first, last + dt.timedelta(days=1))


def daily(spark: SparkSession, sf: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Daily fact (by default of all orders) in whole roubles, so that every engine adds the amounts exactly."""
    first, last = (start, end) if start and end else span(spark, sf)
    return rounded(rounded(facts.daily_sales(td.source_tables(spark, sf), start or first, end or last), 4, "SumRoubles"), 0, "SumRoubles")


def brand_history(spark: SparkSession, sf: str) -> DataFrame:
    return facts.recent_brand_sales(td.source_tables(spark, sf), REF)


def rules(spark: SparkSession, sf: str) -> DataFrame:
    return rec.clean_rules(td.brand_rules(spark, sf))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return rec.clean_sales(brand_history(spark, sf))


def days_to_visit(point: str) -> Column:
    """Days to the next visit as stored; unknown for a third of the outlets."""
    return F.when(F.col(point) % 3 != 0, (F.col(point) % 9 + 1).cast("int"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Stored forecasts: the sales of each day of the window stand in for a model."""
    return daily(spark, sf, START, REF).select(
        "VisitDate", "PointID", "CategoryID", F.col("SumRoubles").alias("predict_new"),
        days_to_visit("PointID").alias("DaysNextVisit"),
    )


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return stored.load_predictions(predictions(spark, sf))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rec.pair_forecast(rec.clean_forecasts(forecasts(spark, sf)))


def recommended(spark: SparkSession, sf: str) -> DataFrame:
    return rec.recommend(forecasts(spark, sf), td.brand_rules(spark, sf), brand_history(spark, sf), REF)


# --- facts ------------------------------------------------------------------------------------


@query
def brand_sales_3m(spark, sf):
    return brand_history(spark, sf).orderBy(F.desc("VisitDate"), "CategoryID", "brand")


@query
def brand_sales_all(spark, sf):
    return facts.brand_sales(td.source_tables(spark, sf), LAST)


@query
def point_features_pivot(spark, sf):
    return facts.point_features(td.faces(spark, sf), td.face_attrs(spark, sf))


@query
def daily_sales_fact(spark, sf):
    return rounded(facts.daily_sales(td.source_tables(spark, sf), *span(spark, sf)), 4, "SumRoubles")


@query
def microregion_stats(spark, sf):
    return facts.region_stats(daily(spark, sf))


@query
def category_totals(spark, sf):
    return rounded(facts.category_totals(daily(spark, sf)), 2, "Revenue")


# --- calendar and history ----------------------------------------------------------------------

KEYS = ["VisitDate", "PointID", "CategoryID"]
WAVES = [f"{n}_{w}" for n in ("DayOfYear", "Month", "DayOfWeek", "WeekOfYear", "Quarter") for w in ("sin", "cos")]


@query
def calendar_features_v1(spark, sf):
    return calendar.add_calendar_v1(daily(spark, sf).select(*KEYS), bounds=span(spark, sf))


@query
def calendar_features_v2(spark, sf):
    return rounded(calendar.add_calendar_v2(daily(spark, sf).select(*KEYS), bounds=span(spark, sf)), 9, *WAVES)


@query
def order_history_v1(spark, sf):
    return rounded(history_v1.add_order_history(td.series(spark, sf)), 6, "Average_Interval_Category")


@query
def sales_features_v1(spark, sf):
    return rounded(history_v1.add_sales_features(td.series(spark, sf)), 6, *history_v1.ROLLING)


@query
def visit_features_v2(spark, sf):
    return history_v2.add_visit_features(td.series(spark, sf))


@query
def category_cadence_v2(spark, sf):
    return rounded(history_v2.add_category_features(td.series(spark, sf)), 2, "LastSalesCategory")


@query
def features_v2_full(spark, sf):
    return rounded(jobs.features_v2(daily(spark, sf), *span(spark, sf)), 9, *WAVES)


@query
def features_v1_full(spark, sf):
    return rounded(
        jobs.features_v1(daily(spark, sf), *span(spark, sf), calendar_flag=True, history_flag=True, sales_flag=True), 4,
        "Average_Interval_Category", *history_v1.ROLLING)


@query
def scoring_frame(spark, sf):
    return rounded(history_v2.scoring_frame(daily(spark, sf, START, REF), REF), 9, *WAVES)


ROLLED = ["Average_Interval_Category", *history_v1.ROLLING]


@query
def state_as_of_day(spark, sf):
    """First-generation features of a scoring day from a stored state, built once and brought forward three times."""
    fact, path = materialize(daily(spark, sf), "daily-sales"), scratch_path(spark, "state")
    for until in (dt.date(1997, 6, 1), START, dt.date(1998, 3, 1), REF):
        state = jobs.update_state(fact, until, path)
    return rounded(state_features.scoring_v1(state, REF).select(
        *KEYS, "Days_Since_Last_Order_Category", "Days_Since_Last_Order_Total", "Prev_Order_Amount_Category", *ROLLED), 4, *ROLLED)


@query
def scoring_frame_from_state(spark, sf):
    """The second-generation scoring frame from a stored state, brought forward once."""
    fact, path = materialize(daily(spark, sf, START, REF), "daily-sales"), scratch_path(spark, "state")
    jobs.update_state(fact, dt.date(1998, 3, 1), path)
    return rounded(state_features.scoring_v2(jobs.update_state(fact, REF, path), REF), 9, *WAVES)


# --- rules, sales, classes -----------------------------------------------------------------------


@query
def brand_rules_clean(spark, sf):
    return rules(spark, sf)


@query
def rule_categories(spark, sf):
    return rules(spark, sf).agg(F.countDistinct("categoryid").alias("categories"), F.count(F.lit(1)).alias("rules"))


@query
def sales_history_clean(spark, sf):
    return sales(spark, sf)


def _class_values(spark, sf):
    pair_values = materialize(classes.pair_sales_value(sales(spark, sf), rules(spark, sf)), "pair-values")
    return pair_values, materialize(classes.point_sales_value(pair_values), "point-values")


@query
def point_total_class(spark, sf):
    return classes.total_class(_class_values(spark, sf)[1])


@query
def point_category_class(spark, sf):
    return classes.category_class(_class_values(spark, sf)[0])


@query
def class_gap_budget(spark, sf):
    gaps = rec.class_gaps(sales(spark, sf), rules(spark, sf))
    budget = F.coalesce("adjustment_factor", F.lit(1.0)) * F.col("predicted_sum")
    return pairs(spark, sf).join(gaps, ["pointid", "categoryid"], "left").select(
        "pointid", "categoryid", "point_total_class", "point_category_class",
        F.coalesce("class_gap", F.lit(0)).alias("class_gap"), "predicted_sum", budget.alias("extended_sum"))


# --- recommendation ----------------------------------------------------------------------------------


@query
def dow_sales_means(spark, sf):
    return rec.dow_means(sales(spark, sf)).join(
        rec.all_day_means(sales(spark, sf)), ["pointid", "categoryid", "brand"])


@query
def local_top_brands(spark, sf):
    return rec.local_top_brands(sales(spark, sf), WEEKDAY)


@query
def point_regions(spark, sf):
    return rec.point_region(sales(spark, sf))


@query
def missing_brands(spark, sf):
    return rec.missing_brands(pairs(spark, sf), rules(spark, sf), sales(spark, sf), WEEKDAY)


@query
def brand_avg_with_fallback(spark, sf):
    wanted = pairs(spark, sf).select("pointid", "categoryid").join(rules(spark, sf).select("categoryid", "brand"), "categoryid")
    means = rec.target_means(sales(spark, sf), WEEKDAY)
    return wanted.join(means, ["pointid", "categoryid", "brand"], "left").select(
        "pointid", "categoryid", "brand", F.coalesce("avg_sales", F.lit(0.0)).alias("avg_sales"))


@query
def pair_forecast(spark, sf):
    return pairs(spark, sf)


@query
def forecasts_of_outlet(spark, sf):
    rows = predictions(spark, sf)
    return stored.load_predictions(rows, point_id=rows.agg(F.min("PointID")).first()[0])


@query
def rules_of_category(spark, sf):
    ruled = rules(spark, sf)
    return stored.rules_of(ruled, ruled.agg(F.max("categoryid")).first()[0])


@query
def saved_pair(spark, sf):
    """Recommendations of one pair are stored, and the number of rows written is told."""
    path = scratch_path(spark, "one-pair")
    rows = materialize(recommended(spark, sf), "recommended")
    point, category = rows.agg(F.min(F.struct("pointid", "categoryid"))).first()[0]
    written = sink.save_recommendations(rows, path, REF, STAMP, "model_a", point_id=point, category_id=category)
    back = spark.read.parquet(path).select(*[F.col(c) for c in ("PointId", "CategoryId", "BrandId", "RecommendedQty", "Included")])
    return lower_columns(back).withColumn("written", F.lit(written).cast("long"))


@query
def forecasts_with_nulls(spark, sf):
    """Unknown forecasts count neither as zero nor as a row of the mean; pairs without any count as zero."""
    odd = F.when((F.col("PointID") + F.dayofmonth("VisitDate")) % 3 == 0, F.lit(None).cast("double")).when(
        F.col("PointID") % 5 == 1, -F.col("predict_new")).otherwise(F.col("predict_new"))
    return rec.pair_forecast(rec.clean_forecasts(stored.load_predictions(predictions(spark, sf).withColumn("predict_new", odd))))


@query
def odd_day_counts(spark, sf):
    """Negative, very large and unknown days to the next visit; the earliest known one of the pair counts."""
    kind = (F.col("PointID") + F.dayofmonth("VisitDate")) % 4
    odd = F.when(kind == 0, -3).when(kind == 1, 2_000_003).when(kind == 2, F.lit(None).cast("int")).otherwise(F.dayofmonth("VisitDate"))
    return rec.pair_forecast(rec.clean_forecasts(stored.load_predictions(predictions(spark, sf).withColumn("DaysNextVisit", odd.cast("int")))))


def _nameless(rules: DataFrame) -> DataFrame:
    names = {"brand", *RULE_SYNONYMS["brand"]}
    return rules.drop(*[c for c in rules.columns if c.lower() in names])


@query
def rules_without_brands(spark, sf):
    """Rules that name no brand recommend nothing."""
    return rec.recommend(forecasts(spark, sf), _nameless(td.brand_rules(spark, sf)), brand_history(spark, sf), REF).agg(
        F.count(F.lit(1)).alias("recommended"))


@query
def clipped_forecasts(spark, sf):
    return stored.clipped_count(predictions(spark, sf))


def _candidates(spark, sf, most=rec.ARRAY_BRANDS):
    history = materialize(sales(spark, sf), "sales-history")
    ruled = materialize(rules(spark, sf), "brand-rules")
    bound = rec.brands_bound(ruled)
    plan = rec.pair_plan(pairs(spark, sf), history, ruled, WEEKDAY, packed=bound <= most)
    return rec.brand_candidates(plan, ruled, history, WEEKDAY), bound


@query
def brand_candidates(spark, sf):
    return _candidates(spark, sf)[0]


@query
def greedy_budget(spark, sf):
    candidates, bound = _candidates(spark, sf)
    filled = rec.greedy_fill(candidates, ["pointid", "categoryid"], most=bound)
    return filled.select("pointid", "categoryid", "brand_id", "priority", "estimated_cost", "extended_sum", "included")


@query
def greedy_budget_streamed(spark, sf):
    """Candidates joined by key, as for categories with very many rules."""
    filled = rec.greedy_fill(_candidates(spark, sf, most=0)[0], ["pointid", "categoryid"])
    return filled.select("pointid", "categoryid", "brand_id", "priority", "estimated_cost", "extended_sum", "included")


@query
def recommend_orders(spark, sf):
    return recommended(spark, sf)


@query
def recommend_from_inputs(spark, sf):
    """The recommended orders once more, by the job with stored rules and sales; the second call reads them."""
    kept = StoredInputs(spark, scratch_path(spark, "inputs"))
    for _ in range(2):
        rows = jobs.recommend_from_stored(
            predictions(spark, sf), td.brand_rules(spark, sf), brand_history(spark, sf), REF, scratch_path(spark, "recs"), STAMP, inputs=kept)
    return rows


@query
def recommendation_rows(spark, sf):
    return sink.recommendation_rows(recommended(spark, sf), REF, "model_a")


@query
def top_brands_per_pair(spark, sf):
    return rec.top_brands(recommended(spark, sf), 3).select("pointid", "categoryid", "brand_id", "priority", "rank")


@query
def recommendation_summary(spark, sf):
    return rounded(rec.summary(recommended(spark, sf)), 2, "total_cost", "forecast_amount")


def _saved_recommendations(spark, sf) -> DataFrame:
    """Two days of stored recommendations, the later one saved in one batch per outlet parity."""
    path = scratch_path(spark, "recommendations")
    rows = materialize(recommended(spark, sf), "recommended")
    sink.save_recommendations(rows, path, dt.date(1998, 3, 25), STAMP, "model_a")
    sink.save_recommendations(rows, path, REF, STAMP, "model_b")
    return spark.read.parquet(path)


KEPT = ["pointid", "categoryid", "brandid", "priority", "recommendedqty", "included", "referencedate", "modelversion", "comment"]


@query
def recommendations_by_point(spark, sf):
    saved = _saved_recommendations(spark, sf)
    busiest = saved.groupBy("PointId").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "PointId").first()
    point = busiest["PointId"] if busiest else -1
    return stored.recommendations_by_point(saved, point, from_date=dt.date(1998, 3, 1), limit=100).select(*KEPT)


@query
def latest_recommendations(spark, sf):
    return stored.latest_recommendations(_saved_recommendations(spark, sf)).select(*KEPT)


@query
def latest_recommendation_batch(spark, sf):
    return stored.latest_batch(_saved_recommendations(spark, sf)).select(*KEPT)


# --- statistics and training frames -----------------------------------------------------------------------


@query
def outlier_filter_iqr(spark, sf):
    rows = materialize(daily(spark, sf).select(*KEYS, "SumRoubles"), "daily-sales")
    return stats.iqr_filter(rows, "SumRoubles")


@query
def training_matrix(spark, sf):
    frame, _ = learning.training_frame(jobs.features_v2(daily(spark, sf), *span(spark, sf)), exclude=("VisitDate", "isHolidayNextVisit"))
    return rounded(frame.drop("isHolidayNextVisit"), 9, *WAVES)


@query
def training_matrix_v1(spark, sf):
    frame, _ = jobs.training_rows_v1(materialize(daily(spark, sf), "daily-sales"), *span(spark, sf))
    return rounded(frame, 4, "Average_Interval_Category", *history_v1.ROLLING)


@query
def time_series_folds(spark, sf):
    rows = materialize(daily(spark, sf).select(*KEYS, "SumRoubles"), "daily-sales")
    return stats.time_series_folds(rows, "VisitDate", ["PointID", "CategoryID"])


@query
def target_encoding(spark, sf):
    rows = materialize(daily(spark, sf).select(*KEYS, "MicroRegionID", "SumRoubles"), "daily-sales")
    return rounded(encoding.encode_as_of(rows), 6, *[f"{k}Mean" for k in encoding.KEYS])


@query
def fold_scores(spark, sf):
    """Both schemes on the baseline forecast: fold metrics, their mean and spread, and the better scheme."""
    rows = _baseline(spark, sf)
    by_time = stats.time_series_folds(rows, "VisitDate", ["PointID", "CategoryID"]).where("block > 0")
    series = stats.regression_metrics(by_time, "SumRoubles", "forecast", ["block"])
    shuffled = stats.regression_metrics(stats.kfold(rows, KEYS), "SumRoubles", "forecast", ["fold"])
    both = learning.compare_schemes(series, shuffled)
    return rounded(both, 6, *[c for c in both.columns if c not in ("scheme", "best")])


@query
def kfold(spark, sf):
    return stats.kfold(daily(spark, sf).select(*KEYS), KEYS)


def _baseline(spark, sf) -> DataFrame:
    """The pair's previous amount as a forecast that any engine can repeat."""
    rows = history_v1.add_sales_features(daily(spark, sf), daily=True)
    previous = F.coalesce("Prev_Order_Amount_Category", F.lit(0.0))
    return materialize(rows.select(*KEYS, "SumRoubles", previous.alias("forecast")), "baseline")


@query
def forecast_sanitise(spark, sf):
    wild = F.when(F.col("CategoryID") == 1, -F.col("forecast")).when(F.col("forecast") == 0, F.lit(float("nan"))).when(
        F.col("PointID") % 97 == 0, F.lit(float("inf"))).otherwise(F.col("forecast") * 50)
    return rounded(stats.sanitise_forecasts(_baseline(spark, sf).withColumn("forecast", wild), "forecast"), 4, "forecast")


@query
def prediction_confidence(spark, sf):
    rows = _baseline(spark, sf)
    error = rows.agg(F.avg(F.abs(F.col("SumRoubles") - F.col("forecast"))).alias("mae"), F.avg("SumRoubles").alias("mean_actual"))
    return rounded(stats.add_confidence(rows, "forecast", error), 9, "Prediction_Confidence")


@query
def forecast_range(spark, sf):
    rows = _baseline(spark, sf)
    error = rows.agg(F.avg(F.abs(F.col("SumRoubles") - F.col("forecast"))).alias("mae"), F.avg("SumRoubles").alias("mean_actual"))
    ranges = stats.forecast_range(stats.add_confidence(rows, "forecast", error), "forecast")
    return rounded(ranges, 6, *ranges.columns)


@query
def regression_metrics(spark, sf):
    return rounded(stats.regression_metrics(_baseline(spark, sf), "SumRoubles", "forecast", ["CategoryID"]), 6, "mae", "rmse", "r2")


@query
def bias_ratio(spark, sf):
    return rounded(stats.bias_ratio(_baseline(spark, sf), "SumRoubles", "forecast"), 9, "bias_ratio", "distance")


# --- learning ------------------------------------------------------------------------------------------------


@query
def forecast_tweedie(spark, sf):
    return jobs.train_and_score(daily(spark, sf), span(spark, sf)[0], LAST, LAST, scratch_path(spark, "forecast")).select(
        *KEYS, "predict_new", "DaysNextVisit", "ModelVersion")


@query
def forecast_ensemble(spark, sf):
    return jobs.train_ensemble_and_score(daily(spark, sf), span(spark, sf)[0], LAST, LAST).select(
        *KEYS, "predict_new", "Prediction_Confidence")


@query
def forecast_by_category(spark, sf):
    return jobs.score_by_category(daily(spark, sf), span(spark, sf)[0], LAST, LAST, categories=[1, 2, 3, 4])


@query
def category_routing(spark, sf):
    """Which pairs a category's own model forecasts: its forecasts are above 0, all others 0."""
    scored = jobs.score_by_category(daily(spark, sf), span(spark, sf)[0], LAST, LAST, categories=[1, 2, 3, 4], with_fallback=False)
    value = F.col("predict_advanced")
    return scored.select(*KEYS, (value > 0).alias("routed"), (~F.isnan(value) & (value >= 0) & (value < float("inf"))).alias("sound"))


@query
def category_weekend_models(spark, sf):
    """Models per category whose only feature is the weekend: they are saturated, so their forecasts are the mean sales."""
    rows = materialize(daily(spark, sf).select(*KEYS, "SumRoubles"), "daily-sales").withColumn("Weekend", (F.weekday("VisitDate") >= 5).cast("int"))
    features = learning.FeatureSet(["Weekend"])
    model = grouped.fit(learning.training_frame(rows, features=features)[0], features, "CategoryID", l2=0.0, tolerance=1e-9, iterations=50)
    cells = rows.groupBy("CategoryID", "Weekend").agg(F.count(F.lit(1)).alias("n"))
    return rounded(learning.predict(model, cells, features, "forecast"), 1, "forecast")


@query
def tune_forecast(spark, sf):
    return jobs.tune_parameters(daily(spark, sf), *span(spark, sf), scratch_path(spark, "params"))[1]


@query
def cv_scores(spark, sf):
    return jobs.compare_validation(daily(spark, sf), *span(spark, sf))


# --- stored tables -------------------------------------------------------------------------------------------------


def _march(spark, sf) -> DataFrame:
    return predictions(spark, sf).withColumn("model", F.lit("a"))


@query
def replace_slice_roundtrip(spark, sf):
    """A day's slice written twice with other values: the second wins, other days stay."""
    path = scratch_path(spark, "slices")
    day = dt.date(1998, 3, 31)
    rows = materialize(_march(spark, sf), "predictions")
    sink.replace_slice(rows, path, None)
    sink.prepare_slice(spark, path, day)
    again = rows.where(F.col("VisitDate") == F.lit(day)).withColumn("model", F.lit("b"))
    sink.replace_slice(again, path, day)
    sink.replace_slice(again, path, day)
    return spark.read.parquet(path)


@query
def slice_with_other_days(spark, sf):
    """A frame for one day that also holds rows of another: the day is replaced, the other day keeps its rows and gains these."""
    path = scratch_path(spark, "mixed-slice")
    day, other = dt.date(1998, 3, 31), dt.date(1998, 3, 30)
    rows = materialize(_march(spark, sf), "predictions")
    sink.replace_slice(rows, path, None)
    mixed = rows.where((F.col("VisitDate") == F.lit(day)) | ((F.col("VisitDate") == F.lit(other)) & (F.col("PointID") % 7 == 0)))
    sink.replace_slice(mixed.withColumn("model", F.lit("b")), path, day)
    return spark.read.parquet(path)


@query
def evolved_then_recreate(spark, sf):
    """A column came with a later day; a frame with exactly the table's columns is no mismatch and loses no day."""
    path = scratch_path(spark, "evolved")
    days = [dt.date(1998, 3, 29), dt.date(1998, 3, 30), dt.date(1998, 3, 31)]
    rows = materialize(predictions(spark, sf), "predictions")
    sink.replace_slice(rows.where(F.col("VisitDate") == F.lit(days[0])), path, days[0])
    wider = rows.withColumn("Prediction_Confidence", F.lit(0.5))
    sink.replace_slice(wider.where(F.col("VisitDate") == F.lit(days[1])), path, days[1])
    sink.replace_slice(wider.where(F.col("VisitDate") == F.lit(days[2])), path, days[2], recreate_on_mismatch=True)
    return sink.read_table(spark, path)


@query
def failed_write_keeps_rows(spark, sf):
    """A slice whose new rows cannot all be computed leaves the stored ones as they are."""
    path = scratch_path(spark, "failing")
    rows = materialize(predictions(spark, sf), "predictions")
    sink.replace_slice(rows, path, None)
    day = dt.date(1998, 3, 31)
    broken = F.when(F.col("PointID") % 2 == 0, F.raise_error(F.lit("no such row")).cast("double")).otherwise(F.lit(0.0))
    for write in (lambda df: sink.replace_slice(df, path, day), lambda df: sink.replace_table(df, path)):
        try:
            write(rows.withColumn("predict_new", broken))
        except Exception as error:  # noqa: BLE001 - the failure is what is tried
            if "no such row" not in str(error):
                raise
        else:
            raise RuntimeError("the broken write went through")
    return sink.read_table(spark, path)


@query
def numbered_append(spark, sf):
    """Identifiers of two appends: as many as rows, without gaps."""
    path = scratch_path(spark, "numbered")
    rows = materialize(predictions(spark, sf), "predictions")
    written = [sink.append_export(part, path, STAMP) for part in (rows.where("CategoryID <= 3"), rows.where("CategoryID > 3"))]
    back = spark.read.parquet(path).withColumn("second", (F.col("ID") >= written[0]).cast("int"))
    return back.groupBy("second").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("ID").alias("ids"), F.min("ID").alias("first_id"), F.max("ID").alias("last_id"),
        F.min("CategoryID").alias("first_category"), F.max("CategoryID").alias("last_category"))


@query
def append_roundtrip(spark, sf):
    """Two appends; identifiers differ from row to row."""
    path = scratch_path(spark, "export")
    rows = materialize(predictions(spark, sf), "predictions")
    sink.append_export(rows, path, STAMP, drop_existing=True)
    sink.append_export(rows, path, STAMP)
    back = spark.read.parquet(path)
    return back.groupBy("VisitDate", "PointID", "CategoryID", "predict_new", "ExportedAt").agg(F.countDistinct("ID").alias("ids"))


@query
def append_predictions_roundtrip(spark, sf):
    path = scratch_path(spark, "predictions-v1")
    rows = predictions(spark, sf).withColumn("not_stored", F.lit(1))
    sink.append_predictions(rows, path, STAMP)
    return spark.read.parquet(path)


@query
def schema_evolution_roundtrip(spark, sf):
    """A slice with a new column joins the table; older rows show NULL there."""
    path = scratch_path(spark, "evolving")
    day = dt.date(1998, 3, 31)
    rows = materialize(predictions(spark, sf), "predictions")
    sink.replace_slice(rows, path, None)
    later = rows.where(F.col("VisitDate") == F.lit(day)).withColumn("Prediction_Confidence", F.lit(0.5))
    sink.replace_slice(later, path, day)
    return sink.read_table(spark, path)


@query
def recreate_on_mismatch_roundtrip(spark, sf):
    """The same slice with the recreate flag drops the other days."""
    path = scratch_path(spark, "recreated")
    day = dt.date(1998, 3, 31)
    rows = materialize(predictions(spark, sf), "predictions")
    sink.replace_slice(rows, path, None)
    later = rows.where(F.col("VisitDate") == F.lit(day)).withColumn("Prediction_Confidence", F.lit(0.5))
    sink.replace_slice(later, path, day, recreate_on_mismatch=True)
    return sink.read_table(spark, path, later.schema)


@query
def add_columns_roundtrip(spark, sf):
    """Adding the later columns of the recommendations twice changes nothing more."""
    rows = sink.recommendation_rows(recommended(spark, sf), REF).drop(*RECOMMENDATIONS_ADDED)
    once = sink.add_missing_columns(rows, RECOMMENDATIONS, RECOMMENDATIONS_ADDED)
    twice = sink.add_missing_columns(once, RECOMMENDATIONS, RECOMMENDATIONS_ADDED)
    return lower_columns(twice).select("pointid", "categoryid", "brandid", "predictedsum", "extendedsum", "comment")


@query
def overwrite_roundtrip(spark, sf):
    """Unusable numbers are stored as NULL, and a second write replaces the first."""
    path = scratch_path(spark, "features")
    rows = materialize(predictions(spark, sf), "predictions")
    odd = F.when(F.col("PointID") % 5 == 0, F.lit(float("nan"))).when(
        F.col("PointID") % 7 == 0, F.lit(float("-inf"))).otherwise(F.col("predict_new"))
    sink.replace_table(rows, path)
    sink.replace_table(rows.withColumn("predict_new", odd), path)
    return spark.read.parquet(path)


@query
def lookup_layout(spark, sf):
    """Forecasts laid out for lookups, read back for every seventh outlet and, in one month, for all."""
    path = scratch_path(spark, "lookups")
    sink.write_for_lookups(predictions(spark, sf), path)
    rows = spark.read.parquet(path)
    month = (F.col("VisitDate") >= dt.date(1998, 2, 1)) & (F.col("VisitDate") < dt.date(1998, 3, 1))
    return rows.where((F.col("PointID") % 7 == 0) | month)


@query
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    rows = predictions(spark, sf)
    sink.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", "true").csv(path)


@query
def full_pipeline(spark, sf):
    """Train, score the day, recommend from the stored scores, save and read back."""
    out = jobs.train_and_recommend(
        daily(spark, sf), td.brand_rules(spark, sf), brand_history(spark, sf), span(spark, sf)[0], REF, REF, STAMP, scratch_path(spark, "run"))
    return lower_columns(out).select(*KEPT)
