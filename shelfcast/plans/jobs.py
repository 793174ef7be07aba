"""End-to-end jobs. Nothing reads the clock: dates and stamps are arguments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions import files
from shelfcast.operators import calendar, encoding, grouped, history_v1, history_v2, learning, recommend as rec, state as st, statistics as stats
from shelfcast.session import materialize, scratch_scope
from shelfcast.sinks import swap, tables as sink
from shelfcast.sources import stored
from shelfcast.sources.inputs import StoredInputs

# fixed values: days of history for training, first and second generation
HISTORY_DAYS_V1, HISTORY_DAYS_V2 = 365, 395


def checked_dates(start: dt.date | dt.datetime | str, end: dt.date | dt.datetime | str) -> tuple[dt.date, dt.date]:
    """Dates from ISO text, dates or times; the start may not lie after the end."""

    def day(value) -> dt.date:
        if isinstance(value, str):
            return dt.datetime.strptime(value, "%Y-%m-%d").date()
        return value.date() if isinstance(value, dt.datetime) else value

    first, last = day(start), day(end)
    if first > last:
        raise ValueError(f"start {first} lies after end {last}")
    return first, last


def _window(fact: DataFrame, start, end) -> tuple[DataFrame, dt.date, dt.date]:
    first, last = checked_dates(start, end)
    inside = (F.col("VisitDate") >= F.lit(first)) & (F.col("VisitDate") < F.lit(last))
    return fact.where(inside), first, last


# --- feature tables -----------------------------------------------------------------------


def features_v2(fact: DataFrame, start, end, holidays: DataFrame | None = None, is_daily: bool = True) -> DataFrame:
    """Daily fact of ``[start, end)`` with all second-generation features."""
    rows, first, last = _window(fact, start, end)
    rows = history_v2.add_history_v2(rows, holidays, (first, last), daily=is_daily)
    return calendar.add_calendar_v2(rows, holidays=holidays, bounds=(first, last))


def features_v1(
    fact: DataFrame, start, end, calendar_flag: bool = False, history_flag: bool = False, sales_flag: bool = False,
    holidays: DataFrame | None = None, is_daily: bool = True,
) -> DataFrame:
    """Daily fact of ``[start, end)`` with the chosen groups of first-generation features."""
    rows, first, last = _window(fact, start, end)
    if history_flag and sales_flag:
        rows = history_v1.add_history_v1(rows, daily=is_daily)
    elif history_flag:
        rows = history_v1.add_order_history(rows, daily=is_daily)
    elif sales_flag:
        rows = history_v1.add_sales_features(rows, daily=is_daily)
    return calendar.add_calendar_v1(rows, holidays, (first, last)) if calendar_flag else rows


def training_rows_v1(source: DataFrame, start, end) -> tuple[DataFrame, learning.FeatureSet]:
    """First-generation training rows within the outlier bounds, and their features; give a stored fact.

    Features leave the amounts as they are, so the bounds come from the fact:
    the wide rows are made once, for whoever reads the result.
    """
    raw = features_v1(source, start, end, calendar_flag=True, history_flag=True, sales_flag=True)
    features = learning.feature_set_by_type(raw)
    amounts = learning.clean_target(_window(source, start, end)[0].select(learning.TARGET))
    return stats.iqr_filter(learning.training_frame(raw, features=features)[0], learning.TARGET, of=amounts), features


def build_feature_table(fact: DataFrame, start, end, path: str, holidays: DataFrame | None = None) -> DataFrame:
    """Write the second-generation features as a whole table and read it back."""
    rows = features_v2(fact, start, end, holidays)
    sink.replace_table(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def update_state(fact: DataFrame, until: dt.date, path: str) -> DataFrame:
    """Bring the stored scoring state forward to all days before ``until``; only days since the stored one are read.

    A state that reaches as far already stays as it is, so a repeated call
    changes nothing. Rows that arrive for days the state has passed are not
    seen: build it anew at another path for them.
    """
    spark = fact.sparkSession
    swap.recover(spark, path)
    old, since = None, None
    if files.exists(spark, path):
        old = spark.read.parquet(path)
        since = old.agg(F.max("AsOf")).first()[0]
    if since is not None and since >= until:
        return old
    rows = fact.where(F.col("VisitDate") < F.lit(until))
    if since is not None:
        rows = rows.where(F.col("VisitDate") >= F.lit(since))
    sink.replace_table(st.advance(old, rows).withColumn("AsOf", F.lit(until)), path)
    return spark.read.parquet(path)


# --- forecasts ------------------------------------------------------------------------------


def train_and_score(
    fact: DataFrame, start, end, target: dt.date, path: str, params: dict | None = None, model_version: str = "tweedie_v1",
    created_at: dt.datetime | None = None,
) -> DataFrame:
    """Train the model that ``params`` describe, save it, score the target day and replace its slice.

    By default it is the log-linear Tweedie model; ``model: tweedie_trees`` boosts trees with Tweedie loss. With
    ``encode`` outlets and cells enter as their as-of sales instead of hashed categories.
    """
    spark, params = fact.sparkSession, params or {}
    with scratch_scope(spark):
        source = materialize(fact, "daily-sales")
        rows, asked = features_v2(source, start, end), history_v2.scoring_frame(source, target)
        features = learning.model_features()
        if params.get("encode"):
            rows, asked = encoding.encode_as_of(rows), encoding.encode_for_scoring(asked, source.where(F.col("VisitDate") >= F.lit(start)), target)
            features = learning.encoded_features(features)
        frame = materialize(learning.training_frame(rows, features=features)[0], "training-frame")
        model = learning.train_from_params(frame, features, params)
        learning.save_model(model, features, f"{path}/model")
        scored = materialize(learning.predict(model, asked, features), "scored")
        if sink.is_older_kind(spark, f"{path}/predictions"):
            sink.prepare_slice(spark, f"{path}/predictions", target)
        stamped = scored.withColumn("CreatedAt", F.lit(created_at).cast("timestamp")).withColumn(
            "ModelVersion", F.lit(model_version))
        sink.replace_slice(stamped, f"{path}/predictions", target)
    return sink.read_table(spark, f"{path}/predictions", stamped.schema)


def train_ensemble_and_score(
    fact: DataFrame, start, end, target: dt.date, iterations: int = learning.ROUNDS, path: str | None = None,
    created_at: dt.datetime | None = None, version: str = "catboost_v1", export_path: str | None = None, end_early: bool = False,
) -> DataFrame:
    """First generation: outlier filter, ensemble of boosted trees, bounded forecasts with confidence.

    All ``iterations`` rounds count. With ``end_early`` the later days end them
    when no round brings a lesser error there.
    With a path the scored rows are also appended there, with an export path
    the training features.
    """
    source = materialize(fact, "daily-sales")
    if export_path is not None:
        sink.append_export(features_v1(source, start, end, calendar_flag=True, history_flag=True, sales_flag=True), export_path, created_at)
    frame, features = training_rows_v1(source, start, end)
    frame = materialize(frame, "training-frame")
    models = learning.train_ensemble(frame, features, iterations=iterations, late=late_days(frame) if end_early else None)
    error = learning.predict_ensemble(models, frame, features, "_fitted").agg(
        F.avg(F.abs(F.col(learning.TARGET) - F.col("_fitted"))).alias("mae"), F.avg(learning.TARGET).alias("mean_actual"))
    asked = st.scoring_v1(st.advance(None, source.where(F.col("VisitDate") < F.lit(target))), target)
    scored = materialize(learning.predict_ensemble(models, asked, features), "scored")
    bounded = stats.sanitise_forecasts(scored, "predict_new")
    out = stats.add_confidence(bounded, "predict_new", materialize(error, "train-error"))
    if path is not None:
        sink.append_predictions(out, path, created_at, version)
    return out


def score_by_category(
    fact: DataFrame, start, end, target: dt.date, categories: Sequence[int], with_fallback: bool = True,
    path: str | None = None,
) -> DataFrame:
    """Score the target day with one model per listed category; others use a common model, else 0.

    The models of all categories are fitted together, one pass over the rows per
    iteration. With a path the day's slice is replaced there.
    """
    source = materialize(fact, "daily-sales")
    frame, features = learning.training_frame(features_v2(source, start, end), features=learning.model_features())
    frame = materialize(frame, "training-frame")
    blocks = learning.tweedie_blocks(frame, features, key="CategoryID")
    fallback = learning.train_tweedie(frame, features, blocks=blocks) if with_fallback else None
    model = grouped.fit(frame, features, "CategoryID", groups=categories, fallback=fallback, blocks=blocks)
    scored = learning.predict(model, history_v2.scoring_frame(source, target), features, "predict_advanced")
    if path is not None:
        scored = materialize(scored, "scored")
        sink.replace_slice(scored, path, target)
    return scored.select("VisitDate", "PointID", "CategoryID", "predict_advanced")


def late_days(frame: DataFrame, share: float = 0.8) -> Column:
    """Condition for the later days: those from where the share of rows is reached."""
    days = frame.groupBy("VisitDate").agg(F.count(F.lit(1)).alias("n"))
    # one row per calendar day, so a window without partitions stays small
    before = Window.orderBy("VisitDate").rowsBetween(Window.unboundedPreceding, -1)
    total = days.agg(F.sum("n")).scalar()
    late = F.coalesce(F.sum("n").over(before), F.lit(0)) >= total * F.lit(share)
    first_late, last = days.withColumn("late", late).agg(
        F.min(F.when(F.col("late"), F.col("VisitDate"))), F.max("VisitDate")).first()
    return F.col("VisitDate") >= F.lit(first_late or last)


def split_by_date(frame: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Earlier days to train on, later days to check: cut where the share of rows is reached."""
    late = late_days(frame, share)
    return frame.where(~late), frame.where(late)


def tune_parameters(
    fact: DataFrame, start, end, path: str, grid: dict | None = None, trials: int = 50
) -> tuple[dict, DataFrame]:
    """Search the grid (by default the whole published one) on a later slice of days and save the best parameters."""
    grid = grid or learning.TUNING_GRID
    with scratch_scope(fact.sparkSession):
        frame, features = learning.training_frame(features_v2(fact, start, end), features=learning.model_features())
        train, holdout = split_by_date(materialize(frame, "training-frame"))
        best, results = learning.tune(train, holdout, features, grid, trials=trials)
    sink.save_params(fact.sparkSession, best, path)
    return best, results


def compare_validation(fact: DataFrame, start, end, iterations: int = learning.ROUNDS, model: str = "boosted") -> DataFrame:
    """Cross-validation by time and by shuffled folds, side by side.

    Validated is the boosted model of ``train_ensemble_and_score`` (features,
    loss, outlier filter; the published single member) with ``iterations`` as the bound of its
    rounds, or the ``tweedie`` one on second-generation features.
    """
    if model not in ("boosted", "tweedie"):
        raise ValueError(f"no such model: {model}")
    keys = ["VisitDate", "PointID", "CategoryID"]
    if model == "boosted":
        frame, features = training_rows_v1(materialize(fact, "daily-sales"), start, end)
    else:
        frame, features = learning.training_frame(features_v2(fact, start, end), features=learning.model_features())
        frame = stats.iqr_filter(materialize(frame, "training-frame"), learning.TARGET)
    frame = materialize(frame, "training-frame")
    # categories may be text here; the modulo order of the folds needs the number
    numbered = frame.withColumn("_point", F.col("PointID").cast("long"))
    by_time = stats.time_series_folds(numbered, "VisitDate", ["_point", "CategoryID"]).drop("_point")
    if model == "boosted":
        vectors = learning.boosted_vectors(stats.kfold(by_time, keys), features, "block", "fold")
        series = learning.cross_validate_boosted(vectors, "block", True, iterations)
        shuffled = learning.cross_validate_boosted(vectors, "fold", False, iterations)
        return learning.compare_schemes(series, shuffled)

    def train(part: DataFrame):
        return learning.train_tweedie(part, features)

    series = learning.cross_validate(by_time, features, "block", True, train)
    shuffled = learning.cross_validate(stats.kfold(frame, keys), features, "fold", False, train)
    return learning.compare_schemes(series, shuffled)


# --- recommendations ---------------------------------------------------------------------------


def recommend_from_stored(
    predictions: DataFrame, rules: DataFrame, sales: DataFrame, reference_date: dt.date, path: str, created_at: dt.datetime,
    model_version: str | None = None, point_id: int | None = None, category_id: int | None = None,
    default_days: int | None = None, clip: bool = True, inputs: StoredInputs | None = None, force_refresh: bool = False,
) -> DataFrame:
    """Recommend from stored forecasts, save, and return the recommended rows.

    With ``inputs`` rules and sales are taken from there while their source files are
    unchanged, so that requests for single pairs do not aggregate all sales again.
    """
    if inputs is not None:
        asked = {"reference_date": reference_date}
        rules = inputs.get("rules", asked, lambda given=rules: given, force_refresh)
        sales = inputs.get("brand-sales", asked, lambda given=sales: given, force_refresh)
    loaded = stored.load_predictions(predictions, point_id, category_id, clip)
    rows = materialize(rec.recommend(loaded, rules, sales, reference_date, default_days), "recommended")
    sink.save_recommendations(rows, path, reference_date, created_at, model_version)
    return rows


def train_and_recommend(
    fact: DataFrame, rules: DataFrame, sales: DataFrame, start, end, reference_date: dt.date, created_at: dt.datetime, path: str,
) -> DataFrame:
    """Train, score the reference day, recommend and save; returns the stored recommendations."""
    predictions = train_and_score(fact, start, end, reference_date, path, created_at=created_at)
    with scratch_scope(fact.sparkSession):
        recommend_from_stored(
            predictions, rules, sales, reference_date, f"{path}/recommendations", created_at, model_version="tweedie_v1")
    return fact.sparkSession.read.parquet(f"{path}/recommendations")
