"""From category forecasts to brand quantities within a budget.

While categories have few rules, which is counted first, everything up to the
last step stays at one row per outlet and category: the outlet's mean quantities
travel as a map from brand to mean, and the popular brands of a grid cell as an
array. Only then does the join with the rules fan out to brands, in place, and
the budget fill works on partitions that already hold whole pairs, as arrays.
With more rules, brand rows are joined by key and the fill takes repeated prefix
sums, which hold for groups of any size.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from shelfcast.functions.columns import finite_or_null, first_present, iso_weekday, lower_columns, rename_synonyms, truthy
from shelfcast.operators import classes
from shelfcast.schemas import FORECAST_SYNONYMS, FORECAST_VALUE_NAMES, RULE_SYNONYMS, SALES_SYNONYMS
from shelfcast.session import broadcast_if_small, materialize

DEFAULT_DAYS = 7
TOP_SHARE = 0.8
TURBO_BONUS, LOCAL_BONUS = 5, 2
MANDATORY_PRIORITY = 9
# Columns of the rules when there are none to apply.
EMPTY_RULES = {
    "categoryid": "int", "brand": "int", "brandquantum": "int", "priorityweight": "int", "avgprice": "double", "isturbobrand": "int",
}
# Brands of one category up to which a pair carries its brand means as a map.
ARRAY_BRANDS = 500
# Candidates that one task fans out and fills. The pairs they come from are too small in bytes to be cut by size.
CANDIDATES_PER_TASK = 100_000
# Rounds of the budget fill between two looks at what is undecided.
ROUNDS_AT_ONCE = 3


# --- input normalisers ------------------------------------------------------------


def clean_rules(rules: DataFrame) -> DataFrame:
    """Canonical names, typed defaults and a numeric turbo flag; no rows without a brand column."""
    df = rename_synonyms(lower_columns(rules), RULE_SYNONYMS)
    if not {"brand", "categoryid"} <= set(df.columns):  # without them a rule says nothing
        known = {f.name: f.dataType for f in df.schema}
        return df.limit(0).select(*[
            (F.col(c) if c in known else F.lit(None)).cast(kind).alias(c) for c, kind in EMPTY_RULES.items()])
    defaults = {"brandquantum": ("int", 1), "priorityweight": ("int", 0), "avgprice": ("double", 0.0)}
    for name, (kind, default) in defaults.items():
        if name in df.columns:
            df = df.withColumn(name, F.coalesce(F.col(name).cast(kind), F.lit(default)))
    if "isturbobrand" in df.columns:
        df = df.withColumn("isturbobrand", truthy("isturbobrand"))
    return df


def clean_sales(sales: DataFrame) -> DataFrame:
    """Canonical names, readable dates and the ISO weekday."""
    df = rename_synonyms(lower_columns(sales), SALES_SYNONYMS)
    if "visitdate" not in df.columns:
        return df
    kind = df.schema["visitdate"].dataType
    if isinstance(kind, T.StringType):
        day = F.col("visitdate").try_cast("timestamp").cast("date")
    else:
        day = F.to_date("visitdate")
    return df.withColumn("visitdate", day).withColumn("dayofweek", iso_weekday("visitdate"))


def clean_forecasts(forecasts: DataFrame) -> DataFrame | None:
    """Columns ``pointid, categoryid, sumroubles, days_until_next_visit, visitdate``; None when unusable.

    The value column is the first known name, else the third column.
    """
    df = rename_synonyms(lower_columns(forecasts), FORECAST_SYNONYMS)
    value = first_present(df, FORECAST_VALUE_NAMES) or (df.columns[2] if len(df.columns) >= 3 else None)
    if value is None or not {"pointid", "categoryid"} <= set(df.columns):
        return None
    days = F.col("days_until_next_visit") if "days_until_next_visit" in df.columns else F.lit(None)
    day = F.to_date("visitdate") if "visitdate" in df.columns else F.lit(None)
    return df.select(
        "pointid", "categoryid", F.col(value).cast("double").alias("sumroubles"),
        days.cast("int").alias("days_until_next_visit"), day.cast("date").alias("visitdate"),
    )


# --- pair level -------------------------------------------------------------------


def pair_forecast(forecasts: DataFrame, default_days: int | None = None, on_date: dt.date | None = None) -> DataFrame:
    """Mean forecast per outlet and category, never negative, and the days to cover.

    Days come from the earliest stored row that has them. All stored dates are
    averaged unless ``on_date`` picks one.
    """
    df = forecasts.where("pointid is not null and categoryid is not null")
    if on_date is not None:
        df = df.where(F.col("visitdate") == F.lit(on_date))
    known = F.when(F.col("days_until_next_visit").isNotNull(), F.struct(
        F.coalesce(F.unix_date("visitdate"), F.lit(0)).alias("day"), F.col("days_until_next_visit").alias("days")))
    fallback = default_days or DEFAULT_DAYS
    return df.groupBy("pointid", "categoryid").agg(
        F.greatest(F.coalesce(F.avg(finite_or_null("sumroubles")), F.lit(0.0)), F.lit(0.0)).alias("predicted_sum"),
        F.coalesce(F.min(known)["days"], F.lit(fallback)).alias("days_until_visit"),
    )


def dow_means(sales: DataFrame) -> DataFrame:
    """Mean quantity per outlet, category, brand and weekday."""
    return sales.where("pointid is not null and categoryid is not null and brand is not null and dayofweek is not null").groupBy(
        "pointid", "categoryid", "brand", "dayofweek").agg(F.coalesce(F.avg("brand_amount"), F.lit(0.0)).alias("avg_sales"))


def all_day_means(sales: DataFrame) -> DataFrame:
    """Mean quantity per outlet, category and brand."""
    return sales.where("pointid is not null and categoryid is not null and brand is not null").groupBy(
        "pointid", "categoryid", "brand").agg(F.coalesce(F.avg("brand_amount"), F.lit(0.0)).alias("avg_sales_all_days"))


def target_means(sales: DataFrame, weekday: int) -> DataFrame:
    """Mean on the weekday, else over all days, in one aggregation.

    A weekday that was seen with unknown quantities counts as zero and does not
    fall back.
    """
    on_day = F.col("dayofweek") == weekday
    mean_on_day = F.coalesce(F.avg(F.when(on_day, F.col("brand_amount"))), F.lit(0.0))
    mean = F.when(F.count_if(on_day) > 0, mean_on_day).otherwise(F.coalesce(F.avg("brand_amount"), F.lit(0.0)))
    return sales.where("pointid is not null and categoryid is not null and brand is not null").groupBy(
        "pointid", "categoryid", "brand").agg(mean.alias("avg_sales"))


def missing_brands(pairs: DataFrame, rules: DataFrame, sales: DataFrame, weekday: int) -> DataFrame:
    """Rule brands without a sale of the pair on the weekday."""
    wanted = pairs.select("pointid", "categoryid").join(broadcast_if_small(rules.select("categoryid", "brand").distinct()), "categoryid")
    sold = sales.where(F.col("dayofweek") == weekday).select("pointid", "categoryid", "brand").distinct()
    return wanted.join(sold, ["pointid", "categoryid", "brand"], "left_anti").select("pointid", "categoryid", "brand")


def local_top_brands(sales: DataFrame, weekday: int, share: float = TOP_SHARE) -> DataFrame:
    """Brands that sell at least ``share`` of the best brand in their grid cell and category; none without a cell column."""
    if "microregionid" not in sales.columns:
        sales = sales.withColumn("microregionid", F.lit(None).cast("string"))
    sums = (
        sales.where(F.col("dayofweek") == weekday)
        .where("microregionid is not null and categoryid is not null and brand is not null")
        .groupBy("microregionid", "categoryid", "brand").agg(F.coalesce(F.sum("brand_amount"), F.lit(0.0)).alias("sold"))
    )
    # A cell and category holds one row per brand here, so its window stays small.
    best = F.max("sold").over(Window.partitionBy("microregionid", "categoryid"))
    return (
        sums.withColumn("best", best).where((F.col("best") > 0) & (F.col("sold") >= F.col("best") * F.lit(share)))
        .select("microregionid", "categoryid", "brand", "sold")
    )


def point_region(sales: DataFrame) -> DataFrame:
    """Grid cell of each outlet: the one of its newest sale; no rows without a cell column."""
    if "microregionid" not in sales.columns:
        sales = sales.withColumn("microregionid", F.lit(None).cast("string"))
    seen = sales.where("microregionid is not null").groupBy("pointid", "microregionid").agg(F.max("visitdate").alias("seen"))
    return seen.groupBy("pointid").agg(F.max(F.struct("seen", "microregionid"))["microregionid"].alias("microregionid"))


def pair_plan(
    pairs: DataFrame, sales: DataFrame, rules: DataFrame, weekday: int, gaps: DataFrame | None = None, packed: bool = False
) -> DataFrame:
    """One row per pair with its budget and grid cell.

    ``packed`` adds the means by brand as a map and the popular brands of the
    cell as an array, both of rule brands only; use it when categories have few
    rules (``brands_bound``). Otherwise ``brand_candidates`` joins them by brand.
    """
    if gaps is None:
        gaps = class_gaps(sales, rules)
    plan = pairs.join(point_region(sales), "pointid", "left")
    if packed:
        ruled = rules.select("categoryid", "brand").distinct()
        popular = local_top_brands(sales, weekday).join(ruled, ["categoryid", "brand"], "left_semi").groupBy(
            "microregionid", "categoryid").agg(F.collect_set("brand").alias("popular"))
        # Outlets without coordinates share one cell: rows of it must not meet in one task.
        plan = plan.join(broadcast_if_small(popular), ["microregionid", "categoryid"], "left")
    # The joins on the pair come last: the fan-out to brands and the budget fill
    # then find whole pairs in place and move no brand rows.
    plan = plan.join(gaps.select("pointid", "categoryid", "class_gap"), ["pointid", "categoryid"], "left")
    if packed:
        by_brand = target_means(sales, weekday).join(ruled, ["categoryid", "brand"], "left_semi").groupBy(
            "pointid", "categoryid").agg(F.map_from_entries(F.collect_list(F.struct("brand", "avg_sales"))).alias("means"))
        plan = plan.join(by_brand, ["pointid", "categoryid"], "left")
    gap = F.coalesce("class_gap", F.lit(0))
    return plan.withColumn("class_gap", gap).withColumn("adjustment_factor", classes.budget_factor(F.col("class_gap"))).withColumn(
        "extended_sum", F.col("predicted_sum") * F.col("adjustment_factor"))


def class_gaps(sales: DataFrame, rules: DataFrame) -> DataFrame:
    """Class gap per outlet and category; the sales values are stored once for all readers."""
    pair_values = materialize(classes.pair_sales_value(sales, rules), "pair-values")
    point_values = materialize(classes.point_sales_value(pair_values), "point-values")
    return classes.class_gap(classes.total_class(point_values), classes.category_class(pair_values))


# --- brand level --------------------------------------------------------------------


def pack_up(need: Column, quantum: Column) -> Column:
    """Smallest whole number of packs that covers the need; zero for no need."""
    pack = F.when(quantum > 0, quantum).otherwise(F.lit(1)).cast("long")
    return F.when(need > 0, F.ceil(need / pack) * pack).otherwise(F.lit(0)).cast("long")


def comment() -> Column:
    """Explanation made of the fragments that apply, in fixed order."""
    # fixed values: texts shown to the representative
    new_brand = "Новый бренд для точки (гарантированный минимум 1 квант)"
    refill = "Регулярное пополнение на %d дн (до след визита)"
    local, turbo = "Популярно на районе", "Турбо-бренд"
    labels = {
        "MUSTLIST": "стратегическая марка (MustList)",
        "DRIVELIST": "стратегическая марка (DriveList)",
        "NPI": "стратегическая марка (NPI)",
        "SPEED": "стратегическая марка (SPEED)",
    }
    raise_text = "Увеличение бюджета на %d%% (точка продает лучше категории)"
    plain = "Стандартная рекомендация"

    label = F.upper(F.trim("importance_label"))
    # the percentage is cut, not rounded: 1.2 - 1 is a little below 0.2
    percent = ((F.col("adjustment_factor") - F.lit(1.0)) * 100).cast("int")
    text = F.concat_ws(
        " + ",
        F.when(~F.col("has_history"), F.lit(new_brand)).when(
            F.col("recommended_qty") > 0, F.format_string(refill, F.col("days_until_visit"))),
        F.when(F.col("is_top_local"), F.lit(local)),
        F.when(F.col("is_turbo") == 1, F.lit(turbo)),
        *[F.when(label.contains(key), F.lit(value)) for key, value in labels.items()],
        F.when((F.col("class_gap") > 0) & (F.col("adjustment_factor") > 1.0), F.format_string(raise_text, percent)),
    )
    return F.when(text == "", F.lit(plain)).otherwise(text)


def _fanned_out(plan: DataFrame, ruled: DataFrame, sales: DataFrame, weekday: int) -> DataFrame:
    """Every rule brand of every pair with its mean quantity and local popularity."""
    # Pairs have few categories, so a shuffle by category would leave most tasks empty.
    fanned = plan.join(broadcast_if_small(ruled), "categoryid")
    if "means" in plan.columns:
        mean, top = F.try_element_at("means", F.col("brand_id")), F.array_contains("popular", F.col("brand_id"))
    else:
        means = target_means(sales, weekday).withColumnRenamed("brand", "brand_id").withColumnRenamed("avg_sales", "_mean")
        popular = local_top_brands(sales, weekday).select(
            "microregionid", "categoryid", F.col("brand").alias("brand_id"), F.lit(True).alias("_top"))
        fanned = fanned.join(popular, ["microregionid", "categoryid", "brand_id"], "left").join(
            means, ["pointid", "categoryid", "brand_id"], "left")
        mean, top = F.col("_mean"), F.col("_top")
    return fanned.withColumn("avg_daily_sales", F.coalesce(mean, F.lit(0.0))).withColumn(
        "is_top_local", F.coalesce(top, F.lit(False)))


def brand_candidates(plan: DataFrame, rules: DataFrame, sales: DataFrame, weekday: int) -> DataFrame:
    """Quantity, cost, priority and comment of every rule brand of every pair.

    Pairs of a category without rules drop out. A brand the outlet never bought
    gets exactly one pack.
    """
    name = F.col("brand_name") if "brand_name" in rules.columns else F.lit(None).cast("string")
    label = F.col("importancelabel") if "importancelabel" in rules.columns else F.lit(None).cast("string")
    ruled = rules.select(
        "categoryid", F.col("brand").alias("brand_id"), F.coalesce(name, F.col("brand").cast("string")).alias("brand_name"),
        F.when(F.col("brandquantum") > 0, F.col("brandquantum")).otherwise(F.lit(1)).alias("quantum"),
        label.alias("importance_label"), "priorityweight", F.col("isturbobrand").alias("is_turbo"),
        F.col("avgprice").alias("avg_price"),
    )
    fanned = _fanned_out(plan, ruled, sales, weekday)
    has_history = F.col("avg_daily_sales") > 0
    need = F.when(has_history, F.col("avg_daily_sales") * F.col("days_until_visit")).otherwise(F.col("quantum").cast("double"))
    quantity = F.when(has_history, pack_up(F.col("raw_need"), F.col("quantum"))).otherwise(F.col("quantum").cast("long"))
    priority = (
        F.lit(1) + F.col("priorityweight") + F.when(F.col("is_turbo") == 1, TURBO_BONUS).otherwise(0)
        + F.when(F.col("is_top_local"), LOCAL_BONUS).otherwise(0)
    )
    return (
        fanned.withColumn("has_history", has_history).withColumn("raw_need", need).withColumn("recommended_qty", quantity)
        .withColumn("estimated_cost", F.col("recommended_qty") * F.col("avg_price"))
        .withColumn("priority", priority.cast("int")).withColumn("comment", comment())
        .select(
            "pointid", "categoryid", "brand_id", "brand_name", "priority", "is_turbo", "importance_label", "is_top_local",
            "avg_daily_sales", "days_until_visit", "raw_need", "quantum", "recommended_qty", "avg_price", "estimated_cost",
            "predicted_sum", "extended_sum", "class_gap", "comment",
        )
    )


def greedy_fill(
    candidates: DataFrame, keys: list[str], item: str = "brand_id", cost: str = "estimated_cost", budget: str = "extended_sum",
    most: int | None = None, array_brands: int = ARRAY_BRANDS,
) -> DataFrame:
    """Mark the candidates that fit the budget of their group (``included``).

    Candidates of mandatory priority are always in, even over budget. If money
    is left, the others are tried by priority, then item number: what fits is
    taken, what does not is skipped. A NULL priority comes last, an unknown
    cost never fits, and after an unknown budget or mandatory cost nothing
    optional does.

    ``most`` is the largest number of candidates a group can have. While that is
    small (``array_brands``) a group is an array that one expression walks: a window
    costs the same for a group of 25 rows as for a long one, and a round takes six.

    Other groups are filled by prefix sums: a round takes the longest prefix that the
    money left can pay, drops what no longer fits, and leaves the rest to the
    next round. Rounds share one partitioning and order; after a few of them
    only groups with undecided candidates go on. The sums start at the money
    left and run in order, so they equal a subtraction item by item, bit for bit.
    """
    others = [c for c in candidates.columns if c not in (*keys, "priority", item, cost)]
    if most is not None and most <= array_brands:
        return _fill_arrays(candidates, keys, item, cost, budget, others)
    ranked = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("priority"), item, cost, *others)
    group = Window.partitionBy(*keys)
    so_far = group.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    must, price = F.coalesce(F.col("priority") >= MANDATORY_PRIORITY, F.lit(False)), F.col(cost).cast("double")
    zero = F.lit(0.0)

    def overdrawn(counted: Column, money: str) -> Column:
        """What the counted costs up to here exceed ``money`` by."""
        return F.sum(F.when(F.col("_at") == 1, -F.col(money)).otherwise(zero) + F.when(counted, price).otherwise(zero)).over(so_far)

    def last(column: str, where: Column) -> Column:
        return F.max(F.when(where, F.struct("_at", column))).over(group)[column]

    rows = candidates.withColumn("_at", F.row_number().over(ranked)).withColumn(
        "_left", F.first(F.col(budget).cast("double")).over(so_far))
    rows = rows.withColumn("_over", overdrawn(must, "_left")).withColumn("_blind", F.max(must & price.isNull()).over(group))
    rows = rows.withColumn("_left", F.when(~F.col("_blind") & F.col("_left").isNotNull(), -last("_over", F.lit(True)))).drop("_blind")
    is_open = F.coalesce((F.col("_left") > 0) & ~F.isnan("_left") & price.isNotNull(), F.lit(False))
    rows = rows.withColumn("_in", F.when(must, True).when(~is_open, False))

    def one_round(df: DataFrame) -> DataFrame:
        waiting = F.col("_in").isNull()
        df = df.withColumn("_over", overdrawn(waiting, "_left"))
        fails = waiting & (F.col("_over") > 0)
        df = df.withColumn("_stop", F.max(fails).over(so_far))
        fits = waiting & ~F.col("_stop")
        df = df.withColumns({
            "_left": F.coalesce(-last("_over", fits), F.col("_left")), "_first": F.min(F.when(fails, F.col("_at"))).over(group),
            # a cost below zero brings money back, so what comes after it may fit again
            "_gains": F.coalesce(F.min(F.when(waiting & F.col("_stop"), price)).over(group) < 0, F.lit(False)),
        })
        never = waiting & ((F.col("_at") == F.col("_first")) | (~F.col("_gains") & (price > F.col("_left"))))
        return df.withColumn("_in", F.when(fits, True).when(never, False).otherwise(F.col("_in"))).drop("_over", "_stop", "_first", "_gains")

    rows, filled = rows.drop("_over"), None
    while True:
        for _ in range(ROUNDS_AT_ONCE):
            rows = one_round(rows)
        stored = materialize(rows.withColumn("_open", F.max(F.col("_in").isNull()).over(group)), "budget-fill")
        closed = stored.where(~F.col("_open")).select(*candidates.columns, F.col("_in").alias("included"))
        filled = closed if filled is None else filled.unionByName(closed)
        rows = stored.where("_open").drop("_open")
        if rows.isEmpty():
            return filled


def _fill_arrays(candidates: DataFrame, keys: list[str], item: str, cost: str, budget: str, others: list[str]) -> DataFrame:
    """The budget fill of groups that fit into an array: the same order, additions and comparisons as the prefix sums."""
    named = [item, cost, *others, "priority"]
    order = [F.col("priority").isNull().alias("_unknown"), (-F.col("priority").cast("long")).alias("_order")]
    groups = candidates.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, *named))).alias("_items"))

    def take(state: Column, x: Column) -> Column:
        must, price, left = F.coalesce(x["priority"] >= MANDATORY_PRIORITY, F.lit(False)), x[cost].cast("double"), state["left"]
        # settled by the first optional candidate: is any money left after the mandatory ones?
        is_open = F.when(~must, F.coalesce(state["open"], ~state["blind"] & (left > 0) & ~F.isnan(left), F.lit(False)))
        fits = must | F.coalesce(is_open & ~((price - left) > 0), F.lit(False))
        return F.struct(
            F.when(fits & price.isNotNull(), left - price).otherwise(left).alias("left"), is_open.alias("open"),
            (state["blind"] | (must & price.isNull())).alias("blind"), F.concat(state["taken"], F.array(fits)).alias("taken"))

    start = F.struct(
        F.get("_items", F.lit(0))[budget].cast("double").alias("left"), F.lit(None).cast("boolean").alias("open"),
        F.lit(False).alias("blind"), F.array().cast("array<boolean>").alias("taken"))
    taken = F.aggregate("_items", start, take, lambda state: state["taken"])
    return groups.select(*keys, F.explode(F.arrays_zip("_items", taken.alias("_taken"))).alias("_z")).select(
        *[F.col(c) if c in keys else F.col(f"_z._items.{c}").alias(c) for c in candidates.columns], F.col("_z._taken").alias("included"))


def brands_bound(rules: DataFrame) -> int:
    """Largest number of rules in one category (one row to the driver)."""
    return rules.groupBy("categoryid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def recommend(
    forecasts: DataFrame, rules: DataFrame, sales: DataFrame, reference_date: dt.date,
    default_days: int | None = None, on_date: dt.date | None = None,
    point_id: int | None = None, category_id: int | None = None, stored: bool = False,
    array_brands: int = ARRAY_BRANDS,
) -> DataFrame:
    """Recommended brands of every forecast pair: the candidates that fit the budget.

    ``point_id`` and ``category_id`` narrow the pairs; classes and popular
    brands still come from all sales. The sales and rules are written once
    unless they are ``stored`` tables already, as several branches read them.
    """
    weekday = reference_date.isoweekday()
    rules, sales = clean_rules(rules), clean_sales(sales)
    if not stored:
        rules, sales = materialize(rules, "brand-rules"), materialize(sales, "sales-history")
    cleaned = clean_forecasts(forecasts)
    if cleaned is None:
        raise ValueError("forecasts need an outlet, a category and a value column")
    if point_id is not None:
        cleaned = cleaned.where(F.col("pointid") == point_id)
    if category_id is not None:
        cleaned = cleaned.where(F.col("categoryid") == category_id)
    pairs = materialize(pair_forecast(cleaned, default_days, on_date), "pairs")
    bound = brands_bound(rules)
    plan = pair_plan(pairs, sales, rules, weekday, packed=bound <= array_brands)
    if bound <= array_brands:
        plan = plan.repartition(max(1, math.ceil(pairs.count() * bound / CANDIDATES_PER_TASK)), "pointid", "categoryid")
    candidates = brand_candidates(plan, rules, sales, weekday)
    return greedy_fill(candidates, ["pointid", "categoryid"], most=bound, array_brands=array_brands).where("included")


# --- reports ------------------------------------------------------------------------


def top_brands(recommended: DataFrame, k: int) -> DataFrame:
    """The ``k`` brands of highest priority per pair."""
    order = Window.partitionBy("pointid", "categoryid").orderBy(F.desc("priority"), "brand_id")
    return recommended.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def summary(recommended: DataFrame) -> DataFrame:
    """Brands and cost per pair, and over all pairs (the row without keys)."""
    keys = [F.col("pointid"), F.col("categoryid")]
    return recommended.groupingSets([keys, []], *keys).agg(
        F.count(F.lit(1)).alias("brands"), F.sum("estimated_cost").alias("total_cost"),
        F.when(F.grouping_id() == 0, F.max("extended_sum")).alias("forecast_amount"),
    )
