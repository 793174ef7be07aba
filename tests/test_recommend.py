import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import recommend as rec

D = dt.date


def _candidates(spark, groups):
    rows = [(g, b, p, float(c), float(budget)) for g, budget, items in groups for b, (p, c) in enumerate(items)]
    return spark.createDataFrame(rows, "g int, brand_id int, priority int, estimated_cost double, extended_sum double")


def _included(df):
    out = {}
    for r in df.where("included").collect():
        out.setdefault(r["g"], set()).add(r["brand_id"])
    return out


def _by_hand(budget, items):
    order = sorted(range(len(items)), key=lambda b: (-items[b][0], b))
    left, taken = budget, set()
    for b in order:
        if items[b][0] >= 9:
            taken.add(b)
            left -= items[b][1]
    if left > 0:
        for b in order:
            if items[b][0] < 9 and items[b][1] <= left:
                taken.add(b)
                left -= items[b][1]
    return taken


CASES = [
    (1, 8, [(3, 5), (2, 9), (1, 2)]),  # skip what does not fit and go on
    (2, 10, [(9, 25), (3, 1)]),  # mandatory over budget
    (3, 10, [(9, 10), (3, 0)]),  # nothing left for optional
    (4, 10, [(5, 10), (3, 0)]),  # free item after the last rouble
    (5, 0, [(5, 0), (3, 1)]),
]


def test_greedy_cases(spark):
    got = _included(rec.greedy_fill(_candidates(spark, CASES), ["g"]))
    assert got == {1: {0, 2}, 2: {0}, 3: {0}, 4: {0, 1}}


def test_greedy_agrees_with_brute_force(spark):
    rng = random.Random(7)
    groups = [(g, rng.randint(0, 60), [(rng.randint(1, 12), rng.randint(0, 20)) for _ in range(rng.randint(1, 30))]) for g in range(200)]
    df = _candidates(spark, groups)
    want = {g: t for g, budget, items in groups if (t := _by_hand(budget, items))}
    assert _included(rec.greedy_fill(df, ["g"])) == want


def test_greedy_fractions_negative_costs_and_many_brands(spark):
    """Fractions that add up to the budget, money brought back, 2000 brands in a group, and a group that takes many rounds."""
    rng = random.Random(8)
    groups = [(g, rng.choice([0.3, 1.0, 2.4, 7.7]), [(rng.randint(1, 12), rng.choice([0.1, 0.2, 0.3, 0.7, -0.1, 1.1])) for _ in range(20)])
              for g in range(100)]
    groups += [(g, 5000.0, [(rng.randint(1, 10), rng.random() * 40) for _ in range(2000)]) for g in (200, 201)]
    steps = [(8, 1.0 if i % 2 == 0 else 99.5 - i / 2) for i in range(40)]
    groups.append((300, 100.0, steps))
    want = {g: t for g, budget, items in groups if (t := _by_hand(budget, items))}
    assert _included(rec.greedy_fill(_candidates(spark, groups), ["g"])) == want


def test_greedy_arrays_equal_prefix_sums(spark):
    """Short groups are walked as arrays, without a window, with the same rows taken: unknown, free, negative and fractional costs, equal brands."""
    rng = random.Random(3)
    money = [None, 0.0, -1.0, 3.3, 20.0, float("nan"), float("inf")]
    rows = [
        (g, rng.randint(0, 5), rng.choice([None, 1, 2, 5, 9, 12]), rng.choice([None, 0.0, -0.7, 0.1, 0.2, 0.3, 1.1, 7.0, float("nan")]), budget, i)
        for g in range(300) for budget in [rng.choice(money)] for i in range(rng.randint(1, 14))]
    df = spark.createDataFrame(rows, "g int, brand_id int, priority int, estimated_cost double, extended_sum double, place int")
    short, long = rec.greedy_fill(df, ["g"], most=14), rec.greedy_fill(df, ["g"], most=14, array_brands=0)
    assert "Window" not in short._jdf.queryExecution().toString()
    assert short.columns == long.columns
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect()))


def test_greedy_unknown_costs_and_budgets(spark):
    rows = [(1, 0, 5, None, 10.0), (1, 1, 5, 4.0, 10.0), (1, 2, 4, float("nan"), 10.0), (1, 3, None, 6.0, 10.0),
            (2, 0, 9, 1.0, None), (2, 1, 5, 1.0, None), (3, 0, 9, None, 10.0), (3, 1, 5, 1.0, 10.0), (4, 0, 9, 1.0, 10.0), (4, 0, 9, 1.0, 10.0)]
    df = spark.createDataFrame(rows, "g int, brand_id int, priority int, estimated_cost double, extended_sum double")
    got = rec.greedy_fill(df, ["g"])
    assert got.count() == len(rows) and got.where("included is null").count() == 0
    assert sorted((r["g"], r["brand_id"]) for r in got.where("included").collect()) == [(1, 1), (1, 3), (2, 0), (3, 0), (4, 0), (4, 0)]
    assert rec.greedy_fill(df.limit(0), ["g"]).collect() == []


def test_pack_rounding(spark):
    df = spark.createDataFrame([(7.5, 6), (0.0, 6), (-1.0, 6), (5.0, 0), (5.2, None), (12.0, 6)], "need double, q int")
    assert [r[0] for r in df.select(rec.pack_up(F.col("need"), F.col("q"))).collect()] == [12, 0, 0, 5, 6, 12]


def _comment(spark, **over):
    base = dict(has_history=True, recommended_qty=6, days_until_visit=3, is_top_local=False, is_turbo=0, importance_label=None,
                class_gap=0, adjustment_factor=1.0)
    base.update(over)
    df = spark.createDataFrame([base], "has_history boolean, recommended_qty int, days_until_visit int, is_top_local boolean, "
                               "is_turbo int, importance_label string, class_gap int, adjustment_factor double")
    return df.select(rec.comment()).first()[0]


def test_comment_fragments(spark):
    assert _comment(spark) == "Регулярное пополнение на 3 дн (до след визита)"
    assert _comment(spark, has_history=False, is_top_local=True, is_turbo=1, importance_label=" npi ") == (
        "Новый бренд для точки (гарантированный минимум 1 квант) + Популярно на районе + Турбо-бренд + стратегическая марка (NPI)")
    assert _comment(spark, recommended_qty=0) == "Стандартная рекомендация"
    assert "марка" not in _comment(spark, importance_label="Must List")


def test_comment_percent_is_cut(spark):
    gaps = spark.range(1, 10).select(F.col("id").cast("int").alias("class_gap"))
    from shelfcast.operators.classes import budget_factor

    df = gaps.select(
        "class_gap", budget_factor(F.col("class_gap")).alias("adjustment_factor"), F.lit(True).alias("has_history"),
        F.lit(0).alias("recommended_qty"), F.lit(1).alias("days_until_visit"), F.lit(False).alias("is_top_local"),
        F.lit(0).alias("is_turbo"), F.lit(None).cast("string").alias("importance_label"))
    texts = [r[0] for r in df.orderBy("class_gap").select(rec.comment()).collect()]
    assert [int(t.split("на ")[1].split("%")[0]) for t in texts] == [10, 19, 30, 39, 50, 60, 70, 80, 89]


def test_rules_are_cleaned(spark):
    flags = ["Да", "TRUE", "1", "yes", "no", None]
    rules = spark.createDataFrame(
        [(1, i, None, "x", None, f, None) for i, f in enumerate(flags)],
        "CategoryID int, GroupID int, BrandQuantum int, ImportanceLabel string, PriorityWeight int, IsTurboBrand string, AvgPrice double")
    rows = rec.clean_rules(rules).orderBy("brand").collect()
    assert [r["isturbobrand"] for r in rows] == [1, 1, 1, 1, 0, 0]
    assert (rows[0]["brandquantum"], rows[0]["priorityweight"], rows[0]["avgprice"]) == (1, 0, 0.0)
    assert rec.clean_rules(spark.createDataFrame([(1,)], "CategoryID int")).count() == 0


def test_sales_are_cleaned(spark):
    sales = spark.createDataFrame([(1, "2024-05-05", 2.0), (1, "bad", 1.0)], "mfid long, Visit_Date string, Amount double")
    rows = rec.clean_sales(sales).orderBy(F.col("visitdate").asc_nulls_last()).collect()
    assert [(r["pointid"], r["dayofweek"], r["brand_amount"]) for r in rows] == [(1, 7, 2.0), (1, None, 1.0)]


def test_forecast_names_and_clamp(spark):
    third = spark.createDataFrame([(1, 2, -5.0), (1, 2, 1.0)], "Point_Id long, Category int, whatever double")
    row = rec.pair_forecast(rec.clean_forecasts(third)).first()
    assert (row["predicted_sum"], row["days_until_visit"]) == (0.0, 7)
    assert rec.clean_forecasts(spark.createDataFrame([(1, 2)], "a int, b int")) is None
    dated = spark.createDataFrame(
        [(1, 2, 10.0, None, D(2024, 1, 1)), (1, 2, 20.0, 5, D(2024, 1, 2)), (1, 2, 30.0, 9, D(2024, 1, 3))],
        "pointid long, categoryid int, forecast double, days_until int, visitdate date")
    row = rec.pair_forecast(rec.clean_forecasts(dated), default_days=4).first()
    assert (row["predicted_sum"], row["days_until_visit"]) == (20.0, 5)
    row = rec.pair_forecast(rec.clean_forecasts(dated), default_days=4, on_date=D(2024, 1, 1)).first()
    assert (row["predicted_sum"], row["days_until_visit"]) == (10.0, 4)


def test_weekday_mean_falls_back_only_when_unseen(spark):
    sales = spark.createDataFrame(
        [(1, 1, 1, 3, None), (1, 1, 1, 4, 8.0), (1, 1, 2, 4, 6.0), (1, 1, 2, 5, 2.0), (1, 1, 3, 3, 1.0), (1, 1, 3, 4, 9.0)],
        "pointid long, categoryid int, brand int, dayofweek int, brand_amount double")
    got = {r["brand"]: r["avg_sales"] for r in rec.target_means(sales, 3).collect()}
    assert got == {1: 0.0, 2: 4.0, 3: 1.0}


def test_local_top_needs_positive_sales(spark):
    sales = spark.createDataFrame(
        [("a", 1, 1, 3, 10.0), ("a", 1, 2, 3, 8.0), ("a", 1, 3, 3, 7.9), ("b", 1, 1, 3, 0.0), ("a", 1, 4, 4, 99.0), (None, 1, 5, 3, 9.0)],
        "microregionid string, categoryid int, brand int, dayofweek int, brand_amount double")
    got = {(r["microregionid"], r["brand"]) for r in rec.local_top_brands(sales, 3).collect()}
    assert got == {("a", 1), ("a", 2)}


@pytest.fixture(scope="module")
def tiny(spark):
    rules = spark.createDataFrame(
        [(101, 1, 6, "MustList", 4, "Да", 10.0), (101, 2, 1, None, 0, "Нет", 100.0), (101, 3, None, None, 1, None, 1.0)],
        "CategoryID int, GroupID int, BrandQuantum int, ImportanceLabel string, PriorityWeight int, IsTurboBrand string, AvgPrice double")
    sales = spark.createDataFrame(
        [(1, D(2024, 5, 1), 101, 1, 2.5, "r"), (2, D(2024, 5, 1), 101, 2, 1.0, "r"), (2, D(2024, 4, 24), 101, 2, 3.0, "r")],
        "PointId long, VisitDate date, CategoryID int, brand int, brand_amount double, MicroRegionID string")
    forecasts = spark.createDataFrame([(1, 101, 50.0, 3), (2, 101, 50.0, None), (1, 102, 30.0, 3)],
                                      "pointid long, categoryid int, sumroubles double, days_until_next_visit int")
    return forecasts, rules, sales


def test_recommend_end_to_end(spark, tiny):
    rows = {(r["pointid"], r["brand_id"]): r for r in rec.recommend(*tiny, D(2024, 5, 8)).collect()}
    must = rows[(1, 1)]
    # mean 2.5 over 3 days needs 7.5: two packs of six; mandatory although over budget
    assert (must["recommended_qty"], must["priority"], must["estimated_cost"], must["raw_need"]) == (12, 10, 120.0, 7.5)
    assert (1, 3) not in rows and (1, 2) not in rows
    assert not [k for k in rows if rows[k]["categoryid"] == 102]
    new = rows[(2, 1)]
    assert (new["recommended_qty"], new["avg_daily_sales"]) == (6, 0.0) and new["comment"].startswith("Новый бренд")


def test_many_rules_take_another_road_to_the_same_rows(spark, tiny):
    few = {tuple(r) for r in rec.recommend(*tiny, D(2024, 5, 8)).collect()}
    many = {tuple(r) for r in rec.recommend(*tiny, D(2024, 5, 8), array_brands=1).collect()}
    assert few == many and few


def test_recommend_single_pair_equals_its_rows(spark, tiny):
    everything = {tuple(r) for r in rec.recommend(*tiny, D(2024, 5, 8)).where("pointid = 2").collect()}
    assert {tuple(r) for r in rec.recommend(*tiny, D(2024, 5, 8), point_id=2, category_id=101).collect()} == everything
    with pytest.raises(ValueError):
        rec.recommend(spark.createDataFrame([(1, 2)], "a int, b int"), tiny[1], tiny[2], D(2024, 5, 8))


def test_invariants_on_generated_pairs(spark, sf):
    from shelfcast.checks import queries as q

    rows = q.QUERIES["greedy_budget"](spark, sf).where("included").collect()
    key = lambda r: (r["pointid"], r["categoryid"])
    for _, group in itertools.groupby(sorted(rows, key=key), key):
        group = list(group)
        optional = sum(r["estimated_cost"] for r in group if r["priority"] < 9)
        mandatory = sum(r["estimated_cost"] for r in group if r["priority"] >= 9)
        assert optional == 0 or optional + mandatory <= group[0]["extended_sum"] + 1e-6
    candidates = q.QUERIES["brand_candidates"](spark, sf)
    assert candidates.where("recommended_qty % quantum <> 0 or recommended_qty < quantum").count() == 0


def test_candidates_are_spread_by_their_number(spark, tiny, monkeypatch):
    """Pairs are few bytes: without a cut by count they fan out and fill in one task."""
    monkeypatch.setattr(rec, "CANDIDATES_PER_TASK", 1)
    forecasts, rules, sales = tiny
    plan = rec.recommend(forecasts, rules, sales, D(2024, 3, 6))._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan
