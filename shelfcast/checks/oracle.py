"""Plain SQL for the registered queries, written independently of the operators.

``sql(name)`` puts the shared subqueries a statement needs in front of it.
"""

from __future__ import annotations

import re

REF, START, LAST = "date '1998-04-01'", "date '1998-01-01'", "date '2002-01-01'"
WEEKDAY = 3

# fixed values: public holidays as month and day
HOLIDAYS = "[(1,1),(1,2),(1,3),(1,4),(1,5),(1,6),(1,7),(1,8),(2,23),(3,8),(5,1),(5,9),(6,12),(11,4)]"

_POINT = "PointID, BranchID, PointClass, PointType, Lat, Lon, MicroRegionID"
_CELL = "rtrim(rtrim(cast(cast(round(floor({0} / 0.027e0) * 0.027e0, 3) as decimal(9,3)) as varchar), '0'), '.')"
_NUM = "try_cast(replace(replace(fa.attrtext, ',', '.'), ' ', '') as double)"

# Shared subqueries, each one may use those above it.
PARTS: dict[str, str] = {}

PARTS["fx_items"] = """select p_partkey as iid, case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3
 when 'PROMO' then 4 when 'SMALL' then 5 when 'STANDARD' then 6 end as itid,
 case when p_size = 50 then 0 else 1 end as activeflag from part"""
PARTS["fx_item_attrs"] = "select p_partkey as id, 635 as attrid, cast(substring(p_brand, 7) as int) as attrvalueid, 1 as activeflag from part"
PARTS["fx_attr_values"] = "select distinct cast(substring(p_brand, 7) as int) as attrvalueid, p_brand as attrvaluename from part"
PARTS["fx_faces"] = """select c_custkey as fid, c_nationkey as distid, 1 as ftype,
 case when c_custkey % 37 = 0 then 0 else 1 end as factiveflag from customer"""
PARTS["fx_face_attrs"] = """select c_custkey as fid, 360 as attrid,
 replace(cast(cast(52 + (c_custkey % 8) * 0.013 as decimal(9,3)) as varchar(20)), '.', ',') as attrtext, 1 as activeflag
 from customer where c_custkey % 29 <> 0
 union all select c_custkey, 361, replace(cast(cast(39 + (c_custkey % 5) * 0.017 as decimal(9,3)) as varchar(20)), '.', ', '), 1
 from customer where c_custkey % 29 <> 0
 union all select c_custkey, 602, c_mktsegment, case when c_custkey % 31 = 0 then 0 else 1 end from customer
 union all select c_custkey, 555, r_name, 1 from customer
 join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
PARTS["fx_orders"] = """select o_orderkey % 7 as masterfid, o_orderkey as orid, o_custkey as mfid, o_orderdate as ordate,
 case when o_orderstatus = 'P' then 2 else 1 end as ortype from orders"""
PARTS["fx_order_items"] = """select l_orderkey % 7 as masterfid, l_orderkey as orid, l_partkey as iid, l_quantity as amount,
 l_extendedprice * (1 - l_discount) as roubles from lineitem"""
PARTS["fx_series"] = """select cast(ts as date) as visitdate, user_id as pointid, cast(case event_type when 'click' then 1
 when 'error' then 2 when 'purchase' then 3 when 'signup' then 4 when 'view' then 5 end as int) as categoryid,
 value as sumroubles from events"""

PARTS["pf0"] = f"""select f.fid as PointID, f.distid as BranchID,
 coalesce(max(case when fa.attrid = 360 then {_NUM} end), 0) as Lat, coalesce(max(case when fa.attrid = 361 then {_NUM} end), 0) as Lon,
 coalesce(max(case when fa.attrid = 602 then fa.attrtext end), 'Unknown') as PointClass,
 coalesce(max(case when fa.attrid = 555 then fa.attrtext end), 'Unknown') as PointType
 from fx_faces f left join fx_face_attrs fa on f.fid = fa.fid and fa.activeflag = 1
 where f.ftype = 1 and f.factiveflag = 1 group by f.fid, f.distid"""
PARTS["pf"] = f"""select PointID, BranchID, PointClass, PointType, Lat, Lon,
 {_CELL.format('Lat')} || '_' || {_CELL.format('Lon')} as MicroRegionID from pf0"""
PARTS["item_map"] = """select i.iid, a.attrvalueid as brand, v.attrvaluename as brand_name, cast(i.itid as int) as CategoryID
 from fx_items i join fx_item_attrs a on i.iid = a.id and a.activeflag = 1 and a.attrid = 635
 join fx_attr_values v on a.attrvalueid = v.attrvalueid where i.activeflag = 1 and i.itid is not null"""
PARTS["lines"] = """select o.mfid as PointID, cast(o.ordate as date) as VisitDate, p.BranchID, p.PointClass, p.PointType, p.Lat, p.Lon,
 p.MicroRegionID, m.CategoryID, m.brand, m.brand_name, i.amount, i.roubles
 from fx_orders o join fx_order_items i on o.masterfid = i.masterfid and o.orid = i.orid
 join item_map m on i.iid = m.iid join pf p on o.mfid = p.PointID where o.ortype = 1"""
_BRAND_SALES = f"select {_POINT}, VisitDate, CategoryID, brand, brand_name, sum(amount) as brand_amount from lines where {{w}} group by all"
PARTS["brand_recent"] = _BRAND_SALES.format(w=f"VisitDate >= {START} and VisitDate < {REF}")
PARTS["brand_all"] = _BRAND_SALES.format(w=f"VisitDate < {LAST}")
PARTS["day_fact4"] = f"select VisitDate, CategoryID, {_POINT}, round(sum(roubles), 4) as SumRoubles from lines group by all"
PARTS["day_fact"] = "select * replace (round(SumRoubles, 0) as SumRoubles) from day_fact4"
PARTS["predictions"] = f"""select VisitDate, PointID, CategoryID, SumRoubles as predict_new,
 cast(case when PointID % 3 <> 0 then 1 + PointID % 9 end as int) as DaysNextVisit
 from day_fact where VisitDate >= {START} and VisitDate < {REF}"""

PARTS["holidays"] = f"select make_date(cast(y as int), md[1], md[2]) as h from (select y, unnest({HOLIDAYS.replace('(', '[').replace(')', ']')}) as md from range(1990, 2031) t(y))"
PARTS["days"] = "select distinct VisitDate as d from day_fact union select distinct visitdate from fx_series"
PARTS["day_holidays"] = """select d, d in (select h from holidays) as is_holiday, (d + 1) in (select h from holidays) as after,
 (d - 1) in (select h from holidays) as before, (select min(h) from holidays where h > d) as nxt, (select max(h) from holidays where h < d) as prv
 from days"""
PARTS["cal1"] = """select d, cast(isodow(d) - 1 as int) as day_of_week, isodow(d) >= 6 as is_weekend, isodow(d) = 1 as is_monday,
 isodow(d) = 5 as is_friday, isodow(d) = 6 as is_saturday, isodow(d) = 7 as is_sunday, is_holiday,
 after or isodow(d + 1) >= 6 as is_pre_holiday, before or isodow(d - 1) >= 6 as is_post_holiday,
 cast(least(nxt - d, 365) as int) as days_to_holiday, cast(least(d - prv, 365) as int) as days_from_holiday,
 cast(month(d) as int) as month, cast(quarter(d) as int) as quarter, cast(weekofyear(d) as int) as week_of_year,
 day(d) = 1 as is_month_start, d = last_day(d) as is_month_end, cast(day(d) as int) as day_of_month, cast(dayofyear(d) as int) as day_of_year
 from day_holidays"""
_CAL2 = {
    "DayOfWeek": "isodow(d)", "IsFriday": "case when isodow(d) = 5 then 1 else 0 end",
    "IsMonday": "case when isodow(d) = 1 then 1 else 0 end", "Quarter": "quarter(d)", "Month": "month(d)",
    "WeekOfYear": "weekofyear(d)", "DayOfMonth": "day(d)", "DayOfYear": "dayofyear(d)",
    "isEndOfMonth": "case when day(d) >= day(last_day(d)) - 2 or (day(d) <= 2 and isodow(d) >= 5) or (isodow(d) = 6 and day(d) + 7 > day(last_day(d))) then 1 else 0 end",
    "DaysToNextHoliday": "nxt - d", "DaysSinceLastHoliday": "d - prv",
    "IsPreHoliday": "case when nxt - d <= 3 then 1 else 0 end", "IsPostHoliday": "case when d - prv <= 3 then 1 else 0 end",
}
_PERIODS = {"DayOfYear": 366, "Month": 12, "DayOfWeek": 7, "WeekOfYear": 53, "Quarter": 4}


def _wave_columns(of) -> str:
    return ", ".join(
        f"round({w}(2 * pi() * {of(n)} / {p}), 9) as {n}_{w}" for n, p in _PERIODS.items() for w in ("sin", "cos"))


PARTS["cal2"] = ("select d, " + ", ".join(f"cast({e} as int) as {n}" for n, e in _CAL2.items()) + ", "
                 + _wave_columns(lambda n: _CAL2[n]) + " from day_holidays")

# first-generation history over the series with several rows a day, and over the daily fact
_HISTORY_1 = """select *,
 cast(visitdate - lag(visitdate) over (partition by pointid, categoryid order by visitdate, sumroubles) as int) as Days_Since_Last_Order_Category,
 cast(visitdate - lag(visitdate) over (partition by pointid order by visitdate, categoryid, sumroubles) as int) as Days_Since_Last_Order_Total,
 cast(coalesce(lead(visitdate) over (partition by pointid order by visitdate, categoryid, sumroubles) - visitdate, 7) as int) as DaysNextVisit,
 lag(sumroubles) over (partition by pointid, categoryid order by visitdate, sumroubles) as Prev_Order_Amount_Category
 from {t}"""
_AVG_INTERVAL = """select * exclude (gap), avg(gap) over (partition by pointid, categoryid) as Average_Interval_Category
 from (select *, Days_Since_Last_Order_Category as gap from {t})"""
_DAY_SUMS = "select pointid, categoryid, visitdate, coalesce(sum(sumroubles), 0) as day_sum from {t} group by all"
_ROLLED = """select *, avg(day_sum) over (w rows between 2 preceding and current row) as SMA_3_Category,
 avg(day_sum) over (w rows between 6 preceding and current row) as SMA_7_Category,
 avg(day_sum) over (w rows between 29 preceding and current row) as SMA_30_Category,
 stddev_samp(day_sum) over (w rows between 29 preceding and current row) as StdDev_Category
 from {t} window w as (partition by pointid, categoryid order by visitdate)"""
for _src, _tag in (("fx_series", "s"), ("day_fact", "f")):
    PARTS[f"hist1_{_tag}"] = _HISTORY_1.format(t=_src)
    PARTS[f"hist1avg_{_tag}"] = _AVG_INTERVAL.format(t=f"hist1_{_tag}")
    PARTS[f"sums_{_tag}"] = _DAY_SUMS.format(t=_src)
    PARTS[f"rolled_{_tag}"] = _ROLLED.format(t=f"sums_{_tag}")
    PARTS[f"visits_{_tag}"] = f"""select pointid, visitdate, cast(coalesce(visitdate - lag(visitdate) over (partition by pointid order by visitdate), 7) as int) as DaysLastVisit,
 cast(coalesce(lead(visitdate) over (partition by pointid order by visitdate) - visitdate, 7) as int) as DaysNextVisit
 from (select distinct pointid, visitdate from {_src})"""
    PARTS[f"visits2_{_tag}"] = f"""select *, cast(isodow(visitdate + DaysNextVisit) >= 6 or (visitdate + DaysNextVisit) in (select h from holidays) as int) as isHolidayNextVisit
 from visits_{_tag}"""
    PARTS[f"cadence_{_tag}"] = f"""select pointid, categoryid, visitdate,
 cast(coalesce(visitdate - lag(visitdate) over (partition by pointid, categoryid order by visitdate), 7) as int) as DaysLastSalesCategory,
 coalesce(lag(day_sum) over (partition by pointid, categoryid order by visitdate), 0) as LastSalesCategory from sums_{_tag}"""


def _rolling_columns(digits: int) -> str:
    names = ["SMA_3_Category", "SMA_7_Category", "SMA_30_Category", "StdDev_Category"]
    momentum = f"round(r.SMA_7_Category / nullif(r.SMA_30_Category, 0), {digits}) as Momentum_Category"
    return ", ".join(f"round(r.{n}, {digits}) as {n}" for n in names) + ", " + momentum


PARTS["feats2"] = """select f.*, v.DaysLastVisit, v.DaysNextVisit, v.isHolidayNextVisit, k.DaysLastSalesCategory, k.LastSalesCategory, c.* exclude (d)
 from day_fact f join visits2_f v on f.PointID = v.pointid and f.VisitDate = v.visitdate
 join cadence_f k on f.PointID = k.pointid and f.CategoryID = k.categoryid and f.VisitDate = k.visitdate join cal2 c on f.VisitDate = c.d"""
PARTS["feats1"] = f"""select h.*, {_rolling_columns(4)}, c.* exclude (d) from hist1avg_f h
 join rolled_f r on h.PointID = r.pointid and h.CategoryID = r.categoryid and h.VisitDate = r.visitdate join cal1 c on h.VisitDate = c.d"""

# rules, sales, classes
PARTS["cents"] = """select i.itid as categoryid, a.attrvalueid as brand, sum(round(p.p_retailprice * 100)) as s, count(*) as n
 from fx_items i join fx_item_attrs a on i.iid = a.id join part p on i.iid = p.p_partkey group by all"""
PARTS["rules"] = """select cast(categoryid as int) as categoryid, cast(brand as int) as brand,
 cast(case when brand % 13 = 0 then 1 else 1 + brand % 6 end as int) as brandquantum,
 case brand % 5 when 4 then 'MustList' when 3 then 'DriveList' when 2 then 'NPI' when 1 then 'SPEED' end as importancelabel,
 cast(brand % 5 as int) as priorityweight, cast(case when brand % 4 = 1 then 1 else 0 end as int) as isturbobrand,
 floor((2 * s + n) / (2 * n)) / 100 as avgprice from cents"""
PARTS["sales"] = "select PointID as pointid, VisitDate as visitdate, BranchID as branchid, PointClass as pointclass, PointType as pointtype, Lat as lat, Lon as lon, MicroRegionID as microregionid, CategoryID as categoryid, brand, brand_name, brand_amount, cast(isodow(VisitDate) as int) as dayofweek from brand_recent"
PARTS["ptot"] = """select s.pointid, s.categoryid, round(sum(s.brand_amount * coalesce(r.avgprice, 0)), 6) as category_sales
 from sales s left join rules r on s.categoryid = r.categoryid and s.brand = r.brand group by all"""
PARTS["tot"] = "select pointid, round(sum(category_sales), 6) as total_sales from ptot group by all"
PARTS["tot_edges"] = """select list_distinct(list_transform(quantile_cont(total_sales, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]), lambda e: round(e, 6))) as e,
 min(total_sales) as lo, max(total_sales) as hi from tot"""
PARTS["tot_class"] = """select pointid, total_sales, cast(case when len(e) > 2 then greatest(1, len(list_filter(e, lambda z: z < total_sales)))
 when lo = hi then 5 else 1 + len(list_filter(range(1, 10), lambda i: round(lo + i * (hi - lo) / 10, 6) < total_sales)) end as int) as point_total_class
 from tot, tot_edges"""
PARTS["cat_lists"] = """select categoryid, list(category_sales order by category_sales) as v, count(*) as n,
 least(10, count(*), count(distinct category_sales)) as q from ptot group by categoryid"""
PARTS["cat_edges"] = """select categoryid, list(distinct round(v[1 + floor(pos)::int] + (v[1 + ceil(pos)::int] - v[1 + floor(pos)::int]) * (pos - floor(pos)), 6)) as e
 from (select categoryid, v, (n - 1) * (cast(unnest(range(0, q + 1)) as double) / q) as pos from cat_lists) group by categoryid"""
PARTS["cat_class"] = """select p.pointid, p.categoryid, p.category_sales,
 cast(greatest(1, len(list_filter(e.e, lambda z: z < p.category_sales))) as int) as point_category_class
 from ptot p join cat_edges e on p.categoryid = e.categoryid"""
PARTS["gaps"] = """select c.pointid, c.categoryid, t.point_total_class, c.point_category_class,
 t.point_total_class - c.point_category_class as class_gap from cat_class c left join tot_class t on c.pointid = t.pointid"""
PARTS["pairs"] = """select PointID as pointid, CategoryID as categoryid, greatest(coalesce(avg(case when predict_new < 0 then 0 else predict_new end), 0), 0) as predicted_sum,
 coalesce(arg_min(DaysNextVisit, VisitDate), 7) as days_until_visit from predictions group by all"""
PARTS["budget"] = """select p.*, g.point_total_class, g.point_category_class, coalesce(g.class_gap, 0) as class_gap,
 case when g.class_gap > 0 then 1e0 + g.class_gap * 1e-1 else 1e0 end as factor,
 p.predicted_sum * case when g.class_gap > 0 then 1e0 + g.class_gap * 1e-1 else 1e0 end as extended_sum
 from pairs p left join gaps g on p.pointid = g.pointid and p.categoryid = g.categoryid"""
PARTS["dow"] = "select pointid, categoryid, brand, dayofweek, coalesce(avg(brand_amount), 0) as avg_sales from sales group by all"
PARTS["alld"] = "select pointid, categoryid, brand, coalesce(avg(brand_amount), 0) as avg_sales_all_days from sales group by all"
PARTS["local_sums"] = f"select microregionid, categoryid, brand, sum(brand_amount) as sold from sales where dayofweek = {WEEKDAY} group by all"
PARTS["local_top"] = """select * exclude (best) from (select *, max(sold) over (partition by microregionid, categoryid) as best from local_sums)
 where best > 0 and sold >= best * 8e-1"""
PARTS["regions"] = """select pointid, microregionid from (select *, row_number() over (partition by pointid order by visitdate desc, categoryid, brand) as rn from sales)
 where rn = 1"""
PARTS["means"] = f"""select p.pointid, p.categoryid, r.brand, coalesce(d.avg_sales, a.avg_sales_all_days, 0) as avg_sales
 from pairs p join rules r on p.categoryid = r.categoryid
 left join dow d on d.pointid = p.pointid and d.categoryid = p.categoryid and d.brand = r.brand and d.dayofweek = {WEEKDAY}
 left join alld a on a.pointid = p.pointid and a.categoryid = p.categoryid and a.brand = r.brand"""
PARTS["cand0"] = """select b.*, r.brand as brand_id, cast(r.brand as varchar) as brand_name, r.brandquantum as quantum,
 r.importancelabel as importance_label, r.priorityweight, r.isturbobrand as is_turbo, r.avgprice as avg_price, m.avg_sales as avg_daily_sales,
 t.brand is not null as is_top_local
 from budget b join rules r on b.categoryid = r.categoryid
 join means m on m.pointid = b.pointid and m.categoryid = b.categoryid and m.brand = r.brand
 left join regions g on g.pointid = b.pointid
 left join local_top t on t.microregionid = g.microregionid and t.categoryid = b.categoryid and t.brand = r.brand"""
PARTS["cand1"] = """select *, case when avg_daily_sales > 0 then avg_daily_sales * days_until_visit else quantum end as raw_need,
 cast(case when avg_daily_sales > 0 then ceil(avg_daily_sales * days_until_visit / quantum) * quantum else quantum end as bigint) as recommended_qty,
 cast(1 + priorityweight + 5 * is_turbo + case when is_top_local then 2 else 0 end as int) as priority from cand0"""
PARTS["cand"] = """select pointid, categoryid, brand_id, brand_name, priority, is_turbo, importance_label, is_top_local, avg_daily_sales,
 days_until_visit, raw_need, quantum, recommended_qty, avg_price, recommended_qty * avg_price as estimated_cost, predicted_sum, extended_sum, class_gap,
 concat_ws(' + ', case when not avg_daily_sales > 0 then 'Новый бренд для точки (гарантированный минимум 1 квант)'
  when recommended_qty > 0 then 'Регулярное пополнение на ' || days_until_visit || ' дн (до след визита)' end,
  case when is_top_local then 'Популярно на районе' end, case when is_turbo = 1 then 'Турбо-бренд' end,
  case upper(importance_label) when 'MUSTLIST' then 'стратегическая марка (MustList)' when 'DRIVELIST' then 'стратегическая марка (DriveList)'
   when 'NPI' then 'стратегическая марка (NPI)' when 'SPEED' then 'стратегическая марка (SPEED)' end,
  case when class_gap > 0 then 'Увеличение бюджета на ' || cast(trunc((factor - 1e0) * 100) as int) || '% (точка продает лучше категории)' end) as comment
 from cand1"""
PARTS["ordered"] = "select *, row_number() over (partition by pointid, categoryid order by priority desc, brand_id) as rn from cand"
PARTS["walk"] = """select pointid, categoryid, rn, priority >= 9 or (extended_sum > 0 and estimated_cost <= extended_sum) as included,
  case when priority >= 9 or (extended_sum > 0 and estimated_cost <= extended_sum) then extended_sum - estimated_cost else extended_sum end as rest,
  case when priority < 9 then extended_sum > 0 end as open from ordered where rn = 1
 union all
 select o.pointid, o.categoryid, o.rn, o.priority >= 9 or (coalesce(w.open, w.rest > 0) and o.estimated_cost <= w.rest),
  case when o.priority >= 9 or (coalesce(w.open, w.rest > 0) and o.estimated_cost <= w.rest) then w.rest - o.estimated_cost else w.rest end,
  case when o.priority < 9 then coalesce(w.open, w.rest > 0) end
 from walk w join ordered o on o.pointid = w.pointid and o.categoryid = w.categoryid and o.rn = w.rn + 1"""
PARTS["filled"] = "select o.* exclude (rn), w.included from ordered o join walk w on o.pointid = w.pointid and o.categoryid = w.categoryid and o.rn = w.rn"
PARTS["recs"] = "select * from filled where included"
PARTS["saved"] = f"""select r.*, d.referencedate, d.modelversion from recs r,
 (values (date '1998-03-25', 'model_a'), ({REF}, 'model_b')) d(referencedate, modelversion)"""

# statistics
PARTS["baseline"] = """select VisitDate, PointID, CategoryID, SumRoubles,
 coalesce(lag(SumRoubles) over (partition by PointID, CategoryID order by VisitDate), 0) as forecast from day_fact"""
PARTS["wild0"] = """select * replace (case when CategoryID = 1 then 0 when forecast = 0 then 0 when PointID % 97 = 0 then 'inf'::double
 else forecast * 50 end as forecast) from baseline"""
PARTS["wild1"] = """select * replace (case when forecast > 1e100 then (select quantile_cont(forecast, 0.99) from wild0 where forecast < 1e100)
 else forecast end as forecast) from wild0"""
PARTS["spread"] = "select avg(forecast) as m, stddev_pop(forecast) as s, avg(abs(SumRoubles - forecast)) as mae, avg(SumRoubles) as y from baseline"
PARTS["confident"] = """select b.*, greatest(0, least(1, 1 - mae / y)) * exp(-power(abs((forecast - m) / s), 2) / 2) as Prediction_Confidence from baseline b, spread"""
PARTS["iqr"] = """select quantile_cont(SumRoubles, 0.25) as q1, quantile_cont(SumRoubles, 0.75) as q3 from day_fact"""
_WITHIN = "SumRoubles between q1 - 3 * (q3 - q1) and q3 + 3 * (q3 - q1)"

ORACLE: dict[str, str] = {}
O = ORACLE
O["brand_sales_3m"] = "select PointID as PointId, * exclude (PointID) from brand_recent"
O["brand_sales_all"] = "select PointID as PointId, * exclude (PointID) from brand_all"
O["point_features_pivot"] = "select * from pf"
O["daily_sales_fact"] = "select * from day_fact4"
O["microregion_stats"] = "select MicroRegionID, sum(SumRoubles) as SumRoubles, count(distinct PointID) as points from day_fact group by all"
O["category_totals"] = "select CategoryID, sum(SumRoubles) as SumRoubles, round(sum(SumRoubles) * 1.2e0, 2) as Revenue from day_fact group by all"
O["calendar_features_v1"] = "select VisitDate, PointID, CategoryID, c.* exclude (d) from day_fact join cal1 c on VisitDate = d"
O["calendar_features_v2"] = "select VisitDate, PointID, CategoryID, c.* exclude (d) from day_fact join cal2 c on VisitDate = d"
O["order_history_v1"] = """select visitdate as VisitDate, pointid as PointID, categoryid as CategoryID, sumroubles as SumRoubles,
 Days_Since_Last_Order_Category, Days_Since_Last_Order_Total, DaysNextVisit, round(Average_Interval_Category, 6) as Average_Interval_Category from hist1avg_s"""
O["sales_features_v1"] = f"""select h.visitdate as VisitDate, h.pointid as PointID, h.categoryid as CategoryID, h.sumroubles as SumRoubles,
 h.Prev_Order_Amount_Category, {_rolling_columns(6)} from hist1_s h join rolled_s r on h.pointid = r.pointid and h.categoryid = r.categoryid and h.visitdate = r.visitdate"""
O["visit_features_v2"] = """select s.visitdate as VisitDate, s.pointid as PointID, s.categoryid as CategoryID, s.sumroubles as SumRoubles,
 v.DaysLastVisit, v.DaysNextVisit, v.isHolidayNextVisit from fx_series s join visits2_s v on s.pointid = v.pointid and s.visitdate = v.visitdate"""
O["category_cadence_v2"] = """select s.visitdate as VisitDate, s.pointid as PointID, s.categoryid as CategoryID, s.sumroubles as SumRoubles,
 k.DaysLastSalesCategory, round(k.LastSalesCategory, 2) as LastSalesCategory from fx_series s
 join cadence_s k on s.pointid = k.pointid and s.categoryid = k.categoryid and s.visitdate = k.visitdate"""
O["features_v2_full"] = "select * from feats2"
O["features_v1_full"] = "select * replace (round(Average_Interval_Category, 4) as Average_Interval_Category) from feats1"
O["scoring_frame"] = f"""select {REF} as VisitDate, x.PointID, x.CategoryID, x.BranchID, x.PointClass, x.PointType, x.Lat, x.Lon, x.MicroRegionID,
 cast({REF} - max(x.VisitDate) over (partition by x.PointID) as int) as DaysLastVisit, cast(7 as int) as DaysNextVisit,
 cast({REF} - x.VisitDate as int) as DaysLastSalesCategory, x.SumRoubles as LastSalesCategory, c.* exclude (d)
 from (select *, row_number() over (partition by PointID, CategoryID order by VisitDate desc) as rn from day_fact
  where VisitDate >= {START} and VisitDate < {REF}) x, cal2 c where x.rn = 1 and c.d = {REF}"""
O["scoring_frame_from_state"] = O["scoring_frame"]
O["state_as_of_day"] = f"""select {REF} as VisitDate, l.PointID, l.CategoryID, cast({REF} - l.last as int) as Days_Since_Last_Order_Category,
 cast({REF} - max(l.last) over (partition by l.PointID) as int) as Days_Since_Last_Order_Total, l.amount as Prev_Order_Amount_Category,
 round((l.last - l.first) / nullif(l.n - 1, 0), 4) as Average_Interval_Category, {_rolling_columns(4)}
 from (select PointID, CategoryID, min(VisitDate) as first, max(VisitDate) as last, count(*) as n, arg_max(SumRoubles, VisitDate) as amount
  from day_fact where VisitDate < {REF} group by all) l
 join rolled_f r on l.PointID = r.pointid and l.CategoryID = r.categoryid and l.last = r.visitdate"""
O["brand_rules_clean"] = "select * from rules"
O["rule_categories"] = "select count(distinct categoryid) as categories, count(*) as rules from rules"
O["sales_history_clean"] = "select * from sales"
O["point_total_class"] = "select * from tot_class"
O["point_category_class"] = "select * from cat_class"
O["class_gap_budget"] = "select pointid, categoryid, point_total_class, point_category_class, class_gap, predicted_sum, extended_sum from budget"
O["dow_sales_means"] = """select d.*, a.avg_sales_all_days from dow d join alld a on d.pointid = a.pointid and d.categoryid = a.categoryid and d.brand = a.brand"""
O["local_top_brands"] = "select * from local_top"
O["point_regions"] = "select * from regions"
O["missing_brands"] = f"""select p.pointid, p.categoryid, r.brand from pairs p join rules r on p.categoryid = r.categoryid
 except select pointid, categoryid, brand from sales where dayofweek = {WEEKDAY}"""
O["brand_avg_with_fallback"] = "select * from means"
O["pair_forecast"] = "select * from pairs"
O["clipped_forecasts"] = "select count(*) filter (where predict_new <= 0) as clipped, count(*) as forecasts from predictions"
O["brand_candidates"] = "select * from cand"
O["greedy_budget"] = "select pointid, categoryid, brand_id, priority, estimated_cost, extended_sum, included from filled"
O["greedy_budget_streamed"] = O["greedy_budget"]
O["recommend_orders"] = "select * from recs"
O["recommend_from_inputs"] = O["recommend_orders"]
O["recommendation_rows"] = f"""select pointid as PointId, categoryid as CategoryId, extended_sum as ForecastAmount, days_until_visit as DaysUntilVisit,
 {REF} as ReferenceDate, cast(3 as int) as TargetDayOfWeek, brand_id as BrandId, brand_name as BrandName, quantum as BrandQuantum,
 importance_label as ImportanceLabel, cast(1 + brand_id % 5 as int) as PriorityWeight, is_turbo as IsTurboBrand, avg_price as AvgPrice,
 cast(is_top_local as int) as IsTopLocal, avg_daily_sales as AvgDailySales, raw_need as RawNeed, priority as Priority,
 recommended_qty as RecommendedQty, estimated_cost as EstimatedCost, cast(1 as int) as Included, 'model_a' as ModelVersion,
 predicted_sum as PredictedSum, extended_sum as ExtendedSum, comment as Comment from recs"""
O["top_brands_per_pair"] = """select pointid, categoryid, brand_id, priority, cast(rank as int) as rank from
 (select *, row_number() over (partition by pointid, categoryid order by priority desc, brand_id) as rank from recs) where rank <= 3"""
O["recommendation_summary"] = """select pointid, categoryid, count(*) as brands, round(sum(estimated_cost), 2) as total_cost,
 case when grouping(pointid) = 0 then round(max(extended_sum), 2) end as forecast_amount from recs group by grouping sets ((pointid, categoryid), ())"""
_KEPT = """pointid, categoryid, brand_id as brandid, priority, recommended_qty as recommendedqty, cast(included as int) as included,
 referencedate, modelversion, comment"""
O["recommendations_by_point"] = f"""select {_KEPT} from saved where pointid = (select pointid from saved group by 1 order by count(*) desc, 1 limit 1)
 and referencedate >= date '1998-03-01' order by referencedate desc, categoryid, priority desc, brandid limit 100"""
O["latest_recommendations"] = f"""select {_KEPT} from (select *, row_number() over (partition by pointid, categoryid
 order by referencedate desc, priority desc, brand_id) as rn from saved where included) where rn = 1"""
O["latest_recommendation_batch"] = f"""select {_KEPT} from saved where referencedate = {REF}"""
O["outlier_filter_iqr"] = f"select VisitDate, PointID, CategoryID, SumRoubles from day_fact, iqr where {_WITHIN}"
_CATEGORIES = ["PointID", "CategoryID", "DayOfWeek", "Quarter", "Month", "WeekOfYear", "IsFriday", "IsMonday", "IsPreHoliday", "IsPostHoliday",
               "isEndOfMonth", "BranchID", "PointClass", "PointType", "MicroRegionID"]
_NUMBERS = ["DayOfMonth", "DayOfYear", "DaysToNextHoliday", "DaysSinceLastHoliday", "DaysLastVisit", "DaysNextVisit", "DaysLastSalesCategory"]
O["training_matrix"] = "select * exclude (isHolidayNextVisit) replace (" + ", ".join(
    [f"coalesce(cast({c} as varchar), 'Unknown') as {c}" for c in _CATEGORIES] + [f"cast({c} as double) as {c}" for c in _NUMBERS]
    + ["cast(cast(LastSalesCategory as decimal(18,1)) as varchar) as LastSalesCategory"]) + ") from feats2"
_FLAGS_1 = ["is_weekend", "is_monday", "is_friday", "is_saturday", "is_sunday", "is_holiday", "is_pre_holiday", "is_post_holiday", "is_month_start", "is_month_end"]
_NUMBERS_1 = ["PointID", "CategoryID", "BranchID", "Lat", "Lon", "Days_Since_Last_Order_Category", "Days_Since_Last_Order_Total", "DaysNextVisit",
              "Prev_Order_Amount_Category", "day_of_week", "days_to_holiday", "days_from_holiday", "month", "quarter", "week_of_year", "day_of_month",
              "day_of_year", "SMA_3_Category", "SMA_7_Category", "SMA_30_Category", "StdDev_Category", "Momentum_Category"]
O["training_matrix_v1"] = ("select f.* replace (" + ", ".join(
    [f"cast({c} as varchar) as {c}" for c in _FLAGS_1] + [f"coalesce(cast({c} as double), 0) as {c}" for c in _NUMBERS_1]
    + ["coalesce(round(Average_Interval_Category, 4), 0) as Average_Interval_Category"]) + f") from feats1 f, iqr where {_WITHIN}")
O["time_series_folds"] = """select VisitDate, PointID, CategoryID, SumRoubles,
 cast(case when i < n - 5 * (n // 6) then 0 else 1 + (i - (n - 5 * (n // 6))) // (n // 6) end as int) as block
 from (select *, count(*) over () as n, row_number() over (order by VisitDate, cast('0x' || substr(md5(cast(PointID as varchar)), 1, 3) as int), PointID, CategoryID) - 1 as i from day_fact)"""
_ENCODED = [("Point", ["PointID"]), ("Cell", ["MicroRegionID"]), ("PointCategory", ["PointID", "CategoryID"])]
O["category_routing"] = f"""select {LAST} as VisitDate, PointID, CategoryID, CategoryID in (1, 2, 3, 4) as routed, true as sound
 from (select distinct PointID, CategoryID from day_fact where VisitDate < {LAST})"""
O["category_weekend_models"] = """select CategoryID, cast(isodow(VisitDate) >= 6 as int) as Weekend, count(*) as n, round(avg(SumRoubles), 1) as forecast
 from day_fact group by all"""
O["target_encoding"] = "with " + ", ".join(
    [f"""day_{n} as (select {', '.join(k)}, VisitDate, sum(SumRoubles) as s, count(SumRoubles) as c from day_fact group by all),
 state_{n} as (select {', '.join(k)}, VisitDate, sum(s) over w as s, coalesce(sum(c) over w, 0) as c from day_{n}
  window w as (partition by {', '.join(k)} order by VisitDate rows between unbounded preceding and 1 preceding))""" for n, k in _ENCODED]
    + ["""all_days as (select VisitDate, sum(s) over w / sum(c) over w as m from (select VisitDate, sum(SumRoubles) as s, count(SumRoubles) as c from day_fact group by all)
 window w as (order by VisitDate rows between unbounded preceding and 1 preceding))"""]) + " select f.VisitDate, f.PointID, f.CategoryID, f.MicroRegionID, f.SumRoubles, " + ", ".join(
    f"round(coalesce((coalesce(e{n}.s, 0) + 20 * a.m) / (e{n}.c + 20), 0), 6) as {n}Mean, cast(e{n}.c as bigint) as {n}Rows" for n, _ in _ENCODED) + " from day_fact f join all_days a using (VisitDate) " + " ".join(
    f"join state_{n} e{n} on f.VisitDate = e{n}.VisitDate and " + " and ".join(f"f.{k} is not distinct from e{n}.{k}" for k in key) for n, key in _ENCODED)
_FOLD_SCORES = "avg(abs(SumRoubles - forecast)) as mae, sqrt(avg(power(SumRoubles - forecast, 2))) as rmse, 1 - avg(power(SumRoubles - forecast, 2)) / var_pop(SumRoubles) as r2"
O["fold_scores"] = f"""with placed as (select b.*, row_number() over (order by VisitDate, cast('0x' || substr(md5(cast(PointID as varchar)), 1, 3) as int), PointID, CategoryID) - 1 as i,
  count(*) over () as n, cast('0x' || substr(md5(VisitDate || '|' || PointID || '|' || CategoryID || '|42'), 1, 7) as bigint) % 5 as fold from baseline b),
 parts as (select 'time_series' as scheme, 1 + (i - (n - 5 * (n // 6))) // (n // 6) as part, SumRoubles, forecast from placed where i >= n - 5 * (n // 6)
  union all select 'kfold', fold, SumRoubles, forecast from placed),
 scores as (select scheme, part, {_FOLD_SCORES} from parts group by scheme, part),
 both_schemes as (select scheme, {', '.join(f"{a}({m}) as {m}_{s}" for m in ("mae", "rmse", "r2") for a, s in (("avg", "mean"), ("stddev_pop", "std")))} from scores group by scheme)
 select scheme, {', '.join(f"round({m}_{s}, 6) as {m}_{s}" for m in ("mae", "rmse", "r2") for s in ("mean", "std"))}, r2_mean = max(r2_mean) over () as best from both_schemes"""
O["numbered_append"] = """with sizes as (select cast(CategoryID > 3 as int) as second, count(*) as n, min(CategoryID) as first_category, max(CategoryID) as last_category from predictions group by 1)
 select second, n, n as ids, cast(coalesce(sum(n) over (order by second rows between unbounded preceding and 1 preceding), 0) as bigint) as first_id,
 cast(sum(n) over (order by second) - 1 as bigint) as last_id, first_category, last_category from sizes"""
O["kfold"] = """select VisitDate, PointID, CategoryID,
 cast(cast('0x' || substr(md5(VisitDate || '|' || PointID || '|' || CategoryID || '|42'), 1, 7) as bigint) % 5 as int) as fold from day_fact"""
O["forecast_sanitise"] = """select * replace (round(least(forecast, greatest((select quantile_cont(forecast, 0.999) from wild1), 1e6)), 4) as forecast) from wild1"""
O["prediction_confidence"] = "select * replace (round(Prediction_Confidence, 9) as Prediction_Confidence) from confident"
O["forecast_range"] = """select round(min(forecast), 6) as min_forecast, round(max(forecast), 6) as max_forecast, round(avg(forecast), 6) as mean_forecast,
 round(min(Prediction_Confidence), 6) as min_confidence, round(max(Prediction_Confidence), 6) as max_confidence,
 round(avg(Prediction_Confidence), 6) as mean_confidence from confident"""
O["regression_metrics"] = """select CategoryID, count(*) as n, round(avg(abs(SumRoubles - forecast)), 6) as mae,
 round(sqrt(avg(power(SumRoubles - forecast, 2))), 6) as rmse, round(1 - sum(power(SumRoubles - forecast, 2)) / (var_pop(SumRoubles) * count(*)), 6) as r2
 from baseline group by CategoryID"""
O["bias_ratio"] = """select round(sum(SumRoubles) / sum(forecast), 9) as bias_ratio, round(abs(sum(SumRoubles) / sum(forecast) - 1), 9) as distance from baseline"""
_NOT_31 = "VisitDate <> date '1998-03-31'"
O["replace_slice_roundtrip"] = f"select *, case when {_NOT_31} then 'a' else 'b' end as model from predictions"
O["forecasts_of_outlet"] = """select PointID as pointid, CategoryID as categoryid,
 case when predict_new < 0 then 0e0 else predict_new end as predicted_category_sum, DaysNextVisit as days_until_next_visit, VisitDate as visitdate
 from predictions where PointID = (select min(PointID) from predictions)"""
O["rules_of_category"] = f"select * from ({O['brand_rules_clean']}) where categoryid = (select max(categoryid) from ({O['brand_rules_clean']}))"
O["saved_pair"] = """select pointid, categoryid, brand_id as brandid, recommended_qty as recommendedqty, cast(included as int) as included,
 count(*) over () as written from recs where (pointid, categoryid) = (select (pointid, categoryid) from recs order by pointid, categoryid limit 1)"""
O["forecasts_with_nulls"] = """select PointID as pointid, CategoryID as categoryid,
 coalesce(avg(case when v < 0 then 0 else v end), 0e0) as predicted_sum, coalesce(arg_min(DaysNextVisit, VisitDate), 7) as days_until_visit
 from (select *, case when (PointID + day(VisitDate)) % 3 = 0 then null when PointID % 5 = 1 then -predict_new else predict_new end as v from predictions)
 group by all"""
O["odd_day_counts"] = """select PointID as pointid, CategoryID as categoryid,
 greatest(coalesce(avg(case when predict_new < 0 then 0 else predict_new end), 0), 0) as predicted_sum,
 cast(coalesce(arg_min(d, VisitDate) filter (where d is not null), 7) as int) as days_until_visit
 from (select *, case (PointID + day(VisitDate)) % 4 when 0 then -3 when 1 then 2000003 when 2 then null else day(VisitDate) end as d from predictions)
 group by all"""
O["rules_without_brands"] = "select cast(0 as bigint) as recommended"
O["slice_with_other_days"] = f"""select *, case when {_NOT_31} then 'a' else 'b' end as model from predictions
 union all select *, 'b' as model from predictions where VisitDate = date '1998-03-30' and PointID % 7 = 0"""
O["evolved_then_recreate"] = """select *, case when VisitDate = date '1998-03-29' then null else cast(0.5 as double) end as Prediction_Confidence
 from predictions where VisitDate between date '1998-03-29' and date '1998-03-31'"""
O["append_roundtrip"] = "select VisitDate, PointID, CategoryID, predict_new, timestamp '1998-04-01 12:00:00' as ExportedAt, cast(2 as bigint) as ids from predictions"
O["append_predictions_roundtrip"] = "select *, timestamp '1998-04-01 12:00:00' as CreatedAt, 'catboost_v1' as ModelVersion from predictions"
O["schema_evolution_roundtrip"] = f"select *, case when {_NOT_31} then null else cast(0.5 as double) end as Prediction_Confidence from predictions"
O["recreate_on_mismatch_roundtrip"] = f"select *, cast(0.5 as double) as Prediction_Confidence from predictions where not {_NOT_31}"
O["add_columns_roundtrip"] = """select pointid, categoryid, brand_id as brandid, cast(null as decimal(18,2)) as predictedsum,
 cast(null as decimal(18,2)) as extendedsum, cast(null as varchar) as comment from recs"""
O["overwrite_roundtrip"] = "select * replace (case when PointID % 5 = 0 or PointID % 7 = 0 then null else predict_new end as predict_new) from predictions"
O["failed_write_keeps_rows"] = "select * from predictions"
O["lookup_layout"] = """select * from predictions where PointID % 7 = 0 or (VisitDate >= date '1998-02-01' and VisitDate < date '1998-03-01')"""
O["csv_roundtrip"] = "select * from predictions"


def _needs(text: str) -> set[str]:
    return {name for name in PARTS if re.search(rf"\b{name}\b", text)}


def sql(name: str) -> str:
    """Statement of a query with the subqueries it needs, in order."""
    wanted, stack = set(), [ORACLE[name]]
    while stack:
        for part in _needs(stack.pop()) - wanted:
            wanted.add(part)
            stack.append(PARTS[part])
    chosen = [p for p in PARTS if p in wanted]
    if not chosen:
        return ORACLE[name]
    body = ",\n".join(f"{p} as ({PARTS[p]})" for p in chosen)
    own = ORACLE[name]
    if own.startswith("with "):  # its own subqueries follow the shared ones
        return f"with {'recursive ' if 'walk' in chosen else ''}{body},\n{own[5:]}"
    return f"with {'recursive ' if 'walk' in chosen else ''}{body}\n{ORACLE[name]}"


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in ORACLE}
