"""Canonical tables, column synonyms and the feature vector."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment})


DAILY_SALES = T.StructType([
    _field("VisitDate", T.DateType(), "day of the visit"),
    _field("PointID", T.LongType(), "outlet"),
    _field("CategoryID", T.IntegerType(), "goods category"),
    _field("BranchID", T.IntegerType(), "distribution branch"),
    _field("PointClass", T.StringType(), "outlet class"),
    _field("PointType", T.StringType(), "outlet type"),
    _field("Lat", T.DoubleType(), "latitude, 0 when unknown"),
    _field("Lon", T.DoubleType(), "longitude, 0 when unknown"),
    _field("MicroRegionID", T.StringType(), "cell of the 3 km grid"),
    _field("SumRoubles", T.DoubleType(), "sales of the day"),
])
DAILY_COLUMNS = DAILY_SALES.fieldNames()

BRAND_SALES_COLUMNS = [
    "PointId", "VisitDate", "BranchID", "PointClass", "PointType", "Lat", "Lon",
    "MicroRegionID", "CategoryID", "brand", "brand_name", "brand_amount",
]

_FLAGS = {
    "is_weekend": "Saturday or Sunday", "is_monday": "Monday", "is_friday": "Friday", "is_saturday": "Saturday",
    "is_sunday": "Sunday", "is_holiday": "public holiday", "is_pre_holiday": "before a holiday or weekend",
    "is_post_holiday": "after a holiday or weekend", "is_month_start": "first day of the month",
    "is_month_end": "last day of the month",
}
_COUNTS = {
    "day_of_week": "0 = Monday … 6 = Sunday", "month": "month", "quarter": "quarter", "week_of_year": "ISO week",
    "day_of_month": "day of the month", "day_of_year": "day of the year", "days_to_holiday": "days to the next holiday",
    "days_from_holiday": "days since the last holiday",
    "Days_Since_Last_Order_Category": "days since the pair's previous order",
    "Days_Since_Last_Order_Total": "days since the outlet's previous order", "DaysNextVisit": "days to the next visit",
}
_FIGURES = {
    "Average_Interval_Category": "mean days between the pair's orders",
    "Prev_Order_Amount_Category": "amount of the pair's previous order", "SMA_3_Category": "mean of the last 3 days sold",
    "SMA_7_Category": "mean of the last 7 days sold", "SMA_30_Category": "mean of the last 30 days sold",
    "Momentum_Category": "7-day mean over 30-day mean", "StdDev_Category": "spread of the last 30 days sold",
    "predict_new": "forecast of the category sum", "Prediction_Confidence": "0 … 1",
}
# Stored first-generation forecasts.
PREDICTIONS = T.StructType([
    *[f for f in DAILY_SALES if f.name != "SumRoubles"],
    *[_field(n, T.BooleanType(), c) for n, c in _FLAGS.items()],
    *[_field(n, T.IntegerType(), c) for n, c in _COUNTS.items()],
    *[_field(n, T.DoubleType(), c) for n, c in _FIGURES.items()],
    _field("CreatedAt", T.TimestampType(), "time of writing"),
    _field("ModelVersion", T.StringType(), "model that made the row"),
])

# fixed values: columns of a stored recommendation, in order
RECOMMENDATIONS = T.StructType([
    _field("PointId", T.LongType(), "outlet"),
    _field("CategoryId", T.IntegerType(), "goods category"),
    _field("ForecastAmount", T.DecimalType(18, 2), "budget after the class adjustment"),
    _field("DaysUntilVisit", T.IntegerType(), "days to cover"),
    _field("ReferenceDate", T.DateType(), "day of the calculation"),
    _field("TargetDayOfWeek", T.IntegerType(), "1 = Monday … 7 = Sunday"),
    _field("BrandId", T.IntegerType(), "brand"),
    _field("BrandName", T.StringType(), "brand name"),
    _field("BrandQuantum", T.IntegerType(), "pack size"),
    _field("ImportanceLabel", T.StringType(), "strategic label"),
    _field("PriorityWeight", T.IntegerType(), "priority without the bonuses"),
    _field("IsTurboBrand", T.IntegerType(), "1 when promoted"),
    _field("AvgPrice", T.DecimalType(18, 2), "mean price"),
    _field("IsTopLocal", T.IntegerType(), "1 when popular in the grid cell"),
    _field("AvgDailySales", T.DecimalType(18, 4), "mean quantity on the weekday"),
    _field("RawNeed", T.DecimalType(18, 4), "quantity before pack rounding"),
    _field("Priority", T.IntegerType(), "final priority"),
    _field("RecommendedQty", T.LongType(), "quantity after pack rounding"),
    _field("EstimatedCost", T.DecimalType(18, 2), "quantity times price"),
    _field("Included", T.IntegerType(), "1 when it fits the budget"),
    _field("ModelVersion", T.StringType(), "model behind the forecast"),
    _field("PredictedSum", T.DecimalType(18, 2), "forecast before the adjustment"),
    _field("ExtendedSum", T.DecimalType(18, 2), "forecast after the adjustment"),
    _field("Comment", T.StringType(), "explanation for the representative"),
])
# Columns a later version added to the table of recommendations.
RECOMMENDATIONS_ADDED = ["PredictedSum", "ExtendedSum", "Comment"]

# fixed values: accepted column names, in order of preference
DATE_NAMES = ["date", "Date", "DATE", "VisitDate", "visitdate"]
POINT_NAMES = ["outlet_id", "OutletID", "OUTLET_ID", "outletId", "PointID", "pointid"]
CATEGORY_NAMES = ["category_id", "CategoryID", "CATEGORY_ID", "categoryId", "Category_Id"]
AMOUNT_NAMES = ["sales_amount", "SalesAmount", "SALES_AMOUNT", "amount", "Amount", "sum", "Sum", "SumRoubles"]

# fixed values: accepted names of the rule columns
RULE_SYNONYMS = {
    "categoryid": ["category_id", "category"],
    "brand": ["brandid", "brand_id", "groupid", "group_id"],
    "brandquantum": ["brand_quantum", "quantum"],
    "priorityweight": ["priority_weight", "weight"],
    "isturbobrand": ["is_turbo_brand", "turbo"],
    "avgprice": ["avg_price", "price"],
    "importancelabel": ["importance_label"],
    "brand_name": ["brandname", "attrvaluename"],
}
# fixed values: accepted names of the sales columns
SALES_SYNONYMS = {
    "pointid": ["point_id", "point", "mfid"],
    "categoryid": ["category_id", "category"],
    "brand_amount": ["brandamount", "amount"],
    "microregionid": ["micro_region_id", "microregion"],
    "visitdate": ["visit_date"],
    "brand": ["brandid", "brand_id"],
}
# fixed values: accepted names of the forecast columns
FORECAST_SYNONYMS = {
    "pointid": ["point_id", "point", "mfid"],
    "categoryid": ["category_id", "category"],
    "days_until_next_visit": ["days_until_visit", "days_until"],
}
# fixed values: names of the forecast itself, in order of preference
FORECAST_VALUE_NAMES = ["predicted_category_sum", "sumroubles", "forecast_amount", "forecast"]

# fixed values: the feature vector of the single model, in order
FEATURES = [
    "PointID", "CategoryID", "BranchID", "PointClass", "PointType", "Lat", "Lon", "MicroRegionID",
    "DayOfWeek", "IsFriday", "IsMonday", "Quarter", "Month", "WeekOfYear", "DayOfMonth", "DayOfYear",
    "isEndOfMonth", "DaysToNextHoliday", "DaysSinceLastHoliday", "IsPreHoliday", "IsPostHoliday",
    "DayOfYear_sin", "DayOfYear_cos", "Month_sin", "Month_cos", "DayOfWeek_sin", "DayOfWeek_cos",
    "WeekOfYear_sin", "WeekOfYear_cos", "Quarter_sin", "Quarter_cos",
    "DaysLastVisit", "DaysNextVisit", "DaysLastSalesCategory", "LastSalesCategory",
]
# fixed values: the features that are categories
CATEGORICAL = [
    "PointID", "CategoryID", "DayOfWeek", "Quarter", "Month", "WeekOfYear", "IsFriday", "IsMonday",
    "IsPreHoliday", "IsPostHoliday", "isEndOfMonth", "BranchID", "PointClass", "PointType",
    "MicroRegionID", "LastSalesCategory",
]

# fixed values: columns of a stored first-generation forecast, in order
PREDICTION_COLUMNS_V1 = [
    "VisitDate", "PointID", "CategoryID", "BranchID", "PointClass", "PointType", "Lat", "Lon", "MicroRegionID",
    "day_of_week", "is_weekend", "is_monday", "is_friday", "is_saturday", "is_sunday",
    "is_holiday", "is_pre_holiday", "is_post_holiday", "month", "quarter", "week_of_year",
    "is_month_start", "is_month_end", "day_of_month", "day_of_year", "days_to_holiday", "days_from_holiday",
    "Days_Since_Last_Order_Category", "Days_Since_Last_Order_Total", "Average_Interval_Category", "DaysNextVisit",
    "Prev_Order_Amount_Category", "SMA_3_Category", "SMA_7_Category", "SMA_30_Category",
    "Momentum_Category", "StdDev_Category", "predict_new", "Prediction_Confidence",
]


def categorical_indexes(features: list[str] = FEATURES) -> list[int]:
    return [i for i, name in enumerate(features) if name in CATEGORICAL]
