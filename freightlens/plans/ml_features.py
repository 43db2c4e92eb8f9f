"""Feature tables for analysis and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_even, mean, ratio, total, whole
from freightlens.functions.rules import DELAY_CUT, KM_CUT, SCORE_CUT_20, VALUE_CUT, flag, lower_text, upto
from freightlens.operators.dedup import first_per_key
from freightlens.operators.profile import column_counts
from freightlens.operators.ranking import quartile_of_rank
from freightlens.plans.eda import known, with_delay
from freightlens.registry import query

# Peak hours and band edges as published.
PEAK_HOURS = (7, 8, 9, 17, 18, 19, 20)
SPEED_CUT = ((3, "Stationary"), (20, "Slow"), (50, "Normal"), (80, "Fast"), (None, "Very Fast"))
SIGNAL_CUT = ((30, "Poor"), (60, "Fair"), (80, "Good"), (None, "Excellent"))
SPEND_CUT = ((5000, "Low"), (20000, "Medium"), (50000, "High"), (None, "Very High"))
VISITS_CUT = (
    (1, "One-Time"), (3, "Occasional"), (8, "Frequent"), (15, "Highly Frequent"), (None, "Very Highly Frequent"),
)


def calendar(c: str) -> dict[str, Column]:
    return {
        "feature_year": F.year(c),
        "feature_month": F.month(c),
        "feature_day": F.dayofmonth(c),
        "feature_day_of_week": F.weekday(c),
        "feature_day_name": F.date_format(c, "EEEE"),
        "feature_week_of_year": F.weekofyear(c),
        "feature_is_weekend": flag(F.weekday(c) >= 5),
    }


def delivery_columns(orders: DataFrame) -> DataFrame:
    value, km = F.col("order_value").cast("double"), F.col("delivery_distance_km").cast("double")
    promised = F.col("promised_delivery_time_min").cast("double")
    return with_delay(orders).withColumns(
        {
            **calendar("order_date"),
            "feature_is_month_start": flag(F.dayofmonth("order_date") == 1),
            "feature_is_month_end": flag(F.col("order_date") == F.last_day("order_date")),
            "order_value_per_km": F.try_divide(value, km),
            "distance_value_interaction": km * value,
            "planned_speed_kmph": F.try_divide(km, promised) * 60,
            "order_value_band": upto("order_value", VALUE_CUT),
            "distance_band": upto("delivery_distance_km", KM_CUT),
            "delay_severity": upto("delivery_delay_min", DELAY_CUT),
        }
    )


def latest_weather(weather: DataFrame) -> DataFrame:
    """One row per (date, region), the last by rainfall and condition."""
    w = weather.select(
        F.col("date").alias("_wdate"), lower_text("location").alias("_wplace"), "temperature_c", "humidity_pct", "rainfall_mm",
        "weather_condition",
    )
    return first_per_key(
        w, ["_wdate", "_wplace"], [F.desc_nulls_last("rainfall_mm"), F.asc_nulls_last("weather_condition"), F.desc("temperature_c"), F.desc("humidity_pct")]
    )


def weather_score(rain: Column, humidity: Column) -> Column:
    wet = F.least(F.coalesce(rain, F.lit(0)), F.lit(50)).cast("double") * 2
    damp = F.greatest(F.least(F.coalesce(humidity, F.lit(0)) - 70, F.lit(30)), F.lit(0)).cast("double") / 3
    return half_even(F.least(wet + damp, F.lit(100.0)), 2)


def delivery_weather(orders: DataFrame, weather: DataFrame) -> DataFrame:
    on = (F.col("order_date") == F.col("_wdate")) & (lower_text("region") == F.col("_wplace"))
    d = delivery_columns(orders).join(latest_weather(weather), on, "left").drop("_wdate", "_wplace")
    return d.withColumns(
        {
            "is_rainy": flag(F.col("rainfall_mm") > 0),
            "heavy_rain_flag": flag(F.col("rainfall_mm") >= 10),
            "high_humidity_flag": flag(F.col("humidity_pct") >= 80),
            "weather_risk_score": weather_score(F.col("rainfall_mm"), F.col("humidity_pct")),
        }
    ).withColumn("weather_risk_category", upto("weather_risk_score", SCORE_CUT_20))


def gps_columns(gps: DataFrame) -> DataFrame:
    speed = F.coalesce("speed_kmph", F.lit(0))
    signal = F.trim("signal_quality").try_cast("double")
    on = F.lower("ignition_status").isin("on", "1", "true")
    return gps.withColumns(
        {
            **calendar("timestamp"),
            "gps_hour": F.hour("timestamp"),
            "is_peak_hour": flag(F.hour("timestamp").isin(*PEAK_HOURS)),
            "is_moving": flag(speed > 3),
            "is_high_speed": flag(speed > 80),
            "speed_band": upto("speed_kmph", SPEED_CUT),
            "signal_quality": signal,
            "is_low_signal": flag(F.coalesce(signal, F.lit(0.0)) < 50),
            "signal_quality_band": upto(signal, SIGNAL_CUT),
            "is_active_vehicle": flag((F.lower("vehicle_status") == "active") & on),
        }
    )


def _activity(orders: DataFrame, key: str, *more) -> DataFrame:
    g = known(with_delay(orders), key).groupBy(key).agg(
        F.count("order_id").alias("total_orders"), total("order_value", "total_order_value"),
        mean("order_value", "average_order_value", None), mean("delivery_delay_min", "average_delay_min", None),
        whole("is_delayed", "delayed_orders"), *more,
    )
    return g.withColumn("delay_rate", ratio("delayed_orders", "total_orders"))


KM = mean("delivery_distance_km", "average_distance_km", None)


def customer_features(orders: DataFrame) -> DataFrame:
    """Order totals and dates per customer. Active days are counted on one row per (customer, day)."""
    days = known(with_delay(orders), "customer_id").groupBy("customer_id", "order_date").agg(
        F.count("order_id").alias("_n"), F.sum("order_value").alias("_v"), F.count("order_value").alias("_vn"),
        F.sum("delivery_distance_km").alias("_k"), F.count("delivery_distance_km").alias("_kn"),
        F.sum("delivery_delay_min").alias("_d"), F.count("delivery_delay_min").alias("_dn"), F.sum("is_delayed").alias("_l"),
    )
    part = lambda a, b: F.try_divide(F.sum(a).cast("double"), F.sum(b))
    g = days.groupBy("customer_id").agg(
        F.sum("_n").alias("total_orders"), total("_v", "total_order_value"), part("_v", "_vn").alias("average_order_value"),
        part("_k", "_kn").alias("average_distance_km"), part("_d", "_dn").alias("average_delay_min"), whole("_l", "delayed_orders"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        F.count("order_date").alias("active_order_days"),
    )
    return g.withColumn("delay_rate", ratio("delayed_orders", "total_orders")).withColumns(
        {
            "on_time_rate": 1 - F.col("delay_rate"),
            "customer_lifetime_days": F.datediff("last_order_date", "first_order_date"),
            "customer_value_segment": upto("total_order_value", SPEND_CUT),
            "customer_frequency_segment": upto("total_orders", VISITS_CUT),
        }
    )


def driver_features(orders: DataFrame) -> DataFrame:
    on_time, delay = F.col("on_time_rate"), F.col("average_delay_min")
    return _activity(orders, "driver_id", KM).withColumn("on_time_rate", 1 - F.col("delay_rate")).withColumn(
        "driver_performance_category",
        F.when((on_time >= 0.90) & (delay < 10), "High Performer")
        .when((on_time >= 0.75) & (delay < 20), "Good Performer")
        .when((on_time >= 0.50) & (delay < 30), "Needs Improvement")
        .otherwise("High Risk"),
    )


def warehouse_features(orders: DataFrame) -> DataFrame:
    order = [F.col("total_orders"), F.col("warehouse_id")]
    return quartile_of_rank(_activity(orders, "warehouse_id"), order, ["Low", "Medium", "High", "Very High"], "workload_segment")


def feature_tables(lake) -> dict[str, DataFrame]:
    return {
        "delivery_features": delivery_weather(lake.orders, lake.weather),
        "gps_features": gps_columns(lake.gps_tracking),
        "customer_features": customer_features(lake.orders),
        "driver_features": driver_features(lake.orders),
    }


@query("feat_summary")
def feature_summary(lake):
    """Rows, missing values and distinct values of every feature column."""
    parts = []
    for name, df in feature_tables(lake).items():
        kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
        parts.append(column_counts(df, name, distinct=True).withColumn("data_type", kinds[F.col("column_name")]))
    gone = F.col("rows") - F.col("filled")
    return reduce(DataFrame.unionByName, parts).select(
        F.col("dataset").alias("feature_dataset"), F.col("column_name").alias("feature_name"), "data_type", "rows",
        gone.alias("missing_count"), ratio(gone, "rows", 2, 100).alias("missing_pct"), F.col("distinct_values").alias("unique_values"),
    ).orderBy("feature_dataset", "feature_name")


query("feat_calendar")(lambda lake: lake.orders.select("order_id", "order_date").withColumns(calendar("order_date")))
query("feat_delivery")(lambda lake: delivery_columns(lake.orders))
query("feat_delivery_weather")(lambda lake: delivery_weather(lake.orders, lake.weather))
query("feat_gps")(lambda lake: gps_columns(lake.gps_tracking))
query("feat_customer")(lambda lake: customer_features(lake.orders))
query("feat_driver")(lambda lake: driver_features(lake.orders))
query("feat_warehouse")(lambda lake: warehouse_features(lake.orders))
