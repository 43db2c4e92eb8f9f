"""Cleaned orders, GPS and weather, the delivery feature table, and the gates that check them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_up, mean, rows_if
from freightlens.functions.rules import KM_BUCKETS, bad_coordinates, below, flag, is_blank, low_signal, upper_text
from freightlens.operators.dedup import first_per_key
from freightlens.registry import query
from freightlens.sources.schemas import RAW, require_columns


def _typed(c: str, kind: str):
    return F.col(c).try_cast(kind).alias(c)


def clean_orders(orders: DataFrame) -> DataFrame:
    require_columns(orders, RAW["orders"].names, "orders")
    typed = orders.select(
        *[F.trim(c).alias(c) for c in ("order_id", "customer_id", "warehouse_id", "driver_id", "vehicle_id")],
        _typed("order_date", "date"),
        *[upper_text(c).alias(c) for c in ("region", "order_status", "delivery_status")],
        *[
            _typed(c, "double")
            for c in ("order_value", "delivery_distance_km", "promised_delivery_time_min", "actual_delivery_time_min")
        ],
    )
    once = first_per_key(typed, ["order_id"], [F.col(c).asc_nulls_last() for c in typed.columns if c != "order_id"])
    delay = half_up(F.col("actual_delivery_time_min") - F.col("promised_delivery_time_min"), 2)
    return once.select(
        "*",
        delay.alias("delivery_delay_min"),
        flag(delay > 0).alias("is_delayed"),
        F.greatest(delay, F.lit(0.0)).alias("positive_delay_min"),
        F.when(F.col("delivery_distance_km") > 0, half_up(F.col("order_value") / F.col("delivery_distance_km"), 2)).alias(
            "delivery_per_km_value"
        ),
    )


def clean_gps(gps: DataFrame) -> DataFrame:
    require_columns(gps, RAW["gps_tracking"].names, "gps_tracking")
    typed = gps.select(
        F.trim("vehicle_id").alias("vehicle_id"),
        _typed("timestamp", "timestamp_ntz"),
        upper_text("region").alias("region"),
        *[_typed(c, "double") for c in ("latitude", "longitude", "speed_kmph", "heading")],
        *[upper_text(c).alias(c) for c in ("vehicle_status", "ignition_status", "signal_quality")],
    )
    keys = ["vehicle_id", "timestamp"]
    once = first_per_key(typed, keys, [F.col(c).asc_nulls_last() for c in typed.columns if c not in keys])
    return once.select(
        "*",
        F.to_date("timestamp").alias("date"),
        F.hour("timestamp").alias("hour"),
        F.date_format("timestamp", "E").alias("day_of_week"),
        F.weekday("timestamp").alias("weekday_index"),
        flag(F.col("speed_kmph") > 0).alias("is_moving"),
        flag(low_signal()).alias("is_low_signal"),
    )


def weather_flags(w: DataFrame) -> DataFrame:
    """Rain, humidity and risk columns; the same for batch rows and streamed weather events."""
    rain, text = F.col("rainfall_mm"), F.col("weather_condition")
    humid = F.col("humidity_pct") >= 80
    return w.select(
        "*",
        flag((rain > 0) | text.rlike("RAIN|DRIZZLE|STORM")).alias("is_rainy"),
        flag(rain >= 10).alias("heavy_rain_flag"),
        flag(humid).alias("high_humidity_flag"),
        F.when((rain >= 20) | text.rlike("STORM|THUNDER"), "HIGH")
        .when((rain >= 5) | humid | text.rlike("RAIN|DRIZZLE"), "MEDIUM")
        .otherwise("LOW")
        .alias("weather_risk"),
    )


def weather_columns(weather: DataFrame) -> DataFrame:
    measures = ("latitude", "longitude", "temperature_c", "humidity_pct", "rainfall_mm")
    return weather.select(
        _typed("date", "date"),
        F.trim("location").alias("location"),
        *[_typed(c, "double") for c in measures],
        upper_text("weather_condition").alias("weather_condition"),
    )


def clean_weather(weather: DataFrame) -> DataFrame:
    require_columns(weather, RAW["weather"].names, "weather")
    typed = weather_columns(weather)
    keys = ["date", "location"]
    order = [F.col("rainfall_mm").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in typed.columns if c not in [*keys, "rainfall_mm"]
    ]
    return weather_flags(first_per_key(typed, keys, order))


def weather_daily(weather_clean: DataFrame, place: Column | None = None) -> DataFrame:
    """One row per day and location, or per day and the given place expression (as column `location`)."""
    weather_clean = weather_clean if place is None else weather_clean.withColumn("location", place)
    level = F.when(F.col("weather_risk") == "HIGH", 3).when(F.col("weather_risk") == "MEDIUM", 2).otherwise(1)
    return (
        weather_clean.groupBy("date", "location")
        .agg(
            mean("temperature_c", "temperature_c"),
            mean("humidity_pct", "humidity_pct"),
            half_up(F.sum("rainfall_mm"), 2).alias("rainfall_mm"),
            *[F.max(c).alias(c) for c in ("is_rainy", "heavy_rain_flag", "high_humidity_flag")],
            F.max(level).alias("_level"),
        )
        .withColumn("weather_risk", F.element_at(F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")), F.col("_level")))
        .drop("_level")
    )


def delivery_features(orders_clean: DataFrame, weather_clean: DataFrame) -> DataFrame:
    """Orders with the day's weather of their region. Spellings of one place are one group, so no order is multiplied."""
    sky = weather_daily(weather_clean, upper_text("location")).select(
        F.col("date").alias("_date"), F.col("location").alias("_place"), "temperature_c", "humidity_pct", "rainfall_mm",
        "is_rainy", "heavy_rain_flag", "high_humidity_flag", "weather_risk",
    )
    o = orders_clean.withColumn("region", upper_text("region"))
    joined = o.join(sky, (F.col("order_date") == F.col("_date")) & (F.col("region") == F.col("_place")), "left").drop("_date", "_place")
    late, wet = F.col("is_delayed") == 1, F.col("is_rainy") == 1
    rough = (F.col("delivery_delay_min") >= 30) | (F.col("heavy_rain_flag") == 1)
    return joined.select(
        "*",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        F.dayofmonth("order_date").alias("order_day"),
        F.dayofweek("order_date").alias("order_day_of_week"),
        flag(F.weekday("order_date") >= 5).alias("is_weekend"),
        F.when(
            F.col("promised_delivery_time_min") > 0,
            half_up(F.col("delivery_delay_min") / F.col("promised_delivery_time_min"), 4),
        ).alias("delay_ratio"),
        F.when(
            F.col("actual_delivery_time_min") > 0,
            half_up(F.col("delivery_distance_km") / F.col("actual_delivery_time_min"), 4),
        ).alias("delivery_efficiency"),
        below("delivery_distance_km", KM_BUCKETS).alias("distance_bucket"),
        below("order_value", ((500, "Low"), (1500, "Medium"), (None, "High"))).alias("order_value_bucket"),
        F.when(late & rough, "HIGH").when(late | wet, "MEDIUM").otherwise("LOW").alias("delivery_risk"),
        flag(late & wet).alias("weather_delay_risk"),
    )


def _any_negative(*cols: str):
    test = F.lit(False)
    for c in cols:
        test = test | (F.col(c) < 0)
    return test


def gate_orders(df: DataFrame) -> DataFrame:
    return df.agg(
        rows_if(is_blank("order_id"), "invalid_ids"),
        rows_if(F.col("order_date").isNull(), "invalid_dates"),
        rows_if(
            _any_negative("order_value", "delivery_distance_km", "promised_delivery_time_min", "actual_delivery_time_min"),
            "negative_values",
        ),
    )


def gate_gps(df: DataFrame) -> DataFrame:
    return df.agg(
        rows_if(is_blank("vehicle_id"), "invalid_vehicle_ids"),
        rows_if(F.col("timestamp").isNull(), "invalid_timestamps"),
        rows_if(bad_coordinates(), "invalid_coordinates"),
        rows_if(F.col("speed_kmph") < 0, "invalid_speed"),
        rows_if(~F.col("heading").between(0, 360), "invalid_heading"),
    )


def gate_weather(df: DataFrame) -> DataFrame:
    return df.agg(
        rows_if(F.col("date").isNull(), "invalid_dates"),
        rows_if(bad_coordinates(), "invalid_coordinates"),
        rows_if(~F.col("humidity_pct").between(0, 100) | (F.col("rainfall_mm") < 0), "invalid_weather_values"),
    )


def gate_features(df: DataFrame) -> DataFrame:
    return df.agg(
        rows_if(is_blank("order_id"), "invalid_ids"),
        rows_if(F.col("delivery_distance_km") < 0, "negative_distance"),
        rows_if(F.col("order_value") < 0, "negative_value"),
    )


def require_clean(gate: DataFrame) -> None:
    """Run a gate (one job, one row) and raise when a count is not zero."""
    counts = gate.first().asDict()
    broken = {k: v for k, v in counts.items() if v}
    if broken:
        raise ValueError("data quality gate failed: " + ", ".join(f"{k}={v}" for k, v in broken.items()))


query("clean_orders")(lambda lake: lake.orders_clean)
query("clean_gps")(lambda lake: lake.gps_clean)
query("clean_weather")(lambda lake: lake.weather_clean)
query("weather_daily")(lambda lake: lake.weather_daily)
query("delivery_features")(lambda lake: lake.features)
query("gate_orders")(lambda lake: gate_orders(lake.orders_clean))
query("gate_gps")(lambda lake: gate_gps(lake.gps_clean))
query("gate_weather")(lambda lake: gate_weather(lake.weather_clean))
query("gate_features")(lambda lake: gate_features(lake.features))
