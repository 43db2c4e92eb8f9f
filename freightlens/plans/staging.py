"""Typed views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.rules import lower_text
from freightlens.registry import query


def _cast(kind: str, *cols: str):
    return [F.col(c).try_cast(kind).alias(c) for c in cols]


def _lower(*cols: str):
    return [lower_text(c).alias(c) for c in cols]


def stg_orders(df: DataFrame) -> DataFrame:
    return df.select(
        *_cast("string", "order_id", "customer_id", "warehouse_id", "driver_id", "vehicle_id"),
        *_cast("date", "order_date"),
        F.trim("region").alias("region"),
        *_lower("order_status", "delivery_status"),
        *_cast("decimal(18,2)", "order_value"),
        *_cast("decimal(12,2)", "delivery_distance_km"),
        *_cast("int", "promised_delivery_time_min", "actual_delivery_time_min"),
    )


def stg_gps(df: DataFrame) -> DataFrame:
    return df.select(
        *_cast("string", "vehicle_id"),
        F.col("timestamp").try_cast("timestamp_ntz").alias("event_timestamp"),
        F.trim("region").alias("region"),
        *_cast("decimal(10,6)", "latitude", "longitude"),
        *_cast("decimal(10,2)", "speed_kmph"),
        *_cast("decimal(6,2)", "heading"),
        *_lower("vehicle_status", "ignition_status", "signal_quality"),
    )


def stg_weather(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("date").try_cast("date").alias("weather_date"),
        F.trim("location").alias("location"),
        *_cast("decimal(10,6)", "latitude", "longitude"),
        *_cast("decimal(8,2)", "temperature_c", "humidity_pct"),
        *_cast("decimal(10,2)", "rainfall_mm"),
        *_lower("weather_condition"),
    )


def stg_traffic(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("timestamp").try_cast("timestamp_ntz").alias("event_timestamp"),
        F.trim("location").alias("location"),
        *_cast("decimal(10,6)", "latitude", "longitude"),
        *_cast("decimal(8,2)", "traffic_score"),
        *_lower("traffic_level"),
        *_cast("decimal(10,2)", "average_speed_kmph"),
    )


query("stg_orders")(lambda lake: lake.stg_orders)
query("stg_gps")(lambda lake: lake.stg_gps)
query("stg_weather")(lambda lake: lake.stg_weather)
query("stg_traffic")(lambda lake: lake.stg_traffic)
