"""Landed API responses (JSON text) as rows of the weather, traffic and route tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_even

# The parts of the provider responses that are read.
WEATHER_JSON = (
    "name string, coord struct<lat: double, lon: double>, main struct<temp: double, humidity: double>, "
    "rain struct<`1h`: double>, weather array<struct<description: string>>"
)
TRAFFIC_JSON = "flowSegmentData struct<currentSpeed: double, freeFlowSpeed: double>"
ROUTE_JSON = "features array<struct<properties: struct<summary: struct<distance: double, duration: double>>>>"


def weather_rows(landed: DataFrame, payload: str = "payload", fetched: str = "fetched_at") -> DataFrame:
    """payload, fetched_at -> weather schema; no rain object means 0 mm, no description means Unknown."""
    p = F.from_json(payload, WEATHER_JSON)
    text = F.get(F.col("_p.weather.description"), F.lit(0))
    return landed.withColumn("_p", p).select(
        F.to_date(fetched).alias("date"), F.col("_p.name").alias("location"), F.col("_p.coord.lat").alias("latitude"),
        F.col("_p.coord.lon").alias("longitude"), F.col("_p.main.temp").alias("temperature_c"),
        F.col("_p.main.humidity").alias("humidity_pct"), F.coalesce(F.col("_p.rain.1h"), F.lit(0.0)).alias("rainfall_mm"),
        F.initcap(F.coalesce(text, F.lit("Unknown"))).alias("weather_condition"),
    )


def traffic_rows(landed: DataFrame, payload: str = "payload", fetched: str = "fetched_at") -> DataFrame:
    """payload, fetched_at, location, latitude, longitude -> traffic schema with score and level."""
    now, free = F.col("_p.flowSegmentData.currentSpeed"), F.col("_p.flowSegmentData.freeFlowSpeed")
    loss = half_even(F.when(free > 0, (1 - now / free) * 100), 2)
    score = F.when(loss.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), loss)))
    level = (
        F.when(F.col("traffic_score").isNull(), "Unknown")
        .when(F.col("traffic_score") >= 70, "Severe")
        .when(F.col("traffic_score") >= 40, "Heavy")
        .when(F.col("traffic_score") >= 20, "Moderate")
        .otherwise("Low")
    )
    return (
        landed.withColumn("_p", F.from_json(payload, TRAFFIC_JSON))
        .withColumn("traffic_score", score)
        .select(
            F.col(fetched).alias("timestamp"), F.coalesce("location", F.lit("Unknown")).alias("location"), "latitude", "longitude",
            "traffic_score", level.alias("traffic_level"), now.alias("average_speed_kmph"),
        )
    )


def table_traffic_level(level):
    """Provider level names as the traffic table spells them."""
    return F.when(level == "Heavy", "High").otherwise(level)


def route_rows(landed: DataFrame, payload: str = "payload", fetched: str = "fetched_at") -> tuple[DataFrame, DataFrame]:
    """payload plus start/end coordinates -> (routes, rejects); a response without a route is rejected."""
    parsed = landed.withColumn("_f", F.get(F.from_json(payload, ROUTE_JSON)["features"], F.lit(0)))
    summary = "_f.properties.summary"
    routes = parsed.filter(F.col("_f").isNotNull()).select(
        F.col(fetched).alias("timestamp"), "start_longitude", "start_latitude", "end_longitude", "end_latitude",
        half_even(F.col(f"{summary}.distance") / 1000, 2).alias("distance_km"),
        half_even(F.col(f"{summary}.duration") / 60, 2).alias("estimated_duration_min"),
    )
    rejects = parsed.filter(F.col("_f").isNull()).select(
        F.col(fetched).alias("timestamp"), "start_longitude", "start_latitude", "end_longitude", "end_latitude",
        F.lit("no route found").alias("reason"),
    )
    return routes, rejects
