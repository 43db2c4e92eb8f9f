"""Intermediate models and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_up, ratio
from freightlens.functions.rules import DONE_STATUSES, KM_REACH, VALID_STATUSES, at_least, below, flag, lower_text
from freightlens.operators.asof import asof_by_day
from freightlens.operators.dedup import first_per_key
from freightlens.operators.proximity import nearest_within
from freightlens.operators.rollup import entity_rollup
from freightlens.registry import query

SKY = ["weather_date", "weather_location", "temperature_c", "humidity_pct", "rainfall_mm", "weather_condition"]
JAM = ["traffic_location", "traffic_latitude", "traffic_longitude", "traffic_score", "traffic_level", "traffic_average_speed_kmph"]
DONE = lower_text("delivery_status").isin(*DONE_STATUSES)
LATE = F.col("actual_delivery_time_min") > F.col("promised_delivery_time_min")
DELAY = F.col("actual_delivery_time_min") - F.col("promised_delivery_time_min")


def delivery_asof_weather(orders: DataFrame, weather: DataFrame) -> DataFrame:
    """Each order with the latest weather of its region on or before the order date."""
    w = weather.select(
        lower_text("location").alias("_place"), F.col("weather_date").alias("_wday"), "weather_date",
        F.col("location").alias("weather_location"), *SKY[2:],
    )
    wettest = [F.desc_nulls_last("rainfall_mm"), F.asc_nulls_last("weather_condition"), F.asc("temperature_c"), F.asc("humidity_pct")]
    return asof_by_day(orders, w, lower_text("region"), "order_date", "_place", "_wday", SKY, wettest)


def int_delivery(matched: DataFrame) -> DataFrame:
    rain, km = F.coalesce("rainfall_mm", F.lit(0)), F.col("delivery_distance_km")
    promised = F.col("promised_delivery_time_min")
    head = [c for c in matched.columns if c not in SKY]
    return matched.select(
        *head,
        DELAY.alias("delivery_delay_min"),
        flag(LATE).alias("is_delayed"),
        F.when(promised > 0, DELAY.cast("double") / promised).alias("delay_ratio"),
        F.when(km > 0, F.col("order_value").cast("double") / km.cast("double")).alias("delivery_value_per_km"),
        *SKY,
        flag(rain > 10).alias("heavy_rain_flag"),
        flag(rain > 0).alias("rainy_flag"),
        flag(F.col("humidity_pct") >= 80).alias("high_humidity_flag"),
    )


def delivery_mart(d: DataFrame) -> DataFrame:
    late, heavy = F.col("is_delayed") == 1, F.col("heavy_rain_flag") == 1
    damp = (F.col("rainy_flag") == 1) | (F.col("high_humidity_flag") == 1)
    delay = F.col("delivery_delay_min")
    return d.withColumns(
        {
            "delay_category": F.when(~late, "On Time")
            .when(delay <= 15, "Minor Delay")
            .when(delay <= 30, "Moderate Delay")
            .otherwise("Severe Delay"),
            "distance_category": below("delivery_distance_km", KM_REACH),
            "weather_risk_category": F.when(heavy, "High Weather Risk")
            .when(damp, "Moderate Weather Risk")
            .when(F.col("weather_date").isNull(), "Unknown")
            .otherwise("Low Weather Risk"),
            "delivery_risk_category": F.when(late & heavy, "Critical")
            .when(late & damp, "High")
            .when(late, "Medium")
            .otherwise("Low"),
        }
    )


def routes_nearest_traffic(gps: DataFrame, traffic: DataFrame) -> DataFrame:
    """Each GPS observation with the traffic reading of its region closest in time, within 30 minutes."""
    keys = ["vehicle_id", "event_timestamp"]
    once = first_per_key(gps, keys, [F.col(c).asc_nulls_last() for c in gps.columns if c not in keys])
    t = traffic.select(
        F.col("event_timestamp").alias("traffic_timestamp"), F.col("location").alias("traffic_location"),
        F.col("latitude").alias("traffic_latitude"), F.col("longitude").alias("traffic_longitude"),
        "traffic_score", "traffic_level", F.col("average_speed_kmph").alias("traffic_average_speed_kmph"),
    )
    return nearest_within(
        once, t, lower_text("region"), lower_text("traffic_location"), "event_timestamp", "traffic_timestamp", JAM, 1800
    )


def int_routes(matched: DataFrame) -> DataFrame:
    speed, score, flow = F.col("speed_kmph"), F.col("traffic_score"), F.col("traffic_average_speed_kmph")
    return matched.select(
        "*",
        flag(speed > 0).alias("is_moving"),
        flag(speed >= 60).alias("high_speed_flag"),
        flag(score >= 75).alias("severe_traffic_flag"),
        flag(score >= 50).alias("congested_traffic_flag"),
        F.when(flow > 0, speed.cast("double") / flow.cast("double")).alias("vehicle_to_traffic_speed_ratio"),
    )


def logistics_mart(r: DataFrame) -> DataFrame:
    jam, still = F.col("congested_traffic_flag") == 1, F.col("is_moving") == 0
    rel = F.col("vehicle_to_traffic_speed_ratio")
    return r.withColumns(
        {
            "traffic_risk_category": F.when(F.col("severe_traffic_flag") == 1, "Severe Congestion")
            .when(jam, "Congested")
            .when(F.col("traffic_score").isNull(), "Unknown")
            .otherwise("Normal"),
            "signal_category": F.when(F.col("signal_quality").isNull(), "Unknown")
            .when(F.lower("signal_quality").isin("poor", "low"), "Low Signal")
            .otherwise("Good Signal"),
            "movement_status_category": F.when(~still & jam, "Moving in Congestion")
            .when(still & (F.col("ignition_status") == "on"), "Stationary - Ignition On")
            .when(still, "Stationary")
            .otherwise("Unknown"),
            "relative_speed_category": F.when(rel.isNull(), "No Traffic Benchmark")
            .when(rel < 0.50, "Much Slower Than Traffic")
            .when(rel < 0.80, "Slower Than Traffic")
            .when(rel <= 1.20, "Aligned With Traffic")
            .otherwise("Faster Than Traffic"),
        }
    )


def driver_performance(orders: DataFrame) -> DataFrame:
    per = entity_rollup(
        orders, ["driver_id"], "order_id", count="total_orders", digits=None,
        count_if={"completed_deliveries": DONE, "delayed_deliveries": LATE},
        max_raw={"region": "region"},
        sums={
            "total_order_value": F.coalesce("order_value", F.lit(0)),
            "total_delivery_distance_km": F.coalesce("delivery_distance_km", F.lit(0)),
        },
        means={
            "average_delivery_delay_min": DELAY,
            "average_promised_delivery_time_min": "promised_delivery_time_min",
            "average_actual_delivery_time_min": "actual_delivery_time_min",
            "average_delivery_distance_km": "delivery_distance_km",
        },
    )
    on_time, delay = F.col("on_time_delivery_rate"), F.col("average_delivery_delay_min")
    done = F.col("completed_deliveries")
    return per.withColumns(
        {
            "on_time_delivery_rate": ratio(done - F.col("delayed_deliveries"), done),
            "delay_rate": ratio("delayed_deliveries", "total_orders"),
            "average_order_value": ratio("total_order_value", "total_orders"),
        }
    ).withColumn(
        "driver_performance_category",
        F.when(F.col("total_orders") == 0, "No Activity")
        .when((on_time >= 0.90) & (delay <= 5), "High Performer")
        .when((on_time >= 0.75) & (delay <= 15), "Stable")
        .when(on_time >= 0.60, "Needs Attention")
        .otherwise("At Risk"),
    )


def warehouse_mart(orders: DataFrame) -> DataFrame:
    per = entity_rollup(
        orders, ["warehouse_id"], "order_id", count="total_orders", digits=None,
        count_if={"completed_deliveries": DONE, "non_completed_deliveries": ~DONE, "delayed_orders": LATE},
        max_raw={"region": "region"},
        sums={
            "total_order_value": F.coalesce("order_value", F.lit(0)),
            "total_delivery_distance_km": F.coalesce("delivery_distance_km", F.lit(0)),
        },
        means={
            "average_order_value": "order_value",
            "average_delivery_delay_min": DELAY,
            "average_delivery_distance_km": "delivery_distance_km",
        },
    )
    rate, delay = F.col("delay_rate"), F.col("average_delivery_delay_min")
    return per.withColumns(
        {
            "completion_rate": ratio("completed_deliveries", "total_orders"),
            "delay_rate": ratio("delayed_orders", "total_orders"),
            "order_value_per_km": F.when(
                F.col("total_delivery_distance_km") > 0, ratio("total_order_value", "total_delivery_distance_km")
            ),
        }
    ).withColumns(
        {
            "workload_category": at_least("total_orders", ((750, "Very High"), (500, "High"), (250, "Medium")), "Low"),
            "warehouse_performance_category": F.when((rate <= 0.10) & (delay <= 10), "Healthy")
            .when((rate <= 0.20) & (delay <= 20), "Stable")
            .when(rate <= 0.30, "Needs Attention")
            .otherwise("At Risk"),
            "warehouse_risk_category": F.when((rate > 0.30) & (delay > 20), "Critical")
            .when(rate > 0.20, "High")
            .when(rate > 0.10, "Medium")
            .otherwise("Low"),
        }
    )


def executive_mart(delivery: DataFrame, logistics: DataFrame, warehouses: DataFrame, report_date=None) -> DataFrame:
    """One row over the three marts. report_date defaults to the last order date, so reruns agree."""
    late = F.col("is_delayed") == 1
    d = entity_rollup(
        delivery, [], "order_id", count="total_orders", digits=None,
        count_if={
            "completed_deliveries": DONE,
            "delayed_orders": late,
            "on_time_orders": F.col("is_delayed") == 0,
            "orders_with_heavy_rain": F.col("heavy_rain_flag") == 1,
            "orders_with_rain": F.col("rainy_flag") == 1,
        },
        sums={
            "total_order_value": F.coalesce("order_value", F.lit(0)),
            "total_delivery_distance_km": F.coalesce("delivery_distance_km", F.lit(0)),
        },
        means={
            "average_order_value": "order_value",
            "average_delivery_distance_km": "delivery_distance_km",
            "average_actual_delivery_time_min": "actual_delivery_time_min",
            "average_promised_delivery_time_min": "promised_delivery_time_min",
            "average_delivery_delay_min": "delivery_delay_min",
        },
        max_raw={"last_order_date": "order_date"},
    )
    fleet = entity_rollup(
        logistics, [], "vehicle_id", count="active_vehicles_observed", digits=None,
        count_if={"moving_vehicles_observed": F.col("is_moving") == 1},
        rows={"total_gps_observations": None},
        means={"average_vehicle_speed_kmph": "speed_kmph", "average_traffic_score": "traffic_score"},
        sums={"_severe": "severe_traffic_flag", "_congested": "congested_traffic_flag"},
    ).withColumns(
        {
            "severe_traffic_observations": F.col("_severe").cast("long"),
            "congested_traffic_observations": F.col("_congested").cast("long"),
        }
    ).drop("_severe", "_congested")
    depots = warehouses.agg(
        F.count("warehouse_id").alias("warehouses_observed"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("warehouse_order_volume"),
        F.coalesce(half_up(F.sum("total_order_value"), 2), F.lit(0.0)).alias("warehouse_order_value"),
        half_up(F.avg("completion_rate"), 10).alias("average_warehouse_completion_rate"),
        half_up(F.avg("delay_rate"), 10).alias("average_warehouse_delay_rate"),
        F.count_if(F.col("warehouse_risk_category").isin("High", "Critical")).alias("high_risk_warehouses"),
    )
    on_time, rate = F.col("on_time_delivery_rate"), F.col("delay_rate")
    day = F.col("last_order_date") if report_date is None else F.lit(report_date).cast("date")
    return (
        d.withColumn("_fleet", fleet.select(F.struct("*")).scalar())
        .withColumn("_depots", depots.select(F.struct("*")).scalar())
        .select("*", "_fleet.*", "_depots.*")
        .withColumns(
            {
                "report_date": day,
                "on_time_delivery_rate": ratio("on_time_orders", "completed_deliveries"),
                "delay_rate": ratio("delayed_orders", "total_orders"),
                "order_value_per_km": F.when(
                    F.col("total_delivery_distance_km") > 0, ratio("total_order_value", "total_delivery_distance_km")
                ),
            }
        )
        .withColumns(
            {
                "overall_delivery_status": at_least(
                    on_time, ((0.90, "Healthy"), (0.75, "Stable"), (0.60, "Needs Attention")), "At Risk"
                ),
                "overall_delivery_risk": F.when(rate <= 0.10, "Low")
                .when(rate <= 0.20, "Medium")
                .when(rate <= 0.30, "High")
                .otherwise("Critical"),
            }
        )
        .drop("_fleet", "_depots", "last_order_date")
    )


def repeated_orders(mart: DataFrame) -> DataFrame:
    return mart.groupBy("order_id").agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def unknown_statuses(mart: DataFrame, allowed=VALID_STATUSES) -> DataFrame:
    odd = mart.filter(F.col("delivery_status").isNotNull() & ~lower_text("delivery_status").isin(*allowed))
    return odd.groupBy("delivery_status").agg(F.count(F.lit(1)).alias("row_count"))


query("int_delivery_asof_weather")(lambda lake: lake.delivery_weather)
query("int_delivery")(lambda lake: lake.int_delivery)
query("int_routes_nearest_traffic")(lambda lake: lake.route_traffic)
query("int_routes")(lambda lake: lake.int_routes)
query("int_driver_performance")(lambda lake: driver_performance(lake.stg_orders))
query("delivery_mart")(lambda lake: lake.delivery_mart)
query("logistics_mart")(lambda lake: lake.logistics_mart)
query("warehouse_mart")(lambda lake: lake.warehouse_mart)
query("executive_mart")(lambda lake: lake.executive_mart)
query("test_unique_orders")(lambda lake: repeated_orders(lake.delivery_mart))
query("test_valid_status")(lambda lake: unknown_statuses(lake.delivery_mart))
