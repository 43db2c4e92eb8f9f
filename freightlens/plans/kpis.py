"""KPI reports over the marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightlens.functions.measures import mean, ratio, rows, whole
from freightlens.operators.rollup import entities_per_key, entity_rollup
from freightlens.plans.marts import DONE
from freightlens.registry import query

LATE, ON_TIME = F.col("is_delayed") == 1, F.col("is_delayed") == 0
MONEY = F.coalesce("order_value", F.lit(0))


def orders_by(lake, keys, count="total_orders", source=None, **spec):
    return entity_rollup(source if source is not None else lake.delivery_mart, keys, "order_id", count=count, digits=None, **spec)


@query("kpi_exec_snapshot")
def exec_snapshot(lake):
    return lake.executive_mart.select(
        "report_date", "total_orders", "completed_deliveries", "total_order_value", "average_order_value", "delayed_orders",
        "on_time_orders", "on_time_delivery_rate", "delay_rate", "average_delivery_delay_min", "average_actual_delivery_time_min",
        "average_promised_delivery_time_min", "average_delivery_distance_km", "total_delivery_distance_km", "order_value_per_km",
        "active_vehicles_observed", "moving_vehicles_observed", "average_vehicle_speed_kmph", "average_traffic_score",
        "warehouses_observed", "high_risk_warehouses", "overall_delivery_status", "overall_delivery_risk",
    )


query("kpi_region_orders")(
    lambda lake: orders_by(
        lake, ["region"], count_if={"completed_deliveries": DONE}, sums={"total_order_value": MONEY},
        means={"average_order_value": "order_value"},
    ).orderBy(F.desc("total_orders"), "region")
)
query("kpi_region_ontime")(
    lambda lake: orders_by(lake, ["region"], count_if={"on_time_orders": ON_TIME, "delayed_orders": LATE})
    .withColumn("on_time_rate", ratio("on_time_orders", "total_orders"))
    .orderBy("on_time_rate", "region")
)
query("kpi_region_delay")(
    lambda lake: orders_by(
        lake, ["region"], None, count_if={"delayed_orders": LATE}, means={"average_delivery_delay_min": "delivery_delay_min"},
        max_raw={"maximum_delivery_delay_min": "delivery_delay_min"},
    ).orderBy(F.desc("average_delivery_delay_min"), "region")
)
query("kpi_daily")(
    lambda lake: orders_by(
        lake, ["order_date"], count_if={"delayed_orders": LATE}, means={"average_delay_min": "delivery_delay_min"},
        sums={"total_order_value": MONEY},
    ).orderBy("order_date")
)


def _by_category(lake, key):
    return orders_by(lake, [key], "order_count", sums={"order_value": MONEY}).orderBy(F.desc("order_count"), key)


query("kpi_delay_category")(lambda lake: _by_category(lake, "delay_category"))
query("kpi_risk_dist")(lambda lake: _by_category(lake, "delivery_risk_category"))


@query("kpi_weather")
def weather(lake):
    known = lake.delivery_mart.filter(F.col("weather_condition").isNotNull())
    return orders_by(
        lake, ["weather_condition"], source=known, shares={"on_time_rate": (ON_TIME, None)},
        means={"average_delay_min": "delivery_delay_min", "average_rainfall_mm": "rainfall_mm"},
    ).orderBy(F.desc("average_delay_min"), "weather_condition")


query("kpi_heavy_rain")(
    lambda lake: orders_by(
        lake, ["heavy_rain_flag"], means={"average_delay_min": "delivery_delay_min"}, shares={"on_time_rate": (ON_TIME, None)}
    ).orderBy("heavy_rain_flag")
)
query("kpi_region_value")(
    lambda lake: orders_by(
        lake, ["region"], sums={"total_order_value": MONEY}, means={"average_order_value": "order_value"}
    ).orderBy(F.desc("total_order_value"), "region")
)


def _fleet(lake, key, *extra):
    m = lake.logistics_mart.groupBy(key).agg(
        rows("gps_observations"), mean("speed_kmph", "average_speed_kmph", None), mean("traffic_score", "average_traffic_score", None),
        *extra,
    )
    who = entities_per_key(lake.logistics_mart, [key], "vehicle_id", "vehicles_observed")
    return m.join(who, key)


query("kpi_fleet_region")(
    lambda lake: _fleet(
        lake, "region", whole("severe_traffic_flag", "severe_traffic_observations"),
        whole("congested_traffic_flag", "congested_traffic_observations"),
    ).orderBy(F.desc("congested_traffic_observations"), "region")
)
query("kpi_traffic_risk")(
    lambda lake: _fleet(lake, "traffic_risk_category").orderBy(F.desc("gps_observations"), "traffic_risk_category")
)
RISKY = F.col("warehouse_risk_category").isin("High", "Critical")
query("kpi_warehouse_rank")(
    lambda lake: lake.warehouse_mart.select(
        "warehouse_id", "region", "total_orders", "completed_deliveries", "total_order_value", "completion_rate", "delay_rate",
        "average_delivery_delay_min", "workload_category", "warehouse_performance_category", "warehouse_risk_category",
    ).orderBy(F.desc("delay_rate"), F.desc("total_orders"), "warehouse_id")
)


def _flagged(lake, cond):
    return lake.warehouse_mart.filter(cond).select(
        "warehouse_id", "region", "total_orders", "delay_rate", "completion_rate", "average_delivery_delay_min",
        "warehouse_risk_category",
    ).orderBy(F.desc("delay_rate"), F.desc("average_delivery_delay_min"), "warehouse_id")


query("kpi_high_risk_wh")(lambda lake: _flagged(lake, RISKY))
query("kpi_exceptions")(lambda lake: _flagged(lake, RISKY | (F.col("delay_rate") > 0.20)))
query("kpi_top100_delayed")(
    lambda lake: lake.delivery_mart.filter(LATE)
    .select(
        "order_id", "region", "warehouse_id", "driver_id", "vehicle_id", "order_value", "delivery_distance_km",
        "promised_delivery_time_min", "actual_delivery_time_min", "delivery_delay_min", "delay_category", "weather_condition",
        "rainfall_mm", "delivery_risk_category",
    )
    .orderBy(F.desc("delivery_delay_min"), "order_id")
    .limit(100)
)
query("kpi_distance_category")(
    lambda lake: orders_by(
        lake, ["distance_category"], shares={"on_time_rate": (ON_TIME, None)}, sums={"total_order_value": MONEY},
        means={"average_distance_km": "delivery_distance_km", "average_delay_min": "delivery_delay_min"},
    ).orderBy("average_distance_km")
)


@query("kpi_monthly")
def monthly(lake):
    dated = lake.delivery_mart.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})
    return orders_by(
        lake, ["order_year", "order_month"], source=dated, sums={"total_order_value": MONEY},
        means={"average_delay_min": "delivery_delay_min"}, shares={"on_time_rate": (ON_TIME, None)},
    ).orderBy("order_year", "order_month")
