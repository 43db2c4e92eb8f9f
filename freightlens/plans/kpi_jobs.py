"""The four KPI jobs over the delivery features and master tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_up, largest, mean, ratio, rows, rows_if, total
from freightlens.functions.rules import JAM_LEVELS, at_least, upper_text
from freightlens.operators.dedup import first_per_key
from freightlens.operators.rollup import entities_per_key, entity_rollup
from freightlens.registry import query

LATE = F.col("is_delayed") == 1
DELIVERED = F.col("delivery_status") == "DELIVERED"
ZERO = F.lit(0.0)


def prepare_deliveries(features: DataFrame, needed: tuple[str, ...] = ("order_id", "order_date", "region")) -> DataFrame:
    """Normalized delivery rows; rows lacking a needed field are dropped."""
    typed = features.select(
        *[F.trim(c).alias(c) for c in ("order_id", "warehouse_id", "driver_id")],
        F.col("order_date").try_cast("date").alias("order_date"),
        *[upper_text(c).alias(c) for c in ("region", "delivery_status")],
        F.col("is_delayed").cast("int").alias("is_delayed"),
        *[
            F.col(c).try_cast("double").alias(c)
            for c in (
                "delivery_delay_min", "actual_delivery_time_min", "promised_delivery_time_min", "delivery_distance_km", "order_value"
            )
        ],
    )
    keep = F.lit(True)
    for c in needed:
        keep = keep & F.col(c).isNotNull()
    return typed.filter(keep)


def _pct(num: str, den: str) -> Column:
    return F.coalesce(ratio(num, den, 2, 100), ZERO)


ON_TIME_OF_DELIVERED = {"_ot": (DELIVERED & (F.col("is_delayed") == 0), DELIVERED)}
TIME = {"avg_delivery_time_min": "actual_delivery_time_min"}
COUNTS = {"delivered_orders": DELIVERED, "delayed_orders": LATE}


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("on_time_delivery_rate_pct", half_up(F.col("_ot") * 100, 2)).drop("_ot")


def overall(df: DataFrame) -> DataFrame:
    late_only = F.when(F.col("delivery_delay_min") > 0, F.col("delivery_delay_min"))
    return _finish(
        entity_rollup(
            df, [], "order_id", count="total_orders", count_if=COUNTS, shares=ON_TIME_OF_DELIVERED,
            means={
                **TIME, "avg_promised_delivery_time_min": "promised_delivery_time_min", "avg_positive_delay_min": late_only,
                "avg_order_value": "order_value", "avg_delivery_distance_km": "delivery_distance_km",
            },
            maxes={"max_delay_min": "delivery_delay_min"},
            sums={"total_order_value": "order_value", "total_delivery_distance_km": "delivery_distance_km"},
        )
    )


def by_region(df: DataFrame) -> DataFrame:
    g = entity_rollup(
        df, ["region"], "order_id", count="total_orders", count_if=COUNTS, shares=ON_TIME_OF_DELIVERED,
        means={**TIME, "avg_delay_min": "delivery_delay_min", "avg_delivery_distance_km": "delivery_distance_km"},
        sums={"total_order_value": "order_value"},
    )
    return _finish(g).withColumns(
        {
            "delay_rate_pct": _pct("delayed_orders", "total_orders"),
            "revenue_per_order": F.coalesce(ratio("total_order_value", "total_orders", 2), ZERO),
        }
    )


def by_day(df: DataFrame) -> DataFrame:
    return entity_rollup(
        df, ["order_date"], "order_id", count="total_orders", count_if={"delayed_orders": LATE},
        means={**TIME, "avg_delay_min": "delivery_delay_min"}, sums={"total_order_value": "order_value"},
    ).withColumn("delay_rate_pct", _pct("delayed_orders", "total_orders"))


def by_status(df: DataFrame) -> DataFrame:
    return entity_rollup(
        df, ["delivery_status"], "order_id", count="total_orders", means={"avg_delay_min": "delivery_delay_min"},
        sums={"total_order_value": "order_value"},
    )


LONG_METRICS = [
    "metric_level", "metric_key", "total_orders", "delivered_orders", "delayed_orders", "on_time_delivery_rate_pct",
    "avg_delivery_time_min", "avg_promised_delivery_time_min", "avg_positive_delay_min", "max_delay_min", "total_order_value",
    "avg_order_value", "total_delivery_distance_km", "avg_delivery_distance_km",
]


def metrics_union(df: DataFrame) -> DataFrame:
    """Overall, regional and daily KPIs in one long table, all levels from one pass; KPIs a level lacks are NULL.

    The overall mean order value is per row, the regional one per distinct order, as published.
    """
    late_only = F.when(F.col("delivery_delay_min") > 0, F.col("delivery_delay_min"))
    g = entity_rollup(
        df, ["region", "order_date"], "order_id", sets=[[], ["region"], ["order_date"]], count="total_orders", count_if=COUNTS,
        shares=ON_TIME_OF_DELIVERED,
        means={
            **TIME, "avg_promised_delivery_time_min": "promised_delivery_time_min", "avg_positive_delay_min": late_only,
            "_aov": "order_value", "avg_delivery_distance_km": "delivery_distance_km",
        },
        maxes={"max_delay_min": "delivery_delay_min"},
        sums={"total_order_value": "order_value", "total_delivery_distance_km": "delivery_distance_km"},
    )
    overall_row, region_row = F.col("_gid") == 6, F.col("_gid") == 2
    only = lambda cond, *cols: {c: F.when(cond, F.col(c)) for c in cols}
    return _finish(g).withColumns(
        {
            "metric_level": F.when(overall_row, "overall").when(region_row, "region").otherwise("daily"),
            "metric_key": F.when(overall_row, "ALL").when(region_row, F.col("region")).otherwise(F.date_format("order_date", "yyyy-MM-dd")),
            "avg_order_value": F.when(overall_row, F.col("_aov")).when(
                region_row, F.coalesce(ratio("total_order_value", "total_orders", 2), ZERO)
            ),
            **only(overall_row | region_row, "delivered_orders", "on_time_delivery_rate_pct", "avg_delivery_distance_km"),
            **only(
                overall_row, "avg_promised_delivery_time_min", "avg_positive_delay_min", "max_delay_min", "total_delivery_distance_km"
            ),
        }
    ).select(*LONG_METRICS)


def _fill(df: DataFrame, counts: tuple, measures: tuple) -> DataFrame:
    return df.fillna({**{c: 0 for c in counts}, **{c: 0.0 for c in measures}})


def _on_time(df: DataFrame) -> DataFrame:
    """On-time orders as delivered minus delayed, which may be negative (kept as published)."""
    return df.withColumn("on_time_orders", F.col("delivered_orders") - F.col("delayed_orders")).withColumns(
        {
            "on_time_delivery_rate_pct": F.when(
                F.col("delivered_orders") > 0, ratio("on_time_orders", "delivered_orders", 2, 100)
            ).otherwise(ZERO),
            "delay_rate_pct": _pct("delayed_orders", "total_orders"),
        }
    )


def driver_metrics(df: DataFrame, drivers: DataFrame) -> DataFrame:
    per = entity_rollup(
        df.filter(F.col("driver_id").isNotNull()), ["driver_id"], "order_id", count="total_orders", count_if=COUNTS,
        means={
            **TIME, "avg_delay_min": "delivery_delay_min", "avg_distance_km": "delivery_distance_km",
            "avg_positive_delay_min": F.when(F.col("delivery_delay_min") > 0, F.col("delivery_delay_min")),
            "avg_order_value": "order_value",
        },
        sums={"total_distance_km": "delivery_distance_km", "total_order_value": "order_value"},
    )
    d = drivers.select(
        F.trim("driver_id").alias("driver_id"), "driver_name", upper_text("region").alias("region"),
        F.col("experience_years").cast("double").alias("experience_years"), F.col("rating").cast("double").alias("rating"),
        "employment_status", "license_type",
    )
    d = first_per_key(d, ["driver_id"], [F.col(c).asc_nulls_last() for c in d.columns if c != "driver_id"])
    joined = _fill(
        d.join(per, "driver_id", "left"), ("total_orders", "delivered_orders", "delayed_orders"),
        (
            "avg_delay_min", "avg_positive_delay_min", "avg_delivery_time_min", "total_distance_km", "avg_distance_km",
            "total_order_value", "avg_order_value",
        ),
    )
    done, rate = F.col("delivered_orders"), F.col("on_time_delivery_rate_pct")
    late, stars = F.col("delay_rate_pct"), F.col("rating")
    weak = (late >= 30) | (stars < 3.5)
    return (
        _on_time(joined)
        .withColumns(
            {
                "orders_per_experience_year": half_up(
                    F.when(F.col("experience_years") > 0, ratio("total_orders", "experience_years")).otherwise(
                        F.col("total_orders").cast("double")
                    ),
                    2,
                ),
                "revenue_per_km": F.coalesce(
                    F.when(F.col("total_distance_km") > 0, ratio("total_order_value", "total_distance_km", 2)), ZERO
                ),
                "performance_category": F.when((done >= 20) & (rate >= 90) & (stars >= 4.5), "Top Performer")
                .when((done >= 10) & (rate >= 80) & (stars >= 4.0), "Strong Performer")
                .when(F.col("total_orders") == 0, "No Delivery Data")
                .when(weak, "Needs Attention")
                .otherwise("Average"),
                "risk_flag": F.when(weak, "High").when((late >= 15) | (stars < 4.0), "Medium").otherwise("Low"),
            }
        )
        .orderBy(F.desc("on_time_delivery_rate_pct"), F.desc("rating"), "driver_id")
    )


def driver_region_metrics(df: DataFrame) -> DataFrame:
    g = entity_rollup(
        df, ["region"], "order_id", count="total_orders", count_if={"delayed_orders": LATE},
        means={**TIME, "avg_delay_min": "delivery_delay_min"}, sums={"total_order_value": "order_value"},
    ).withColumn("delay_rate_pct", _pct("delayed_orders", "total_orders"))
    return g.join(entities_per_key(df, ["region"], "driver_id", "active_drivers"), "region").orderBy(
        F.desc("total_orders"), "region"
    )


def warehouse_metrics(df: DataFrame, warehouses: DataFrame) -> DataFrame:
    per = entity_rollup(
        df, ["warehouse_id"], "order_id", count="total_orders", count_if=COUNTS,
        means={
            **TIME, "avg_delay_min": "delivery_delay_min", "avg_delivery_distance_km": "delivery_distance_km",
            "avg_order_value": "order_value",
        },
        sums={"total_delivery_distance_km": "delivery_distance_km", "total_order_value": "order_value"},
    ).join(entities_per_key(df, ["warehouse_id"], "driver_id", "active_drivers"), "warehouse_id")
    w = warehouses.select(
        F.trim("warehouse_id").alias("warehouse_id"), "warehouse_name", upper_text("region").alias("region"),
        *[F.col(c).cast("double").alias(c) for c in ("capacity_units", "latitude", "longitude")],
    )
    w = first_per_key(w, ["warehouse_id"], [F.col(c).asc_nulls_last() for c in w.columns if c != "warehouse_id"])
    joined = _fill(
        w.join(per, "warehouse_id", "left"), ("total_orders", "delivered_orders", "delayed_orders", "active_drivers"),
        (
            "avg_delay_min", "avg_delivery_time_min", "avg_delivery_distance_km", "total_delivery_distance_km",
            "total_order_value", "avg_order_value",
        ),
    )
    n, load = F.col("total_orders"), F.col("orders_per_capacity_unit")
    rate, late = F.col("on_time_delivery_rate_pct"), F.col("delay_rate_pct")
    return (
        _on_time(joined)
        .withColumns(
            {
                "orders_per_driver": F.coalesce(ratio("total_orders", "active_drivers", 2), ZERO),
                "orders_per_capacity_unit": F.coalesce(
                    F.when(F.col("capacity_units") > 0, ratio("total_orders", "capacity_units", 4)), ZERO
                ),
                "revenue_per_order": F.coalesce(ratio("total_order_value", "total_orders", 2), ZERO),
            }
        )
        .withColumns(
            {
                "workload_category": F.when(n == 0, "No Activity").otherwise(
                    at_least(load, ((1.0, "Very High"), (0.75, "High"), (0.40, "Moderate")), "Low")
                ),
                "performance_category": F.when(n == 0, "No Activity")
                .when((rate >= 90) & (late < 10), "High Performing")
                .when((rate >= 80) & (late < 20), "Stable")
                .when(late >= 30, "Needs Attention")
                .otherwise("Watch"),
                "risk_flag": F.when(late >= 30, "High").when((late >= 15) | (rate < 80), "Medium").otherwise("Low"),
            }
        )
        .orderBy(F.desc("total_orders"), F.desc("on_time_delivery_rate_pct"), "warehouse_id")
    )


def warehouse_region_metrics(df: DataFrame, warehouses: DataFrame) -> DataFrame:
    depots = (
        warehouses.select(F.trim("warehouse_id").alias("warehouse_id"), upper_text("region").alias("region"), "capacity_units")
        .groupBy("region")
        .agg(F.count_distinct("warehouse_id").alias("total_warehouses"), total("capacity_units", "total_capacity_units"))
    )
    orders = entity_rollup(
        df, ["region"], "order_id", count="total_orders", count_if=COUNTS,
        means={**TIME, "avg_delay_min": "delivery_delay_min"}, sums={"total_order_value": "order_value"},
    ).join(entities_per_key(df, ["region"], "warehouse_id", "active_warehouses"), "region")
    joined = _fill(
        depots.join(orders, "region", "left"), ("total_orders", "delivered_orders", "delayed_orders", "active_warehouses"),
        ("avg_delay_min", "avg_delivery_time_min", "total_order_value"),
    )
    return (
        _on_time(joined)
        .withColumns(
            {
                "orders_per_capacity_unit": F.coalesce(ratio("total_orders", "total_capacity_units", 4), ZERO),
                "orders_per_warehouse": F.coalesce(ratio("total_orders", "active_warehouses", 2), ZERO),
            }
        )
        .orderBy(F.desc("total_orders"), "region")
    )


def gps_region_metrics(gps_clean: DataFrame) -> DataFrame:
    moving, weak, speed = F.col("is_moving") == 1, F.col("is_low_signal") == 1, F.col("speed_kmph")
    g = gps_clean.groupBy("region").agg(
        rows("gps_events"), mean(speed, "avg_speed_kmph"), mean(F.when(moving, speed), "avg_moving_speed_kmph"),
        largest("speed_kmph", "max_speed_kmph"), rows_if(moving, "moving_events"), rows_if(weak, "low_signal_events"),
    )
    g = g.withColumns(
        {
            "moving_event_rate_pct": _pct("moving_events", "gps_events"),
            "low_signal_rate_pct": _pct("low_signal_events", "gps_events"),
        }
    )
    return g.join(entities_per_key(gps_clean, ["region"], "vehicle_id", "tracked_vehicles"), "region", "left")


def traffic_location_metrics(traffic: DataFrame) -> DataFrame:
    level = upper_text("traffic_level")
    return (
        traffic.groupBy(upper_text("location").alias("location"))
        .agg(
            rows("traffic_events"), mean("traffic_score", "avg_traffic_score"), largest("traffic_score", "max_traffic_score"),
            mean("average_speed_kmph", "avg_traffic_speed_kmph"), rows_if(level.isin(*JAM_LEVELS), "congested_events"),
            rows_if(level == "SEVERE", "severe_congestion_events"),
        )
        .withColumns(
            {
                "congestion_rate_pct": _pct("congested_events", "traffic_events"),
                "severe_congestion_rate_pct": _pct("severe_congestion_events", "traffic_events"),
            }
        )
    )


def road_type_metrics(roads: DataFrame) -> DataFrame:
    bad = upper_text("road_condition").isin("POOR", "CRITICAL")
    return (
        roads.groupBy("road_type")
        .agg(
            F.count_distinct("road_id").alias("road_count"), total("distance_km", "total_road_distance_km"),
            mean("distance_km", "avg_road_distance_km"), mean("lanes", "avg_lanes"),
            mean("speed_limit_kmph", "avg_speed_limit_kmph"), rows_if(bad, "poor_condition_roads"),
        )
        .withColumn("poor_condition_rate_pct", _pct("poor_condition_roads", "road_count"))
        .orderBy(F.desc("total_road_distance_km"), "road_type")
    )


def delivery_route_region(df: DataFrame) -> DataFrame:
    return entity_rollup(
        df, ["region"], "order_id", count="delivery_orders", count_if={"delayed_orders": LATE},
        means={
            "avg_delivery_distance_km": "delivery_distance_km", **TIME, "avg_delivery_delay_min": "delivery_delay_min"
        },
        maxes={"max_delivery_distance_km": "delivery_distance_km"},
        sums={"total_delivery_distance_km": "delivery_distance_km"},
    ).withColumns(
        {
            "delay_rate_pct": _pct("delayed_orders", "delivery_orders"),
            "avg_delivery_minutes_per_km": F.coalesce(ratio("avg_delivery_time_min", "avg_delivery_distance_km", 2), ZERO),
        }
    )


def route_region_metrics(df: DataFrame, gps_clean: DataFrame, traffic: DataFrame) -> DataFrame:
    jams = traffic_location_metrics(traffic).select(
        F.col("location").alias("region"), "traffic_events", "avg_traffic_score", "avg_traffic_speed_kmph", "congested_events",
        "congestion_rate_pct",
    )
    joined = delivery_route_region(df).join(gps_region_metrics(gps_clean), "region", "left").join(jams, "region", "left")
    filled = _fill(
        joined, ("gps_events", "tracked_vehicles", "moving_events", "low_signal_events", "traffic_events", "congested_events"),
        (
            "avg_speed_kmph", "avg_moving_speed_kmph", "max_speed_kmph", "moving_event_rate_pct", "low_signal_rate_pct",
            "avg_traffic_score", "avg_traffic_speed_kmph", "congestion_rate_pct",
        ),
    )
    late, jam, weak = F.col("delay_rate_pct"), F.col("congestion_rate_pct"), F.col("low_signal_rate_pct")
    return filled.withColumn(
        "route_risk",
        F.when((late >= 30) | (jam >= 50) | (weak >= 20), "High")
        .when((late >= 15) | (jam >= 25) | (weak >= 10), "Medium")
        .otherwise("Low"),
    ).orderBy(F.desc("delivery_orders"), "region")


def _deliveries(lake):
    return prepare_deliveries(lake.features)


query("job_prepare_deliveries")(_deliveries)
query("delivery_overall")(lambda lake: overall(_deliveries(lake)))
query("delivery_by_region")(lambda lake: by_region(_deliveries(lake)).orderBy(F.desc("total_orders"), "region"))
query("delivery_by_day")(lambda lake: by_day(_deliveries(lake)).orderBy("order_date"))
query("delivery_by_status")(
    lambda lake: by_status(_deliveries(lake)).orderBy(F.desc("total_orders"), "delivery_status")
)
query("delivery_metrics_union")(lambda lake: metrics_union(_deliveries(lake)))
query("driver_metrics")(lambda lake: driver_metrics(prepare_deliveries(lake.features, ("order_id", "driver_id")), lake.drivers))
query("driver_region_metrics")(
    lambda lake: driver_region_metrics(prepare_deliveries(lake.features, ("order_id", "driver_id")))
)
query("warehouse_metrics")(
    lambda lake: warehouse_metrics(prepare_deliveries(lake.features, ("order_id", "warehouse_id")), lake.warehouses)
)
query("warehouse_region_metrics")(
    lambda lake: warehouse_region_metrics(prepare_deliveries(lake.features, ("order_id", "warehouse_id")), lake.warehouses)
)
query("gps_region_metrics")(lambda lake: gps_region_metrics(lake.gps_clean))
query("traffic_location_metrics")(
    lambda lake: traffic_location_metrics(lake.traffic).orderBy(F.desc("avg_traffic_score"), "location")
)
query("road_type_metrics")(lambda lake: road_type_metrics(lake.roads))
query("delivery_route_region")(lambda lake: delivery_route_region(prepare_deliveries(lake.features, ("order_id",))))
query("route_region_metrics")(
    lambda lake: route_region_metrics(prepare_deliveries(lake.features, ("order_id",)), lake.gps_clean, lake.traffic)
)
