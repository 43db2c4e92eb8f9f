"""Delivery, distance and warehouse reports over the raw orders table."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightlens.functions.measures import (
    grand_total, largest, mean, mean_of, ratio, rows, rows_if, share, smallest, total, whole,
)
from freightlens.functions.rules import KM_BUCKETS, below, positive_delay
from freightlens.operators.rollup import entities_per_key
from freightlens.registry import query

ACTUAL, PROMISED = F.col("actual_delivery_time_min"), F.col("promised_delivery_time_min")
GOOD, LATE = ACTUAL <= PROMISED, ACTUAL > PROMISED
ORDERS = rows("total_orders")
VALUE = total("order_value", "total_order_value")
AOV = mean("order_value", "avg_order_value")
KM = mean("delivery_distance_km", "avg_distance_km")
ACTUAL_MEAN = mean(ACTUAL, "avg_actual_time_min")
LATENESS = mean(positive_delay(), "avg_delay_min")
LATE_ORDERS = rows_if(LATE, "delayed_orders")
PACE = mean(F.try_divide(ACTUAL.cast("double"), F.when(F.col("delivery_distance_km") > 0, F.col("delivery_distance_km").cast("double"))).cast("decimal(24,10)"), "avg_minutes_per_km")


def counted_share(df, key, count: str, pct: str):
    """Rows per key and their share of all rows, the total taken from the grouped rows."""
    g = df.groupBy(key).agg(rows(count))
    n = grand_total(g, F.sum(count))
    return g.withColumn(pct, ratio(count, n, 2, 100)).orderBy(F.desc(count))


@query("dlv_overall")
def overall(lake):
    return lake.orders.agg(ORDERS, AOV, KM, mean(PROMISED, "avg_promised_time_min"), ACTUAL_MEAN)


@query("dlv_ontime_split")
def ontime_split(lake):
    label = F.when(GOOD, "On Time").otherwise("Delayed").alias("delivery_performance")
    return counted_share(lake.orders, label, "order_count", "percentage")


query("dlv_delay_region")(
    lambda lake: lake.orders.groupBy("region").agg(ORDERS, LATE_ORDERS, LATENESS).orderBy(F.desc("avg_delay_min"), "region")
)
query("dlv_status_dist")(lambda lake: counted_share(lake.orders, "delivery_status", "order_count", "percentage"))
query("dlv_order_status_dist")(
    lambda lake: lake.orders.groupBy("order_status").agg(rows("order_count")).orderBy(F.desc("order_count"), "order_status")
)


def _by_bucket(lake, *aggs):
    """Groups of the distance buckets in bucket order."""
    edge = F.array_position(F.array(*[F.lit(label) for _, label in KM_BUCKETS]), F.col("distance_bucket"))
    return (
        lake.orders.groupBy(below("delivery_distance_km", KM_BUCKETS).alias("distance_bucket")).agg(*aggs).orderBy(edge)
    )


query("dlv_distance_bucket")(lambda lake: _by_bucket(lake, ORDERS, ACTUAL_MEAN, LATENESS))
query("dlv_warehouse")(
    lambda lake: lake.orders.groupBy("warehouse_id")
    .agg(ORDERS, AOV, KM, ACTUAL_MEAN, LATENESS)
    .orderBy(F.desc("avg_delay_min"), "warehouse_id")
)
query("dlv_driver")(
    lambda lake: lake.orders.groupBy("driver_id")
    .agg(rows("total_deliveries"), KM, ACTUAL_MEAN, rows_if(GOOD, "on_time_deliveries"), share(GOOD, "on_time_rate_pct"))
    .orderBy(F.desc("on_time_rate_pct"), "driver_id")
)
query("dlv_daily")(
    lambda lake: lake.orders.groupBy("order_date").agg(ORDERS, LATE_ORDERS, ACTUAL_MEAN).orderBy("order_date")
)
query("dlv_revenue_region")(
    lambda lake: lake.orders.groupBy("region").agg(ORDERS, VALUE, AOV).orderBy(F.desc("total_order_value"), "region")
)


@query("dlv_severe")
def severe(lake):
    return (
        lake.orders.filter(ACTUAL - PROMISED > 30)
        .select(
            "order_id", "customer_id", "warehouse_id", "driver_id", "region", "delivery_distance_km",
            "promised_delivery_time_min", "actual_delivery_time_min", (ACTUAL - PROMISED).alias("delay_min"),
        )
        .orderBy(F.desc("delay_min"), "order_id")
    )


@query("dlv_kpi_summary")
def kpi_summary(lake):
    return lake.orders.agg(
        ORDERS, rows_if(GOOD, "on_time_orders"), LATE_ORDERS, share(GOOD, "on_time_delivery_rate_pct"), AOV, VALUE
    )


# routes ---------------------------------------------------------------------------------------------

query("rt_distance_region")(
    lambda lake: lake.orders.groupBy("region")
    .agg(ORDERS, KM, smallest("delivery_distance_km", "min_distance_km"), largest("delivery_distance_km", "max_distance_km"))
    .orderBy(F.desc("avg_distance_km"), "region")
)
query("rt_distance_bucket")(
    lambda lake: _by_bucket(
        lake, ORDERS, mean(PROMISED, "avg_promised_time_min"), ACTUAL_MEAN, mean(ACTUAL - PROMISED, "avg_time_variance_min")
    )
)


@query("rt_gps_region")
def gps_region(lake):
    g = lake.gps_tracking
    m = g.groupBy("region").agg(
        rows("gps_records"), mean("speed_kmph", "avg_speed_kmph"), largest("speed_kmph", "max_speed_kmph")
    )
    who = entities_per_key(g, ["region"], "vehicle_id", "tracked_vehicles")
    return m.join(who, "region").orderBy(F.desc("avg_speed_kmph"), "region")


query("rt_vehicle_movement")(
    lambda lake: lake.gps_tracking.groupBy("vehicle_id")
    .agg(
        rows("telemetry_records"), mean("speed_kmph", "avg_speed_kmph"), largest("speed_kmph", "max_speed_kmph"),
        rows_if(F.col("speed_kmph") > 0, "moving_records"), rows_if(F.col("speed_kmph") == 0, "stationary_records"),
    )
    .orderBy(F.desc("avg_speed_kmph"), "vehicle_id")
)
SCORE = mean("traffic_score", "avg_traffic_score")
FLOW = mean("average_speed_kmph", "avg_speed_kmph")
READINGS = rows("observations")
query("rt_traffic_location")(
    lambda lake: lake.traffic.groupBy("location")
    .agg(READINGS, SCORE, mean("average_speed_kmph", "avg_traffic_speed_kmph"), largest("traffic_score", "max_traffic_score"))
    .orderBy(F.desc("avg_traffic_score"), "location")
)
query("rt_traffic_level")(
    lambda lake: lake.traffic.groupBy("traffic_level").agg(READINGS, SCORE, FLOW).orderBy(F.desc("avg_traffic_score"))
)
query("rt_traffic_hourly")(
    lambda lake: lake.traffic.groupBy(F.hour("timestamp").alias("hour_of_day")).agg(READINGS, SCORE, FLOW).orderBy("hour_of_day")
)


def hotspots(traffic, min_score: float = 70):
    hot = traffic.groupBy("location").agg(mean_of("traffic_score").alias("_m"), SCORE, FLOW, READINGS)
    return hot.filter(F.col("_m") >= min_score).drop("_m").orderBy(F.desc("avg_traffic_score"), "location")


query("rt_hotspots")(lambda lake: hotspots(lake.traffic))
TIME = mean(ACTUAL, "avg_delivery_time_min")
query("rt_minutes_per_km")(
    lambda lake: lake.orders.groupBy("region").agg(ORDERS, KM, TIME, PACE).orderBy("avg_minutes_per_km", "region")
)


@query("rt_delivery_vs_traffic")
def delivery_vs_traffic(lake):
    d = lake.orders.groupBy("region").agg(
        ORDERS, mean("delivery_distance_km", "avg_delivery_distance_km"), TIME,
        mean(ACTUAL - PROMISED, "avg_delivery_variance_min"),
    )
    t = lake.traffic.groupBy("location").agg(SCORE, mean("average_speed_kmph", "avg_traffic_speed_kmph"))
    return d.join(t, F.col("region") == F.col("location"), "left").drop("location").orderBy(
        F.desc_nulls_last("avg_traffic_score"), "region"
    )


@query("rt_kpi_summary")
def route_kpis(lake):
    return lake.orders.agg(
        ORDERS, mean("delivery_distance_km", "avg_delivery_distance_km"),
        total("delivery_distance_km", "total_delivery_distance_km"), TIME, PACE,
    )


# warehouses over orders -----------------------------------------------------------------------------

CAPACITY = F.col("capacity_units")


@query("hwh_master_summary")
def master_summary(lake):
    return lake.warehouses.agg(
        rows("total_warehouses"), whole(CAPACITY, "total_network_capacity_units"),
        mean(CAPACITY, "avg_warehouse_capacity_units"), F.min(CAPACITY).alias("minimum_capacity_units"),
        F.max(CAPACITY).alias("maximum_capacity_units"),
    )


query("hwh_capacity_rank")(
    lambda lake: lake.warehouses.select("warehouse_id", "warehouse_name", "region", "capacity_units").orderBy(
        F.desc("capacity_units"), "warehouse_id"
    )
)
query("hwh_region_capacity")(
    lambda lake: lake.warehouses.groupBy("region")
    .agg(rows("warehouse_count"), whole(CAPACITY, "total_capacity_units"), mean(CAPACITY, "avg_capacity_units"))
    .orderBy(F.desc("total_capacity_units"), "region")
)
query("hwh_order_volume")(
    lambda lake: lake.orders.groupBy("warehouse_id")
    .agg(ORDERS, VALUE, AOV, mean("delivery_distance_km", "avg_delivery_distance_km"))
    .orderBy(F.desc("total_orders"), "warehouse_id")
)
query("hwh_delivery")(
    lambda lake: lake.orders.groupBy("warehouse_id")
    .agg(ORDERS, rows_if(GOOD, "on_time_orders"), LATE_ORDERS, share(GOOD, "on_time_rate_pct"), LATENESS)
    .orderBy("on_time_rate_pct", "warehouse_id")
)


@query("hwh_capacity_ratio")
def capacity_ratio(lake):
    o = lake.orders.groupBy("warehouse_id").agg(rows("_n"), total("order_value", "_v"))
    n = F.coalesce("_n", F.lit(0))
    return (
        lake.warehouses.join(o, "warehouse_id", "left")
        .select(
            "warehouse_id", "warehouse_name", "region", "capacity_units", n.alias("total_orders"),
            ratio(n, CAPACITY, 2, 100).alias("order_to_capacity_ratio_pct"),
            F.coalesce("_v", F.lit(0.0)).alias("total_order_value"),
        )
        .orderBy(F.desc_nulls_last("order_to_capacity_ratio_pct"), "warehouse_id")
    )


@query("hwh_region_performance")
def region_performance(lake):
    m = lake.orders.groupBy("region").agg(
        ORDERS, VALUE, mean("delivery_distance_km", "avg_delivery_distance_km"), TIME, LATENESS
    )
    who = entities_per_key(lake.orders, ["region"], "warehouse_id", "active_warehouses")
    return m.join(who, "region").orderBy(F.desc("total_orders"), "region")


query("hwh_highest_delay")(
    lambda lake: lake.orders.groupBy("warehouse_id")
    .agg(ORDERS, LATENESS, share(LATE, "delay_rate_pct"))
    .filter("total_orders >= 10")
    .orderBy(F.desc("avg_delay_min"), "warehouse_id")
)


@query("hwh_value_contribution")
def value_contribution(lake):
    g = lake.orders.groupBy("warehouse_id").agg(ORDERS, F.sum("order_value").alias("_v"))
    v = F.col("_v").cast("double")
    return g.select(
        "warehouse_id", "total_orders", v.alias("total_order_value"),
        ratio(v, grand_total(g, F.sum("_v")).cast("double"), 2, 100).alias("revenue_contribution_pct"),
    ).orderBy(F.desc("total_order_value"), "warehouse_id")


query("hwh_geo")(
    lambda lake: lake.warehouses.select(
        "warehouse_id", "warehouse_name", "region", "latitude", "longitude", "capacity_units"
    ).orderBy("region", "warehouse_name")
)


@query("hwh_kpi_summary")
def warehouse_kpis(lake):
    o = lake.orders.groupBy("warehouse_id").agg(
        rows("_n"), total("order_value", "_v"), KM, TIME, LATENESS, share(GOOD, "on_time_rate_pct")
    )
    zero = lambda c, alias=None: F.coalesce(c, F.lit(0.0)).alias(alias or c)
    return (
        lake.warehouses.join(o, "warehouse_id", "left")
        .select(
            "warehouse_id", "warehouse_name", "region", "capacity_units", F.coalesce("_n", F.lit(0)).alias("total_orders"),
            zero("_v", "total_order_value"), zero("avg_distance_km"), zero("avg_delivery_time_min"), zero("avg_delay_min"),
            zero("on_time_rate_pct"),
        )
        .orderBy(F.desc("total_orders"), "warehouse_id")
    )
