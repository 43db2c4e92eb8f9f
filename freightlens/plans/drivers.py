"""Driver reports over the delivery mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightlens.functions.measures import (
    half_up, grand_total, mean, mean_of, ratio, rows, rows_if, share, share_of, total, whole,
)
from freightlens.functions.rules import KM_REACH_LONG, below
from freightlens.operators.ranking import global_ntile
from freightlens.operators.rollup import entities_per_key
from freightlens.plans.customers import (
    AOV, DELAY, LATE, LATE_ORDERS, LATE_PCT, ON_TIME_PCT, ORDERS, VALUE, by, rounded, top_contributors,
)
from freightlens.registry import query

WET = F.col("rainy_flag") == 1
WORST = F.max("delivery_delay_min").alias("maximum_delay_min")


def per_driver(lake):
    return by(lake, "driver_id").agg(
        ORDERS, VALUE, mean_of("delivery_delay_min").alias("average_delay_min"), share_of(LATE).alias("delay_rate")
    )


@query("drv_overall_kpis")
def overall(lake):
    d = by(lake, "driver_id").agg(
        rows("n"), F.sum("order_value").alias("v"), F.sum("delivery_delay_min").alias("d"),
        F.count("delivery_delay_min").alias("dn"), rows_if(LATE, "l"),
    )
    return d.agg(
        F.count("driver_id").alias("active_drivers"),
        F.sum("n").alias("total_orders"),
        ratio(F.sum("n"), F.count("driver_id"), 2).alias("orders_per_driver"),
        ratio(F.sum("d").cast("double"), F.sum("dn"), 2).alias("average_delivery_delay_min"),
        ratio(F.sum("l"), F.sum("n"), 2, 100).alias("overall_delay_rate_pct"),
        total("v", "total_order_value"),
    )


@query("drv_performance")
def performance(lake):
    return by(lake, "driver_id").agg(
        ORDERS, VALUE, AOV, mean("delivery_distance_km", "average_distance_km"), DELAY, LATE_ORDERS, LATE_PCT, ON_TIME_PCT
    ).orderBy(F.desc("total_orders"), "driver_id")


def _top(lake, aggs, order, keep=None, k=20):
    g = by(lake, "driver_id").agg(*aggs)
    g = g.filter(keep) if keep else g
    return g.orderBy(*order, "driver_id").limit(k)


query("drv_top20_volume")(lambda lake: _top(lake, [ORDERS, VALUE, DELAY, ON_TIME_PCT], [F.desc("total_orders")]))
query("drv_top20_value")(lambda lake: _top(lake, [ORDERS, VALUE, AOV, DELAY], [F.desc("total_order_value")]))
query("drv_top20_ontime")(
    lambda lake: _top(
        lake, [ORDERS, ON_TIME_PCT, DELAY, LATE_ORDERS],
        [F.desc("on_time_rate_pct"), F.asc_nulls_last("average_delay_min")], "total_orders >= 10",
    )
)


@query("drv_repeat_delays")
def repeat_delays(lake):
    return by(lake, "driver_id").agg(ORDERS, LATE_ORDERS, LATE_PCT, DELAY, WORST).filter("delayed_orders >= 3").orderBy(
        F.desc("delayed_orders"), F.desc("average_delay_min"), "driver_id"
    )


@query("drv_segmentation")
def segmentation(lake):
    n, rate, delay = F.col("total_orders"), F.col("delay_rate"), F.col("average_delay_min")
    level = (
        F.when((n >= 10) & (rate <= 0.10) & (delay < 10), 1)
        .when((rate <= 0.25) & (delay < 20), 2)
        .when((rate <= 0.50) & (delay < 30), 3)
        .otherwise(4)
    )
    names = F.array(*[F.lit(x) for x in ("High Performer", "Good Performer", "Needs Improvement", "High Risk")])
    return (
        per_driver(lake)
        .withColumn("_level", level)
        .orderBy("_level", "delay_rate", "driver_id")
        .select(
            "driver_id", "total_orders", rounded("average_delay_min"), rounded("delay_rate", "delay_rate_pct", 100),
            F.element_at(names, F.col("_level")).alias("performance_category"),
        )
    )


@query("drv_workload_region")
def workload_region(lake):
    m = by(lake, "region").agg(ORDERS, DELAY, LATE_PCT)
    who = entities_per_key(lake.delivery_mart, ["region"], "driver_id", "active_drivers")
    return m.join(who, "region").withColumn("orders_per_driver", ratio("total_orders", "active_drivers", 2)).orderBy(
        F.desc("orders_per_driver"), "region"
    )


query("drv_region_performance")(
    lambda lake: by(lake, "region", "driver_id")
    .agg(ORDERS, DELAY, ON_TIME_PCT, VALUE)
    .orderBy("region", F.desc("on_time_rate_pct"), "driver_id")
)
query("drv_revenue_contribution")(lambda lake: top_contributors(lake, "driver_id"))


@query("drv_distance_efficiency")
def distance_efficiency(lake):
    km = F.sum("delivery_distance_km").cast("double")
    return by(lake, "driver_id").agg(
        ORDERS, total("delivery_distance_km", "total_distance_km"), mean("delivery_distance_km", "average_distance_km"), VALUE,
        ratio(F.sum("order_value").cast("double"), km, 2).alias("order_value_per_km"),
        ratio(mean_of("delivery_distance_km"), F.count(F.lit(1)), 2).alias("distance_per_order_km"),
    ).orderBy(F.desc("order_value_per_km"), "driver_id")


@query("drv_distance_segment")
def distance_segment(lake):
    return by(lake, "driver_id", below("delivery_distance_km", KM_REACH_LONG).alias("distance_segment")).agg(
        ORDERS, DELAY, LATE_PCT
    ).orderBy("driver_id", F.desc("average_delay_min"), "distance_segment")


@query("drv_rainy")
def rainy(lake):
    return by(lake, "driver_id").agg(
        ORDERS, share(WET, "rainy_order_share_pct"), share(WET & LATE, "rainy_delay_rate_pct"),
        share(~WET & LATE, "non_rainy_delay_rate_pct"), DELAY,
    ).orderBy(F.desc("rainy_delay_rate_pct"), "driver_id")


query("drv_weather_risk")(
    lambda lake: by(lake, "driver_id", "weather_risk_category")
    .agg(ORDERS, DELAY, LATE_PCT)
    .orderBy("driver_id", F.desc("delay_rate_pct"), "weather_risk_category")
)
query("drv_daily")(
    lambda lake: by(lake, "order_date", "driver_id")
    .agg(ORDERS, DELAY, LATE_ORDERS, ON_TIME_PCT, VALUE)
    .orderBy("order_date", "driver_id")
)
query("drv_monthly")(
    lambda lake: by(lake, F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"), "driver_id")
    .agg(ORDERS, VALUE, DELAY, ON_TIME_PCT)
    .orderBy("order_year", "order_month", F.desc("total_orders"), "driver_id")
)


@query("drv_workload_deciles")
def workload_deciles(lake):
    g = by(lake, "driver_id").agg(ORDERS)
    tiles = global_ntile(g, 10, [F.desc("total_orders"), F.asc("driver_id")], "workload_decile")
    return tiles.groupBy("workload_decile").agg(
        rows("driver_count"), whole("total_orders", "total_orders"), mean("total_orders", "average_orders_per_driver")
    ).orderBy("workload_decile")


@query("drv_overloaded")
def overloaded(lake):
    d = per_driver(lake)
    usual = grand_total(d, mean_of("total_orders"))
    busy = F.col("total_orders") > usual
    poor = (F.col("delay_rate") >= 0.25) | (F.col("average_delay_min") >= 20)
    return d.filter(busy & poor).select(
        "driver_id", "total_orders", rounded("average_delay_min"), rounded("delay_rate", "delay_rate_pct", 100)
    ).orderBy(F.desc("total_orders"), F.desc("delay_rate_pct"), "driver_id")


@query("drv_exceptions")
def exceptions(lake):
    g = by(lake, "driver_id").agg(
        ORDERS, LATE_ORDERS, WORST, mean_of("delivery_delay_min").alias("average_delay_min"), VALUE
    )
    return g.filter("average_delay_min >= 30 OR delayed_orders >= 5").withColumn(
        "average_delay_min", half_up("average_delay_min", 2)
    ).orderBy(F.desc("average_delay_min"), "driver_id")


@query("drv_exec_snapshot")
def exec_snapshot(lake):
    return per_driver(lake).agg(
        rows("total_drivers"),
        rows_if(F.col("total_orders") > 0, "active_drivers"),
        rows_if(F.col("delay_rate") <= 0.10, "high_reliability_drivers"),
        rows_if(F.col("delay_rate") >= 0.50, "high_risk_drivers"),
        mean("total_orders", "average_orders_per_driver"),
        mean("total_order_value", "average_driver_order_value"),
        mean("average_delay_min", "average_driver_delay_min"),
        half_up(mean_of("delay_rate") * 100, 2).alias("average_driver_delay_rate_pct"),
    )
