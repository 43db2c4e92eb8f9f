"""Warehouse reports over the warehouse mart, with names from the warehouse table."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightlens.functions.measures import grand_total, half_up, mean, mean_of, ratio, rows, rows_if, whole
from freightlens.functions.rules import at_least
from freightlens.operators.ranking import global_dense_rank, global_ntile
from freightlens.registry import query

WHO = ["warehouse_id", "warehouse_name", "region", "total_orders"]
RATE = ratio("delayed_orders", "total_orders")
LATE_PCT = ratio("delayed_orders", "total_orders", 2, 100).alias("delay_rate_pct")
DELAY = F.col("average_delivery_delay_min")
DELAY2 = half_up(DELAY, 2).alias("average_delay_min")
DELIVERY_DELAY2 = half_up(DELAY, 2).alias("average_delivery_delay_min")
MOST = [F.desc("total_orders"), "warehouse_id"]
RICHEST = [F.desc("total_order_value"), "warehouse_id"]
NETWORK_MEAN = mean_of("total_orders")


def named(lake):
    """warehouse_mart with the warehouse name (unknown warehouses keep a NULL name)."""
    names = lake.warehouses.groupBy("warehouse_id").agg(F.min("warehouse_name").alias("warehouse_name"))
    return lake.warehouse_mart.join(names, "warehouse_id", "left")


@query("wh_overall")
def overall(lake):
    return named(lake).agg(
        F.count("warehouse_id").alias("total_warehouses"), whole("total_orders", "total_orders"),
        mean("total_orders", "average_orders_per_warehouse"), half_up(F.sum("total_order_value"), 2).alias("total_order_value"),
        mean(DELAY, "average_delivery_delay_min"), whole("delayed_orders", "total_delayed_orders"),
        ratio(F.sum("delayed_orders"), F.sum("total_orders"), 2, 100).alias("overall_delay_rate_pct"),
    )


query("wh_performance")(
    lambda lake: named(lake)
    .select(*WHO, "total_order_value", half_up("average_order_value", 2).alias("average_order_value"), DELIVERY_DELAY2, "delayed_orders", LATE_PCT)
    .orderBy(*MOST)
)
query("wh_top20_volume")(
    lambda lake: named(lake).select(*WHO, "total_order_value", DELIVERY_DELAY2).orderBy(*MOST).limit(20)
)
AOV = ratio("total_order_value", "total_orders", 2).alias("average_order_value")
query("wh_top20_value")(lambda lake: named(lake).select(*WHO, "total_order_value", AOV).orderBy(*RICHEST).limit(20))
query("wh_delivery_risk")(
    lambda lake: named(lake)
    .select(
        "warehouse_id", "warehouse_name", "total_orders", "delayed_orders", LATE_PCT, DELIVERY_DELAY2,
        F.when((RATE >= 0.50) | (DELAY >= 30), "High Risk")
        .when((RATE >= 0.25) | (DELAY >= 15), "Medium Risk")
        .otherwise("Low Risk")
        .alias("warehouse_delivery_risk"),
    )
    .orderBy(F.desc("delay_rate_pct"), F.desc("average_delivery_delay_min"), "warehouse_id")
)


@query("wh_segmentation")
def segmentation(lake):
    n = F.col("total_orders")
    level = F.when((n >= 750) & (DELAY < 15), 1).when((n >= 500) & (DELAY < 25), 2).when(DELAY < 35, 3).otherwise(4)
    names = F.array(*[F.lit(x) for x in ("High Performing", "Stable", "Needs Improvement", "High Risk")])
    return (
        named(lake)
        .withColumn("_level", level)
        .orderBy("_level", *MOST)
        .select(*WHO, "total_order_value", DELIVERY_DELAY2, F.element_at(names, F.col("_level")).alias("performance_category"))
    )


@query("wh_region")
def by_region(lake):
    return named(lake).groupBy("region").agg(
        F.count("warehouse_id").alias("warehouse_count"), whole("total_orders", "total_orders"),
        ratio(F.sum("total_orders"), F.count("warehouse_id"), 2).alias("average_orders_per_warehouse"),
        half_up(F.sum("total_order_value"), 2).alias("total_order_value"), mean(DELAY, "average_delay_min"),
        whole("delayed_orders", "delayed_orders"),
        ratio(F.sum("delayed_orders"), F.sum("total_orders"), 2, 100).alias("delay_rate_pct"),
    ).orderBy(F.desc("total_orders"), "region")


@query("wh_value_share")
def value_share(lake):
    m = named(lake)
    return m.select(
        *WHO, "total_order_value",
        ratio("total_order_value", grand_total(m, F.sum("total_order_value")), 2, 100).alias("value_contribution_pct"),
    ).orderBy(*RICHEST)


def _against_mean(lake, keep, *cols):
    m = named(lake)
    usual = grand_total(m, NETWORK_MEAN)
    return m.filter(keep(usual)).select(*WHO, half_up(usual, 2).alias("network_average_orders"), *cols)


BUSY = lambda usual: F.col("total_orders") > usual
query("wh_above_avg")(lambda lake: _against_mean(lake, BUSY, "total_order_value", DELAY2, LATE_PCT).orderBy(*MOST))
query("wh_above_avg_poor")(
    lambda lake: _against_mean(lake, lambda u: BUSY(u) & ((DELAY >= 20) | (RATE >= 0.25)), DELAY2, LATE_PCT).orderBy(*MOST)
)
query("wh_below_avg")(
    lambda lake: _against_mean(lake, lambda u: F.col("total_orders") < u, "total_order_value", DELAY2).orderBy(
        "total_orders", "warehouse_id"
    )
)


@query("wh_deciles")
def deciles(lake):
    tiles = global_ntile(
        named(lake).select("warehouse_id", "total_orders"), 10, [F.desc("total_orders"), F.asc("warehouse_id")], "workload_decile"
    )
    return tiles.groupBy("workload_decile").agg(
        rows("warehouse_count"), whole("total_orders", "total_orders"), mean("total_orders", "average_orders")
    ).orderBy("workload_decile")


query("wh_value_segment")(
    lambda lake: named(lake)
    .select(
        *WHO, "total_order_value",
        at_least("total_order_value", ((100000, "High Value"), (50000, "Medium Value")), "Low Value").alias("value_segment"),
    )
    .orderBy(*RICHEST)
)
query("wh_aov")(
    lambda lake: named(lake).select(*WHO, AOV, "total_order_value").orderBy(F.desc("average_order_value"), "warehouse_id")
)
query("wh_delay_impact")(
    lambda lake: named(lake).select(*WHO, "delayed_orders", LATE_PCT, DELAY2).orderBy(F.desc("delayed_orders"), "warehouse_id")
)


@query("wh_dense_rank")
def dense_rank(lake):
    m = named(lake).select(*WHO, DELAY2, LATE_PCT, RATE.alias("_rate"), DELAY.alias("_delay"))
    ranked = global_dense_rank(m, {"_rate": True, "_delay": True}, "performance_rank")
    return ranked.drop("_rate", "_delay").orderBy("performance_rank", "warehouse_id")


query("wh_exceptions")(
    lambda lake: named(lake)
    .filter((DELAY >= 30) | (RATE >= 0.50))
    .select(*WHO, "delayed_orders", DELAY2, LATE_PCT)
    .orderBy(F.desc("average_delay_min"), F.desc("delay_rate_pct"), "warehouse_id")
)


@query("wh_network_balance")
def network_balance(lake):
    m = named(lake)
    both = grand_total(m, F.struct(NETWORK_MEAN.alias("mean"), F.stddev_samp("total_orders").alias("spread")))
    usual, spread = F.col("_net.mean"), F.col("_net.spread")
    n, margin = F.col("total_orders"), F.coalesce(spread, F.lit(0.0))
    return m.withColumn("_net", both).select(
        *WHO, half_up(usual, 2).alias("network_avg_orders"), half_up(spread, 2).alias("network_stddev_orders"),
        F.when(n > usual + margin, "Above Normal Workload")
        .when(n < usual - margin, "Below Normal Workload")
        .otherwise("Within Normal Range")
        .alias("workload_position"),
    ).orderBy(*MOST)


@query("wh_workload_delay_matrix")
def workload_delay(lake):
    m = named(lake)
    heavy = F.col("total_orders") >= grand_total(m, NETWORK_MEAN)
    side = F.when(heavy, "High Workload / ").otherwise("Low Workload / ")
    return m.select(
        *WHO, DELAY2,
        F.concat(side, F.when(DELAY >= 20, "High Delay").otherwise("Controlled Delay")).alias("workload_delay_segment"),
    ).orderBy(*MOST)


@query("wh_exec_snapshot")
def exec_snapshot(lake):
    return named(lake).agg(
        rows("total_warehouses"), whole("total_orders", "total_orders"), mean("total_orders", "average_orders_per_warehouse"),
        half_up(F.sum("total_order_value"), 2).alias("total_order_value"), mean("total_order_value", "average_warehouse_order_value"),
        mean(DELAY, "average_delivery_delay_min"), whole("delayed_orders", "total_delayed_orders"),
        ratio(F.sum("delayed_orders"), F.sum("total_orders"), 2, 100).alias("network_delay_rate_pct"),
        rows_if((DELAY >= 30) | (RATE >= 0.50), "high_risk_warehouses"),
    )
