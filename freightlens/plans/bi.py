"""Dashboard measures over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightlens.functions.measures import grand_total, half_up, largest, mean, ratio, rows, rows_if, total
from freightlens.functions.rules import DELAY_CUT, upto
from freightlens.operators.ranking import global_running_total
from freightlens.registry import query

LATE, ON_TIME = F.col("is_delayed") == 1, F.col("is_delayed") == 0
ALL_ROWS = F.count(F.lit(1))
LATE_RATE = ratio(F.count_if(LATE), ALL_ROWS, 4).alias("delay_rate")
ON_TIME_RATE = ratio(F.count_if(ON_TIME), ALL_ROWS, 4).alias("on_time_rate")
VALUE = total("order_value", "total_order_value")
DELAY = mean("delivery_delay_min", "average_delay_min")
REGION = F.coalesce("region", F.lit("ALL")).alias("region")


def orders_in_regions(lake):
    """fact_orders with the region name; only the location join is kept."""
    return lake.fact_orders.join(lake.dims["location"].select("location_key", "region"), "location_key")


@query("bi_executive")
def executive(lake):
    """Headline measures in total (region ALL) and the risk table by region, from one pass."""
    return orders_in_regions(lake).rollup("region").agg(
        rows("orders"), VALUE, mean("order_value", "average_order_value"), DELAY, rows_if(LATE, "delayed_orders"), ON_TIME_RATE,
        LATE_RATE,
    ).withColumn("region", REGION).orderBy(F.desc("delay_rate"), "region")


@query("bi_delivery")
def delivery(lake):
    """Totals, delay severity and weather impact as groupings of one pass over the delivery mart."""
    m = lake.delivery_mart.withColumn("severity", upto("delivery_delay_min", DELAY_CUT))
    g = m.groupingSets([[], ["severity"], ["weather_condition"]], "severity", "weather_condition").agg(
        F.grouping_id().alias("_g"), rows("deliveries"), rows_if(LATE, "delayed_deliveries"), DELAY,
        largest("delivery_delay_min", "maximum_delay_min"), LATE_RATE,
    )
    view = F.when(F.col("_g") == 3, "total").when(F.col("_g") == 1, "severity").otherwise("weather")
    key = F.when(F.col("_g") == 3, "ALL").otherwise(F.coalesce("severity", "weather_condition", F.lit("Unknown")))
    return g.select(
        view.alias("view"), key.alias("key"), "deliveries", "delayed_deliveries", "average_delay_min", "maximum_delay_min", "delay_rate"
    ).orderBy("view", "key")


@query("bi_fleet")
def fleet(lake):
    d = lake.fact_orders.groupBy("driver_key").agg(
        F.sum("delivery_delay_min").alias("s"), F.count("delivery_delay_min").alias("c")
    ).agg(
        F.count("driver_key").alias("active_drivers"),
        ratio(F.sum("s").cast("double"), F.sum("c"), 2).alias("average_driver_delay_min"),
    )
    g = lake.fact_gps.groupBy("vehicle_id").agg(
        F.sum("speed_kmph").alias("s"), F.count("speed_kmph").alias("c"), F.count_if(F.col("is_low_signal") == 1).alias("w")
    ).agg(
        F.struct(
            F.count("vehicle_id").alias("active_vehicles"),
            ratio(F.sum("s").cast("double"), F.sum("c"), 2).alias("average_gps_speed_kmph"),
            F.sum("w").alias("low_signal_observations"),
        ).alias("g")
    )
    return d.withColumn("_g", g.scalar()).select("active_drivers", "average_driver_delay_min", "_g.*")


query("bi_fleet_risk_matrix")(
    lambda lake: lake.fact_orders.join(lake.dims["driver"].select("driver_key", "driver_id"), "driver_key")
    .groupBy("driver_id")
    .agg(rows("orders"), ON_TIME_RATE, DELAY, VALUE)
    .orderBy(F.desc("orders"), "driver_id")
)


@query("bi_warehouse")
def warehouse(lake):
    w = lake.fact_orders.groupBy("warehouse_key").agg(rows("n"), F.count_if(LATE).alias("l"))
    return w.agg(
        F.count("warehouse_key").alias("total_warehouses"), F.sum("n").alias("warehouse_orders"),
        ratio(F.sum("n"), F.count("warehouse_key"), 2).alias("average_orders_per_warehouse"),
        ratio(F.sum("l"), F.sum("n"), 4).alias("warehouse_delay_rate"),
    )


query("bi_warehouse_risk")(
    lambda lake: lake.warehouse_mart.join(
        lake.warehouses.groupBy("warehouse_id").agg(F.min("warehouse_name").alias("warehouse_name")), "warehouse_id", "left"
    )
    .select(
        "warehouse_id", "warehouse_name", "region", F.col("total_orders").alias("orders"), "total_order_value", "delayed_orders",
        half_up("delay_rate", 4).alias("delay_rate"), half_up("average_delivery_delay_min", 2).alias("average_delay_min"),
        F.col("warehouse_risk_category").alias("risk_category"),
    )
    .orderBy(F.desc("delay_rate"), "warehouse_id")
)


@query("bi_financial")
def financial(lake):
    """Pareto view: customers by order value with their own and the cumulative contribution."""
    c = lake.fact_orders.join(lake.dims["customer"].select("customer_key", "customer_id"), "customer_key")
    g = c.groupBy("customer_id").agg(F.coalesce(F.sum("order_value"), F.lit(0)).alias("_v"))
    run = global_running_total(g, {"_v": "_run"}, [F.desc("_v"), F.asc("customer_id")])
    everything = grand_total(run, F.sum("_v")).cast("double")
    own, upto_here = F.col("_v").cast("double"), F.col("_run").cast("double")
    return run.select(
        "customer_id", own.alias("total_order_value"), ratio(own, everything, 4, 100).alias("contribution_pct"),
        ratio(upto_here, everything, 4, 100).alias("cumulative_pct"),
    ).orderBy(F.desc("total_order_value"), "customer_id")


query("bi_financial_kpis")(
    lambda lake: lake.fact_orders.agg(
        total("order_value", "total_revenue"), mean("order_value", "average_order_value"), rows("financial_orders"),
        ratio(F.sum("order_value").cast("double"), F.sum("delivery_distance_km").cast("double"), 2).alias("revenue_per_km"),
    )
)


@query("bi_reconcile")
def reconcile(lake):
    """Checks between measures: on-time plus delayed is the total, and published rates stay within 0..1."""
    d = lake.fact_delivery.agg(
        rows("total_deliveries"), rows_if(LATE, "delayed_deliveries"), rows_if(ON_TIME, "on_time_deliveries"),
        F.count_if(F.col("delivery_status") == "DELIVERED").alias("_done"),
    )
    share = F.try_divide(F.col("on_time_deliveries").cast("double"), F.col("_done"))
    return d.select(
        "total_deliveries", "delayed_deliveries", "on_time_deliveries",
        (F.col("delayed_deliveries") + F.col("on_time_deliveries") == F.col("total_deliveries")).alias("totals_agree"),
        half_up(share, 4).alias("on_time_to_delivered_ratio"), (share > 1).alias("ratio_out_of_range"),
    )
