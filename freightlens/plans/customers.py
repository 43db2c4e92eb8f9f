"""Customer reports over the delivery mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightlens.functions.measures import (
    grand_total, half_up, mean, mean_of, ratio, rows, rows_if, share, share_of, total,
)
from freightlens.functions.rules import at_least
from freightlens.operators.ranking import global_ntile
from freightlens.operators.rollup import entities_per_key
from freightlens.registry import query

LATE = F.col("is_delayed") == 1
ON_TIME = F.col("is_delayed") == 0
ORDERS = rows("total_orders")
VALUE = total("order_value", "total_order_value")
AOV = mean("order_value", "average_order_value")
DELAY = mean("delivery_delay_min", "average_delay_min")
DELIVERY_DELAY = mean("delivery_delay_min", "average_delivery_delay_min")
LATE_ORDERS = rows_if(LATE, "delayed_orders")
LATE_PCT = share(LATE, "delay_rate_pct")
ON_TIME_PCT = share(ON_TIME, "on_time_rate_pct")


def by(lake, *keys):
    return lake.delivery_mart.groupBy(*keys)


def per_customer(lake):
    """Unrounded per-customer facts that several reports aggregate again."""
    return by(lake, "customer_id").agg(
        ORDERS,
        VALUE,
        LATE_ORDERS,
        mean_of("delivery_delay_min").alias("average_delay_min"),
        share_of(LATE).alias("delay_rate"),
    )


def share_of_groups(groups, label: str):
    """Rows per label and their share of all groups."""
    n = grand_total(groups, F.count(F.lit(1)))
    out = groups.groupBy(label).agg(rows("customer_count"))
    return out.withColumn("customer_share_pct", ratio("customer_count", n, 2, 100)).orderBy(F.desc("customer_count"), label)


@query("cust_overall_kpis")
def overall(lake):
    m = lake.delivery_mart.groupBy("customer_id").agg(
        rows("n"), F.sum("order_value").alias("v"), F.count("order_value").alias("vn"),
        F.sum("delivery_delay_min").alias("d"), F.count("delivery_delay_min").alias("dn"), rows_if(LATE, "l"),
    )
    return m.agg(
        F.count("customer_id").alias("total_customers"),
        F.sum("n").alias("total_orders"),
        ratio(F.sum("n"), F.count("customer_id"), 2).alias("orders_per_customer"),
        total("v", "total_order_value"),
        ratio(F.sum("v").cast("double"), F.sum("vn"), 2).alias("average_order_value"),
        ratio(F.sum("d").cast("double"), F.sum("dn"), 2).alias("average_delivery_delay_min"),
        ratio(F.sum("l"), F.sum("n"), 2, 100).alias("customer_order_delay_rate_pct"),
    )


@query("cust_activity")
def activity(lake):
    return by(lake, "customer_id").agg(
        ORDERS, VALUE, AOV, mean("delivery_distance_km", "average_delivery_distance_km"), DELIVERY_DELAY, LATE_ORDERS, LATE_PCT
    ).orderBy(F.desc("total_order_value"), "customer_id")


def top_contributors(lake, key: str, k: int = 20):
    g = by(lake, key).agg(ORDERS, F.sum("order_value").alias("_v"))
    all_value = grand_total(g, F.sum("_v")).cast("double")
    return g.select(
        key, "total_orders", F.col("_v").cast("double").alias("total_order_value"),
        ratio(F.col("_v").cast("double"), all_value, 2, 100).alias("revenue_contribution_pct"),
    ).orderBy(F.desc("total_order_value"), key).limit(k)


query("cust_top20_revenue")(lambda lake: top_contributors(lake, "customer_id"))


@query("cust_value_segment")
def value_segment(lake):
    label = at_least("total_order_value", ((100000, "High Value"), (50000, "Medium Value")), "Low Value")
    return by(lake, "customer_id").agg(ORDERS, VALUE).withColumn("customer_value_segment", label).orderBy(
        F.desc("total_order_value"), "customer_id"
    )


@query("cust_frequency_segment")
def frequency_segment(lake):
    label = at_least("total_orders", ((15, "Highly Frequent"), (8, "Frequent"), (3, "Occasional")), "Low Frequency")
    return by(lake, "customer_id").agg(ORDERS).withColumn("frequency_segment", label).orderBy(
        F.desc("total_orders"), "customer_id"
    )


@query("cust_repeat_share")
def repeat_share(lake):
    kind = F.when(F.col("total_orders") == 1, "One-Time").otherwise("Repeat")
    return share_of_groups(by(lake, "customer_id").agg(ORDERS).select(kind.alias("customer_type")), "customer_type")


@query("cust_retention_proxy")
def retention(lake):
    months = lake.delivery_mart.select("customer_id", F.trunc("order_date", "month").alias("m")).distinct()
    kind = F.when(F.count("m") > 1, "Multi-Month Customer").otherwise("Single-Month Customer")
    groups = months.groupBy("customer_id").agg(kind.alias("retention_segment")).select("retention_segment")
    return share_of_groups(groups, "retention_segment")


def with_customers(lake, key: str, alias: str, measures: list, order: list):
    """Measures per key plus distinct customers per key; the distinct count never expands the facts."""
    m = by(lake, key).agg(*measures)
    c = entities_per_key(lake.delivery_mart, [key], "customer_id", alias).withColumnRenamed(key, "_k")
    return m.join(c, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k").orderBy(*order)


query("cust_region")(
    lambda lake: with_customers(
        lake, "region", "unique_customers", [ORDERS, VALUE, AOV, DELIVERY_DELAY, LATE_PCT],
        [F.desc("total_order_value"), "region"],
    )
)


@query("cust_experience")
def experience(lake):
    late = share_of(LATE)
    label = F.when(late >= 0.50, "Poor Experience").when(late >= 0.25, "Needs Attention").otherwise("Good Experience")
    return by(lake, "customer_id").agg(
        ORDERS, LATE_ORDERS, DELAY, ON_TIME_PCT, label.alias("experience_segment")
    ).orderBy(F.desc("average_delay_min"), "customer_id")


def rounded(c: str, alias: str | None = None, scale: float = 1.0):
    x = F.col(c) * scale if scale != 1.0 else F.col(c)
    return half_up(x, 2).alias(alias or c)


@query("cust_high_value_poor")
def high_value_poor(lake):
    return per_customer(lake).filter("total_order_value >= 50000 AND delay_rate >= 0.25").select(
        "customer_id", "total_orders", "total_order_value", rounded("average_delay_min"),
        rounded("delay_rate", "delay_rate_pct", 100),
    ).orderBy(F.desc("total_order_value"), F.desc("delay_rate_pct"), "customer_id")


@query("cust_delivery_risk")
def delivery_risk(lake):
    high = (F.col("delayed_orders") >= 5) | (F.col("average_delay_min") >= 30)
    medium = (F.col("delayed_orders") >= 2) | (F.col("average_delay_min") >= 15)
    level = F.when(high, 1).when(medium, 2).otherwise(3)
    names = F.element_at(F.array(F.lit("High Risk"), F.lit("Medium Risk"), F.lit("Low Risk")), F.col("_level"))
    return (
        per_customer(lake)
        .withColumn("_level", level)
        .orderBy("_level", F.desc("average_delay_min"), "customer_id")
        .select("customer_id", "total_orders", "delayed_orders", rounded("average_delay_min"), names.alias("delivery_risk"))
    )


@query("cust_monthly_trend")
def monthly_trend(lake):
    m = lake.delivery_mart.withColumn("_m", F.trunc("order_date", "month"))
    facts = m.groupBy("_m").agg(ORDERS, VALUE, AOV, LATE_PCT)
    who = entities_per_key(m, ["_m"], "customer_id", "active_customers")
    return facts.join(who, "_m").select(
        F.year("_m").alias("order_year"), F.month("_m").alias("order_month"), "active_customers", "total_orders",
        "total_order_value", "average_order_value", "delay_rate_pct",
    ).orderBy("order_year", "order_month")


@query("cust_value_deciles")
def value_deciles(lake):
    g = by(lake, "customer_id").agg(F.sum("order_value").alias("v"))
    tiles = global_ntile(g, 10, [F.col("v").desc_nulls_last(), F.col("customer_id")], "customer_decile")
    d = tiles.groupBy("customer_decile").agg(rows("customers"), total("v", "order_value"))
    all_value = grand_total(tiles, F.sum("v")).cast("double")
    return d.withColumn("value_share_pct", ratio("order_value", all_value, 2, 100)).orderBy("customer_decile")


@query("cust_value_vs_experience")
def value_vs_experience(lake):
    label = at_least("total_order_value", ((50000, "High Value"), (20000, "Medium Value")), "Low Value")
    return per_customer(lake).groupBy(label.alias("value_segment")).agg(
        rows("customers"), mean("total_orders", "avg_orders_per_customer"), mean("total_order_value", "avg_customer_value"),
        mean("average_delay_min", "avg_delay_min"), half_up(mean_of("delay_rate") * 100, 2).alias("avg_delay_rate_pct"),
    ).orderBy(F.desc("avg_customer_value"))


@query("cust_repeated_delays")
def repeated_delays(lake):
    return by(lake, "customer_id").agg(
        ORDERS, LATE_ORDERS, DELAY, F.max("delivery_delay_min").alias("maximum_delay_min")
    ).filter("delayed_orders >= 3").orderBy(F.desc("delayed_orders"), F.desc("average_delay_min"), "customer_id")


query("cust_by_weather")(
    lambda lake: with_customers(
        lake, "weather_condition", "unique_customers", [ORDERS, VALUE, DELAY, LATE_PCT],
        [F.desc("total_order_value"), "weather_condition"],
    )
)


@query("cust_exec_snapshot")
def exec_snapshot(lake):
    return per_customer(lake).agg(
        rows("total_customers"),
        rows_if(F.col("total_orders") > 1, "repeat_customers"),
        rows_if(F.col("total_order_value") >= 50000, "high_value_customers"),
        rows_if(F.col("delay_rate") >= 0.25, "customers_with_high_delay_rate"),
        mean("total_orders", "avg_orders_per_customer"),
        mean("total_order_value", "avg_customer_value"),
        mean("average_delay_min", "avg_customer_delay_min"),
    )
