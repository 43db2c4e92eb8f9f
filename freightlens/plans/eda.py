"""Exploratory summaries of all raw datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import grand_total, half_up, largest, mean, ratio, rows, rows_if, total, whole
from freightlens.functions.rules import flag
from freightlens.operators.profile import column_counts, describe_columns, duplicate_rows, histogram, long_values
from freightlens.registry import query

NUMERIC = ("decimal", "int", "bigint", "double", "float", "smallint")


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind.startswith(NUMERIC)]


@query("eda_dataset_summary")
def dataset_summary(lake):
    parts = []
    for name, df in lake.raw_tables().items():
        cells = column_counts(df, name).groupBy("dataset").agg(
            F.max("rows").alias("rows"), rows("columns"), F.sum(F.col("rows") - F.col("filled")).cast("long").alias("missing_cells")
        )
        parts.append(cells.withColumn("duplicate_rows", duplicate_rows(df).scalar()))
    cells = F.greatest(F.col("rows") * F.col("columns"), F.lit(1))
    return _union(parts).withColumn("missing_cells_pct", ratio("missing_cells", cells, 2, 100)).orderBy(F.desc("rows"), "dataset")


@query("eda_missing_values")
def missing_values(lake):
    parts = [column_counts(df, name) for name, df in lake.raw_tables().items()]
    gone = F.col("rows") - F.col("filled")
    return _union(parts).select(
        "dataset", "column_name", gone.alias("missing_count"),
        ratio(gone, F.greatest("rows", F.lit(1)), 2, 100).alias("missing_pct"),
    ).orderBy(F.desc("missing_count"), "dataset", "column_name")


@query("eda_numeric_summary")
def numeric_summary(lake):
    parts = [long_values(df, name, numeric_columns(df)) for name, df in lake.raw_tables().items() if numeric_columns(df)]
    d = describe_columns(_union(parts))
    return d.select(
        "dataset", "column_name", "count", *[half_up(c, 6).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    ).orderBy("dataset", "column_name")


ACTUAL, PROMISED = F.col("actual_delivery_time_min"), F.col("promised_delivery_time_min")


def with_delay(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"delivery_delay_min": ACTUAL - PROMISED, "is_delayed": flag(ACTUAL > PROMISED)})


def known(df: DataFrame, key: str) -> DataFrame:
    """Group keys without a value are left out, as data-frame group-bys do."""
    return df.filter(F.col(key).isNotNull())


VALUE = total("order_value", "total_order_value")
AOV = mean("order_value", "average_order_value", None)
DELAY = mean("delivery_delay_min", "average_delay_min", None)
LATE = whole("is_delayed", "delayed_orders")


def activity(lake, key: str, count: str, *more):
    return known(with_delay(lake.orders), key).groupBy(key).agg(F.count("order_id").alias(count), VALUE, AOV, *more)


query("eda_orders_region")(
    lambda lake: activity(
        lake, "region", "orders", mean("delivery_distance_km", "average_distance_km", None), DELAY, LATE
    ).orderBy(F.desc("orders"), "region")
)


@query("eda_status_share")
def status_share(lake):
    g = lake.orders.groupBy("delivery_status").agg(rows("orders"))
    return g.withColumn("order_share_pct", ratio("orders", grand_total(g, F.sum("orders")), 2, 100)).orderBy(
        F.desc("orders"), "delivery_status"
    )


query("eda_order_value_histogram")(lambda lake: histogram(lake.orders, "order_value").orderBy("bin"))
query("eda_rain_histogram")(lambda lake: histogram(lake.weather, "rainfall_mm").orderBy("bin"))


@query("eda_distance_vs_delay")
def distance_vs_delay(lake):
    """Kilometre bins of the distance/delay scatter, with the correlation over all pairs."""
    p = with_delay(lake.orders).select("delivery_distance_km", "delivery_delay_min").dropna()
    x, y = F.col("delivery_distance_km").cast("decimal(18,2)"), F.col("delivery_delay_min").cast("decimal(10,0)")
    s = lambda c: F.sum(c).cast("double")
    n = F.count(F.lit(1)).cast("double")
    cov = n * s(x * y) - s(x) * s(y)
    var = F.sqrt((n * s(x * x) - s(x) * s(x)) * (n * s(y * y) - s(y) * s(y)))
    r = grand_total(p, F.try_divide(cov, var))
    return p.groupBy(F.floor("delivery_distance_km").cast("int").alias("distance_km_bin")).agg(
        rows("orders"), mean("delivery_distance_km", "average_distance_km"), mean("delivery_delay_min", "average_delay_min")
    ).withColumn("correlation", half_up(r, 8)).orderBy("distance_km_bin")


query("eda_customer_activity")(
    lambda lake: activity(lake, "customer_id", "total_orders", DELAY, LATE).orderBy(F.desc("total_order_value"), "customer_id")
)
query("eda_customers_region")(
    lambda lake: known(lake.customers, "region").groupBy("region").agg(F.count_distinct("customer_id").alias("customers")).orderBy(
        F.desc("customers"), "region"
    )
)
LATE_PCT = ratio("delayed_orders", "total_orders", 2, 100)


@query("eda_driver_performance")
def driver_performance(lake):
    m = activity(lake, "driver_id", "total_orders", DELAY, LATE).withColumn("delay_rate_pct", LATE_PCT)
    m = m.withColumn("on_time_rate_pct", half_up(100 - F.col("delay_rate_pct"), 2))
    d = lake.drivers.groupBy("driver_id").agg(F.min("region").alias("region"))
    return m.join(d, "driver_id", "left").orderBy(F.desc("total_orders"), "driver_id")


@query("eda_warehouse_workload")
def warehouse_workload(lake):
    m = activity(
        lake, "warehouse_id", "total_orders", mean("delivery_delay_min", "average_delivery_delay_min", None), LATE
    ).withColumn("delay_rate_pct", LATE_PCT)
    one = F.min(F.struct("warehouse_name", "region", "capacity_units")).alias("one")
    w = lake.warehouses.groupBy("warehouse_id").agg(one).select("warehouse_id", "one.*")
    return m.join(w, "warehouse_id", "left").orderBy(F.desc("total_orders"), "warehouse_id")


OBS = rows("observations")
query("eda_weather_condition")(
    lambda lake: known(lake.weather, "weather_condition").groupBy("weather_condition").agg(
        OBS, mean("temperature_c", "average_temperature_c", None), mean("humidity_pct", "average_humidity_pct", None),
        mean("rainfall_mm", "average_rainfall_mm", None),
    ).orderBy(F.desc("observations"), "weather_condition")
)
query("eda_traffic_location")(
    lambda lake: known(lake.traffic, "location").groupBy("location").agg(
        OBS, mean("traffic_score", "average_traffic_score", None), mean("average_speed_kmph", "average_speed_kmph", None)
    ).orderBy(F.desc("average_traffic_score"), "location")
)
query("eda_traffic_level")(
    lambda lake: lake.traffic.groupBy("traffic_level").agg(OBS).orderBy(F.desc("observations"), "traffic_level")
)
SIGNAL = F.trim("signal_quality").try_cast("decimal(10,2)")
query("eda_gps_vehicle")(
    lambda lake: known(lake.gps_tracking, "vehicle_id").groupBy("vehicle_id").agg(
        rows("gps_observations"), mean("speed_kmph", "average_speed_kmph", None), largest("speed_kmph", "maximum_speed_kmph"),
        mean(SIGNAL, "average_signal_quality", None), rows_if(F.lower("vehicle_status") == "active", "active_observations"),
    ).orderBy(F.desc("gps_observations"), "vehicle_id")
)
query("eda_delivery_events")(
    lambda lake: known(lake.delivery_updates, "event_type").groupBy("event_type").agg(
        rows("events"), mean("delay_minutes", "average_delay_minutes", None)
    ).orderBy(F.desc("events"), "event_type")
)
query("eda_update_status")(
    lambda lake: lake.delivery_updates.groupBy("delivery_status").agg(rows("events")).orderBy(F.desc("events"), "delivery_status")
)
