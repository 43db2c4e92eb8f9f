"""Lake-table profiles: several groupings of one table in a single pass (GROUPING SETS)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import largest, mean, rows, rows_if, total, whole
from freightlens.functions.rules import bad_coordinates
from freightlens.registry import query


def profile(df: DataFrame, sets: list[list[str]], *measures) -> DataFrame:
    """One row per value of each grouping: (profile, profile_key, measures).

    profile names the grouping ('all' for the whole table); profile_key joins its values with '|' and
    writes NULL as the word NULL. The table is read once for all groupings.
    """
    cols = list(dict.fromkeys(c for s in sets for c in s))
    if not cols:
        return df.agg(*measures).select(F.lit("all").alias("profile"), F.lit("ALL").alias("profile_key"), "*")
    g = df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.grouping_id().alias("_gid"), *measures)
    name = key = None
    for s in sets:
        gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s)
        hit = F.col("_gid") == gid
        label = F.lit("+".join(s) or "all")
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in s]) if s else F.lit("ALL")
        name = F.when(hit, label) if name is None else name.when(hit, label)
        key = F.when(hit, text) if key is None else key.when(hit, text)
    return g.select(name.alias("profile"), key.alias("profile_key"), *[c for c in g.columns if c not in [*cols, "_gid"]]).orderBy(
        "profile", "profile_key"
    )


BAD = rows_if(bad_coordinates(), "invalid_coordinates")


@query("prof_customers")
def customers(lake):
    """Counts by type and region; mean age in days up to the last registration in the table."""
    c = lake.customers
    day = F.coalesce(F.lit(lake.as_of).cast("date"), c.agg(F.max("registration_date")).scalar())
    aged = c.withColumn("_age", F.datediff(day, "registration_date"))
    return profile(aged, [[], ["customer_type"], ["region"]], rows("customer_count"), mean("_age", "avg_customer_age_days", 0))


query("prof_drivers")(
    lambda lake: profile(
        lake.drivers, [[], ["employment_status"], ["region"], ["license_type"]], rows("driver_count"), mean("rating", "avg_rating"),
        mean("experience_years", "avg_experience_years"),
    )
)
query("prof_gps")(
    lambda lake: profile(
        lake.gps_tracking, [[], ["region"], ["vehicle_id"], ["signal_quality"], ["vehicle_status", "ignition_status"]],
        rows("gps_records"), mean("speed_kmph", "avg_speed_kmph"), largest("speed_kmph", "max_speed_kmph"), BAD,
    )
)
query("prof_orders")(
    lambda lake: profile(
        lake.orders, [[], ["delivery_status"], ["region"]], rows("total_orders"), mean("order_value", "avg_order_value"),
        mean("delivery_distance_km", "avg_distance_km"),
    )
)
query("prof_traffic")(
    lambda lake: profile(
        lake.traffic.withColumn("hour_start", F.date_format("timestamp", "yyyy-MM-dd HH")),
        [[], ["traffic_level"], ["location"], ["hour_start"]], rows("observations"), mean("traffic_score", "avg_traffic_score"),
        mean("average_speed_kmph", "avg_speed_kmph"), BAD,
    )
)
query("prof_vehicles")(
    lambda lake: profile(
        lake.vehicles, [[], ["vehicle_type"], ["fuel_type"], ["maintenance_status"], ["vehicle_status"]], rows("vehicle_count"),
        mean("capacity_kg", "avg_capacity_kg"), mean("odometer_km", "avg_odometer_km"),
    )
)
query("prof_warehouses")(
    lambda lake: profile(
        lake.warehouses, [[], ["region"], ["warehouse_id"]], rows("warehouse_count"), whole("capacity_units", "total_capacity_units"),
        mean("capacity_units", "avg_capacity_units"), F.min("capacity_units").alias("minimum_capacity"),
        F.max("capacity_units").alias("maximum_capacity"),
        rows_if(F.col("latitude").isNull() | F.col("longitude").isNull(), "missing_coordinates"),
    )
)
query("prof_weather")(
    lambda lake: profile(
        lake.weather, [[], ["location"], ["weather_condition"]], rows("observations"), mean("temperature_c", "avg_temperature_c"),
        mean("humidity_pct", "avg_humidity_pct"), mean("rainfall_mm", "avg_rainfall_mm"), total("rainfall_mm", "total_rainfall_mm"),
        largest("rainfall_mm", "max_rainfall_mm"), BAD,
    )
)
