"""Star schema: dimensions, facts, and the reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.measures import filled, largest, mean, ratio, rows, rows_if, total, whole
from freightlens.functions.rules import EXPERIENCE_BANDS, JAM_LEVELS, KM_FACT_BANDS, below, upper_text
from freightlens.operators.proximity import points_in_intervals
from freightlens.operators.rollup import entities_per_key
from freightlens.registry import query

LOADED_AT = "2024-02-01 00:00:00"


def surrogate(*cols) -> Column:
    """A stable 60-bit key from the natural key: no lookup table, no shuffle, same value on every reload."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def dimension(df: DataFrame, natural: str, key: str, columns: list, loaded_at: str = LOADED_AT) -> DataFrame:
    """One row per natural id, the smallest row on repeats, with key and audit columns.

    Built as an aggregate so that the optimizer knows natural is unique and drops the joins of facts to
    dimensions a report does not use.
    """
    attrs = df.filter(F.col(natural).isNotNull()).select(F.trim(natural).alias(natural), *columns)
    rest = [c for c in attrs.columns if c != natural]
    one = attrs.groupBy(natural).agg(F.min(F.struct(*rest)).alias("_r"))
    stamp = F.lit(loaded_at).cast("timestamp_ntz")
    return one.select(
        surrogate(natural).alias(key), natural, "_r.*", F.lit("synthetic_source").alias("source_system"),
        stamp.alias("created_at"), stamp.alias("updated_at"),
    )


def dim_customer(df):
    return dimension(df, "customer_id", "customer_key", ["customer_name", "region", "customer_type", "registration_date"])


def dim_driver(df):
    dec = [F.col("experience_years").cast("decimal(6,2)").alias("experience_years"), F.col("rating").cast("decimal(4,2)").alias("rating")]
    return dimension(df, "driver_id", "driver_key", ["driver_name", "region", *dec, "employment_status", "license_type"])


def dim_vehicle(df):
    return dimension(
        df, "vehicle_id", "vehicle_key",
        ["vehicle_type", "driver_id", "fuel_type", "capacity_kg", "manufacture_year", "maintenance_status", "vehicle_status", "odometer_km"],
    )


def dim_warehouse(df):
    cap = F.col("capacity_units").cast("decimal(14,2)").alias("capacity_units")
    return dimension(df, "warehouse_id", "warehouse_key", ["warehouse_name", "region", cap, "latitude", "longitude"])


def dim_location(orders, warehouses, weather, traffic, gps) -> DataFrame:
    """Every named place once. A name known under several types keeps the first type in the order REGION,
    WEATHER_POINT, TRAFFIC_POINT, GPS_AREA, WAREHOUSE, and the first coordinates given in that order."""
    none = F.lit(None).cast("decimal(10,6)")

    def part(df, rank, kind, name, region, lat=none, lon=none):
        return df.select(
            F.trim(name).alias("location_name"), F.trim(region).alias("region"), lat.alias("latitude"), lon.alias("longitude"),
            F.lit(rank).alias("_rank"), F.lit(kind).alias("location_type"),
        ).filter(F.col("location_name").isNotNull())

    lat, lon = F.col("latitude").cast("decimal(10,6)"), F.col("longitude").cast("decimal(10,6)")
    places = (
        part(orders, 1, "REGION", "region", "region")
        .unionByName(part(weather, 2, "WEATHER_POINT", "location", "location", lat, lon))
        .unionByName(part(traffic, 3, "TRAFFIC_POINT", "location", "location", lat, lon))
        .unionByName(part(gps, 4, "GPS_AREA", "region", "region"))
        .unionByName(part(warehouses, 5, "WAREHOUSE", "warehouse_name", "region", lat, lon))
    )
    placed = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.struct("_rank", "latitude", "longitude"))
    one = places.groupBy("location_name").agg(
        F.min(F.struct("_rank", "location_type", "region")).alias("_t"), F.min(placed).alias("_p")
    )
    stamp = F.lit(LOADED_AT).cast("timestamp_ntz")
    return one.select(
        surrogate("location_name").alias("location_key"), "location_name", F.col("_t.region").alias("region"),
        F.col("_p.latitude").alias("latitude"), F.col("_p.longitude").alias("longitude"),
        F.col("_t.location_type").alias("location_type"), stamp.alias("created_at"), stamp.alias("updated_at"),
    )


def date_key(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar of whole years around the dates in days (column d)."""
    ends = days.agg(F.trunc(F.min("d"), "year").alias("a"), F.trunc(F.max("d"), "year").alias("b"))
    d = ends.select(
        F.explode(F.sequence("a", F.date_sub(F.add_months("b", 12), 1), F.expr("interval 1 day"))).alias("full_date")
    )
    return d.select(
        date_key("full_date").alias("date_key"), "full_date", F.dayofmonth("full_date").alias("day_of_month"),
        (F.weekday("full_date") + 1).alias("day_of_week"), F.date_format("full_date", "EEEE").alias("day_name"),
        F.weekofyear("full_date").alias("week_of_year"), F.month("full_date").alias("month_number"),
        F.date_format("full_date", "MMMM").alias("month_name"), F.quarter("full_date").alias("quarter_number"),
        F.year("full_date").alias("year_number"), (F.weekday("full_date") >= 5).alias("is_weekend"),
    )


def _with_key(fact: DataFrame, dim: DataFrame, natural: str, key: str) -> DataFrame:
    return fact.join(dim.select(natural, key), natural, "left")


def _with_region(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """location_key of the REGION row: region names are unique there, so no order is multiplied."""
    regions = dim.filter("location_type = 'REGION'").groupBy(upper_text("location_name").alias("_place")).agg(
        F.min("location_key").alias("location_key")
    )
    return fact.join(regions, upper_text("region") == F.col("_place"), "left").drop("_place")


MONEY = "decimal(14,2)"
MEASURE = "decimal(12,2)"


def _keyed_orders(orders_clean, dims) -> DataFrame:
    f = orders_clean
    for natural, key, dim in (
        ("customer_id", "customer_key", dims["customer"]), ("driver_id", "driver_key", dims["driver"]),
        ("vehicle_id", "vehicle_key", dims["vehicle"]), ("warehouse_id", "warehouse_key", dims["warehouse"]),
    ):
        f = _with_key(f, dim, natural, key)
    return _with_region(f, dims["location"]).withColumn("date_key", date_key("order_date"))


KEYS = ["customer_key", "driver_key", "vehicle_key", "warehouse_key", "location_key", "date_key"]


def _measures(*cols):
    return [F.col(c).cast(MEASURE).alias(c) for c in cols]


def fact_orders(orders_clean, dims) -> DataFrame:
    return _keyed_orders(orders_clean, dims).select(
        surrogate("order_id").alias("order_key"), "order_id", *KEYS, "order_status", "delivery_status",
        F.col("order_value").cast(MONEY).alias("order_value"),
        *_measures("delivery_distance_km", "promised_delivery_time_min", "actual_delivery_time_min", "delivery_delay_min"),
        "is_delayed",
    )


def fact_delivery(orders_clean, dims) -> DataFrame:
    on_time = F.when(F.col("delivery_delay_min").isNotNull(), 1 - F.col("is_delayed"))
    return _keyed_orders(orders_clean, dims).select(
        surrogate("order_id").alias("delivery_key"), "order_id", *KEYS, "delivery_status",
        *_measures("promised_delivery_time_min", "actual_delivery_time_min", "delivery_delay_min", "delivery_distance_km"),
        "is_delayed", on_time.alias("on_time_flag"),
    )


def fact_gps(gps_clean, dims) -> DataFrame:
    v = dims["vehicle"].select("vehicle_id", "vehicle_key", "driver_id")
    f = _with_key(gps_clean.join(v, "vehicle_id", "left"), dims["driver"], "driver_id", "driver_key")
    return _with_region(f, dims["location"]).select(
        surrogate("vehicle_id", "timestamp").alias("gps_key"), "vehicle_key", "driver_key", "location_key",
        date_key("date").alias("date_key"), "vehicle_id", F.col("timestamp").alias("event_timestamp"),
        *[F.col(c).cast("decimal(10,6)").alias(c) for c in ("latitude", "longitude")],
        F.col("speed_kmph").cast("decimal(12,2)").alias("speed_kmph"), F.col("heading").cast("decimal(8,2)").alias("heading"),
        "vehicle_status", "ignition_status", "signal_quality", "is_moving", "is_low_signal",
    )


def fact_traffic(traffic, dims) -> DataFrame:
    places = dims["location"].groupBy(upper_text("location_name").alias("_place")).agg(F.min("location_key").alias("location_key"))
    t = traffic.join(places, upper_text("location") == F.col("_place"), "left")
    return t.select(
        surrogate(upper_text("location"), F.col("timestamp").cast("string")).alias("traffic_key"), "location_key",
        date_key("timestamp").alias("date_key"), F.col("timestamp").alias("event_timestamp"), "traffic_score",
        upper_text("traffic_level").alias("traffic_level"), F.col("average_speed_kmph").cast(MEASURE).alias("average_speed_kmph"),
    )


# slowly changing dimension ----------------------------------------------------------------------------


def versions(log: DataFrame, natural: str, day: str, attrs: list[str]) -> DataFrame:
    """Type-2 history from a log of observed attributes: one row per run of unchanged attributes.

    The log is first reduced to one row per (id, day), so a hot id costs its task at most one row per day.
    """
    daily = log.groupBy(natural, day).agg(F.max(F.struct(*attrs)).alias("_a"))
    w = Window.partitionBy(natural).orderBy(day)
    changed = ~F.col("_a").eqNullSafe(F.lag("_a").over(w)) | F.lag(day).over(w).isNull()
    starts = daily.withColumn("_new", changed).filter("_new")
    nxt = F.lead(day).over(w)
    return starts.select(
        surrogate(natural, day).alias("version_key"), natural, "_a.*", F.col(day).alias("valid_from"),
        F.date_sub(nxt, 1).alias("valid_to"), nxt.isNull().alias("is_current"),
    )


def scd2_merge(history: DataFrame, snapshot: DataFrame, natural: str, attrs: list[str], effective: str) -> DataFrame:
    """Fold a new snapshot into a history: changed ids get their open version closed and a new one opened."""
    day = F.lit(effective).cast("date")
    now = snapshot.select(natural, F.struct(*attrs).alias("_new"))
    current = history.filter("is_current").select(natural, F.struct(*attrs).alias("_old"))
    diff = now.join(current, natural, "left").filter(~F.col("_new").eqNullSafe(F.col("_old")))
    closing = diff.select(natural, F.lit(True).alias("_close"))
    kept = history.join(closing, natural, "left")
    close = F.coalesce("_close", F.lit(False)) & F.col("is_current")
    kept = kept.withColumns(
        {
            "valid_to": F.when(close, F.date_sub(day, 1)).otherwise(F.col("valid_to")),
            "is_current": F.col("is_current") & ~close,
        }
    ).drop("_close")
    opened = diff.select(
        surrogate(F.col(natural), day.cast("string")).alias("version_key"), natural, "_new.*", day.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"),
    )
    return kept.select(*opened.columns).unionByName(opened)


def version_at(facts: DataFrame, history: DataFrame, natural: str, day: str) -> DataFrame:
    """Facts with the version valid on their date."""
    h = history.withColumnRenamed(natural, "_id")
    on = (F.col(natural) == F.col("_id")) & (F.col(day) >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col(day) <= F.col("valid_to"))
    )
    return facts.join(h, on, "left").drop("_id")


query("dim_customer")(lambda lake: lake.dims["customer"])
query("dim_driver")(lambda lake: lake.dims["driver"])
query("dim_vehicle")(lambda lake: lake.dims["vehicle"])
query("dim_warehouse")(lambda lake: lake.dims["warehouse"])
query("dim_location")(lambda lake: lake.dims["location"])
query("dim_date")(lambda lake: lake.dims["date"])
query("load_fact_orders")(lambda lake: lake.fact_orders)
query("load_fact_delivery")(lambda lake: lake.fact_delivery)
query("load_fact_gps")(lambda lake: lake.fact_gps)
query("load_fact_traffic")(lambda lake: lake.fact_traffic)
query("dim_scd2")(lambda lake: versions(lake.stg_orders, "driver_id", "order_date", ["region"]))

# fact orders ------------------------------------------------------------------------------------------

ORDERS = filled("order_id", "total_orders")
VALUE = total("order_value", "total_order_value")
DELAY = mean("delivery_delay_min", "avg_delay_min")
LATE = whole("is_delayed", "delayed_orders")


def joined(lake, fact: str, dim: str):
    """Inner star join; only the columns a report uses are read."""
    d = lake.dims[dim]
    key = f"{dim}_key"
    clash = {"driver_id", "vehicle_status", "created_at", "updated_at", "source_system", "vehicle_id", "latitude", "longitude"}
    keep = [c for c in d.columns if c not in clash or (c == "vehicle_id" and dim == "vehicle" and fact != "fact_gps")]
    return getattr(lake, fact).join(d.select(*keep), key)


query("fo_total")(lambda lake: lake.fact_orders.agg(rows("total_orders"), VALUE))
query("fo_month")(
    lambda lake: joined(lake, "fact_orders", "date")
    .groupBy("year_number", "month_number", "month_name")
    .agg(ORDERS, VALUE)
    .orderBy("year_number", "month_number")
)
query("fo_customer_type")(
    lambda lake: joined(lake, "fact_orders", "customer").groupBy("customer_type").agg(ORDERS, VALUE).orderBy(
        F.desc("total_order_value"), "customer_type"
    )
)
query("fo_warehouse")(
    lambda lake: joined(lake, "fact_orders", "warehouse").groupBy("warehouse_name", "region").agg(ORDERS, VALUE, DELAY).orderBy(
        F.desc("total_orders"), "warehouse_name"
    )
)
query("fo_driver")(
    lambda lake: joined(lake, "fact_orders", "driver").groupBy("driver_name", "region").agg(ORDERS, LATE, DELAY).orderBy(
        F.desc("delayed_orders"), "driver_name"
    )
)
query("fo_region")(
    lambda lake: joined(lake, "fact_orders", "location")
    .groupBy("region")
    .agg(ORDERS, VALUE, DELAY, ratio(F.sum("is_delayed"), F.count("order_id"), 2, 100).alias("delay_rate_pct"))
    .orderBy(F.desc("total_orders"), "region")
)

# fact delivery ----------------------------------------------------------------------------------------

DONE = filled("order_id", "total_deliveries")
ON_TIME = whole("on_time_flag", "on_time_deliveries")
ON_TIME_PCT = ratio(F.sum("on_time_flag"), F.count("order_id"), 2, 100)
LATE_D = whole("is_delayed", "delayed_deliveries")
TIME = mean("actual_delivery_time_min", "avg_delivery_time_min")
query("fd_overall")(
    lambda lake: lake.fact_delivery.agg(
        rows("total_deliveries"), ON_TIME, LATE_D, ON_TIME_PCT.alias("on_time_delivery_rate_pct"), TIME, DELAY
    )
)
query("fd_driver")(
    lambda lake: joined(lake, "fact_delivery", "driver")
    .groupBy("driver_name", "region")
    .agg(DONE, ON_TIME, LATE_D, ON_TIME_PCT.alias("on_time_rate_pct"), DELAY)
    .orderBy(F.desc("delayed_deliveries"), "driver_name")
)
query("fd_warehouse")(
    lambda lake: joined(lake, "fact_delivery", "warehouse")
    .groupBy("warehouse_name", "region")
    .agg(DONE, ON_TIME_PCT.alias("on_time_rate_pct"), DELAY)
    .orderBy("on_time_rate_pct", "warehouse_name")
)
query("fd_daily")(
    lambda lake: joined(lake, "fact_delivery", "date")
    .groupBy("full_date")
    .agg(DONE, ON_TIME_PCT.alias("on_time_rate_pct"), DELAY)
    .orderBy("full_date")
)
query("fd_distance_band")(
    lambda lake: lake.fact_delivery.groupBy(below("delivery_distance_km", KM_FACT_BANDS).alias("distance_band"))
    .agg(rows("deliveries"), TIME, DELAY)
    .orderBy(F.desc("deliveries"), "distance_band")
)


def severe_deliveries(fact, minutes: int = 60):
    return fact.filter(F.col("delivery_delay_min") >= minutes).select(
        "order_id", "delivery_delay_min", "delivery_distance_km", "delivery_status"
    ).orderBy(F.desc("delivery_delay_min"), "order_id")


query("fd_severe")(lambda lake: severe_deliveries(lake.fact_delivery))

# fact gps ---------------------------------------------------------------------------------------------

PINGS = filled("gps_key", "gps_events")
SPEED = mean("speed_kmph", "avg_speed_kmph")
WEAK_PCT = ratio(F.sum("is_low_signal"), F.count("gps_key"), 2, 100).alias("low_signal_rate_pct")


def _with_vehicles(facts, key, aggs, alias):
    m = facts.groupBy(key).agg(*aggs)
    return m.join(entities_per_key(facts, [key], "vehicle_id", alias), key)


query("fg_overall")(
    lambda lake: lake.fact_gps.groupBy("vehicle_id")
    .agg(rows("n"), F.sum("speed_kmph").alias("s"), F.count("speed_kmph").alias("c"), F.max("speed_kmph").alias("m"))
    .agg(
        F.sum("n").alias("gps_events"), F.count("vehicle_id").alias("tracked_vehicles"),
        ratio(F.sum("s").cast("double"), F.sum("c"), 2).alias("avg_speed_kmph"), largest("m", "max_speed_kmph"),
    )
)
query("fg_vehicle")(
    lambda lake: lake.fact_gps.join(lake.dims["vehicle"].select("vehicle_key", "vehicle_type"), "vehicle_key")
    .groupBy("vehicle_id", "vehicle_type")
    .agg(PINGS, SPEED, ratio(F.sum("is_moving"), F.count("gps_key"), 2, 100).alias("moving_rate_pct"), WEAK_PCT)
    .orderBy(F.desc("avg_speed_kmph"), "vehicle_id")
)
query("fg_region")(
    lambda lake: _with_vehicles(joined(lake, "fact_gps", "location"), "region", [PINGS, SPEED, WEAK_PCT], "tracked_vehicles").orderBy(
        F.desc("gps_events"), "region"
    )
)
query("fg_hourly")(
    lambda lake: _with_vehicles(
        lake.fact_gps.withColumn("event_hour", F.hour("event_timestamp")), "event_hour", [rows("gps_events"), SPEED], "active_vehicles"
    ).orderBy("event_hour")
)
query("fg_daily")(
    lambda lake: _with_vehicles(joined(lake, "fact_gps", "date"), "full_date", [PINGS, SPEED], "tracked_vehicles").orderBy("full_date")
)
query("fg_low_signal")(
    lambda lake: lake.fact_gps.groupBy("vehicle_id")
    .agg(rows("gps_events"), whole("is_low_signal", "low_signal_events"), WEAK_PCT)
    .filter("low_signal_events > 0")
    .orderBy(F.desc("low_signal_rate_pct"), "vehicle_id")
)

# fact traffic -----------------------------------------------------------------------------------------

READINGS = filled("traffic_key", "traffic_events")
SCORE = mean("traffic_score", "avg_traffic_score")
FLOW = mean("average_speed_kmph", "avg_speed_kmph")
query("ft_overall")(
    lambda lake: lake.fact_traffic.agg(
        rows("traffic_events"), SCORE, largest("traffic_score", "max_traffic_score"), mean("average_speed_kmph", "avg_traffic_speed_kmph")
    )
)
query("ft_location")(
    lambda lake: joined(lake, "fact_traffic", "location").groupBy("location_name", "region").agg(READINGS, SCORE, FLOW).orderBy(
        F.desc("avg_traffic_score"), "location_name"
    )
)
JAMMED = F.col("traffic_level").isin(*JAM_LEVELS)
query("ft_congestion")(
    lambda lake: joined(lake, "fact_traffic", "location")
    .groupBy("location_name", "region")
    .agg(
        rows("traffic_events"), rows_if(JAMMED, "congested_events"),
        ratio(F.count_if(JAMMED), F.count(F.lit(1)), 2, 100).alias("congestion_rate_pct"),
    )
    .orderBy(F.desc("congestion_rate_pct"), "location_name")
)
query("ft_hourly")(
    lambda lake: lake.fact_traffic.groupBy(F.hour("event_timestamp").alias("event_hour")).agg(rows("traffic_events"), SCORE, FLOW).orderBy(
        "event_hour"
    )
)
query("ft_daily")(
    lambda lake: joined(lake, "fact_traffic", "date").groupBy("full_date").agg(READINGS, SCORE, FLOW).orderBy("full_date")
)
query("ft_severe")(
    lambda lake: joined(lake, "fact_traffic", "location")
    .filter("traffic_level = 'SEVERE'")
    .select("location_name", "region", "event_timestamp", "traffic_score", "traffic_level", "average_speed_kmph")
    .orderBy(F.desc("traffic_score"), F.desc("event_timestamp"), "location_name")
)


@query("ft_delivery_window")
def delivery_window(lake):
    """Traffic readings at the delivery's location between its start and its end."""
    d = lake.fact_delivery.select("order_id", "delivery_delay_min", "location_key").join(lake.delivery_windows, "order_id")
    t = lake.fact_traffic.select("location_key", "event_timestamp", "traffic_score", "traffic_level")
    hits = points_in_intervals(d, t, ["location_key"], "start_time", "end_time", "event_timestamp")
    return hits.select("order_id", "delivery_delay_min", "traffic_score", "traffic_level", "event_timestamp")


# calendar and dimension reports -----------------------------------------------------------------------

query("dd_month")(
    lambda lake: joined(lake, "fact_orders", "date").groupBy("year_number", "month_number", "month_name").agg(ORDERS).orderBy(
        "year_number", "month_number"
    )
)
query("dd_dow")(
    lambda lake: joined(lake, "fact_delivery", "date").groupBy("day_of_week", "day_name").agg(ORDERS, DELAY).orderBy("day_of_week")
)
query("dd_weekend")(lambda lake: joined(lake, "fact_delivery", "date").groupBy("is_weekend").agg(ORDERS, DELAY))
query("dd_quarter")(
    lambda lake: joined(lake, "fact_orders", "date").groupBy("year_number", "quarter_number").agg(VALUE).orderBy(
        "year_number", "quarter_number"
    )
)


def _count_by(dim: str, key, alias: str, *more):
    return lambda lake: lake.dims[dim].groupBy(key).agg(rows(alias), *more).orderBy(F.desc(alias), key)


query("dv_region")(_count_by("driver", "region", "driver_count"))
query("dv_rating")(
    lambda lake: lake.dims["driver"].groupBy("region").agg(mean("rating", "avg_rating")).orderBy(F.desc("avg_rating"), "region")
)
query("dv_experience_band")(
    lambda lake: lake.dims["driver"].groupBy(below("experience_years", EXPERIENCE_BANDS).alias("experience_band")).agg(
        rows("driver_count")
    ).orderBy(F.desc("driver_count"))
)
query("dveh_type")(_count_by("vehicle", "vehicle_type", "vehicle_count"))
query("dveh_fuel")(_count_by("vehicle", "fuel_type", "vehicle_count"))
query("dveh_maintenance")(_count_by("vehicle", "maintenance_status", "vehicle_count"))


def fleet_age(vehicles: DataFrame, year: int):
    return vehicles.groupBy("vehicle_type").agg(
        mean(F.lit(year) - F.col("manufacture_year"), "avg_vehicle_age_years")
    ).orderBy(F.desc("avg_vehicle_age_years"), "vehicle_type")


query("dveh_age")(lambda lake: fleet_age(lake.dims["vehicle"], 2026))
query("dveh_capacity")(
    lambda lake: lake.dims["vehicle"].groupBy("vehicle_type")
    .agg(rows("vehicle_count"), total("capacity_kg", "total_capacity_kg"), mean("capacity_kg", "avg_capacity_kg"))
    .orderBy(F.desc("total_capacity_kg"), "vehicle_type")
)
query("dc_region")(_count_by("customer", "region", "customer_count"))
query("dc_type")(_count_by("customer", "customer_type", "customer_count"))
query("dw_region")(_count_by("warehouse", "region", "warehouse_count"))
query("dw_capacity")(
    lambda lake: lake.dims["warehouse"].groupBy("region")
    .agg(rows("warehouse_count"), total("capacity_units", "total_capacity_units"), mean("capacity_units", "avg_capacity_units"))
    .orderBy(F.desc("total_capacity_units"), "region")
)
query("dw_largest")(
    lambda lake: lake.dims["warehouse"].select("warehouse_id", "warehouse_name", "region", "capacity_units").orderBy(
        F.desc("capacity_units"), "warehouse_id"
    )
)
query("dw_geo")(
    lambda lake: lake.dims["warehouse"].select("warehouse_id", "warehouse_name", "region", "latitude", "longitude").orderBy(
        "region", "warehouse_name"
    )
)
query("dl_region")(_count_by("location", "region", "location_count"))
query("dl_list")(
    lambda lake: lake.dims["location"].select(
        "location_key", "location_name", "region", "latitude", "longitude", "location_type"
    ).orderBy("region", "location_name")
)
query("dl_with_coords")(
    lambda lake: lake.dims["location"].filter("latitude IS NOT NULL AND longitude IS NOT NULL").select(
        "location_name", "region", "latitude", "longitude"
    )
)
