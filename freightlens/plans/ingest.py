"""Ingestion: validation of landed text tables, and the source and sink operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_even, rows
from freightlens.operators.dedup import first_per_key
from freightlens.plans import kpi_jobs
from freightlens.registry import query
from freightlens.session import run_dir
from freightlens.sources import payloads, readers, sinks
from freightlens.sources.schemas import RAW, require_columns

ORDER_NUMBERS = ("order_value", "delivery_distance_km", "promised_delivery_time_min", "actual_delivery_time_min")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def _trimmed(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c).cast("string")) for c in columns})


def _valid_orders(df: DataFrame) -> DataFrame:
    """Distinct, trimmed and typed orders, before rows are dropped."""
    df = require_columns(lower_names(df), RAW["orders"].names, "orders").distinct()
    text = [f.name for f in RAW["orders"].fields if f.dataType.simpleString() == "string"]
    return _trimmed(df, text).withColumns(
        {"order_date": F.col("order_date").try_cast("date"), **{c: F.col(c).try_cast("double") for c in ORDER_NUMBERS}}
    )


def _valid_customers(df: DataFrame) -> DataFrame:
    df = require_columns(lower_names(df), RAW["customers"].names, "customers").distinct()
    return _trimmed(df, ("customer_id", "customer_name", "region", "customer_type")).withColumns(
        {
            "region": F.initcap("region"), "customer_type": F.initcap("customer_type"),
            "registration_date": F.col("registration_date").try_cast("date"),
        }
    )


def _valid_warehouses(df: DataFrame) -> DataFrame:
    df = require_columns(lower_names(df), RAW["warehouses"].names, "warehouses").distinct()
    lat, lon, cap = (F.col(c).try_cast("double") for c in ("latitude", "longitude", "capacity_units"))
    return _trimmed(df, ("warehouse_id", "warehouse_name", "region")).withColumns(
        {
            "region": F.initcap("region"), "latitude": F.when(lat.between(-90, 90), lat),
            "longitude": F.when(lon.between(-180, 180), lon), "capacity_units": F.when(cap >= 0, cap),
        }
    )


STEPS = {
    "orders": (_valid_orders, ["order_id", "order_date"], "order_id"),
    "customers": (_valid_customers, ["customer_id"], "customer_id"),
    "warehouses": (_valid_warehouses, RAW["warehouses"].names, "warehouse_id"),
}


def validate(df: DataFrame, dataset: str) -> DataFrame:
    """Cleaned rows of a dataset, one per id (the smallest row of an id, which does not depend on file order)."""
    prepare, needed, key = STEPS[dataset]
    kept = prepare(df).dropna(subset=needed)
    once = first_per_key(kept, [key], [F.col(c).asc_nulls_last() for c in kept.columns if c != key])
    if dataset == "warehouses":
        once = once.withColumns(
            {
                "capacity_units": F.bround("capacity_units", 0).cast("long"), "latitude": half_even("latitude", 6),
                "longitude": half_even("longitude", 6),
            }
        )
    return once


def require_rows(df: DataFrame, dataset: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no valid {dataset} remain after validation")
    return df


def report(df: DataFrame, dataset: str) -> DataFrame:
    """Rows read, repeated, dropped for missing values, dropped as repeated ids, and kept; from one pass
    per (id, row) group."""
    prepare, needed, key = STEPS[dataset]
    complete = F.lit(True)
    for c in needed:
        complete = complete & F.col(c).isNotNull()
    seen = prepare(df).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count_if(complete).alias("_ok"))
    read = df.agg(F.count(F.lit(1))).scalar()
    return seen.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_d"), F.coalesce(F.sum("_ok"), F.lit(0)).alias("_o"), F.count_if(F.col("_ok") > 0).alias("kept_rows")).select(
        F.lit(dataset).alias("dataset"), read.alias("source_rows"), (read - F.col("_d")).alias("repeated_rows"),
        (F.col("_d") - F.col("_o")).alias("dropped_missing"), (F.col("_o") - F.col("kept_rows")).alias("dropped_duplicate_ids"), "kept_rows",
    )


def as_text(df: DataFrame) -> DataFrame:
    """A table as it lands: all columns text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


query("ingest_orders")(lambda lake: validate(as_text(lake.orders), "orders"))
query("ingest_customers")(lambda lake: validate(as_text(lake.customers), "customers"))
query("ingest_warehouses")(lambda lake: validate(as_text(lake.warehouses), "warehouses"))
query("ingest_report")(
    lambda lake: reduce(DataFrame.unionByName, [report(as_text(getattr(lake, d)), d) for d in ("orders", "customers", "warehouses")])
)


# sources and sinks ------------------------------------------------------------------------------------


@query("src_csv_contract")
def csv_contract(lake):
    """The orders table landed as headered CSV and read back under its contract."""
    path = run_dir(lake.spark, "csv") + "/orders.csv"
    lake.orders.write.option("header", True).csv(path)
    return readers.read_csv(lake.spark, path, RAW["orders"], "orders")


@query("src_processed_or_raw")
def processed_or_raw(lake):
    """Cleaned orders from the processed layer, which is preferred to the raw one."""
    base = run_dir(lake.spark, "layers")
    lake.orders_clean.write.parquet(f"{base}/processed/orders_clean")
    return readers.first_available(lake.spark, [f"{base}/processed/orders_clean", f"{base}/raw/orders.csv"], required=True)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(rows("row_count")).select(F.lit(n).alias("dataset"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@query("src_all_datasets")
def all_datasets(lake):
    """Row counts of every table found in the source folder; 'shipments' is absent and skipped."""
    wanted = ["orders", "customer", "part", "supplier", "lineitem", "events", "nation", "region", "shipments"]
    return row_counts(readers.read_all(lake.spark, lake.raw.folder, wanted))


@query("sink_single_csv")
def single_csv(lake):
    path = run_dir(lake.spark, "report")
    out = kpi_jobs.by_region(kpi_jobs.prepare_deliveries(lake.features))
    sinks.write_single_csv(out, path)
    return readers.read_csv(lake.spark, path, out.schema, "delivery metrics")


@query("sink_partitioned_lake")
def partitioned_lake(lake):
    path = run_dir(lake.spark, "lake") + "/gps"
    back = sinks.write_lake(lake.gps_clean.withColumn("event_date", F.col("date")), path, ["event_date", "region"])
    return back.groupBy("event_date", "region").agg(rows("gps_events"), F.max("speed_kmph").alias("max_speed_kmph"))


@query("tbl_hive_register")
def register(lake):
    """The eight lake tables in the catalogue, counted through their table names."""
    names = ("orders", "customers", "drivers", "vehicles", "warehouses", "gps_tracking", "weather", "traffic")
    made = sinks.register_tables(
        lake.spark, "freight_lake", {n: getattr(lake, n) for n in names}, run_dir(lake.spark, "tables")
    )
    return row_counts({n.split(".")[1]: lake.spark.table(n) for n in made})


@query("mat_view_table")
def layers(lake):
    views = {n: getattr(lake, n) for n in ("stg_orders", "stg_gps", "stg_weather", "stg_traffic", "int_delivery", "int_routes")}
    tables = {n: getattr(lake, n) for n in ("delivery_mart", "logistics_mart", "warehouse_mart")}
    made = sinks.materialize(views, tables, run_dir(lake.spark, "marts"))
    return row_counts({n: made[n] for n in tables})


# landed API responses ---------------------------------------------------------------------------------


@query("norm_weather_payload")
def weather_payload(lake):
    """Weather rows written as provider responses (no rain object on dry days) and normalized again."""
    body = F.struct(
        F.col("location").alias("name"), F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("coord"),
        F.struct(F.col("temperature_c").alias("temp"), F.col("humidity_pct").alias("humidity")).alias("main"),
        F.when(F.col("rainfall_mm") > 0, F.struct(F.col("rainfall_mm").alias("1h"))).alias("rain"),
        F.array(F.struct(F.lower("weather_condition").alias("description"))).alias("weather"),
    )
    return payloads.weather_rows(lake.weather.select(F.to_json(body).alias("payload"), F.col("date").alias("fetched_at")))


@query("norm_traffic_payload")
def traffic_payload(lake):
    """Traffic rows as provider responses; the free-flow speed varies by hour and is 0 at midnight."""
    free = F.hour("timestamp") * 10 % 110
    body = F.struct(F.struct(F.col("average_speed_kmph").alias("currentSpeed"), free.alias("freeFlowSpeed")).alias("flowSegmentData"))
    landed = lake.traffic.select(
        F.to_json(body).alias("payload"), F.col("timestamp").alias("fetched_at"), "location", "latitude", "longitude"
    )
    return payloads.traffic_rows(landed)


@query("norm_route_payload")
def route_payload(lake):
    """Deliveries as routing responses; one in nineteen has no route and goes to the rejects."""
    n = F.substring("order_id", 2, 20).cast("long")
    leg = F.struct(
        F.struct(
            F.struct(
                (F.col("delivery_distance_km") * 1000).alias("distance"), (F.col("actual_delivery_time_min") * 60).alias("duration")
            ).alias("summary")
        ).alias("properties")
    )
    legs = F.when(n % 19 == 0, F.slice(F.array(leg), 1, 0)).otherwise(F.array(leg))
    landed = lake.orders.select(
        F.to_json(F.struct(legs.alias("features"))).alias("payload"), F.col("order_date").alias("fetched_at"),
        *[(n % m).cast("double").alias(c) for c, m in (("start_longitude", 97), ("start_latitude", 83), ("end_longitude", 89), ("end_latitude", 79))],
    )
    routes, rejects = payloads.route_rows(landed)
    return routes.unionByName(rejects, allowMissingColumns=True)
