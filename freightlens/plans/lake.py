"""The model graph: every table of the lake as a lazy DataFrame built from the ones before it."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from freightlens.plans import cleaning, marts, staging, star
from freightlens.sources.bindings import StarTables

RAW_TABLES = (
    "orders", "customers", "drivers", "vehicles", "warehouses", "gps_tracking", "weather", "traffic", "roads", "delivery_updates",
)


_LAKES: dict[tuple, Lake] = {}


class Lake:
    """Tables by name. raw is any object with one method per raw table."""

    def __init__(self, spark: SparkSession, raw, as_of: str | None = None):
        self.spark, self.raw, self.as_of = spark, raw, as_of

    @classmethod
    def over_star(cls, spark: SparkSession, folder: str) -> Lake:
        """The lake over one folder, shared by all queries of a session: only plans are kept, no rows."""
        key = (spark.sparkContext.applicationId, id(spark), folder)
        if key not in _LAKES:
            _LAKES.clear()
            _LAKES[key] = cls(spark, StarTables(spark, folder))
        return _LAKES[key]

    def raw_tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in RAW_TABLES}

    # raw
    orders = cached_property(lambda s: s.raw.orders())
    customers = cached_property(lambda s: s.raw.customers())
    drivers = cached_property(lambda s: s.raw.drivers())
    vehicles = cached_property(lambda s: s.raw.vehicles())
    warehouses = cached_property(lambda s: s.raw.warehouses())
    gps_tracking = cached_property(lambda s: s.raw.gps_tracking())
    weather = cached_property(lambda s: s.raw.weather())
    traffic = cached_property(lambda s: s.raw.traffic())
    roads = cached_property(lambda s: s.raw.roads())
    delivery_updates = cached_property(lambda s: s.raw.delivery_updates())
    delivery_windows = cached_property(lambda s: s.raw.delivery_windows())

    # cleaned
    orders_clean = cached_property(lambda s: cleaning.clean_orders(s.orders))
    gps_clean = cached_property(lambda s: cleaning.clean_gps(s.gps_tracking))
    weather_clean = cached_property(lambda s: cleaning.clean_weather(s.weather))
    weather_daily = cached_property(lambda s: cleaning.weather_daily(s.weather_clean))
    features = cached_property(lambda s: cleaning.delivery_features(s.orders_clean, s.weather_clean))

    # staging, intermediate, marts
    stg_orders = cached_property(lambda s: staging.stg_orders(s.orders))
    stg_gps = cached_property(lambda s: staging.stg_gps(s.gps_tracking))
    stg_weather = cached_property(lambda s: staging.stg_weather(s.weather))
    stg_traffic = cached_property(lambda s: staging.stg_traffic(s.traffic))
    delivery_weather = cached_property(lambda s: marts.delivery_asof_weather(s.stg_orders, s.stg_weather))
    int_delivery = cached_property(lambda s: marts.int_delivery(s.delivery_weather))
    delivery_mart = cached_property(lambda s: marts.delivery_mart(s.int_delivery))
    route_traffic = cached_property(lambda s: marts.routes_nearest_traffic(s.stg_gps, s.stg_traffic))
    int_routes = cached_property(lambda s: marts.int_routes(s.route_traffic))
    logistics_mart = cached_property(lambda s: marts.logistics_mart(s.int_routes))
    warehouse_mart = cached_property(lambda s: marts.warehouse_mart(s.stg_orders))
    executive_mart = cached_property(
        lambda s: marts.executive_mart(s.delivery_mart, s.logistics_mart, s.warehouse_mart, s.as_of)
    )

    # star schema
    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        days = self.orders.selectExpr("cast(order_date AS date) AS d").unionByName(
            self.gps_tracking.selectExpr("cast(timestamp AS date) AS d")
        )
        return {
            "customer": star.dim_customer(self.customers),
            "driver": star.dim_driver(self.drivers),
            "vehicle": star.dim_vehicle(self.vehicles),
            "warehouse": star.dim_warehouse(self.warehouses),
            "location": star.dim_location(self.orders, self.warehouses, self.weather, self.traffic, self.gps_tracking),
            "date": star.dim_date(days),
        }

    fact_orders = cached_property(lambda s: star.fact_orders(s.orders_clean, s.dims))
    fact_delivery = cached_property(lambda s: star.fact_delivery(s.orders_clean, s.dims))
    fact_gps = cached_property(lambda s: star.fact_gps(s.gps_clean, s.dims))
    fact_traffic = cached_property(lambda s: star.fact_traffic(s.traffic, s.dims))
