"""The logistics tables as views over the TPC-H-like star and the event table (FIXTURES.md §3)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.session import shared_dir
from freightlens.sources.versions import derived_once, files_version

K37 = "mod(o_orderkey * 37, 211)"
K13 = "mod(o_orderkey * 13, 121)"
RAIN = "mod(h0 * 7919 + r_regionkey * 331, 1000)"
JAM = "mod(hn * 31 + r_regionkey * 17, 1010)"


# Column types of the source tables; stated so that no job has to read file footers first.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class StarTables:
    """Reads one scale folder; every method returns a lazy view.

    Views that join or aggregate whole tables (orders with the ids of their lines, weather, traffic, roads) are written
    once per version of the files to the shared folder, by the first query that needs them, and read from there.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @cached_property
    def _derived(self) -> str:
        paths = [f"{self.folder}/{name}.parquet" for name in COLUMNS]
        return f"{shared_dir(self.spark)}/bindings/{files_version(self.spark, paths)}"

    def _once(self, name: str, df: DataFrame) -> DataFrame:
        return derived_once(name, df, self._derived)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _places(self) -> DataFrame:
        """nation key -> region (one row per nation)."""
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "r_regionkey", "r_name"
        )

    def _customer_region(self) -> DataFrame:
        return self.table("customer").join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))

    def _dealt_regions(self, df: DataFrame, key: str) -> DataFrame:
        """Each row with the region that its key falls to when keys are dealt over all regions in turn."""
        regions = self.table("region").selectExpr("r_regionkey", "r_name", "row_number() OVER (ORDER BY r_regionkey) - 1 AS _turn")
        count = self.table("region").agg(F.count(F.lit(1))).scalar()
        return df.withColumn("_turn", F.pmod(F.col(key).cast("bigint"), count)).join(
            regions.withColumn("_turn", F.col("_turn").cast("bigint")), "_turn"
        ).drop("_turn")

    def _line_ids(self) -> DataFrame:
        """The part and supplier keys that stand for an order's driver, vehicle and warehouse; one row per order with lines."""
        return self.table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("_driver"), F.max("l_partkey").alias("_vehicle"), F.min("l_suppkey").alias("_warehouse")
        )

    def _placed_orders(self) -> DataFrame:
        placed = self.table("orders").join(
            self._customer_region().select("c_custkey", "r_regionkey", "r_name"), F.col("o_custkey") == F.col("c_custkey")
        )
        return placed.join(self._line_ids(), F.col("o_orderkey") == F.col("l_orderkey"), "left")

    def orders(self) -> DataFrame:
        return self._once("orders", self.order_columns(self._placed_orders()))

    @staticmethod
    def order_columns(o: DataFrame) -> DataFrame:
        """An order without lines names a driver, vehicle and warehouse by its own key, mostly ones that don't exist."""
        return o.selectExpr(
            "concat('O', o_orderkey) AS order_id",
            "concat('C', o_custkey) AS customer_id",
            "concat('W', coalesce(_warehouse, o_orderkey)) AS warehouse_id",
            "concat('D', coalesce(_driver, o_orderkey)) AS driver_id",
            "concat('V', coalesce(_vehicle, o_orderkey)) AS vehicle_id",
            "cast(o_orderdate AS date) AS order_date",
            "r_name AS region",
            "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Shipped' ELSE 'Processing' END AS order_status",
            f"""CASE WHEN mod(o_orderkey, 29) = 0 THEN 'Failed' WHEN mod(o_orderkey, 23) = 0 THEN 'In Transit'
                WHEN {K13} > 75 THEN 'Delayed' ELSE 'Delivered' END AS delivery_status""",
            "cast(o_totalprice AS decimal(18,2)) AS order_value",
            "cast(mod(o_orderkey * 37, 1000) * mod(o_orderkey * 37, 1000) / 12500.0 AS decimal(12,2)) AS delivery_distance_km",
            f"cast(30 + {K37} AS int) AS promised_delivery_time_min",
            f"cast(CASE WHEN 30 + {K37} + {K13} - 75 < 1 THEN 1 ELSE 30 + {K37} + {K13} - 75 END AS int) AS actual_delivery_time_min",
        )

    def weather(self) -> DataFrame:
        """Readings for the days and regions in which orders were placed."""
        return self._once("weather", self._weather())

    def _weather(self) -> DataFrame:
        days = self.table("orders").join(
            self._customer_region().select("c_custkey", "r_regionkey", "r_name"), F.col("o_custkey") == F.col("c_custkey")
        ).select(F.col("o_orderdate").cast("date").alias("dt"), "r_regionkey", "r_name").distinct()
        days = days.withColumn("h0", F.datediff("dt", F.lit("1995-01-01").cast("date")))
        return days.filter("mod(h0 + r_regionkey, 11) <> 0").selectExpr(
            "dt AS date",
            "r_name AS location",
            "cast(8 + r_regionkey * 1.1 AS decimal(10,6)) AS latitude",
            "cast(76 + r_regionkey * 0.9 AS decimal(10,6)) AS longitude",
            "cast(10 + mod(h0 * 17 + r_regionkey * 29, 250) / 10.0 AS decimal(8,2)) AS temperature_c",
            "cast(40 + mod(h0 * 37 + r_regionkey * 53, 600) / 10.0 AS decimal(8,2)) AS humidity_pct",
            f"cast(CASE WHEN {RAIN} < 750 THEN 0 ELSE ({RAIN} - 750) * 0.2 END AS decimal(10,2)) AS rainfall_mm",
            f"""CASE WHEN {RAIN} < 750 THEN CASE WHEN mod(h0, 3) = 0 THEN 'Cloudy' ELSE 'Clear' END
                WHEN {RAIN} >= 990 THEN 'Thunderstorm' WHEN {RAIN} >= 900 THEN 'Heavy Rain' ELSE 'Light Rain' END AS weather_condition""",
        )

    def gps_tracking(self) -> DataFrame:
        return self.gps_columns(self.table("events"))

    def gps_columns(self, events: DataFrame) -> DataFrame:
        return self._dealt_regions(events, "user_id").selectExpr(
            "concat('V', user_id) AS vehicle_id",
            "ts AS timestamp",
            "r_name AS region",
            "cast(8 + mod(event_id * 37, 5000) / 1000.0 AS decimal(10,6)) AS latitude",
            "cast(76 + mod(event_id * 41, 5000) / 1000.0 AS decimal(10,6)) AS longitude",
            "cast(CASE WHEN event_type = 'signup' THEN 0 WHEN value > 95 THEN 95 ELSE value END AS decimal(10,2)) AS speed_kmph",
            "cast(mod(event_id * 53, 36000) / 100.0 AS decimal(6,2)) AS heading",
            "CASE event_type WHEN 'signup' THEN 'Stopped' WHEN 'error' THEN 'Idle' ELSE 'Moving' END AS vehicle_status",
            "CASE WHEN event_type = 'signup' THEN 'Off' ELSE 'On' END AS ignition_status",
            "CASE WHEN event_type = 'error' THEN ' low ' WHEN event_type = 'view' THEN 'Fair' ELSE 'Good' END AS signal_quality",
        )

    def traffic(self) -> DataFrame:
        return self._once("traffic", self._traffic())

    def _traffic(self) -> DataFrame:
        hours = self._dealt_regions(self.table("events"), "user_id").select(
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hr"), "r_regionkey", "r_name"
        ).distinct()
        hours = hours.withColumn("hn", F.dayofmonth("hr") * 24 + F.hour("hr"))
        return hours.filter("mod(hn + r_regionkey, 5) <> 0").selectExpr(
            "hr AS timestamp",
            "r_name AS location",
            "cast(8 + r_regionkey * 1.1 AS decimal(10,6)) AS latitude",
            "cast(76 + r_regionkey * 0.9 AS decimal(10,6)) AS longitude",
            f"cast({JAM} / 10.0 AS decimal(8,2)) AS traffic_score",
            f"""CASE WHEN {JAM} >= 750 THEN 'Severe' WHEN {JAM} >= 500 THEN 'High'
                WHEN {JAM} >= 250 THEN 'Moderate' ELSE 'Low' END AS traffic_level""",
            f"cast(100 - {JAM} / 11.0 AS decimal(10,2)) AS average_speed_kmph",
        )

    def delivery_updates(self) -> DataFrame:
        ref = self.orders().select("order_id", "driver_id", "vehicle_id", "region", "delivery_status")
        events = self.table("lineitem").selectExpr(
            "concat('E', l_orderkey, '-', l_linenumber) AS event_id",
            "concat('O', l_orderkey) AS order_id",
            "CASE l_returnflag WHEN 'R' THEN 'Delivery Exception' WHEN 'A' THEN 'Delivered' ELSE 'Out for Delivery' END AS event_type",
            "l_shipdate AS event_timestamp",
            "cast(l_quantity AS int) AS delay_minutes",
        )
        return events.join(ref, "order_id", "left").select(
            "event_id", "order_id", "driver_id", "vehicle_id", "event_timestamp", "region", "event_type",
            "delivery_status", "delay_minutes", F.lit("simulated").alias("source"),
        )

    def delivery_windows(self) -> DataFrame:
        """Start and end of each delivery, placed in the month the traffic table covers."""
        start = (
            "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, "
            "mod(cast(substr(order_id, 2) AS bigint) * 7919, 2592000))"
        )
        return (
            self.orders()
            .selectExpr("order_id", "actual_delivery_time_min", f"{start} AS start_time")
            .selectExpr("order_id", "start_time", "start_time + make_dt_interval(0, 0, actual_delivery_time_min, 0) AS end_time")
        )

    def customers(self) -> DataFrame:
        return self._customer_region().selectExpr(
            "concat('C', c_custkey) AS customer_id", "c_name AS customer_name", "r_name AS region",
            "c_mktsegment AS customer_type",
            "date_add(date '1994-01-01', cast(mod(c_custkey, 1000) AS int)) AS registration_date",
        )

    def drivers(self) -> DataFrame:
        return self._dealt_regions(self.table("part"), "p_partkey").selectExpr(
            "concat('D', p_partkey) AS driver_id", "p_name AS driver_name", "r_name AS region",
            "cast(p_size AS int) AS experience_years",
            "cast(2.5 + mod(p_partkey * 17, 251) / 100.0 AS decimal(4,2)) AS rating",
            "CASE WHEN mod(p_partkey, 17) = 0 THEN 'Inactive' ELSE 'Active' END AS employment_status",
            "CASE mod(p_partkey, 3) WHEN 0 THEN 'LMV' WHEN 1 THEN 'HMV' ELSE 'Commercial' END AS license_type",
        )

    def vehicles(self) -> DataFrame:
        return self.table("part").selectExpr(
            "concat('V', p_partkey) AS vehicle_id",
            "CASE mod(p_partkey, 4) WHEN 0 THEN 'Van' WHEN 1 THEN 'Truck' WHEN 2 THEN 'Mini Truck' ELSE 'Bike' END AS vehicle_type",
            "concat('D', p_partkey) AS driver_id",
            "CASE mod(p_partkey, 3) WHEN 0 THEN 'Diesel' WHEN 1 THEN 'Petrol' ELSE 'Electric' END AS fuel_type",
            "cast(p_retailprice AS decimal(12,2)) AS capacity_kg",
            "cast(2016 + mod(p_partkey, 10) AS int) AS manufacture_year",
            "CASE WHEN mod(p_partkey, 7) = 0 THEN 'Due' ELSE 'Good' END AS maintenance_status",
            "CASE WHEN mod(p_partkey, 9) = 0 THEN 'Idle' ELSE 'Active' END AS vehicle_status",
            "cast(5000 + p_partkey * 131 AS decimal(14,2)) AS odometer_km",
        )

    def warehouses(self) -> DataFrame:
        return self.table("supplier").join(self._places(), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "concat('W', s_suppkey) AS warehouse_id", "s_name AS warehouse_name", "r_name AS region",
            "cast(50 + mod(s_suppkey, 1000) * 45 AS int) AS capacity_units",
            "cast(8 + mod(s_suppkey, 100) * 0.37 AS decimal(10,6)) AS latitude",
            "cast(76 + mod(s_suppkey, 100) * 0.41 AS decimal(10,6)) AS longitude",
        )

    def roads(self) -> DataFrame:
        """One road between the nations of a supplier and a customer who trade with each other."""
        return self._once("roads", self._roads())

    def _roads(self) -> DataFrame:
        nations = self.table("nation")
        sold = (
            self.table("lineitem").select("l_orderkey", "l_suppkey").distinct()
            .join(self.table("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.table("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        )
        pairs = sold.filter("s_nationkey <> c_nationkey").selectExpr(
            "least(s_nationkey, c_nationkey) AS ak", "greatest(s_nationkey, c_nationkey) AS bk"
        ).distinct()
        pairs = pairs.join(nations.selectExpr("n_nationkey AS ak", "n_name AS start_location"), "ak").join(
            nations.selectExpr("n_nationkey AS bk", "n_name AS end_location"), "bk"
        )
        return pairs.selectExpr(
            "concat('R', ak, '-', bk) AS road_id", "start_location", "end_location",
            "CASE mod(ak + bk, 4) WHEN 0 THEN 'Highway' WHEN 1 THEN 'Urban' WHEN 2 THEN 'Rural' ELSE 'Expressway' END AS road_type",
            "cast(5 + mod(ak * 31 + bk * 17, 400) * 0.5 AS decimal(10,2)) AS distance_km",
            "cast(2 + mod(ak * bk, 4) AS int) AS lanes",
            "cast(40 + 10 * mod(ak + 2 * bk, 7) AS int) AS speed_limit_kmph",
            "CASE mod(ak * 3 + bk, 10) WHEN 0 THEN 'Poor' WHEN 1 THEN 'Critical' WHEN 2 THEN 'Fair' ELSE 'Good' END AS road_condition",
        )
