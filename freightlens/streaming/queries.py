"""The streaming operators run over the given tables: rows are published as events to a folder topic in the
shared folder, consumed as a stream until it is drained, and the written result is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.registry import query
from freightlens.session import run_dir
from freightlens.sources.schemas import GPS_EVENT, ORDER_EVENT
from freightlens.streaming import events as ev
from freightlens.streaming import sinks
from freightlens.streaming.sources import as_events, folder_topic, publish, publish_in_order

NUMBER = F.substring("order_id", 2, 20).cast("long")


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if k == "timestamp" else F.col(c) for c, k in df.dtypes])


class Topics:
    """Event folders of one run, filled on first use. Ingest times are derived from the rows, so reruns agree.

    Replays for windows are published in order of time in `slices` parts, read as that many micro-batches and followed by
    a closing message, so that every window is given out.
    """

    #: Past the last message by more than the longest window, session gap and watermark delay together.
    CLOSING = "interval 2 days"
    FILES = 4

    def __init__(self, lake, slices: int = 2):
        self.lake, self.spark, self.slices = lake, lake.spark, slices
        self.base = run_dir(lake.spark, "stream")

    def _topic(self, name: str, events: DataFrame) -> DataFrame:
        return folder_topic(self.spark, publish(events, f"{self.base}/topics/{name}"))

    def orders(self) -> DataFrame:
        # the day as a timestamp plus an offset of up to one day
        at = (F.unix_timestamp(F.col("order_date").cast("timestamp")) + NUMBER % 86400).cast("timestamp")
        return self._topic("orders", as_events(self.lake.orders, "order_id", at))

    def gps(self, copies: int = 1) -> DataFrame:
        lag = F.substring("vehicle_id", 2, 20).cast("int") % 30
        e = as_events(self.lake.gps_tracking, "vehicle_id", F.col("timestamp").cast("timestamp") + F.make_dt_interval(secs=lag))
        if copies > 1:
            e = e.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_i")
        return self._topic("gps_tracking", e)

    def traffic(self) -> DataFrame:
        return self._topic("traffic_updates", as_events(self.lake.traffic, "location", F.col("timestamp")))

    def weather(self) -> DataFrame:
        return self._topic("weather_updates", as_events(self.lake.weather, "location", F.col("date")))

    def _ordered(self, name: str, rows: DataFrame, key: str, at: str = "timestamp") -> DataFrame:
        last = rows.agg((F.max(at) + F.expr(self.CLOSING)).alias(at))
        closing = as_events(last.withColumn(key, F.lit(None).cast("string")), key, F.col(at))
        path = f"{self.base}/topics/{name}-ordered"
        files = publish_in_order(as_events(rows, key, F.col(at)), path, closing, self.slices, self.FILES)
        return folder_topic(self.spark, path, files)

    def gps_in_order(self) -> DataFrame:
        return self._ordered("gps_tracking", self.lake.gps_tracking, "vehicle_id")

    def updates_in_order(self) -> DataFrame:
        path = f"{self.base}/topics/delivery_updates-ordered"
        files = publish_in_order(as_events(self.lake.delivery_updates, "order_id", F.col("event_timestamp")), path, None, self.slices, self.FILES)
        return folder_topic(self.spark, path, files)

    def traffic_in_order(self) -> DataFrame:
        return self._ordered("traffic_updates", self.lake.traffic, "location")

    def drain(self, stream: DataFrame, name: str, fmt: str = "parquet", settings: dict[str, str] | None = None) -> DataFrame:
        path = f"{self.base}/out/{name}"
        sinks.run_once(stream, path, f"{self.base}/checkpoints/{name}", fmt, settings)
        return plain_times(self.spark.read.schema(stream.schema).format(fmt).load(path))


def _run(name: str, topic: str, transform, **kw):
    def go(lake):
        t = Topics(lake)
        return t.drain(transform(getattr(t, topic)(**kw)), name)

    return go


query("st_gps")(_run("st_gps", "gps", ev.gps_monitor))
query("st_orders")(_run("st_orders", "orders", ev.orders))
query("st_parse_orders_active")(_run("st_parse_orders_active", "orders", ev.active_orders))
query("st_parse_gps")(_run("st_parse_gps", "gps", ev.gps))
query("st_weather_updates")(_run("st_weather_updates", "weather", ev.weather))
query("st_gps_windows")(_run("st_gps_windows", "gps_in_order", lambda s: ev.windowed_gps(ev.gps(s), "1 hour")))
query("st_gps_windows_sliding")(_run("st_gps_windows_sliding", "gps_in_order", lambda s: ev.windowed_gps(ev.gps(s), "2 hours", "1 hour")))
query("st_gps_sessions")(_run("st_gps_sessions", "gps_in_order", lambda s: ev.vehicle_sessions(ev.gps(s))))
query("st_dedup")(
    _run("st_dedup", "gps", lambda s: ev.deduplicated(ev.gps(s)).select("vehicle_id", "timestamp", "region", "speed_kmph"), copies=2)
)


@query("st_unified_events")
def unified(lake):
    t = Topics(lake)
    return t.drain(ev.unified(t.orders(), t.gps()), "st_unified_events")


@query("st_orders_gps_join")
def orders_gps(lake):
    """Orders placed at their delivery start, joined with the positions of their vehicle in the next 30 minutes."""
    t = Topics(lake)
    placed = lake.orders.select("order_id", "vehicle_id").join(lake.delivery_windows.select("order_id", "start_time"), "order_id")
    schema = "order_id string, vehicle_id string, start_time timestamp"
    stream = ev.parse(t._topic("dispatches", as_events(placed, "order_id", F.col("start_time"))), schema)
    return t.drain(ev.orders_with_gps(stream, ev.gps(t.gps())), "st_orders_gps_join", settings=sinks.INNER_JOIN)


@query("st_delivery_status")
def delivery_status(lake):
    t = Topics(lake)
    path = f"{t.base}/out/st_delivery_status"
    updates = ev.updates(t.updates_in_order()).select(*ev.STATUS)
    sinks.write_latest(updates, path, f"{t.base}/checkpoints/st_delivery_status", "order_id", ev.STATUS_ORDER, every=t.slices).awaitTermination()
    return plain_times(sinks.read_latest(lake.spark, path, "order_id", ev.STATUS_ORDER, updates.schema))


@query("st_traffic_trend")
def traffic_trend(lake):
    """Window means per location with the change to the window before (one row per location and window)."""
    t = Topics(lake)
    return t.drain(ev.traffic_trend(ev.traffic(t.traffic_in_order())), "st_traffic_trend")


@query("st_triggers")
def triggers(lake):
    """Two bounded runs on one checkpoint: the second finds nothing new, so the output stays as it was."""
    t = Topics(lake)
    stream = ev.gps(t.gps())
    first = t.drain(stream, "st_triggers").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    second = t.drain(stream, "st_triggers")
    return second.agg(F.lit(first).cast("long").alias("rows_after_first_run"), F.count(F.lit(1)).alias("rows_after_second_run"))


@query("src_kafka_json")
def topic_source(lake):
    """The topic reader's columns, drained from the replay folder that stands in for a broker."""
    t = Topics(lake)
    return t.drain(t.gps(), "src_kafka_json").groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"), F.min("timestamp").alias("first_ingest"), F.max("timestamp").alias("last_ingest")
    )


@query("sink_stream_json")
def stream_json(lake):
    t = Topics(lake)
    out = ev.orders(t.orders()).select("order_id", "region", "delivery_delay_min", "distance_bucket", "is_valid_order")
    return t.drain(out, "sink_stream_json", "json")


@query("pub_events_json")
def published(lake):
    """Published order messages; fields read back from the JSON text."""
    e = as_events(lake.orders, "order_id", F.lit("2024-01-01").cast("timestamp"))
    field = lambda c, kind: F.get_json_object("value", f"$.{c}").cast(kind).alias(c)
    return e.select("key", field("customer_id", "string"), field("order_date", "date"), field("order_value", "double"), field("actual_delivery_time_min", "int"))


@query("sub_validate_append")
def validated(lake):
    """Consumed messages split into valid rows and rejects; some messages are published without an id or malformed."""
    t = Topics(lake)
    damaged = lake.orders.withColumns(
        {
            "customer_id": F.when(NUMBER % 17 == 0, "").otherwise(F.col("customer_id")),
            "warehouse_id": F.when(NUMBER % 23 == 0, F.lit(None)).otherwise(F.col("warehouse_id")),
        }
    )
    e = as_events(damaged, "order_id", F.col("order_date"))
    bad = F.substring("key", 2, 20).cast("long") % 31 == 0
    stream = t._topic("orders", e.withColumn("value", F.when(bad, F.substring("value", 1, 20)).otherwise(F.col("value"))))
    valid, rejects = f"{t.base}/out/valid", f"{t.base}/out/rejects"
    sinks.write_split(
        stream, lambda b: ev.split_valid(b, "orders", ORDER_EVENT), valid, rejects, f"{t.base}/checkpoints/split"
    ).awaitTermination()
    read = lake.spark.read.parquet
    ok = read(valid).select("order_id", F.lit("valid").alias("outcome"), F.lit("").alias("missing_fields"))
    return ok.unionByName(read(rejects).select(F.col("key").alias("order_id"), F.lit("rejected").alias("outcome"), "missing_fields"))


@query("sub_validate_append_gps")
def validated_gps(lake):
    """The same for GPS messages, of which some lack coordinates."""
    t = Topics(lake)
    v = F.substring("vehicle_id", 2, 20).cast("int")
    damaged = lake.gps_tracking.withColumn("latitude", F.when(v % 13 == 0, F.lit(None)).otherwise(F.col("latitude")))
    stream = t._topic("gps_tracking", as_events(damaged, "vehicle_id", F.col("timestamp")))
    valid, rejects = f"{t.base}/out/valid", f"{t.base}/out/rejects"
    sinks.write_split(
        stream, lambda b: ev.split_valid(b, "gps_tracking", GPS_EVENT), valid, rejects, f"{t.base}/checkpoints/split"
    ).awaitTermination()
    read = lake.spark.read.parquet
    ok = read(valid).select("vehicle_id", F.lit("valid").alias("outcome"))
    return ok.unionByName(read(rejects).select(F.col("key").alias("vehicle_id"), F.lit("rejected").alias("outcome"))).groupBy(
        "vehicle_id", "outcome"
    ).agg(F.count(F.lit(1)).alias("messages"))
