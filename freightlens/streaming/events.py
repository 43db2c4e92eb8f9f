"""Transformations of the event streams; all work alike on a stream and on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_up
from freightlens.functions.rules import ACTIVE_STATUSES, KM_BUCKETS, below, flag, is_blank, low_signal, upper_text
from freightlens.plans.cleaning import weather_columns, weather_flags
from freightlens.sources.schemas import GPS_EVENT, ORDER_EVENT, REQUIRED_EVENT_FIELDS, TRAFFIC_EVENT, UPDATE_EVENT, WEATHER_EVENT


def parse(events: DataFrame, schema) -> DataFrame:
    """key, value, timestamp -> kafka_key, kafka_timestamp and the JSON fields (NULL when malformed)."""
    return events.select(
        F.col("key").alias("kafka_key"), F.col("timestamp").alias("kafka_timestamp"), F.from_json("value", schema).alias("_d")
    ).select("kafka_key", "kafka_timestamp", "_d.*")


def _upper(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: upper_text(c) for c in columns})


def _order_base(events: DataFrame) -> DataFrame:
    o = _upper(parse(events, ORDER_EVENT), "region", "order_status", "delivery_status")
    delay = F.col("actual_delivery_time_min") - F.col("promised_delivery_time_min")
    return o.withColumns(
        {"order_date": F.col("order_date").try_cast("date"), "delivery_delay_min": delay, "is_delayed": flag(delay > 0)}
    )


def orders(events: DataFrame) -> DataFrame:
    km, value = F.col("delivery_distance_km"), F.col("order_value")
    valid = ~is_blank("order_id") & F.col("customer_id").isNotNull() & F.col("warehouse_id").isNotNull() & (value >= 0) & (km >= 0)
    midnight = F.col("order_date").cast("timestamp")
    return _order_base(events).withColumns(
        {
            "delivery_per_km_value": F.when(km > 0, half_up(value / km, 2)),
            "distance_bucket": below(km, KM_BUCKETS),
            "is_valid_order": flag(valid),
            "processing_delay_sec": F.unix_timestamp("kafka_timestamp") - F.unix_timestamp(midnight),
        }
    )


def active_orders(events: DataFrame) -> DataFrame:
    return _order_base(events).withColumn("active_delivery", flag(F.col("delivery_status").isin(*ACTIVE_STATUSES)))


def gps(events: DataFrame) -> DataFrame:
    """Normalized GPS events with movement and signal flags."""
    g = _upper(parse(events, GPS_EVENT), "region", "vehicle_status", "ignition_status", "signal_quality")
    return g.withColumns({"is_moving": flag(F.col("speed_kmph") > 0), "is_low_signal": flag(low_signal())})


def gps_monitor(events: DataFrame) -> DataFrame:
    ok = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    return gps(events).withColumns(
        {
            "event_date": F.to_date("timestamp"), "event_hour": F.hour("timestamp"), "is_valid_coordinates": flag(ok),
            "processing_delay_sec": F.unix_timestamp("kafka_timestamp") - F.unix_timestamp("timestamp"),
        }
    )


def updates(events: DataFrame) -> DataFrame:
    return _upper(parse(events, UPDATE_EVENT), "region")


def traffic(events: DataFrame) -> DataFrame:
    return _upper(parse(events, TRAFFIC_EVENT), "location", "traffic_level")


def weather(events: DataFrame) -> DataFrame:
    return weather_flags(weather_columns(parse(events, WEATHER_EVENT)))


UNIFIED = {
    "event_ingest_time": "timestamp", "event_time": "timestamp", "event_source": "string", "order_id": "string",
    "customer_id": "string", "warehouse_id": "string", "driver_id": "string", "vehicle_id": "string", "region": "string",
    "status": "string", "delivery_delay_min": "double", "is_delayed": "int", "active_delivery": "int", "latitude": "double",
    "longitude": "double", "speed_kmph": "double", "signal_quality": "string", "is_moving": "int", "is_low_signal": "int",
}


def _as_unified(df: DataFrame, source: str, renamed: dict) -> DataFrame:
    """The common event model; fields a source lacks are typed NULLs."""
    given = {**{c: F.col(c) for c in df.columns if c in UNIFIED}, **renamed, "event_source": F.lit(source)}
    return df.select(*[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in UNIFIED.items()])


def unified(order_events: DataFrame, gps_events: DataFrame) -> DataFrame:
    """Union of active orders and GPS events; no join, so no state."""
    o = _as_unified(
        active_orders(order_events), "ORDER",
        {"event_ingest_time": F.col("kafka_timestamp"), "event_time": F.col("order_date"), "status": F.col("delivery_status")},
    )
    g = _as_unified(
        gps(gps_events), "GPS",
        {"event_ingest_time": F.col("kafka_timestamp"), "event_time": F.col("timestamp"), "status": F.col("vehicle_status")},
    )
    return o.unionByName(g).withColumn(
        "operational_risk", F.when(F.col("is_delayed") == 1, "HIGH").when(F.col("is_low_signal") == 1, "MEDIUM").otherwise("LOW")
    )


def split_valid(events: DataFrame, topic: str, schema) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected messages with the missing fields); a malformed message misses every field."""
    needed = REQUIRED_EVENT_FIELDS[topic]
    p = events.withColumn("_d", F.from_json("value", schema))
    missing = F.array_compact(
        F.array(*[F.when(is_blank(F.col(f"_d.{c}").cast("string")), c) for c in needed])
    )
    p = p.withColumn("_missing", missing)
    valid = p.filter(F.size("_missing") == 0).select("_d.*")
    rejected = p.filter(F.size("_missing") > 0).select("key", "value", "timestamp", F.concat_ws(", ", "_missing").alias("missing_fields"))
    return valid, rejected


# stateful ---------------------------------------------------------------------------------------------


def orders_with_gps(order_stream: DataFrame, gps_stream: DataFrame, reach: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """GPS events of the order's vehicle within reach after its start; both sides are watermarked, so
    state older than reach plus late is dropped."""
    o = order_stream.withWatermark("start_time", late).alias("o")
    g = gps_stream.withWatermark("timestamp", late).alias("g")
    on = F.expr(
        f"o.vehicle_id = g.vehicle_id AND g.timestamp >= o.start_time AND g.timestamp <= o.start_time + interval {reach}"
    )
    return o.join(g, on).select("o.order_id", "o.vehicle_id", "o.start_time", F.col("g.timestamp").alias("gps_time"), "g.speed_kmph")


def windowed_gps(gps_stream: DataFrame, length: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Observations and speed per region and event-time window; a window is emitted once the watermark passes it."""
    w = F.window("timestamp", length, slide) if slide else F.window("timestamp", length)
    speed = F.col("speed_kmph").cast("decimal(18,4)")
    return gps_stream.withWatermark("timestamp", late).groupBy(w.alias("w"), "region").agg(
        F.count(F.lit(1)).alias("gps_events"), F.sum(speed).alias("_s"), F.count_if(F.col("is_low_signal") == 1).alias("low_signal_events")
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "region", "gps_events",
        half_up(F.col("_s").cast("double") / F.col("gps_events"), 2).alias("avg_speed_kmph"), "low_signal_events",
    )


def vehicle_sessions(gps_stream: DataFrame, gap: str = "2 hours", late: str = "10 minutes") -> DataFrame:
    """Runs of observations of one vehicle without a pause longer than gap."""
    s = F.session_window("timestamp", gap)
    return gps_stream.withWatermark("timestamp", late).groupBy(s.alias("s"), "vehicle_id").agg(
        F.count(F.lit(1)).alias("gps_events")
    ).select("vehicle_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "gps_events")


def deduplicated(gps_stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """First occurrence per (vehicle, event time); keys are forgotten after the watermark delay."""
    return gps_stream.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["vehicle_id", "timestamp"])


#: What makes an update of an order the latest, and what is kept of it.
STATUS_ORDER, STATUS = ["event_timestamp", "event_id"], ["order_id", "event_timestamp", "event_id", "event_type", "delay_minutes"]


def traffic_windows(traffic_stream: DataFrame, length: str = "2 hours", slide: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Sum and number of the scores per location and window, once the watermark passes the window."""
    w = F.window("timestamp", length, slide)
    score = F.col("traffic_score").cast("decimal(18,4)")
    return traffic_stream.withWatermark("timestamp", late).groupBy(w.alias("w"), "location").agg(
        F.sum(score).alias("_s"), F.count(score).alias("_n")
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "location",
        half_up(F.try_divide(F.col("_s").cast("double"), F.col("_n")), 2).alias("avg_traffic_score"),
    )


TREND = "window_start timestamp, window_end timestamp, location string, avg_traffic_score double, trend string"


def trend_processor():
    """A stateful processor per location: closed windows wait in order for an event-time timer at their end; when it
    fires, a window is compared with the one before it and given out. The class is made here so that it travels with
    the query and workers need no package."""
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    class Trend(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.open = handle.getMapState("open", "end_ms long", "window_start timestamp, window_end timestamp, score double")
            self.last = handle.getValueState("last", "score double, known boolean")

        def handleInputRows(self, key, rows, timerValues):
            for r in rows:
                end = int(r.window_end.timestamp() * 1000)
                self.open.updateValue((end,), (r.window_start, r.window_end, r.avg_traffic_score))
                self.handle.registerTimer(end)
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            end = (expiredTimerInfo.getExpiryTimeInMs(),)
            if self.open.containsKey(end):
                start, stop, score = self.open.getValue(end)
                self.open.removeKey(end)
                before = self.last.get()[0] if self.last.exists() else None
                if before is None:
                    trend = "first"
                elif score is None or score == before:
                    trend = "unchanged"
                else:
                    trend = "worsening" if score > before else "improving"
                self.last.update((score, True))
                yield Row(window_start=start, window_end=stop, location=key[0], avg_traffic_score=score, trend=trend)

        def close(self) -> None:
            pass

    return Trend()


def traffic_trend(traffic_stream: DataFrame, length: str = "2 hours", slide: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Window means per location with the change to the window before, given out by the stream itself.

    Readings are summed per window first, so the processor gets one row per location and window however many readings a
    busy location has; its state is the windows between their end and the watermark, and one mean.
    """
    windows = traffic_windows(traffic_stream, length, slide, late)
    return windows.groupBy("location").transformWithState(
        statefulProcessor=trend_processor(), outputStructType=TREND, outputMode="Append", timeMode="EventTime"
    )
