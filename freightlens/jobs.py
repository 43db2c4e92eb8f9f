"""Jobs for spark-submit: ingestion, the daily batch, KPI tables, star schema, analytics, and the streams.

    spark-submit -m freightlens.jobs ingest    --raw DIR --out DIR
    spark-submit -m freightlens.jobs daily     --raw DIR --out DIR
    spark-submit -m freightlens.jobs kpis      --raw DIR --out DIR
    spark-submit -m freightlens.jobs star      --raw DIR --out DIR
    spark-submit -m freightlens.jobs analytics --raw DIR --out DIR
    spark-submit -m freightlens.jobs publish   --raw DIR --brokers HOST:PORT
    spark-submit -m freightlens.jobs consume   --brokers HOST:PORT --out DIR [--once]
    spark-submit -m freightlens.jobs stream    --brokers HOST:PORT --out DIR [--once]
"""

from __future__ import annotations

import argparse
from functools import reduce

from freightlens.session import build_session


def daily(spark, raw: str, out: str) -> None:
    """Clean, gate, features, marts. Each later step reads what the step before has written; a failing gate publishes nothing."""
    from freightlens.plans import cleaning
    from freightlens.plans.lake import Lake
    from freightlens.sources.folder import FolderTables

    lake = Lake(spark, FolderTables(spark, raw))
    for name, by, gate in (
        ("orders_clean", ["order_date"], cleaning.gate_orders),
        ("gps_clean", ["date", "region"], cleaning.gate_gps),
        ("weather_clean", [], cleaning.gate_weather),
    ):
        publish_gated(spark, lake, name, by, gate, out)
    publish_gated(spark, lake, "delivery_features", ["order_date"], cleaning.gate_features, out, attribute="features")
    for name in ("delivery_mart", "logistics_mart", "warehouse_mart", "executive_mart"):
        path = f"{out}/marts/{name}"
        getattr(lake, name).write.mode("overwrite").parquet(path)
        setattr(lake, name, spark.read.parquet(path))


def publish_gated(spark, lake, name: str, by: list[str], gate, out: str, attribute: str | None = None) -> None:
    """Write to a staging folder, check what was written, and only then publish it as the table's next version.

    A version holds the whole table, so days that are gone from the input don't stay behind, and readers meanwhile see the
    version before it.
    """
    from freightlens.plans import cleaning
    from freightlens.sources.sinks import write_lake

    staged = f"{out}/staging/{name}"
    getattr(lake, attribute or name).write.mode("overwrite").parquet(staged)
    ready = spark.read.parquet(staged)
    cleaning.require_clean(gate(ready))
    setattr(lake, attribute or name, write_lake(ready, f"{out}/processed/{name}", by, whole=True))


def kpis(spark, raw: str, out: str) -> None:
    """The KPI tables, each as one report file; delivery features are read from the processed layer when present."""
    from freightlens.plans import kpi_jobs
    from freightlens.plans.lake import Lake
    from freightlens.sources.folder import FolderTables
    from freightlens.sources.sinks import read_lake, write_csv_by, write_single_csv

    lake = Lake(spark, FolderTables(spark, raw))
    done = read_lake(spark, f"{out}/processed/delivery_features")
    features = lake.features if done is None else done
    full = kpi_jobs.prepare_deliveries(features)
    by_driver = kpi_jobs.prepare_deliveries(features, ("order_id", "driver_id"))
    by_warehouse = kpi_jobs.prepare_deliveries(features, ("order_id", "warehouse_id"))
    by_order = kpi_jobs.prepare_deliveries(features, ("order_id",))
    for name, df in {
        "delivery_metrics": kpi_jobs.metrics_union(full),
        "driver_metrics": kpi_jobs.driver_metrics(by_driver, lake.drivers),
        "driver_region_metrics": kpi_jobs.driver_region_metrics(by_driver),
        "warehouse_metrics": kpi_jobs.warehouse_metrics(by_warehouse, lake.warehouses),
        "warehouse_region_metrics": kpi_jobs.warehouse_region_metrics(by_warehouse, lake.warehouses),
        "route_metrics": kpi_jobs.route_region_metrics(by_order, lake.gps_clean, lake.traffic),
        "traffic_metrics": kpi_jobs.traffic_location_metrics(lake.traffic),
        "road_metrics": kpi_jobs.road_type_metrics(lake.roads),
    }.items():
        if name in KEYED:
            write_csv_by(df, KEYED[name], f"{out}/kpis/{name}")
        else:
            write_single_csv(df, f"{out}/kpis/{name}")


#: Reports with a row per driver or warehouse grow with the input and are written by many tasks.
KEYED = {"driver_metrics": "driver_id", "warehouse_metrics": "warehouse_id"}


def star(spark, raw: str, out: str) -> None:
    """The star schema: dimensions and facts as one version, checked before it becomes current."""
    from freightlens.plans import quality
    from freightlens.plans.lake import Lake
    from freightlens.sources.folder import FolderTables
    from freightlens.sources.versions import publish_version

    lake = Lake(spark, FolderTables(spark, raw))
    quality.require_quality(quality.consistency(lake.fact_delivery))
    tables = {f"dim_{name}": df for name, df in lake.dims.items()}
    tables |= {f"fact_{name}": getattr(lake, f"fact_{name}") for name in ("orders", "delivery", "gps", "traffic")}
    publish_version(tables, f"{out}/warehouse", keep=2)


def analytics(spark, raw: str, out: str) -> None:
    """Exploration, features, route study, forecast and delay prediction, each report written as a table of its name."""
    from freightlens import registry
    from freightlens.plans.lake import Lake
    from freightlens.sources.folder import FolderTables
    from freightlens.sources.versions import publish_version

    lake = Lake(spark, FolderTables(spark, raw))
    for group in ("eda", "feat", "ra", "fc", "dp"):
        reports = {name: registry.resolve(name)(lake) for name in registry.names() if name.startswith(f"{group}_")}
        publish_version(reports, f"{out}/analytics/{group}", keep=2)


def ingest(spark, raw: str, out: str) -> None:
    """Landed orders, customers and warehouses: valid rows as tables, and the report of what was refused."""
    from freightlens.plans import ingest as intake
    from freightlens.plans.lake import Lake
    from freightlens.sources.folder import FolderTables
    from freightlens.sources.versions import publish_version

    lake = Lake(spark, FolderTables(spark, raw))
    landed = {name: intake.as_text(getattr(lake, name)) for name in intake.STEPS}
    tables = {name: intake.require_rows(intake.validate(df, name), name) for name, df in landed.items()}
    reports = [intake.report(df, name) for name, df in landed.items()]
    tables["report"] = reduce(lambda a, b: a.unionByName(b), reports)
    publish_version(tables, f"{out}/ingested", keep=2)


def consume(spark, brokers: str, out: str, once: bool) -> None:
    """Order and GPS messages to valid rows and rejects, and the latest status of each order."""
    from freightlens.sources.schemas import GPS_EVENT, ORDER_EVENT
    from freightlens.streaming import events, sinks
    from freightlens.streaming.sources import kafka_topic

    running = [
        sinks.write_split(
            kafka_topic(spark, brokers, topic), lambda b, t=topic, k=schema: events.split_valid(b, t, k),
            f"{out}/{topic}/valid", f"{out}/{topic}/rejected", f"{out}/checkpoints/consume-{topic}", once,
        )
        for topic, schema in (("orders", ORDER_EVENT), ("gps_tracking", GPS_EVENT))
    ]
    updates = events.updates(kafka_topic(spark, brokers, "delivery_updates")).select(*events.STATUS)
    running.append(sinks.write_latest(updates, f"{out}/delivery_status", f"{out}/checkpoints/delivery_status", "order_id", events.STATUS_ORDER, once=once))
    _until_stopped(spark, running)


def publish(spark, raw: str, brokers: str) -> None:
    """Send the rows of the raw tables to their topics."""
    from freightlens.plans.lake import Lake
    from freightlens.sources.folder import FolderTables
    from freightlens.streaming.sources import as_events, publish_kafka

    lake = Lake(spark, FolderTables(spark, raw))
    for topic, name, key in (
        ("orders", "orders", "order_id"), ("gps_tracking", "gps_tracking", "vehicle_id"), ("delivery_updates", "delivery_updates", "order_id"),
        ("traffic_updates", "traffic", "location"), ("weather_updates", "weather", "location"),
    ):
        publish_kafka(as_events(getattr(lake, name), key), brokers, topic)


def stream(spark, brokers: str, out: str, once: bool) -> None:
    """The GPS, order and unified event streams, until stopped or, with once, until the topics are drained."""
    from freightlens.streaming import events, sinks
    from freightlens.streaming.sources import kafka_topic

    orders = kafka_topic(spark, brokers, "orders")
    gps = kafka_topic(spark, brokers, "gps_tracking")
    running = [
        sinks.start(df, f"{out}/{name}", f"{out}/checkpoints/{name}", "json", once)
        for name, df in (
            ("gps_stream", events.gps_monitor(gps)), ("order_stream", events.orders(orders)),
            ("realtime_delivery", events.unified(orders, gps)),
        )
    ]
    _until_stopped(spark, running)


def _until_stopped(spark, running: list) -> None:
    try:
        while any(q.isActive for q in running):
            spark.streams.awaitAnyTermination()  # raises when a query fails
            spark.streams.resetTerminated()
    finally:
        for q in running:
            q.stop()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="job", required=True)
    batch = {"daily": daily, "kpis": kpis, "star": star, "analytics": analytics, "ingest": ingest}
    streams = {"stream": stream, "consume": consume}
    for name in batch:
        s = sub.add_parser(name)
        s.add_argument("--raw", required=True)
        s.add_argument("--out", required=True)
    s = sub.add_parser("publish")
    s.add_argument("--raw", required=True)
    s.add_argument("--brokers", required=True)
    for name in streams:
        s = sub.add_parser(name)
        s.add_argument("--brokers", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--once", action="store_true")
    a = p.parse_args(argv)
    spark = build_session(f"freightlens-{a.job}")
    if a.job in batch:
        batch[a.job](spark, a.raw, a.out)
    elif a.job == "publish":
        publish(spark, a.raw, a.brokers)
    else:
        streams[a.job](spark, a.brokers, a.out, a.once)


if __name__ == "__main__":
    main()
