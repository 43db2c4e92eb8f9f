"""The batch jobs over a folder of raw files, end to end."""

import pytest

from freightlens.session import run_dir


MONTH = "order_date BETWEEN date '1995-03-01' AND date '1995-03-31'"


@pytest.fixture(scope="module")
def raw(spark, lake):
    """The tables as files; orders of one month only, to keep the number of day partitions small."""
    base = run_dir(spark, "raw")
    for name, df in lake.raw_tables().items():
        if name == "orders":
            df.filter(MONTH).write.option("header", True).csv(f"{base}/orders.csv")
        elif name != "roads":  # one dataset is absent
            df.write.parquet(f"{base}/{name}")
    return base


def test_daily_and_kpi_jobs(spark, lake, raw):
    from freightlens import jobs

    out = run_dir(spark, "out")
    jobs.daily(spark, raw, out)
    mart = spark.read.parquet(f"{out}/marts/delivery_mart")
    assert mart.count() == lake.orders.filter(MONTH).count() > 0
    same = ["order_id", "delay_category", "rainfall_mm", "delivery_risk_category"]
    assert mart.select(*same).exceptAll(lake.delivery_mart.filter(MONTH).select(*same)).count() == 0
    assert spark.read.parquet(f"{out}/marts/executive_mart").count() == 1
    jobs.kpis(spark, raw, out)
    drivers = spark.read.option("header", True).csv(f"{out}/kpis/driver_metrics")
    assert drivers.count() == lake.drivers.count()
    assert spark.read.option("header", True).csv(f"{out}/kpis/road_metrics").count() == 0
    from freightlens.sources.sinks import read_lake

    before = read_lake(spark, f"{out}/processed/gps_clean")
    jobs.daily(spark, raw, out)  # a second run publishes a new version; readers of the first are not disturbed
    assert before.count() == read_lake(spark, f"{out}/processed/gps_clean").count() == lake.gps_tracking.count()


def test_folder_tables_read_contracts(spark, lake, raw):
    from freightlens.plans.lake import Lake
    from freightlens.sources.folder import FolderTables

    mine = Lake(spark, FolderTables(spark, raw))
    assert mine.orders.schema.simpleString() == lake.orders.schema.simpleString()
    assert mine.orders.exceptAll(lake.orders.filter(MONTH)).count() == 0
    assert mine.delivery_windows.filter("start_time > end_time").count() == 0
    with pytest.raises(AttributeError):
        mine.raw.shipments


def test_star_ingestion_and_analytics_jobs(spark, lake, raw, monkeypatch):
    from freightlens import jobs, registry
    from freightlens.sources.versions import current_version

    out = run_dir(spark, "out")
    jobs.star(spark, raw, out)
    star = current_version(spark, f"{out}/warehouse")
    assert spark.read.parquet(f"{star}/fact_orders").count() == lake.orders.filter(MONTH).count()
    assert spark.read.parquet(f"{star}/dim_driver").count() == lake.drivers.count()
    jobs.ingest(spark, raw, out)
    taken = current_version(spark, f"{out}/ingested")
    assert {r.dataset: r.kept_rows for r in spark.read.parquet(f"{taken}/report").collect()} == {
        n: spark.read.parquet(f"{taken}/{n}").count() for n in ("orders", "customers", "warehouses")}
    some = [n for n in registry.names() if n in ("eda_orders_region", "ra_gps_region", "feat_driver", "fc_daily_demand", "dp_target")]
    monkeypatch.setattr(registry, "names", lambda: some)
    jobs.analytics(spark, raw, out)
    days = [r.order_date for r in lake.orders.filter(MONTH).select("order_date").distinct().collect()]
    assert spark.read.parquet(f"{current_version(spark, f'{out}/analytics/fc')}/fc_daily_demand").count() == (max(days) - min(days)).days + 1
