"""Edge cases of cleaning, marts, ingestion, star schema and quality rules."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from freightlens.session import run_dir

ORDER = "order_id string, customer_id string, warehouse_id string, driver_id string, vehicle_id string, order_date string, region string, order_status string, delivery_status string, order_value string, delivery_distance_km string, promised_delivery_time_min string, actual_delivery_time_min string"


def orders(spark, *specs):
    base = dict(
        order_id="O1", customer_id="C1", warehouse_id="W1", driver_id="D1", vehicle_id="V1", order_date="2024-01-02", region="North",
        order_status="Completed", delivery_status="Delivered", order_value="100.00", delivery_distance_km="10",
        promised_delivery_time_min="30", actual_delivery_time_min="30",
    )
    return spark.createDataFrame([tuple({**base, **s}.values()) for s in specs], ORDER)


def test_clean_orders_edges(spark):
    from freightlens.plans.cleaning import clean_orders, gate_orders, require_clean

    df = orders(
        spark, dict(order_id=" O1 ", region=" north "), dict(order_id="O1", order_value="5"), dict(order_id="O2", actual_delivery_time_min=None),
        dict(order_id="O3", delivery_distance_km="0"), dict(order_id="O4", order_date="never", order_value="abc"),
        dict(order_id="O5", actual_delivery_time_min="31"), dict(order_id="", actual_delivery_time_min="-4"),
    )
    out = {r.order_id: r for r in clean_orders(df).collect()}
    assert len(out) == 6 and out["O1"].region == "NORTH" and out["O1"].order_value == 5.0
    assert (out["O2"].delivery_delay_min, out["O2"].is_delayed) == (None, 0)
    assert out["O3"].delivery_per_km_value is None
    assert out["O4"].order_date is None and out["O4"].order_value is None
    assert (out["O5"].delivery_delay_min, out["O5"].is_delayed) == (1.0, 1)
    gate = gate_orders(clean_orders(df))
    assert gate.first().asDict() == {"invalid_ids": 1, "invalid_dates": 1, "negative_values": 1}
    with pytest.raises(ValueError, match="invalid_ids=1"):
        require_clean(gate)
    with pytest.raises(ValueError, match="order_value, region"):
        clean_orders(df.drop("region", "order_value"))
    assert clean_orders(df.limit(0)).count() == 0


def test_weather_boundaries(spark):
    from freightlens.plans.cleaning import clean_weather

    data = [(f"2024-01-0{i + 1}", "North", "8", "76", "20", h, r, c) for i, (h, r, c) in enumerate(
        [("10", "0", "Clear"), ("80", "0", "Clear"), ("10", "5", "Cloudy"), ("10", "10", "Cloudy"), ("10", "20", "Cloudy"), ("10", "0", "Brainstorm")])]
    data.append(("2024-01-01", "North", "8", "76", "20", "10", "3", "Clear"))
    df = spark.createDataFrame(data, "date string, location string, latitude string, longitude string, temperature_c string, humidity_pct string, rainfall_mm string, weather_condition string")
    out = [(r.weather_risk, r.is_rainy, r.heavy_rain_flag, r.high_humidity_flag) for r in clean_weather(df).orderBy("date").collect()]
    assert out == [("LOW", 1, 0, 0), ("MEDIUM", 0, 0, 1), ("MEDIUM", 1, 0, 0), ("MEDIUM", 1, 1, 0), ("HIGH", 1, 1, 0), ("HIGH", 1, 0, 0)]


def test_gps_signal_and_flags(spark):
    from freightlens.plans.cleaning import clean_gps, gate_gps

    data = [("V1", f"2024-01-01 00:0{i}:00", "North", lat, "10", sp, hd, "Active", "On", sig) for i, (lat, sp, hd, sig) in enumerate(
        [("90", "0", "360", " low "), ("-90", "0.1", "361", "49.9"), ("91", None, "0", "50"), ("0", "-1", "0", "Fair")])]
    df = spark.createDataFrame(data + data[:1], "vehicle_id string, timestamp string, region string, latitude string, longitude string, speed_kmph string, heading string, vehicle_status string, ignition_status string, signal_quality string")
    c = clean_gps(df)
    assert [(r.is_moving, r.is_low_signal) for r in c.orderBy("timestamp").collect()] == [(0, 1), (1, 1), (0, 0), (0, 0)]
    assert gate_gps(c).first().asDict() == {"invalid_vehicle_ids": 0, "invalid_timestamps": 0, "invalid_coordinates": 1, "invalid_speed": 1, "invalid_heading": 1}


def mart(spark, order_frame, weather_rows):
    from freightlens.plans import marts, staging

    w = spark.createDataFrame(
        [(d, loc, None, None, None, D(h), D(r), c) for d, loc, h, r, c in weather_rows],
        "date date, location string, latitude decimal(10,6), longitude decimal(10,6), temperature_c decimal(8,2), humidity_pct decimal(8,2), rainfall_mm decimal(10,2), weather_condition string",
    )
    return marts.delivery_mart(marts.int_delivery(marts.delivery_asof_weather(staging.stg_orders(order_frame), staging.stg_weather(w))))


def test_delivery_mart_boundaries(spark):
    day = dt.date(2024, 1, 2)
    sky = [(day, " NORTH", 10, 10, "Rain"), (dt.date(2024, 1, 4), "North", 80, 0, "Clear"), (dt.date(2024, 1, 4), "North", 10, 11, "Rain"), (dt.date(2024, 1, 6), "North", 10, 0, "Clear")]
    o = orders(
        spark, dict(order_id="A", order_date="2024-01-01", actual_delivery_time_min="45"), dict(order_id="B", actual_delivery_time_min="60"),
        dict(order_id="C", order_date="2024-01-03", actual_delivery_time_min="61"), dict(order_id="D", order_date="2024-01-05", actual_delivery_time_min="31"),
        dict(order_id="E", order_date="2030-01-01", promised_delivery_time_min="0", delivery_distance_km="0"), dict(order_id="F", region=None),
    )
    got = {r.order_id: r for r in mart(spark, o, sky).collect()}
    assert (got["A"].delay_category, got["A"].weather_risk_category, got["A"].delivery_risk_category) == ("Minor Delay", "Unknown", "Medium")
    assert (got["B"].delay_category, got["B"].heavy_rain_flag, got["B"].delivery_risk_category) == ("Moderate Delay", 0, "High")
    assert (got["C"].delay_category, got["C"].weather_date) == ("Severe Delay", day)
    assert (got["D"].rainfall_mm, got["D"].delivery_risk_category) == (D("11.00"), "Critical")  # same-day tie: most rain
    assert (got["E"].weather_date, got["E"].delay_ratio, got["E"].delivery_value_per_km) == (dt.date(2024, 1, 6), None, None)
    assert got["F"].weather_date is None and len(got) == 6


def test_driver_metrics_fill_and_negative_on_time(spark):
    from freightlens.plans import cleaning, kpi_jobs

    o = cleaning.clean_orders(orders(spark, dict(order_id="A", actual_delivery_time_min="50", delivery_status="Failed"), dict(order_id="B", actual_delivery_time_min="40")))
    d = spark.createDataFrame([("D1", "x", "n", 2, 4.9, "Active", "LMV"), ("D2", "y", "n", 0, 3.0, "Active", "LMV")], "driver_id string, driver_name string, region string, experience_years int, rating double, employment_status string, license_type string")
    got = {r.driver_id: r for r in kpi_jobs.driver_metrics(kpi_jobs.prepare_deliveries(o), d).collect()}
    assert (got["D1"].on_time_orders, got["D1"].on_time_delivery_rate_pct, got["D1"].delay_rate_pct) == (-1, -100.0, 100.0)
    assert (got["D2"].total_orders, got["D2"].performance_category, got["D2"].risk_flag) == (0, "No Delivery Data", "High")


def test_ingest_rules(spark):
    from freightlens.plans.ingest import report, require_rows, validate

    df = orders(spark, dict(), dict(), dict(order_value="9"), dict(order_id=None), dict(order_id="O2", order_date="soon"), dict(order_id=" O3 ", order_value="?"))
    assert rows(validate(df, "orders").select("order_id", "order_value")) == [("O1", 9.0), ("O3", None)]
    assert tuple(report(df, "orders").first()) == ("orders", 6, 1, 2, 1, 2)
    with pytest.raises(ValueError, match="no valid orders"):
        require_rows(validate(df.filter("order_id is null"), "orders"), "orders")
    w = spark.createDataFrame(
        [(" W1", "a", "new york", "10.5", "1", "2"), ("W2", "b", "x", "-1", "1", "2"), ("W3", "c", "x", "5", "91", "2")],
        "Warehouse_ID string, warehouse_name string, Region string, capacity_units string, latitude string, longitude string",
    )
    assert rows(validate(w, "warehouses")) == [("W1", "a", "New York", 10, 1.0, 2.0)]


def test_payload_edges(spark):
    from freightlens.sources import payloads

    at = dt.datetime(2024, 1, 1)
    w = spark.createDataFrame([('{"name":"X","main":{"temp":20.5,"humidity":80},"weather":[]}', at)], "payload string, fetched_at timestamp_ntz")
    r = payloads.weather_rows(w).first()
    assert (r.location, r.rainfall_mm, r.weather_condition, r.latitude) == ("X", 0.0, "Unknown", None)
    speeds = [(50, 0), (80, 60), (18, 60), (36, 60), (48, 60), (None, 60)]
    t = spark.createDataFrame(
        [('{"flowSegmentData":{"currentSpeed":%s,"freeFlowSpeed":%s}}' % ("null" if c is None else c, f), at, None, 1.0, 2.0, i) for i, (c, f) in enumerate(speeds)],
        "payload string, fetched_at timestamp_ntz, location string, latitude double, longitude double, i int",
    )
    assert [(r.traffic_score, r.traffic_level) for r in payloads.traffic_rows(t).collect()] == [
        (None, "Unknown"), (0.0, "Low"), (70.0, "Severe"), (40.0, "Heavy"), (20.0, "Moderate"), (None, "Unknown")]
    base = "payload string, fetched_at timestamp_ntz, start_longitude double, start_latitude double, end_longitude double, end_latitude double"
    m = spark.createDataFrame([('{"features":[]}', at, 1.0, 2.0, 3.0, 4.0), ('{"features":[{"properties":{"summary":{"distance":1234.5,"duration":90}}}]}', at, 1.0, 2.0, 3.0, 4.0)], base)
    routes, rejects = payloads.route_rows(m)
    assert [(r.distance_km, r.estimated_duration_min) for r in routes.collect()] == [(1.23, 1.5)] and rejects.count() == 1


def test_readers_and_sinks(spark):
    from freightlens.sources import readers, sinks
    from freightlens.sources.schemas import RAW

    base = run_dir(spark, "t")
    spark.createDataFrame([("W1", "n", "r", "12", "x", "2")], "warehouse_id string, warehouse_name string, region string, capacity_units string, latitude string, longitude string").write.option("header", True).csv(f"{base}/w.csv")
    r = readers.read_csv(spark, f"{base}/w.csv", RAW["warehouses"], "warehouses").first()
    assert (r.capacity_units, r.latitude) == (12, None)
    with pytest.raises(ValueError, match="orders is missing required columns: actual_delivery_time_min"):
        readers.read_csv(spark, f"{base}/w.csv", RAW["orders"], "orders")
    assert readers.first_available(spark, [f"{base}/none"]) is None
    with pytest.raises(FileNotFoundError):
        readers.first_available(spark, [f"{base}/none"], required=True)
    day = lambda d, n: spark.createDataFrame([(d, "a", n)], "event_date string, region string, n int")
    for d, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)):
        sinks.write_lake(day(d, n), f"{base}/lake", ["event_date", "region"])
    assert sorted(r.n for r in sinks.read_lake(spark, f"{base}/lake").collect()) == [1, 3]  # only the rewritten day changed
    assert [r.n for r in sinks.write_lake(day("2024-01-03", 4), f"{base}/lake", ["event_date", "region"], whole=True).collect()] == [4]


def test_registered_tables_change_at_once(spark):
    """A load points the table to a new folder; one that fails leaves it as it was."""
    from freightlens.sources import sinks

    base = run_dir(spark, "r")
    df = spark.range(3)
    (name,) = sinks.register_tables(spark, "freight_versions", {"t": df}, base)
    held = spark.table(name)
    with pytest.raises(Exception, match="stop"):
        sinks.register_tables(spark, "freight_versions", {"t": df.select(F.when(F.col("id") > 1, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))}, base)
    assert spark.table(name).count() == held.count() == 3
    sinks.register_tables(spark, "freight_versions", {"t": spark.range(5)}, base)
    assert spark.table(name).count() == 5
    sinks.register_tables(spark, "freight_versions", {"t": spark.range(2).withColumn("more", F.lit("x"))}, base)
    assert spark.table(name).columns == ["id", "more"]
    spark.sql("DROP DATABASE freight_versions CASCADE")


def test_star_keeps_orders_and_scd2(spark, lake):
    from freightlens.plans import star

    assert lake.fact_orders.count() == lake.orders.count()
    assert lake.fact_orders.filter("location_key is null or date_key is null").count() == 0
    one = lake.dims["location"].groupBy("location_name").count().filter("count > 1")
    assert one.count() == 0
    d = lambda s: dt.date.fromisoformat(s)
    log = spark.createDataFrame([("D1", d("2024-01-01"), "N"), ("D1", d("2024-01-02"), "N"), ("D1", d("2024-01-05"), "S"), ("D2", d("2024-01-03"), None)], "id string, day date, region string")
    h = star.versions(log, "id", "day", ["region"])
    cols = ("id", "region", "valid_from", "valid_to", "is_current")
    assert rows(h.select(*cols)) == [("D1", "N", d("2024-01-01"), d("2024-01-04"), False), ("D1", "S", d("2024-01-05"), None, True), ("D2", None, d("2024-01-03"), None, True)]
    snap = spark.createDataFrame([("D1", "S"), ("D2", "W"), ("D3", "E")], "id string, region string")
    m = star.scd2_merge(h, snap, "id", ["region"], "2024-02-01")
    assert [(r.id, r.region, r.is_current) for r in m.orderBy("id", "valid_from").collect()] == [
        ("D1", "N", False), ("D1", "S", True), ("D2", None, False), ("D2", "W", True), ("D3", "E", True)]
    again = star.scd2_merge(m, snap, "id", ["region"], "2024-03-01")
    assert again.count() == m.count()
    facts = spark.createDataFrame([("D1", d("2024-01-04")), ("D1", d("2024-01-05")), ("D1", d("2023-01-01"))], "id string, d date")
    assert [r.region for r in star.version_at(facts, h, "id", "d").orderBy("d").collect()] == [None, "N", "S"]


def test_history_loads_equal_one_pass_and_touch_changed_buckets(spark):
    """Random logs in several loads; a repeated last day, ids without change, nulls, and a refused late row."""
    from freightlens.plans import star
    from freightlens.plans.history import _manifest, load_history, read_history

    rnd = random.Random(5)
    base = run_dir(spark, "history")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(9)]
    log = [(f"D{rnd.randrange(12)}", d, rnd.choice(["N", "S", None])) for d in days for _ in range(8)]
    frame = lambda rows: spark.createDataFrame(rows, "id string, day date, region string")
    load = lambda rows: load_history(frame(rows), "id", "day", ["region"], base, 16)
    assert read_history(spark, base) is None
    for low, high in ((0, 3), (3, 6), (6, 9)):
        got = load([r for r in log if days[low] <= r[1] < days[high - 1] + dt.timedelta(days=1)] + [(None, days[low], "N"), ("D1", None, "N")])
    want = star.versions(frame(log), "id", "day", ["region"])
    assert rows(got.select(*want.columns)) == rows(want)
    before = {e.bucket: e.folder for e in _manifest(spark, base)}
    same = [tuple(r) for r in got.where("is_current").select("id", "valid_from", "region").collect()]
    assert rows(load(same).select(*want.columns)) == rows(want) and rows(load([]).select(*want.columns)) == rows(want)
    assert {e.bucket: e.folder for e in _manifest(spark, base) if e.bucket is not None} == {b: f for b, f in before.items() if b is not None}
    got = load([("D1", dt.date(2024, 3, 1), "moved"), ("new", dt.date(2024, 3, 1), None)])
    after = {e.bucket: e.folder for e in _manifest(spark, base)}
    assert 1 <= sum(f != before.get(b) for b, f in after.items() if b is not None) <= 2
    want = star.versions(frame([*log, ("D1", dt.date(2024, 3, 1), "moved"), ("new", dt.date(2024, 3, 1), None)]), "id", "day", ["region"])
    assert rows(got.select(*want.columns)) == rows(want)
    with pytest.raises(Exception, match="older than the open version"):
        load([("D1", dt.date(2024, 2, 1), "late")])
    assert rows(read_history(spark, base).select(*want.columns)) == rows(want)


def test_severe_deliveries_threshold(spark):
    from freightlens.plans.star import severe_deliveries

    f = spark.createDataFrame([("a", 59, 1.0, "x"), ("b", 60, 1.0, "x"), ("c", None, 1.0, "x")], "order_id string, delivery_delay_min int, delivery_distance_km double, delivery_status string")
    assert [r.order_id for r in severe_deliveries(f).collect()] == ["b"]


def test_quality_rules_find_faults(spark, lake):
    from freightlens.plans import quality

    t = lake.raw_tables()
    hurt = {**t, "orders": t["orders"].withColumn("driver_id", F.lit("D-none")).withColumn("order_value", F.lit(-1))}
    bad = {(r.dataset, r.rule): r for r in quality.referential(hurt).collect()}
    assert bad[("orders", "driver_id in drivers")].failed == bad[("orders", "driver_id in drivers")].total > 0
    ranged = quality.ranges(hurt)
    assert {r.rule for r in ranged.filter("dataset = 'orders' and failed > 0").collect()} == {"order_value >= 0"}
    with pytest.raises(ValueError, match="order_value >= 0"):
        quality.require_quality(ranged, warn_only=("heading >= 0 < 360",))


def test_gps_features_and_bands(spark):
    from freightlens.plans.ml_features import gps_columns, weather_score

    at = dt.datetime(2024, 1, 6, 7)
    g = spark.createDataFrame([("V", at, s, q, "Active", i) for s, q, i in ((3.0, "50", "ON"), (3.1, "49.9", "off"), (80.0, "80", "1"), (None, "bad", "true"))], "vehicle_id string, timestamp timestamp_ntz, speed_kmph double, signal_quality string, vehicle_status string, ignition_status string")
    got = [(r.is_moving, r.speed_band, r.is_low_signal, r.signal_quality_band, r.is_active_vehicle, r.is_peak_hour, r.feature_is_weekend) for r in gps_columns(g).collect()]
    assert got == [(0, "Stationary", 0, "Fair", 1, 1, 1), (1, "Slow", 1, "Fair", 0, 1, 1), (1, "Fast", 0, "Good", 1, 1, 1), (0, None, 1, None, 1, 1, 1)]
    s = spark.createDataFrame([(D("60"), D("100")), (None, None), (D("2"), D("71"))], "r decimal(10,2), h decimal(8,2)")
    assert [x[0] for x in s.select(weather_score(F.col("r"), F.col("h"))).collect()] == [100.0, 0.0, 4.33]
