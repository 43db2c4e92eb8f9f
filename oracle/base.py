"""DuckDB side of the checks: the logistics tables and marts as common table expressions.

Written independently of the Spark code: as-of matching uses DuckDB's ASOF JOIN, nearest matching a range
join with row_number, distinct counts plain COUNT(DISTINCT ...).
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def r(expr: str, digits: int = 2) -> str:
    """Round half up on the decimal value, as Spark's round does."""
    return f"cast(round(cast(({expr}) AS decimal(38,{digits + 6})), {digits}) AS double)"


def even(expr: str, digits: int = 2) -> str:
    """Round half to even on the decimal value."""
    s = 10**digits
    v = f"(cast(({expr}) AS decimal(38,{digits + 6})) * {s})"
    return f"cast(CASE WHEN abs({v} - floor({v})) = 0.5 THEN 2 * round({v} / 2.0) ELSE round({v}) END AS double) / {s}.0"


def avg(c: str, digits: int | None = 2) -> str:
    m = f"cast(sum({c}) AS double) / nullif(count({c}), 0)"
    return m if digits is None else r(m, digits)


def dbl(c: str) -> str:
    return f"cast(sum({c}) AS double)"


def n_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def pct(cond: str) -> str:
    return r(f"count(*) FILTER (WHERE {cond}) * 100.0 / nullif(count(*), 0)")


def div(a: str, b: str) -> str:
    return f"cast({a} AS double) / nullif({b}, 0)"


def compose(sql: str) -> str:
    """Prefix the common table expressions a query mentions, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b", text):
                need(CTES[name])
                if name not in order:
                    order.append(name)

    need(sql)
    if not order:
        return sql
    withs = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order)
    return f"WITH {withs}\n" + re.sub(r"^\s*WITH\b", ",", sql) if re.match(r"\s*WITH\b", sql) else f"WITH {withs}\n{sql}"


DD = "date_diff('day', date '1995-01-01', cast(o_orderdate AS date))"
CTES["lg_regions"] = "SELECT *, row_number() OVER (ORDER BY r_regionkey) - 1 AS turn, count(*) OVER () AS turns FROM region"
CTES["lg_lines"] = "SELECT l_orderkey, min(l_partkey) AS driver, max(l_partkey) AS vehicle, min(l_suppkey) AS warehouse FROM lineitem GROUP BY l_orderkey"
CTES["lg_orders"] = """
SELECT concat('O', cast(o.o_orderkey AS varchar)) AS order_id, concat('C', cast(o.o_custkey AS varchar)) AS customer_id,
 concat('W', cast(coalesce(l.warehouse, o.o_orderkey) AS varchar)) AS warehouse_id, concat('D', cast(coalesce(l.driver, o.o_orderkey) AS varchar)) AS driver_id,
 concat('V', cast(coalesce(l.vehicle, o.o_orderkey) AS varchar)) AS vehicle_id, cast(o.o_orderdate AS date) AS order_date, r.r_name AS region,
 CASE o.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Shipped' ELSE 'Processing' END AS order_status,
 CASE WHEN mod(o.o_orderkey, 29) = 0 THEN 'Failed' WHEN mod(o.o_orderkey, 23) = 0 THEN 'In Transit'
  WHEN mod(o.o_orderkey * 13, 121) > 75 THEN 'Delayed' ELSE 'Delivered' END AS delivery_status,
 cast(o.o_totalprice AS decimal(18,2)) AS order_value,
 cast(mod(o.o_orderkey * 37, 1000) * mod(o.o_orderkey * 37, 1000) / 12500.0 AS decimal(12,2)) AS delivery_distance_km,
 cast(30 + mod(o.o_orderkey * 37, 211) AS int) AS promised_delivery_time_min,
 cast(CASE WHEN 30 + mod(o.o_orderkey * 37, 211) + mod(o.o_orderkey * 13, 121) - 75 < 1 THEN 1
  ELSE 30 + mod(o.o_orderkey * 37, 211) + mod(o.o_orderkey * 13, 121) - 75 END AS int) AS actual_delivery_time_min
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN lg_lines l ON l.l_orderkey = o.o_orderkey"""
CTES["lg_weather"] = f"""
SELECT d.dt AS date, r.r_name AS location, cast(8 + r.r_regionkey * 1.1 AS decimal(10,6)) AS latitude, cast(76 + r.r_regionkey * 0.9 AS decimal(10,6)) AS longitude,
 cast(10 + mod(d.h0 * 17 + r.r_regionkey * 29, 250) / 10.0 AS decimal(8,2)) AS temperature_c,
 cast(40 + mod(d.h0 * 37 + r.r_regionkey * 53, 600) / 10.0 AS decimal(8,2)) AS humidity_pct,
 cast(CASE WHEN mod(d.h0 * 7919 + r.r_regionkey * 331, 1000) < 750 THEN 0 ELSE (mod(d.h0 * 7919 + r.r_regionkey * 331, 1000) - 750) * 0.2 END AS decimal(10,2)) AS rainfall_mm,
 CASE WHEN mod(d.h0 * 7919 + r.r_regionkey * 331, 1000) < 750 THEN CASE WHEN mod(d.h0, 3) = 0 THEN 'Cloudy' ELSE 'Clear' END
  WHEN mod(d.h0 * 7919 + r.r_regionkey * 331, 1000) >= 990 THEN 'Thunderstorm'
  WHEN mod(d.h0 * 7919 + r.r_regionkey * 331, 1000) >= 900 THEN 'Heavy Rain' ELSE 'Light Rain' END AS weather_condition
FROM (SELECT DISTINCT cast(o_orderdate AS date) AS dt, {DD} AS h0, n_regionkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) d
JOIN region r ON r.r_regionkey = d.n_regionkey
WHERE mod(d.h0 + r.r_regionkey, 11) <> 0"""
CTES["lg_gps"] = """
SELECT concat('V', cast(user_id AS varchar)) AS vehicle_id, ts AS timestamp, r.r_name AS region,
 cast(8 + mod(event_id * 37, 5000) / 1000.0 AS decimal(10,6)) AS latitude, cast(76 + mod(event_id * 41, 5000) / 1000.0 AS decimal(10,6)) AS longitude,
 cast(CASE WHEN event_type = 'signup' THEN 0 WHEN value > 95 THEN 95 ELSE value END AS decimal(10,2)) AS speed_kmph,
 cast(mod(event_id * 53, 36000) / 100.0 AS decimal(6,2)) AS heading,
 CASE event_type WHEN 'signup' THEN 'Stopped' WHEN 'error' THEN 'Idle' ELSE 'Moving' END AS vehicle_status,
 CASE WHEN event_type = 'signup' THEN 'Off' ELSE 'On' END AS ignition_status,
 CASE WHEN event_type = 'error' THEN ' low ' WHEN event_type = 'view' THEN 'Fair' ELSE 'Good' END AS signal_quality
FROM events JOIN lg_regions r ON r.turn = mod(user_id, r.turns)"""
CTES["lg_traffic"] = """
SELECT h.hr AS timestamp, r.r_name AS location, cast(8 + r.r_regionkey * 1.1 AS decimal(10,6)) AS latitude, cast(76 + r.r_regionkey * 0.9 AS decimal(10,6)) AS longitude,
 cast(mod(h.hn * 31 + r.r_regionkey * 17, 1010) / 10.0 AS decimal(8,2)) AS traffic_score,
 CASE WHEN mod(h.hn * 31 + r.r_regionkey * 17, 1010) >= 750 THEN 'Severe' WHEN mod(h.hn * 31 + r.r_regionkey * 17, 1010) >= 500 THEN 'High'
  WHEN mod(h.hn * 31 + r.r_regionkey * 17, 1010) >= 250 THEN 'Moderate' ELSE 'Low' END AS traffic_level,
 cast(100 - mod(h.hn * 31 + r.r_regionkey * 17, 1010) / 11.0 AS decimal(10,2)) AS average_speed_kmph
FROM (SELECT DISTINCT date_trunc('hour', ts) AS hr, day(ts) * 24 + hour(ts) AS hn, r_regionkey AS rk FROM events JOIN lg_regions g ON g.turn = mod(user_id, g.turns)) h
JOIN region r ON r.r_regionkey = h.rk
WHERE mod(h.hn + r.r_regionkey, 5) <> 0"""
CTES["lg_updates"] = """
SELECT concat('E', cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS event_id, l.order_id, o.driver_id, o.vehicle_id,
 l_shipdate AS event_timestamp, o.region, CASE l_returnflag WHEN 'R' THEN 'Delivery Exception' WHEN 'A' THEN 'Delivered' ELSE 'Out for Delivery' END AS event_type,
 o.delivery_status, cast(l_quantity AS int) AS delay_minutes, 'simulated' AS source
FROM (SELECT *, concat('O', cast(l_orderkey AS varchar)) AS order_id FROM lineitem) l LEFT JOIN lg_orders o ON l.order_id = o.order_id"""
CTES["lg_windows"] = """
SELECT order_id, s AS start_time, s + to_minutes(m) AS end_time FROM (
 SELECT order_id, actual_delivery_time_min AS m, timestamp '2024-01-01 00:00:00' + to_seconds(mod(cast(substr(order_id, 2) AS bigint) * 7919, 2592000)) AS s FROM lg_orders)"""
CTES["lg_customers"] = """
SELECT concat('C', cast(c_custkey AS varchar)) AS customer_id, c_name AS customer_name, r.r_name AS region, c_mktsegment AS customer_type,
 date '1994-01-01' + cast(mod(c_custkey, 1000) AS int) AS registration_date
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r.r_regionkey"""
CTES["lg_drivers"] = """
SELECT concat('D', cast(p_partkey AS varchar)) AS driver_id, p_name AS driver_name, r.r_name AS region, cast(p_size AS int) AS experience_years,
 cast(2.5 + mod(p_partkey * 17, 251) / 100.0 AS decimal(4,2)) AS rating, CASE WHEN mod(p_partkey, 17) = 0 THEN 'Inactive' ELSE 'Active' END AS employment_status,
 CASE mod(p_partkey, 3) WHEN 0 THEN 'LMV' WHEN 1 THEN 'HMV' ELSE 'Commercial' END AS license_type
FROM part JOIN lg_regions r ON r.turn = mod(p_partkey, r.turns)"""
CTES["lg_vehicles"] = """
SELECT concat('V', cast(p_partkey AS varchar)) AS vehicle_id,
 CASE mod(p_partkey, 4) WHEN 0 THEN 'Van' WHEN 1 THEN 'Truck' WHEN 2 THEN 'Mini Truck' ELSE 'Bike' END AS vehicle_type,
 concat('D', cast(p_partkey AS varchar)) AS driver_id, CASE mod(p_partkey, 3) WHEN 0 THEN 'Diesel' WHEN 1 THEN 'Petrol' ELSE 'Electric' END AS fuel_type,
 cast(p_retailprice AS decimal(12,2)) AS capacity_kg, cast(2016 + mod(p_partkey, 10) AS int) AS manufacture_year,
 CASE WHEN mod(p_partkey, 7) = 0 THEN 'Due' ELSE 'Good' END AS maintenance_status, CASE WHEN mod(p_partkey, 9) = 0 THEN 'Idle' ELSE 'Active' END AS vehicle_status,
 cast(5000 + p_partkey * 131 AS decimal(14,2)) AS odometer_km
FROM part"""
CTES["lg_warehouses"] = """
SELECT concat('W', cast(s_suppkey AS varchar)) AS warehouse_id, s_name AS warehouse_name, r.r_name AS region,
 cast(50 + mod(s_suppkey, 1000) * 45 AS int) AS capacity_units, cast(8 + mod(s_suppkey, 100) * 0.37 AS decimal(10,6)) AS latitude,
 cast(76 + mod(s_suppkey, 100) * 0.41 AS decimal(10,6)) AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region r ON n_regionkey = r.r_regionkey"""
CTES["lg_roads"] = """
SELECT concat('R', cast(a.n_nationkey AS varchar), '-', cast(b.n_nationkey AS varchar)) AS road_id, a.n_name AS start_location, b.n_name AS end_location,
 CASE mod(a.n_nationkey + b.n_nationkey, 4) WHEN 0 THEN 'Highway' WHEN 1 THEN 'Urban' WHEN 2 THEN 'Rural' ELSE 'Expressway' END AS road_type,
 cast(5 + mod(a.n_nationkey * 31 + b.n_nationkey * 17, 400) * 0.5 AS decimal(10,2)) AS distance_km, cast(2 + mod(a.n_nationkey * b.n_nationkey, 4) AS int) AS lanes,
 cast(40 + 10 * mod(a.n_nationkey + 2 * b.n_nationkey, 7) AS int) AS speed_limit_kmph,
 CASE mod(a.n_nationkey * 3 + b.n_nationkey, 10) WHEN 0 THEN 'Poor' WHEN 1 THEN 'Critical' WHEN 2 THEN 'Fair' ELSE 'Good' END AS road_condition
FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey
WHERE (a.n_nationkey, b.n_nationkey) IN (
 SELECT (least(s_nationkey, c_nationkey), greatest(s_nationkey, c_nationkey)) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
 JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

# cleaned ---------------------------------------------------------------------------------------------
CTES["c_orders"] = f"""
SELECT *, delivery_delay_min > 0 AND delivery_delay_min IS NOT NULL AS late FROM (
SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, trim(warehouse_id) AS warehouse_id, trim(driver_id) AS driver_id,
 trim(vehicle_id) AS vehicle_id, order_date, upper(trim(region)) AS region, upper(trim(order_status)) AS order_status,
 upper(trim(delivery_status)) AS delivery_status, cast(order_value AS double) AS order_value, cast(delivery_distance_km AS double) AS delivery_distance_km,
 cast(promised_delivery_time_min AS double) AS promised_delivery_time_min, cast(actual_delivery_time_min AS double) AS actual_delivery_time_min,
 cast(actual_delivery_time_min - promised_delivery_time_min AS double) AS delivery_delay_min,
 CASE WHEN actual_delivery_time_min > promised_delivery_time_min THEN 1 ELSE 0 END AS is_delayed,
 cast(greatest(actual_delivery_time_min - promised_delivery_time_min, 0) AS double) AS positive_delay_min,
 CASE WHEN delivery_distance_km > 0 THEN {r("cast(order_value AS double) / nullif(cast(delivery_distance_km AS double), 0)")} END AS delivery_per_km_value
FROM lg_orders)"""
CTES["c_gps"] = """
SELECT trim(vehicle_id) AS vehicle_id, timestamp, upper(region) AS region, cast(latitude AS double) AS latitude, cast(longitude AS double) AS longitude,
 cast(speed_kmph AS double) AS speed_kmph, cast(heading AS double) AS heading, upper(trim(vehicle_status)) AS vehicle_status,
 upper(trim(ignition_status)) AS ignition_status, upper(trim(signal_quality)) AS signal_quality, cast(timestamp AS date) AS date,
 cast(hour(timestamp) AS int) AS hour, strftime(timestamp, '%a') AS day_of_week, cast(isodow(timestamp) - 1 AS int) AS weekday_index,
 CASE WHEN speed_kmph > 0 THEN 1 ELSE 0 END AS is_moving,
 CASE WHEN upper(trim(signal_quality)) IN ('LOW', 'POOR') OR try_cast(trim(signal_quality) AS double) < 50 THEN 1 ELSE 0 END AS is_low_signal
FROM lg_gps"""
CTES["c_weather"] = """
SELECT *, CASE WHEN rainfall_mm >= 20 OR regexp_matches(weather_condition, 'STORM|THUNDER') THEN 'HIGH'
  WHEN rainfall_mm >= 5 OR humidity_pct >= 80 OR regexp_matches(weather_condition, 'RAIN|DRIZZLE') THEN 'MEDIUM' ELSE 'LOW' END AS weather_risk FROM (
SELECT date, trim(location) AS location, cast(latitude AS double) AS latitude, cast(longitude AS double) AS longitude,
 cast(temperature_c AS double) AS temperature_c, cast(humidity_pct AS double) AS humidity_pct, cast(rainfall_mm AS double) AS rainfall_mm,
 upper(trim(weather_condition)) AS weather_condition,
 CASE WHEN rainfall_mm > 0 OR regexp_matches(upper(weather_condition), 'RAIN|DRIZZLE|STORM') THEN 1 ELSE 0 END AS is_rainy,
 CASE WHEN rainfall_mm >= 10 THEN 1 ELSE 0 END AS heavy_rain_flag, CASE WHEN humidity_pct >= 80 THEN 1 ELSE 0 END AS high_humidity_flag
FROM lg_weather)"""
CTES["c_daily"] = """
SELECT date, location, round(avg(temperature_c), 2) AS temperature_c, round(avg(humidity_pct), 2) AS humidity_pct, round(sum(rainfall_mm), 2) AS rainfall_mm,
 max(is_rainy) AS is_rainy, max(heavy_rain_flag) AS heavy_rain_flag, max(high_humidity_flag) AS high_humidity_flag,
 CASE WHEN bool_or(weather_risk = 'HIGH') THEN 'HIGH' WHEN bool_or(weather_risk = 'MEDIUM') THEN 'MEDIUM' ELSE 'LOW' END AS weather_risk
FROM c_weather GROUP BY date, location"""
CTES["c_features"] = f"""
SELECT o.* EXCLUDE (late), temperature_c, humidity_pct, rainfall_mm, is_rainy, heavy_rain_flag, high_humidity_flag, weather_risk,
 cast(year(order_date) AS int) AS order_year, cast(month(order_date) AS int) AS order_month, cast(day(order_date) AS int) AS order_day,
 cast(dayofweek(order_date) + 1 AS int) AS order_day_of_week, CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
 CASE WHEN promised_delivery_time_min > 0 THEN {r("delivery_delay_min / promised_delivery_time_min", 4)} END AS delay_ratio,
 CASE WHEN actual_delivery_time_min > 0 THEN {r("delivery_distance_km / actual_delivery_time_min", 4)} END AS delivery_efficiency,
 CASE WHEN delivery_distance_km < 5 THEN '0-5 km' WHEN delivery_distance_km < 10 THEN '5-10 km' WHEN delivery_distance_km < 20 THEN '10-20 km'
  WHEN delivery_distance_km < 50 THEN '20-50 km' ELSE '50+ km' END AS distance_bucket,
 CASE WHEN order_value < 500 THEN 'Low' WHEN order_value < 1500 THEN 'Medium' ELSE 'High' END AS order_value_bucket,
 CASE WHEN is_delayed = 1 AND (delivery_delay_min >= 30 OR heavy_rain_flag = 1) THEN 'HIGH' WHEN is_delayed = 1 OR is_rainy = 1 THEN 'MEDIUM' ELSE 'LOW' END AS delivery_risk,
 CASE WHEN is_delayed = 1 AND is_rainy = 1 THEN 1 ELSE 0 END AS weather_delay_risk
FROM c_orders o LEFT JOIN c_daily w ON o.order_date = w.date AND o.region = upper(w.location)"""

# staging, intermediate, marts ------------------------------------------------------------------------
CTES["s_orders"] = """
SELECT order_id, customer_id, warehouse_id, driver_id, vehicle_id, order_date, trim(region) AS region, lower(trim(order_status)) AS order_status,
 lower(trim(delivery_status)) AS delivery_status, order_value, delivery_distance_km, promised_delivery_time_min, actual_delivery_time_min FROM lg_orders"""
CTES["s_gps"] = """
SELECT vehicle_id, timestamp AS event_timestamp, trim(region) AS region, latitude, longitude, speed_kmph, heading,
 lower(trim(vehicle_status)) AS vehicle_status, lower(trim(ignition_status)) AS ignition_status, lower(trim(signal_quality)) AS signal_quality FROM lg_gps"""
CTES["s_weather"] = """
SELECT date AS weather_date, trim(location) AS location, latitude, longitude, temperature_c, humidity_pct, rainfall_mm,
 lower(trim(weather_condition)) AS weather_condition FROM lg_weather"""
CTES["s_traffic"] = """
SELECT timestamp AS event_timestamp, trim(location) AS location, latitude, longitude, traffic_score, lower(trim(traffic_level)) AS traffic_level,
 average_speed_kmph FROM lg_traffic"""
CTES["d_weather"] = """
SELECT o.*, w.weather_date, w.location AS weather_location, w.temperature_c, w.humidity_pct, w.rainfall_mm, w.weather_condition
FROM s_orders o ASOF LEFT JOIN s_weather w ON lower(o.region) = lower(w.location) AND o.order_date >= w.weather_date"""
CTES["d_int"] = """
SELECT * EXCLUDE (weather_date, weather_location, temperature_c, humidity_pct, rainfall_mm, weather_condition),
 actual_delivery_time_min - promised_delivery_time_min AS delivery_delay_min,
 CASE WHEN actual_delivery_time_min > promised_delivery_time_min THEN 1 ELSE 0 END AS is_delayed,
 CASE WHEN promised_delivery_time_min > 0 THEN cast(actual_delivery_time_min - promised_delivery_time_min AS double) / nullif(promised_delivery_time_min, 0) END AS delay_ratio,
 CASE WHEN delivery_distance_km > 0 THEN cast(order_value AS double) / nullif(cast(delivery_distance_km AS double), 0) END AS delivery_value_per_km,
 weather_date, weather_location, temperature_c, humidity_pct, rainfall_mm, weather_condition,
 CASE WHEN rainfall_mm > 10 THEN 1 ELSE 0 END AS heavy_rain_flag, CASE WHEN rainfall_mm > 0 THEN 1 ELSE 0 END AS rainy_flag,
 CASE WHEN humidity_pct >= 80 THEN 1 ELSE 0 END AS high_humidity_flag
FROM d_weather"""
CTES["d_mart"] = """
SELECT *, CASE WHEN is_delayed = 0 THEN 'On Time' WHEN delivery_delay_min <= 15 THEN 'Minor Delay' WHEN delivery_delay_min <= 30 THEN 'Moderate Delay' ELSE 'Severe Delay' END AS delay_category,
 CASE WHEN delivery_distance_km < 5 THEN 'Short' WHEN delivery_distance_km < 15 THEN 'Medium' WHEN delivery_distance_km < 30 THEN 'Long' ELSE 'Very Long' END AS distance_category,
 CASE WHEN heavy_rain_flag = 1 THEN 'High Weather Risk' WHEN rainy_flag = 1 OR high_humidity_flag = 1 THEN 'Moderate Weather Risk' WHEN weather_date IS NULL THEN 'Unknown' ELSE 'Low Weather Risk' END AS weather_risk_category,
 CASE WHEN is_delayed = 0 THEN 'Low' WHEN heavy_rain_flag = 1 THEN 'Critical' WHEN rainy_flag = 1 OR high_humidity_flag = 1 THEN 'High' ELSE 'Medium' END AS delivery_risk_category
FROM d_int"""
CTES["g_near"] = """
SELECT * EXCLUDE (rn) FROM (
 SELECT g.*, t.event_timestamp AS traffic_timestamp, t.location AS traffic_location, t.latitude AS traffic_latitude, t.longitude AS traffic_longitude,
  t.traffic_score, t.traffic_level, t.average_speed_kmph AS traffic_average_speed_kmph,
  cast(abs(date_diff('second', date_trunc('second', g.event_timestamp), date_trunc('second', t.event_timestamp))) AS bigint) AS time_difference_seconds,
  row_number() OVER (PARTITION BY g.vehicle_id, g.event_timestamp ORDER BY
   abs(date_diff('second', date_trunc('second', g.event_timestamp), date_trunc('second', t.event_timestamp))), t.event_timestamp) AS rn
 FROM s_gps g LEFT JOIN s_traffic t ON lower(g.region) = lower(t.location)
  AND t.event_timestamp BETWEEN g.event_timestamp - INTERVAL 30 MINUTE AND g.event_timestamp + INTERVAL 30 MINUTE) WHERE rn = 1"""
CTES["g_int"] = """
SELECT *, CASE WHEN speed_kmph > 0 THEN 1 ELSE 0 END AS is_moving, CASE WHEN speed_kmph >= 60 THEN 1 ELSE 0 END AS high_speed_flag,
 CASE WHEN traffic_score >= 75 THEN 1 ELSE 0 END AS severe_traffic_flag, CASE WHEN traffic_score >= 50 THEN 1 ELSE 0 END AS congested_traffic_flag,
 CASE WHEN traffic_average_speed_kmph > 0 THEN cast(speed_kmph AS double) / nullif(cast(traffic_average_speed_kmph AS double), 0) END AS vehicle_to_traffic_speed_ratio
FROM g_near"""
CTES["g_mart"] = """
SELECT *, CASE WHEN severe_traffic_flag = 1 THEN 'Severe Congestion' WHEN congested_traffic_flag = 1 THEN 'Congested' WHEN traffic_score IS NULL THEN 'Unknown' ELSE 'Normal' END AS traffic_risk_category,
 CASE WHEN signal_quality IS NULL THEN 'Unknown' WHEN signal_quality IN ('poor', 'low') THEN 'Low Signal' ELSE 'Good Signal' END AS signal_category,
 CASE WHEN is_moving = 1 AND congested_traffic_flag = 1 THEN 'Moving in Congestion' WHEN is_moving = 1 THEN 'Unknown' WHEN ignition_status = 'on' THEN 'Stationary - Ignition On' ELSE 'Stationary' END AS movement_status_category,
 CASE WHEN vehicle_to_traffic_speed_ratio IS NULL THEN 'No Traffic Benchmark' WHEN vehicle_to_traffic_speed_ratio < 0.50 THEN 'Much Slower Than Traffic'
  WHEN vehicle_to_traffic_speed_ratio < 0.80 THEN 'Slower Than Traffic' WHEN vehicle_to_traffic_speed_ratio <= 1.20 THEN 'Aligned With Traffic' ELSE 'Faster Than Traffic' END AS relative_speed_category
FROM g_int"""
DONE = "delivery_status IN ('delivered', 'completed')"
LATE = "actual_delivery_time_min > promised_delivery_time_min"
CTES["w_mart"] = f"""
SELECT *, CASE WHEN total_orders >= 750 THEN 'Very High' WHEN total_orders >= 500 THEN 'High' WHEN total_orders >= 250 THEN 'Medium' ELSE 'Low' END AS workload_category,
 CASE WHEN delay_rate <= 0.10 AND average_delivery_delay_min <= 10 THEN 'Healthy' WHEN delay_rate <= 0.20 AND average_delivery_delay_min <= 20 THEN 'Stable'
  WHEN delay_rate <= 0.30 THEN 'Needs Attention' ELSE 'At Risk' END AS warehouse_performance_category,
 CASE WHEN delay_rate > 0.30 AND average_delivery_delay_min > 20 THEN 'Critical' WHEN delay_rate > 0.20 THEN 'High' WHEN delay_rate > 0.10 THEN 'Medium' ELSE 'Low' END AS warehouse_risk_category
FROM (SELECT *, {div("completed_deliveries", "total_orders")} AS completion_rate, {div("delayed_orders", "total_orders")} AS delay_rate,
 CASE WHEN total_delivery_distance_km > 0 THEN total_order_value / nullif(total_delivery_distance_km, 0) END AS order_value_per_km FROM (
SELECT warehouse_id, max(region) AS region, count(DISTINCT order_id) AS total_orders, count(DISTINCT CASE WHEN {DONE} THEN order_id END) AS completed_deliveries,
 count(DISTINCT CASE WHEN NOT {DONE} THEN order_id END) AS non_completed_deliveries, {dbl("coalesce(order_value, 0)")} AS total_order_value,
 {avg("order_value", None)} AS average_order_value, {avg("actual_delivery_time_min - promised_delivery_time_min", None)} AS average_delivery_delay_min,
 count(DISTINCT CASE WHEN {LATE} THEN order_id END) AS delayed_orders, {avg("delivery_distance_km", None)} AS average_delivery_distance_km,
 {dbl("coalesce(delivery_distance_km, 0)")} AS total_delivery_distance_km FROM s_orders GROUP BY warehouse_id))"""
CTES["e_mart"] = f"""
SELECT *, CASE WHEN on_time_delivery_rate >= 0.90 THEN 'Healthy' WHEN on_time_delivery_rate >= 0.75 THEN 'Stable' WHEN on_time_delivery_rate >= 0.60 THEN 'Needs Attention' ELSE 'At Risk' END AS overall_delivery_status,
 CASE WHEN delay_rate <= 0.10 THEN 'Low' WHEN delay_rate <= 0.20 THEN 'Medium' WHEN delay_rate <= 0.30 THEN 'High' ELSE 'Critical' END AS overall_delivery_risk
FROM (SELECT *, {div("on_time_orders", "completed_deliveries")} AS on_time_delivery_rate, {div("delayed_orders", "total_orders")} AS delay_rate,
 CASE WHEN total_delivery_distance_km > 0 THEN total_order_value / nullif(total_delivery_distance_km, 0) END AS order_value_per_km
FROM (SELECT max(order_date) AS report_date, count(DISTINCT order_id) AS total_orders, count(DISTINCT CASE WHEN {DONE} THEN order_id END) AS completed_deliveries,
 {dbl("coalesce(order_value, 0)")} AS total_order_value, {avg("order_value", None)} AS average_order_value, {avg("delivery_distance_km", None)} AS average_delivery_distance_km,
 {dbl("coalesce(delivery_distance_km, 0)")} AS total_delivery_distance_km, {avg("actual_delivery_time_min", None)} AS average_actual_delivery_time_min,
 {avg("promised_delivery_time_min", None)} AS average_promised_delivery_time_min, {avg("delivery_delay_min", None)} AS average_delivery_delay_min,
 count(DISTINCT CASE WHEN is_delayed = 1 THEN order_id END) AS delayed_orders, count(DISTINCT CASE WHEN is_delayed = 0 THEN order_id END) AS on_time_orders,
 count(DISTINCT CASE WHEN heavy_rain_flag = 1 THEN order_id END) AS orders_with_heavy_rain, count(DISTINCT CASE WHEN rainy_flag = 1 THEN order_id END) AS orders_with_rain FROM d_mart) d
CROSS JOIN (SELECT count(*) AS total_gps_observations, count(DISTINCT vehicle_id) AS active_vehicles_observed, count(DISTINCT CASE WHEN is_moving = 1 THEN vehicle_id END) AS moving_vehicles_observed,
 {avg("speed_kmph", None)} AS average_vehicle_speed_kmph, {avg("traffic_score", None)} AS average_traffic_score, cast(sum(severe_traffic_flag) AS bigint) AS severe_traffic_observations,
 cast(sum(congested_traffic_flag) AS bigint) AS congested_traffic_observations FROM g_mart) l
CROSS JOIN (SELECT count(DISTINCT warehouse_id) AS warehouses_observed, cast(sum(total_orders) AS bigint) AS warehouse_order_volume, {r("sum(total_order_value)")} AS warehouse_order_value,
 {r("avg(completion_rate)", 10)} AS average_warehouse_completion_rate, {r("avg(delay_rate)", 10)} AS average_warehouse_delay_rate,
 count(DISTINCT CASE WHEN warehouse_risk_category IN ('High', 'Critical') THEN warehouse_id END) AS high_risk_warehouses FROM w_mart) w)"""
for key, cte in {
    "clean_gps": "c_gps", "clean_weather": "c_weather", "weather_daily": "c_daily", "delivery_features": "c_features",
    "stg_orders": "s_orders", "stg_gps": "s_gps", "stg_weather": "s_weather", "stg_traffic": "s_traffic",
    "int_delivery_asof_weather": "d_weather", "int_delivery": "d_int", "int_routes_nearest_traffic": "g_near", "int_routes": "g_int",
    "delivery_mart": "d_mart", "logistics_mart": "g_mart", "warehouse_mart": "w_mart", "executive_mart": "e_mart",
}.items():
    ORACLE[key] = f"SELECT * FROM {cte}"
ORACLE["clean_orders"] = "SELECT * EXCLUDE (late) FROM c_orders"
COORD = "latitude IS NULL OR longitude IS NULL OR abs(latitude) > 90 OR abs(longitude) > 180"
ORACLE["gate_orders"] = f"""SELECT {n_if("order_id IS NULL OR order_id = ''")} AS invalid_ids, {n_if("order_date IS NULL")} AS invalid_dates,
 {n_if("order_value < 0 OR delivery_distance_km < 0 OR promised_delivery_time_min < 0 OR actual_delivery_time_min < 0")} AS negative_values FROM c_orders"""
ORACLE["gate_gps"] = f"""SELECT {n_if("vehicle_id IS NULL OR vehicle_id = ''")} AS invalid_vehicle_ids, {n_if("timestamp IS NULL")} AS invalid_timestamps,
 {n_if(COORD)} AS invalid_coordinates, {n_if("speed_kmph < 0")} AS invalid_speed, {n_if("heading < 0 OR heading > 360")} AS invalid_heading FROM c_gps"""
ORACLE["gate_weather"] = f"""SELECT {n_if("date IS NULL")} AS invalid_dates, {n_if(COORD)} AS invalid_coordinates,
 {n_if("humidity_pct < 0 OR humidity_pct > 100 OR rainfall_mm < 0")} AS invalid_weather_values FROM c_weather"""
ORACLE["gate_features"] = f"""SELECT {n_if("order_id IS NULL OR order_id = ''")} AS invalid_ids, {n_if("delivery_distance_km < 0")} AS negative_distance,
 {n_if("order_value < 0")} AS negative_value FROM c_features"""
ORACLE["int_driver_performance"] = f"""
SELECT *, CASE WHEN total_orders = 0 THEN 'No Activity' WHEN on_time_delivery_rate >= 0.90 AND average_delivery_delay_min <= 5 THEN 'High Performer'
 WHEN on_time_delivery_rate >= 0.75 AND average_delivery_delay_min <= 15 THEN 'Stable' WHEN on_time_delivery_rate >= 0.60 THEN 'Needs Attention' ELSE 'At Risk' END AS driver_performance_category
FROM (SELECT *, {div("completed_deliveries - delayed_deliveries", "completed_deliveries")} AS on_time_delivery_rate, {div("delayed_deliveries", "total_orders")} AS delay_rate,
 {div("total_order_value", "total_orders")} AS average_order_value FROM (
SELECT driver_id, max(region) AS region, count(DISTINCT order_id) AS total_orders, count(DISTINCT CASE WHEN {DONE} THEN order_id END) AS completed_deliveries,
 count(DISTINCT CASE WHEN {LATE} THEN order_id END) AS delayed_deliveries, {avg("actual_delivery_time_min - promised_delivery_time_min", None)} AS average_delivery_delay_min,
 {avg("promised_delivery_time_min", None)} AS average_promised_delivery_time_min, {avg("actual_delivery_time_min", None)} AS average_actual_delivery_time_min,
 {dbl("coalesce(order_value, 0)")} AS total_order_value, {avg("delivery_distance_km", None)} AS average_delivery_distance_km,
 {dbl("coalesce(delivery_distance_km, 0)")} AS total_delivery_distance_km FROM s_orders GROUP BY driver_id))"""
ORACLE["test_unique_orders"] = "SELECT order_id, count(*) AS row_count FROM d_mart GROUP BY order_id HAVING count(*) > 1"
ORACLE["test_valid_status"] = """SELECT delivery_status, count(*) AS row_count FROM d_mart WHERE delivery_status NOT IN
 ('delivered', 'completed', 'pending', 'in_transit', 'cancelled', 'failed', 'returned', 'out_for_delivery') GROUP BY delivery_status"""
