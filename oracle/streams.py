"""DuckDB SQL of the streaming operators: the result a stream must have written once it is drained."""

from __future__ import annotations

from oracle.base import CTES, ORACLE, n_if, r

O = ORACLE
NUM = "cast(substr(order_id, 2) AS bigint)"
CTES["t_orders"] = f"""SELECT order_id AS kafka_key, cast(order_date AS timestamp) + to_seconds({NUM} % 86400) AS kafka_timestamp, order_id, customer_id, warehouse_id, driver_id, vehicle_id, order_date,
 upper(region) AS region, upper(order_status) AS order_status, upper(delivery_status) AS delivery_status, cast(order_value AS double) AS order_value, cast(delivery_distance_km AS double) AS delivery_distance_km,
 promised_delivery_time_min, actual_delivery_time_min, actual_delivery_time_min - promised_delivery_time_min AS delivery_delay_min,
 CASE WHEN actual_delivery_time_min > promised_delivery_time_min THEN 1 ELSE 0 END AS is_delayed FROM lg_orders"""
CTES["t_gps"] = """SELECT vehicle_id AS kafka_key, timestamp + to_seconds(cast(substr(vehicle_id, 2) AS int) % 30) AS kafka_timestamp, vehicle_id, timestamp, region, latitude, longitude, speed_kmph, heading,
 vehicle_status, ignition_status, signal_quality, is_moving, is_low_signal FROM c_gps"""
O["st_orders"] = f"""SELECT *, CASE WHEN delivery_distance_km > 0 THEN {r("order_value / nullif(delivery_distance_km, 0)")} END AS delivery_per_km_value,
 CASE WHEN delivery_distance_km < 5 THEN '0-5 km' WHEN delivery_distance_km < 10 THEN '5-10 km' WHEN delivery_distance_km < 20 THEN '10-20 km' WHEN delivery_distance_km < 50 THEN '20-50 km' ELSE '50+ km' END AS distance_bucket,
 CASE WHEN order_id <> '' AND customer_id IS NOT NULL AND warehouse_id IS NOT NULL AND order_value >= 0 AND delivery_distance_km >= 0 THEN 1 ELSE 0 END AS is_valid_order,
 {NUM} % 86400 AS processing_delay_sec FROM t_orders"""
ACTIVE = "CASE WHEN delivery_status IN ('ASSIGNED', 'PICKED_UP', 'IN_TRANSIT', 'OUT_FOR_DELIVERY') THEN 1 ELSE 0 END AS active_delivery"
O["st_parse_orders_active"] = f"SELECT *, {ACTIVE} FROM t_orders"
O["st_parse_gps"] = "SELECT * FROM t_gps"
O["st_gps"] = """SELECT *, cast(timestamp AS date) AS event_date, cast(hour(timestamp) AS int) AS event_hour, CASE WHEN abs(latitude) <= 90 AND abs(longitude) <= 180 THEN 1 ELSE 0 END AS is_valid_coordinates,
 cast(substr(vehicle_id, 2) AS bigint) % 30 AS processing_delay_sec FROM t_gps"""
O["st_weather_updates"] = "SELECT * FROM c_weather"
O["st_unified_events"] = f"""SELECT kafka_timestamp AS event_ingest_time, cast(order_date AS timestamp) AS event_time, 'ORDER' AS event_source, order_id, customer_id, warehouse_id, driver_id, vehicle_id, region, delivery_status AS status,
 cast(delivery_delay_min AS double) AS delivery_delay_min, is_delayed, {ACTIVE}, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude, NULL::DOUBLE AS speed_kmph, NULL::VARCHAR AS signal_quality, NULL::INT AS is_moving, NULL::INT AS is_low_signal,
 CASE WHEN is_delayed = 1 THEN 'HIGH' ELSE 'LOW' END AS operational_risk FROM t_orders
UNION ALL BY NAME SELECT kafka_timestamp AS event_ingest_time, timestamp AS event_time, 'GPS' AS event_source, vehicle_id, region, vehicle_status AS status, latitude, longitude, speed_kmph, signal_quality, is_moving, is_low_signal,
 CASE WHEN is_low_signal = 1 THEN 'MEDIUM' ELSE 'LOW' END AS operational_risk FROM t_gps"""
O["st_orders_gps_join"] = """SELECT o.order_id, o.vehicle_id, w.start_time, g.timestamp AS gps_time, g.speed_kmph FROM lg_orders o JOIN lg_windows w ON o.order_id = w.order_id
 JOIN c_gps g ON o.vehicle_id = g.vehicle_id AND g.timestamp BETWEEN w.start_time AND w.start_time + INTERVAL 30 MINUTE"""
AGG = f"count(*) AS gps_events, {r('cast(sum(cast(speed_kmph AS decimal(18,4))) AS double) / count(*)')} AS avg_speed_kmph, {n_if('is_low_signal = 1')} AS low_signal_events"
O["st_gps_windows"] = f"""SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, region, {AGG} FROM (SELECT *, date_trunc('hour', timestamp) AS ws FROM c_gps)
 GROUP BY ALL"""
O["st_gps_windows_sliding"] = f"""SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, region, {AGG} FROM (SELECT *, date_trunc('hour', timestamp) - to_hours(h) AS ws FROM c_gps CROSS JOIN (VALUES (0), (1)) k(h))
 GROUP BY ALL"""
O["st_gps_sessions"] = """SELECT vehicle_id, min(timestamp) AS session_start, max(timestamp) + INTERVAL 2 HOUR AS session_end, count(*) AS gps_events FROM (
SELECT *, sum(brk) OVER (PARTITION BY vehicle_id ORDER BY timestamp) AS grp FROM (
SELECT *, CASE WHEN timestamp > lag(timestamp) OVER (PARTITION BY vehicle_id ORDER BY timestamp) + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS brk FROM c_gps))
GROUP BY vehicle_id, grp"""
O["st_dedup"] = "SELECT vehicle_id, timestamp, region, speed_kmph FROM c_gps"
O["st_delivery_status"] = """SELECT order_id, event_timestamp, event_id, event_type, delay_minutes FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp DESC, event_id DESC, event_type DESC, delay_minutes DESC) AS rn FROM lg_updates) WHERE rn = 1"""
O["st_traffic_trend"] = f"""SELECT window_start, window_end, location, s AS avg_traffic_score, CASE WHEN p IS NULL THEN 'first' WHEN s > p THEN 'worsening' WHEN s < p THEN 'improving' ELSE 'unchanged' END AS trend FROM (
SELECT *, lag(s) OVER (PARTITION BY location ORDER BY window_start) AS p FROM (
SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, location, {r("cast(sum(traffic_score) AS double) / count(*)")} AS s
 FROM (SELECT upper(location) AS location, traffic_score, timestamp - to_hours(h) AS ws FROM lg_traffic CROSS JOIN (VALUES (0), (1)) k(h))
 GROUP BY ALL))"""
O["st_triggers"] = "SELECT count(*) AS rows_after_first_run, count(*) AS rows_after_second_run FROM c_gps"
O["src_kafka_json"] = "SELECT kafka_key AS key, count(*) AS messages, min(kafka_timestamp) AS first_ingest, max(kafka_timestamp) AS last_ingest FROM t_gps GROUP BY 1"
O["sink_stream_json"] = f"SELECT order_id, region, delivery_delay_min, distance_bucket, is_valid_order FROM ({O['st_orders']})"
O["pub_events_json"] = "SELECT order_id AS key, customer_id, order_date, cast(order_value AS double) AS order_value, actual_delivery_time_min FROM lg_orders"
O["sub_validate_append"] = f"""SELECT order_id, CASE WHEN m = '' THEN 'valid' ELSE 'rejected' END AS outcome, m AS missing_fields FROM (
SELECT order_id, CASE WHEN n % 31 = 0 THEN 'order_id, customer_id, warehouse_id, order_date' ELSE concat_ws(', ', CASE WHEN n % 17 = 0 THEN 'customer_id' END, CASE WHEN n % 23 = 0 THEN 'warehouse_id' END) END AS m
 FROM (SELECT *, {NUM} AS n FROM lg_orders))"""
O["sub_validate_append_gps"] = "SELECT vehicle_id, CASE WHEN cast(substr(vehicle_id, 2) AS int) % 13 = 0 THEN 'rejected' ELSE 'valid' END AS outcome, count(*) AS messages FROM lg_gps GROUP BY ALL"
