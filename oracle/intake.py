"""DuckDB SQL of ingestion, sources, sinks and landed responses."""

from __future__ import annotations

from oracle.base import ORACLE, even
from oracle.jobs import O as JOBS

O = ORACLE


def title(c: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({c}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


NUM = ", ".join(f"cast({c} AS double) AS {c}" for c in ("order_value", "delivery_distance_km", "promised_delivery_time_min", "actual_delivery_time_min"))
O["ingest_orders"] = f"SELECT order_id, customer_id, warehouse_id, driver_id, vehicle_id, order_date, region, order_status, delivery_status, {NUM} FROM lg_orders"
O["ingest_customers"] = f"SELECT customer_id, customer_name, {title('region')} AS region, {title('customer_type')} AS customer_type, registration_date FROM lg_customers"
O["ingest_warehouses"] = f"SELECT warehouse_id, warehouse_name, {title('region')} AS region, cast(capacity_units AS bigint) AS capacity_units, cast(latitude AS double) AS latitude, cast(longitude AS double) AS longitude FROM lg_warehouses"
O["ingest_report"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, count(*) AS source_rows, cast(0 AS bigint) AS repeated_rows, cast(0 AS bigint) AS dropped_missing, count(*) - count(DISTINCT {k}) AS dropped_duplicate_ids, count(DISTINCT {k}) AS kept_rows FROM lg_{d}"
    for d, k in (("orders", "order_id"), ("customers", "customer_id"), ("warehouses", "warehouse_id")))
O["src_csv_contract"] = "SELECT * FROM lg_orders"
O["src_processed_or_raw"] = "SELECT * EXCLUDE (late) FROM c_orders"
O["src_all_datasets"] = " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS row_count FROM {t}" for t in ("orders", "customer", "part", "supplier", "lineitem", "events", "nation", "region"))
O["sink_single_csv"] = JOBS["delivery_by_region"]
O["sink_partitioned_lake"] = "SELECT date AS event_date, region, count(*) AS gps_events, max(speed_kmph) AS max_speed_kmph FROM c_gps GROUP BY ALL"
LG = {"orders": "lg_orders", "customers": "lg_customers", "drivers": "lg_drivers", "vehicles": "lg_vehicles", "warehouses": "lg_warehouses", "gps_tracking": "lg_gps", "weather": "lg_weather", "traffic": "lg_traffic"}
O["tbl_hive_register"] = " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS row_count FROM {t}" for n, t in LG.items())
O["mat_view_table"] = " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS row_count FROM {t}" for n, t in (("delivery_mart", "d_mart"), ("logistics_mart", "g_mart"), ("warehouse_mart", "w_mart")))
O["norm_weather_payload"] = f"""SELECT date, location, cast(latitude AS double) AS latitude, cast(longitude AS double) AS longitude, cast(temperature_c AS double) AS temperature_c,
 cast(humidity_pct AS double) AS humidity_pct, cast(rainfall_mm AS double) AS rainfall_mm, {title("weather_condition")} AS weather_condition FROM lg_weather"""
LOSS = even("CASE WHEN free > 0 THEN (1 - cast(average_speed_kmph AS double) / free) * 100 END")
O["norm_traffic_payload"] = f"""SELECT timestamp, location, latitude, longitude, s AS traffic_score, CASE WHEN s IS NULL THEN 'Unknown' WHEN s >= 70 THEN 'Severe' WHEN s >= 40 THEN 'Heavy' WHEN s >= 20 THEN 'Moderate' ELSE 'Low' END AS traffic_level,
 cast(average_speed_kmph AS double) AS average_speed_kmph FROM (SELECT *, CASE WHEN free > 0 THEN greatest(0, least(100, {LOSS})) END AS s FROM (SELECT *, hour(timestamp) * 10 % 110 AS free FROM lg_traffic))"""
O["norm_route_payload"] = f"""SELECT order_date AS timestamp, cast(n % 97 AS double) AS start_longitude, cast(n % 83 AS double) AS start_latitude, cast(n % 89 AS double) AS end_longitude, cast(n % 79 AS double) AS end_latitude,
 CASE WHEN n % 19 <> 0 THEN {even("delivery_distance_km")} END AS distance_km, CASE WHEN n % 19 <> 0 THEN cast(actual_delivery_time_min AS double) END AS estimated_duration_min,
 CASE WHEN n % 19 = 0 THEN 'no route found' END AS reason FROM (SELECT *, cast(substr(order_id, 2) AS bigint) AS n FROM lg_orders)"""
