"""DuckDB SQL of the star schema and its reports."""

from __future__ import annotations

from oracle.base import CTES, ORACLE, avg, dbl, n_if, r

O = ORACLE


def key(expr: str) -> str:
    return f"cast('0x' || substr(md5({expr}), 1, 15) AS bigint)"


def dkey(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) AS int)"


AUDIT = "'synthetic_source' AS source_system, timestamp '2024-02-01 00:00:00' AS created_at, timestamp '2024-02-01 00:00:00' AS updated_at"
CTES["x_customer"] = f"SELECT {key('customer_id')} AS customer_key, *, {AUDIT} FROM lg_customers"
CTES["x_driver"] = f"SELECT {key('driver_id')} AS driver_key, * REPLACE (cast(experience_years AS decimal(6,2)) AS experience_years), {AUDIT} FROM lg_drivers"
CTES["x_vehicle"] = f"SELECT {key('vehicle_id')} AS vehicle_key, *, {AUDIT} FROM lg_vehicles"
CTES["x_warehouse"] = f"SELECT {key('warehouse_id')} AS warehouse_key, * REPLACE (cast(capacity_units AS decimal(14,2)) AS capacity_units), {AUDIT} FROM lg_warehouses"
CTES["x_location"] = f"""
SELECT {key("location_name")} AS location_key, location_name, region, latitude, longitude, location_type, timestamp '2024-02-01 00:00:00' AS created_at, timestamp '2024-02-01 00:00:00' AS updated_at
FROM (SELECT DISTINCT n.region AS location_name, n.region, w.latitude, w.longitude, 'REGION' AS location_type
 FROM (SELECT DISTINCT region FROM lg_orders) n LEFT JOIN (SELECT DISTINCT location, latitude, longitude FROM lg_weather) w ON n.region = w.location
 UNION ALL SELECT warehouse_name, region, latitude, longitude, 'WAREHOUSE' FROM lg_warehouses)"""
CTES["x_date"] = f"""
SELECT {dkey("d")} AS date_key, d AS full_date, cast(day(d) AS int) AS day_of_month, cast(isodow(d) AS int) AS day_of_week, dayname(d) AS day_name, cast(weekofyear(d) AS int) AS week_of_year,
 cast(month(d) AS int) AS month_number, monthname(d) AS month_name, cast(quarter(d) AS int) AS quarter_number, cast(year(d) AS int) AS year_number, isodow(d) >= 6 AS is_weekend
FROM (SELECT cast(unnest(generate_series(cast(date_trunc('year', min(d)) AS timestamp), cast(date_trunc('year', max(d)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS timestamp), INTERVAL 1 DAY)) AS date) AS d
 FROM (SELECT order_date AS d FROM lg_orders UNION ALL SELECT cast(timestamp AS date) FROM lg_gps))"""
KEYED = """c_orders o LEFT JOIN x_customer c ON o.customer_id = c.customer_id LEFT JOIN x_driver dr ON o.driver_id = dr.driver_id LEFT JOIN x_vehicle v ON o.vehicle_id = v.vehicle_id
 LEFT JOIN x_warehouse w ON o.warehouse_id = w.warehouse_id LEFT JOIN x_location l ON o.region = upper(l.location_name) AND l.location_type = 'REGION' LEFT JOIN x_date d ON o.order_date = d.full_date"""
KEYS = "customer_key, driver_key, vehicle_key, warehouse_key, location_key, date_key"
M = "cast(o.delivery_distance_km AS decimal(12,2)) AS delivery_distance_km, cast(o.promised_delivery_time_min AS decimal(12,2)) AS promised_delivery_time_min, cast(o.actual_delivery_time_min AS decimal(12,2)) AS actual_delivery_time_min, cast(o.delivery_delay_min AS decimal(12,2)) AS delivery_delay_min"
CTES["f_orders"] = f"SELECT {key('order_id')} AS order_key, order_id, {KEYS}, order_status, delivery_status, cast(order_value AS decimal(14,2)) AS order_value, {M}, is_delayed FROM {KEYED}"
CTES["f_delivery"] = f"SELECT {key('order_id')} AS delivery_key, order_id, {KEYS}, delivery_status, {M}, is_delayed, 1 - is_delayed AS on_time_flag FROM {KEYED}"
CTES["f_gps"] = f"""
SELECT {key("g.vehicle_id || '|' || cast(g.timestamp AS varchar)")} AS gps_key, vehicle_key, driver_key, location_key, {dkey("g.date")} AS date_key, g.vehicle_id, g.timestamp AS event_timestamp,
 cast(g.latitude AS decimal(10,6)) AS latitude, cast(g.longitude AS decimal(10,6)) AS longitude, cast(speed_kmph AS decimal(12,2)) AS speed_kmph, cast(heading AS decimal(8,2)) AS heading,
 g.vehicle_status, ignition_status, signal_quality, is_moving, is_low_signal
FROM c_gps g LEFT JOIN x_vehicle v ON g.vehicle_id = v.vehicle_id LEFT JOIN x_driver dr ON v.driver_id = dr.driver_id LEFT JOIN x_location l ON g.region = upper(l.location_name) AND l.location_type = 'REGION'"""
CTES["f_traffic"] = f"""
SELECT {key("upper(t.location) || '|' || cast(t.timestamp AS varchar)")} AS traffic_key, location_key, {dkey("t.timestamp")} AS date_key, t.timestamp AS event_timestamp, traffic_score,
 upper(traffic_level) AS traffic_level, cast(average_speed_kmph AS decimal(12,2)) AS average_speed_kmph FROM lg_traffic t LEFT JOIN x_location l ON upper(t.location) = upper(l.location_name)"""
for name in ("customer", "driver", "vehicle", "warehouse", "location", "date"):
    O[f"dim_{name}"] = f"SELECT * FROM x_{name}"
for name in ("orders", "delivery", "gps", "traffic"):
    O[f"load_fact_{name}"] = f"SELECT * FROM f_{name}"
O["dim_scd2"] = f"""SELECT {key("driver_id || '|' || cast(order_date AS varchar)")} AS version_key, driver_id, region, order_date AS valid_from, cast(nxt - 1 AS date) AS valid_to, nxt IS NULL AS is_current FROM (
SELECT *, lead(order_date) OVER (PARTITION BY driver_id ORDER BY order_date) AS nxt FROM (
SELECT *, lag(region) OVER (PARTITION BY driver_id ORDER BY order_date) AS prev FROM (
SELECT driver_id, order_date, max(region) AS region FROM s_orders GROUP BY driver_id, order_date)) WHERE prev IS NULL OR prev <> region)"""
O["dim_scd2_merged"] = O["dim_scd2"]
N, V, AD, LD = "count(order_id) AS total_orders", f"{dbl('order_value')} AS total_order_value", f"{avg('delivery_delay_min')} AS avg_delay_min", "cast(sum(is_delayed) AS bigint) AS delayed_orders"


def star(keys: str, cols: list[str], fact: str, dim: str | None, tail: str = "") -> str:
    src = f"{fact} f" + (f" JOIN x_{dim} x USING ({dim}_key)" if dim else "")
    return f"SELECT {keys}, {', '.join(cols)} FROM {src} GROUP BY ALL {tail}"


O["fo_total"] = f"SELECT count(*) AS total_orders, {V} FROM f_orders"
O["fo_month"] = star("year_number, month_number, month_name", [N, V], "f_orders", "date")
O["fo_customer_type"] = star("customer_type", [N, V], "f_orders", "customer")
O["fo_warehouse"] = star("warehouse_name, region", [N, V, AD], "f_orders", "warehouse")
O["fo_driver"] = star("driver_name, region", [N, LD, AD], "f_orders", "driver")
O["fo_region"] = star("region", [N, V, AD, r("sum(is_delayed) * 100.0 / count(order_id)") + " AS delay_rate_pct"], "f_orders", "location")
TD, OD, DD = "count(order_id) AS total_deliveries", "cast(sum(on_time_flag) AS bigint) AS on_time_deliveries", "cast(sum(is_delayed) AS bigint) AS delayed_deliveries"
OP = r("sum(on_time_flag) * 100.0 / count(order_id)")
TM = f"{avg('actual_delivery_time_min')} AS avg_delivery_time_min"
O["fd_overall"] = f"SELECT {TD}, {OD}, {DD}, {OP} AS on_time_delivery_rate_pct, {TM}, {AD} FROM f_delivery"
O["fd_driver"] = star("driver_name, region", [TD, OD, DD, OP + " AS on_time_rate_pct", AD], "f_delivery", "driver")
O["fd_warehouse"] = star("warehouse_name, region", [TD, OP + " AS on_time_rate_pct", AD], "f_delivery", "warehouse")
O["fd_daily"] = star("full_date", [TD, OP + " AS on_time_rate_pct", AD], "f_delivery", "date")
O["fd_distance_band"] = star("CASE WHEN delivery_distance_km < 5 THEN '<5 km' WHEN delivery_distance_km < 10 THEN '5-10 km' WHEN delivery_distance_km < 25 THEN '10-25 km' ELSE '25+ km' END AS distance_band",
 ["count(*) AS deliveries", TM, AD], "f_delivery", None)
O["fd_severe"] = "SELECT order_id, delivery_delay_min, delivery_distance_km, delivery_status FROM f_delivery WHERE delivery_delay_min >= 60"
G, SP = "count(gps_key) AS gps_events", f"{avg('speed_kmph')} AS avg_speed_kmph"
TV = "count(DISTINCT vehicle_id) AS tracked_vehicles"
WP = r("sum(is_low_signal) * 100.0 / count(gps_key)") + " AS low_signal_rate_pct"
O["fg_overall"] = f"SELECT {G}, {TV}, {SP}, cast(max(speed_kmph) AS double) AS max_speed_kmph FROM f_gps"
O["fg_vehicle"] = f"SELECT f.vehicle_id, vehicle_type, {G}, {SP}, {r('sum(is_moving) * 100.0 / count(gps_key)')} AS moving_rate_pct, {WP} FROM f_gps f JOIN x_vehicle x ON f.vehicle_key = x.vehicle_key GROUP BY ALL"
O["fg_region"] = star("region", [G, TV, SP, WP], "f_gps", "location")
O["fg_hourly"] = star("cast(hour(event_timestamp) AS int) AS event_hour", [G, "count(DISTINCT vehicle_id) AS active_vehicles", SP], "f_gps", None)
O["fg_daily"] = star("full_date", [G, TV, SP], "f_gps", "date")
O["fg_low_signal"] = star("vehicle_id", [G, "cast(sum(is_low_signal) AS bigint) AS low_signal_events", WP], "f_gps", None, "HAVING sum(is_low_signal) > 0")
T, TS, TF = "count(traffic_key) AS traffic_events", f"{avg('traffic_score')} AS avg_traffic_score", f"{avg('average_speed_kmph')} AS avg_speed_kmph"
O["ft_overall"] = f"SELECT {T}, {TS}, cast(max(traffic_score) AS double) AS max_traffic_score, {avg('average_speed_kmph')} AS avg_traffic_speed_kmph FROM f_traffic"
O["ft_location"] = star("location_name, region", [T, TS, TF], "f_traffic", "location")
J = "traffic_level IN ('HIGH', 'SEVERE')"
O["ft_congestion"] = star("location_name, region", [T, f"{n_if(J)} AS congested_events", r(f"count(*) FILTER (WHERE {J}) * 100.0 / count(*)") + " AS congestion_rate_pct"], "f_traffic", "location")
O["ft_hourly"] = star("cast(hour(event_timestamp) AS int) AS event_hour", [T, TS, TF], "f_traffic", None)
O["ft_daily"] = star("full_date", [T, TS, TF], "f_traffic", "date")
O["ft_severe"] = "SELECT location_name, region, event_timestamp, traffic_score, traffic_level, average_speed_kmph FROM f_traffic JOIN x_location USING (location_key) WHERE traffic_level = 'SEVERE'"
O["ft_delivery_window"] = """SELECT d.order_id, delivery_delay_min, traffic_score, traffic_level, event_timestamp FROM f_delivery d JOIN lg_windows w ON d.order_id = w.order_id
 JOIN f_traffic t ON d.location_key = t.location_key AND t.event_timestamp BETWEEN w.start_time AND w.end_time"""
O["dd_month"] = star("year_number, month_number, month_name", [N], "f_orders", "date")
O["dd_dow"] = star("day_of_week, day_name", [N, AD], "f_delivery", "date")
O["dd_weekend"] = star("is_weekend", [N, AD], "f_delivery", "date")
O["dd_quarter"] = star("year_number, quarter_number", [V], "f_orders", "date")
for name, dim, col, alias in (
    ("dv_region", "driver", "region", "driver_count"), ("dveh_type", "vehicle", "vehicle_type", "vehicle_count"), ("dveh_fuel", "vehicle", "fuel_type", "vehicle_count"),
    ("dveh_maintenance", "vehicle", "maintenance_status", "vehicle_count"), ("dc_region", "customer", "region", "customer_count"), ("dc_type", "customer", "customer_type", "customer_count"),
    ("dw_region", "warehouse", "region", "warehouse_count"), ("dl_region", "location", "region", "location_count"),
):
    O[name] = f"SELECT {col}, count(*) AS {alias} FROM x_{dim} GROUP BY {col}"
O["dv_rating"] = f"SELECT region, {avg('rating')} AS avg_rating FROM x_driver GROUP BY region"
O["dv_experience_band"] = """SELECT CASE WHEN experience_years < 2 THEN '0-2 Years' WHEN experience_years < 5 THEN '2-5 Years' WHEN experience_years < 10 THEN '5-10 Years' ELSE '10+ Years' END AS experience_band,
 count(*) AS driver_count FROM x_driver GROUP BY 1"""
O["dveh_age"] = f"SELECT vehicle_type, {avg('2026 - manufacture_year')} AS avg_vehicle_age_years FROM x_vehicle GROUP BY 1"
O["dveh_capacity"] = f"SELECT vehicle_type, count(*) AS vehicle_count, {dbl('capacity_kg')} AS total_capacity_kg, {avg('capacity_kg')} AS avg_capacity_kg FROM x_vehicle GROUP BY 1"
O["dw_capacity"] = f"SELECT region, count(*) AS warehouse_count, {dbl('capacity_units')} AS total_capacity_units, {avg('capacity_units')} AS avg_capacity_units FROM x_warehouse GROUP BY 1"
O["dw_largest"] = "SELECT warehouse_id, warehouse_name, region, capacity_units FROM x_warehouse"
O["dw_geo"] = "SELECT warehouse_id, warehouse_name, region, latitude, longitude FROM x_warehouse"
O["dl_list"] = "SELECT location_key, location_name, region, latitude, longitude, location_type FROM x_location"
O["dl_with_coords"] = "SELECT location_name, region, latitude, longitude FROM x_location WHERE latitude IS NOT NULL AND longitude IS NOT NULL"
