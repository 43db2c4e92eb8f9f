"""DuckDB SQL of the KPI jobs."""

from __future__ import annotations

from oracle.base import CTES, ORACLE, avg, dbl, n_if, r

O = ORACLE
CTES["k_deliveries"] = """SELECT order_id, warehouse_id, driver_id, order_date, region, delivery_status, is_delayed, delivery_delay_min, actual_delivery_time_min, promised_delivery_time_min,
 delivery_distance_km, order_value FROM c_features
 WHERE order_id IS NOT NULL AND order_date IS NOT NULL AND region IS NOT NULL"""
D = "k_deliveries"


def cd(cond: str) -> str:
    return f"count(DISTINCT CASE WHEN {cond} THEN order_id END)"


N = "count(DISTINCT order_id) AS total_orders"
DN, LN = f"{cd("delivery_status = 'DELIVERED'")} AS delivered_orders", f"{cd('is_delayed = 1')} AS delayed_orders"
OT = r("count(*) FILTER (WHERE delivery_status = 'DELIVERED' AND is_delayed = 0) * 100.0 / nullif(count(*) FILTER (WHERE delivery_status = 'DELIVERED'), 0)") + " AS on_time_delivery_rate_pct"
T = f"{avg('actual_delivery_time_min')} AS avg_delivery_time_min"
P = f"{avg('promised_delivery_time_min')} AS avg_promised_delivery_time_min"
PD = f"{avg('CASE WHEN delivery_delay_min > 0 THEN delivery_delay_min END')} AS avg_positive_delay_min"
AD = f"{avg('delivery_delay_min')} AS avg_delay_min"
V = f"{r('sum(order_value)')} AS total_order_value"
A = f"{avg('order_value')} AS avg_order_value"
K = f"{avg('delivery_distance_km')} AS avg_delivery_distance_km"
TK = f"{r('sum(delivery_distance_km)')} AS total_delivery_distance_km"
LP = r(f"{cd('is_delayed = 1')} * 100.0 / nullif(count(DISTINCT order_id), 0)") + " AS delay_rate_pct"
ALL = f"{N}, {DN}, {LN}, {OT}, {T}, {P}, {PD}, cast(max(delivery_delay_min) AS double) AS max_delay_min, {V}, {A}, {TK}, {K}"
RPO = r("sum(order_value) / nullif(count(DISTINCT order_id), 0)")
O["job_prepare_deliveries"] = "SELECT * FROM k_deliveries"
O["delivery_overall"] = f"SELECT {ALL} FROM {D}"
O["delivery_by_region"] = f"SELECT region, {N}, {DN}, {LN}, {OT}, {T}, {AD}, {V}, {K}, {LP}, {RPO} AS revenue_per_order FROM {D} GROUP BY region"
O["delivery_by_day"] = f"SELECT order_date, {N}, {LN}, {T}, {AD}, {V}, {LP} FROM {D} GROUP BY order_date"
O["delivery_by_status"] = f"SELECT delivery_status, {N}, {V}, {AD} FROM {D} GROUP BY delivery_status"
O["delivery_metrics_union"] = f"""SELECT 'overall' AS metric_level, 'ALL' AS metric_key, {ALL} FROM {D}
UNION ALL BY NAME SELECT 'region' AS metric_level, region AS metric_key, {N}, {DN}, {LN}, {OT}, {T}, {V}, {RPO} AS avg_order_value, {K} FROM {D} GROUP BY region
UNION ALL BY NAME SELECT 'daily' AS metric_level, strftime(order_date, '%Y-%m-%d') AS metric_key, {N}, {LN}, {T}, {V} FROM {D} GROUP BY order_date"""
ONT = """delivered_orders - delayed_orders AS on_time_orders, CASE WHEN delivered_orders > 0 THEN {} ELSE 0 END AS on_time_delivery_rate_pct, coalesce({}, 0) AS delay_rate_pct""".format(
    r("(delivered_orders - delayed_orders) * 100.0 / nullif(delivered_orders, 0)"), r("delayed_orders * 100.0 / nullif(total_orders, 0)"))
DRIVER = f"SELECT driver_id, {N}, {DN}, {LN}, {AD}, {PD}, {T}, {r('sum(delivery_distance_km)')} AS total_distance_km, {avg('delivery_distance_km')} AS avg_distance_km, {V}, {A} FROM {D} GROUP BY driver_id"
ZERO = lambda *cols: ", ".join(f"coalesce({c}, 0) AS {c}" for c in cols)
O["driver_metrics"] = f"""SELECT *, CASE WHEN delivered_orders >= 20 AND on_time_delivery_rate_pct >= 90 AND rating >= 4.5 THEN 'Top Performer'
 WHEN delivered_orders >= 10 AND on_time_delivery_rate_pct >= 80 AND rating >= 4.0 THEN 'Strong Performer' WHEN total_orders = 0 THEN 'No Delivery Data'
 WHEN delay_rate_pct >= 30 OR rating < 3.5 THEN 'Needs Attention' ELSE 'Average' END AS performance_category,
 CASE WHEN delay_rate_pct >= 30 OR rating < 3.5 THEN 'High' WHEN delay_rate_pct >= 15 OR rating < 4.0 THEN 'Medium' ELSE 'Low' END AS risk_flag FROM (
SELECT *, {ONT}, {r("CASE WHEN experience_years > 0 THEN total_orders / experience_years ELSE total_orders END")} AS orders_per_experience_year,
 coalesce({r("total_order_value / nullif(total_distance_km, 0)")}, 0) AS revenue_per_km FROM (
SELECT d.driver_id, driver_name, upper(d.region) AS region, cast(experience_years AS double) AS experience_years, cast(rating AS double) AS rating, employment_status, license_type,
 {ZERO("total_orders", "delivered_orders", "delayed_orders", "avg_delay_min", "avg_positive_delay_min", "avg_delivery_time_min", "total_distance_km", "avg_distance_km", "total_order_value", "avg_order_value")}
FROM lg_drivers d LEFT JOIN ({DRIVER}) k ON d.driver_id = k.driver_id))"""
O["driver_region_metrics"] = f"SELECT region, count(DISTINCT driver_id) AS active_drivers, {N}, {LN}, {AD}, {T}, {V}, {LP} FROM {D} GROUP BY region"
WH = f"SELECT warehouse_id, {N}, {DN}, {LN}, {AD}, {T}, {K}, {TK}, {V}, {A}, count(DISTINCT driver_id) AS active_drivers FROM {D} GROUP BY warehouse_id"
O["warehouse_metrics"] = f"""SELECT *, CASE WHEN total_orders = 0 THEN 'No Activity' WHEN orders_per_capacity_unit >= 1.0 THEN 'Very High' WHEN orders_per_capacity_unit >= 0.75 THEN 'High'
 WHEN orders_per_capacity_unit >= 0.40 THEN 'Moderate' ELSE 'Low' END AS workload_category,
 CASE WHEN total_orders = 0 THEN 'No Activity' WHEN on_time_delivery_rate_pct >= 90 AND delay_rate_pct < 10 THEN 'High Performing' WHEN on_time_delivery_rate_pct >= 80 AND delay_rate_pct < 20 THEN 'Stable'
 WHEN delay_rate_pct >= 30 THEN 'Needs Attention' ELSE 'Watch' END AS performance_category,
 CASE WHEN delay_rate_pct >= 30 THEN 'High' WHEN delay_rate_pct >= 15 OR on_time_delivery_rate_pct < 80 THEN 'Medium' ELSE 'Low' END AS risk_flag FROM (
SELECT *, {ONT}, coalesce({r("total_orders * 1.0 / nullif(active_drivers, 0)")}, 0) AS orders_per_driver, coalesce({r("total_orders / nullif(capacity_units, 0)", 4)}, 0) AS orders_per_capacity_unit,
 coalesce({r("total_order_value / nullif(total_orders, 0)")}, 0) AS revenue_per_order FROM (
SELECT w.warehouse_id, warehouse_name, upper(w.region) AS region, cast(capacity_units AS double) AS capacity_units, cast(latitude AS double) AS latitude, cast(longitude AS double) AS longitude,
 {ZERO("total_orders", "delivered_orders", "delayed_orders", "avg_delay_min", "avg_delivery_time_min", "avg_delivery_distance_km", "total_delivery_distance_km", "total_order_value", "avg_order_value", "active_drivers")}
FROM lg_warehouses w LEFT JOIN ({WH}) k ON w.warehouse_id = k.warehouse_id))"""
O["warehouse_region_metrics"] = f"""SELECT *, {ONT}, coalesce({r("total_orders / nullif(total_capacity_units, 0)", 4)}, 0) AS orders_per_capacity_unit,
 coalesce({r("total_orders * 1.0 / nullif(active_warehouses, 0)")}, 0) AS orders_per_warehouse FROM (
SELECT w.region, total_warehouses, total_capacity_units, {ZERO("total_orders", "delivered_orders", "delayed_orders", "avg_delay_min", "avg_delivery_time_min", "total_order_value", "active_warehouses")}
FROM (SELECT upper(region) AS region, count(DISTINCT warehouse_id) AS total_warehouses, {dbl("capacity_units")} AS total_capacity_units FROM lg_warehouses GROUP BY 1) w
LEFT JOIN (SELECT region, {N}, {DN}, {LN}, {AD}, {T}, {V}, count(DISTINCT warehouse_id) AS active_warehouses FROM {D} GROUP BY region) k ON w.region = k.region)"""
GPS = f"""SELECT region, count(*) AS gps_events, count(DISTINCT vehicle_id) AS tracked_vehicles, {avg("speed_kmph")} AS avg_speed_kmph,
 {avg("CASE WHEN is_moving = 1 THEN speed_kmph END")} AS avg_moving_speed_kmph, max(speed_kmph) AS max_speed_kmph, {n_if("is_moving = 1")} AS moving_events,
 {n_if("is_low_signal = 1")} AS low_signal_events, {r("count(*) FILTER (WHERE is_moving = 1) * 100.0 / count(*)")} AS moving_event_rate_pct,
 {r("count(*) FILTER (WHERE is_low_signal = 1) * 100.0 / count(*)")} AS low_signal_rate_pct FROM c_gps GROUP BY region"""
O["gps_region_metrics"] = GPS
JAM = "upper(traffic_level) IN ('HIGH', 'SEVERE')"
TRAFFIC = f"""SELECT upper(location) AS location, count(*) AS traffic_events, {avg("traffic_score")} AS avg_traffic_score, cast(max(traffic_score) AS double) AS max_traffic_score,
 {avg("average_speed_kmph")} AS avg_traffic_speed_kmph, {n_if(JAM)} AS congested_events, {n_if("upper(traffic_level) = 'SEVERE'")} AS severe_congestion_events,
 {r(f"count(*) FILTER (WHERE {JAM}) * 100.0 / count(*)")} AS congestion_rate_pct, {r("count(*) FILTER (WHERE upper(traffic_level) = 'SEVERE') * 100.0 / count(*)")} AS severe_congestion_rate_pct
 FROM lg_traffic GROUP BY 1"""
O["traffic_location_metrics"] = TRAFFIC
O["road_type_metrics"] = f"""SELECT road_type, count(DISTINCT road_id) AS road_count, {dbl("distance_km")} AS total_road_distance_km, {avg("distance_km")} AS avg_road_distance_km, {avg("lanes")} AS avg_lanes,
 {avg("speed_limit_kmph")} AS avg_speed_limit_kmph, {n_if("upper(road_condition) IN ('POOR', 'CRITICAL')")} AS poor_condition_roads,
 {r("count(*) FILTER (WHERE upper(road_condition) IN ('POOR', 'CRITICAL')) * 100.0 / count(DISTINCT road_id)")} AS poor_condition_rate_pct FROM lg_roads GROUP BY road_type"""
ROUTE = f"""SELECT *, coalesce({r("delayed_orders * 100.0 / nullif(delivery_orders, 0)")}, 0) AS delay_rate_pct,
 coalesce({r("avg_delivery_time_min / nullif(avg_delivery_distance_km, 0)")}, 0) AS avg_delivery_minutes_per_km FROM (
SELECT region, count(DISTINCT order_id) AS delivery_orders, {LN}, {K}, {T}, {avg("delivery_delay_min")} AS avg_delivery_delay_min,
 cast(max(delivery_distance_km) AS double) AS max_delivery_distance_km, {TK} FROM {D} GROUP BY region)"""
O["delivery_route_region"] = ROUTE
O["route_region_metrics"] = f"""SELECT *, CASE WHEN delay_rate_pct >= 30 OR congestion_rate_pct >= 50 OR low_signal_rate_pct >= 20 THEN 'High'
 WHEN delay_rate_pct >= 15 OR congestion_rate_pct >= 25 OR low_signal_rate_pct >= 10 THEN 'Medium' ELSE 'Low' END AS route_risk FROM (
SELECT d.*, {ZERO("gps_events", "tracked_vehicles", "avg_speed_kmph", "avg_moving_speed_kmph", "max_speed_kmph", "moving_events", "low_signal_events", "moving_event_rate_pct", "low_signal_rate_pct",
 "traffic_events", "avg_traffic_score", "avg_traffic_speed_kmph", "congested_events", "congestion_rate_pct")}
FROM ({ROUTE}) d LEFT JOIN ({GPS}) g ON d.region = g.region LEFT JOIN ({TRAFFIC}) t ON d.region = t.location)"""
