"""DuckDB SQL of the customer, driver, delivery, route and warehouse reports."""

from __future__ import annotations

from oracle.base import ORACLE, avg, dbl, n_if, pct, r

L, T, W = "is_delayed = 1", "is_delayed = 0", "rainy_flag = 1"
N = "count(*) AS total_orders"
V = f"{dbl('order_value')} AS total_order_value"
A = f"{avg('order_value')} AS average_order_value"
D = f"{avg('delivery_delay_min')} AS average_delay_min"
DD = f"{avg('delivery_delay_min')} AS average_delivery_delay_min"
LN = f"{n_if(L)} AS delayed_orders"
LP = f"{pct(L)} AS delay_rate_pct"
TP = f"{pct(T)} AS on_time_rate_pct"
PER = f"""(SELECT {{key}}, {N}, {V}, {LN}, {avg('delivery_delay_min', None)} AS d, {n_if(L)} / cast(count(*) AS double) AS lr FROM d_mart GROUP BY {{key}})"""
CUST, DRV = PER.format(key="customer_id"), PER.format(key="driver_id")


def grouped(keys: str, cols: list[str], src: str = "d_mart", tail: str = "") -> str:
    return f"SELECT {keys}, {', '.join(cols)} FROM {src} GROUP BY ALL {tail}"


def case(*pairs: str) -> str:
    """case('cond', 'label', ..., 'else label')"""
    body = " ".join(f"WHEN {pairs[i]} THEN '{pairs[i + 1]}'" for i in range(0, len(pairs) - 1, 2))
    return f"CASE {body} ELSE '{pairs[-1]}' END"


MONTH = "cast(year(order_date) AS int) AS order_year, cast(month(order_date) AS int) AS order_month"
O = ORACLE
O["cust_overall_kpis"] = f"""SELECT count(DISTINCT customer_id) AS total_customers, {N}, {r("count(*) * 1.0 / nullif(count(DISTINCT customer_id), 0)")} AS orders_per_customer,
 {V}, {A}, {DD}, {pct(L)} AS customer_order_delay_rate_pct FROM d_mart"""
O["cust_activity"] = grouped("customer_id", [N, V, A, f"{avg('delivery_distance_km')} AS average_delivery_distance_km", DD, LN, LP])


def top_share(key: str) -> str:
    return f"""SELECT {key}, {N}, {V}, {r("cast(sum(order_value) AS double) * 100.0 / nullif((SELECT cast(sum(order_value) AS double) FROM d_mart), 0)")} AS revenue_contribution_pct
 FROM d_mart GROUP BY {key} ORDER BY sum(order_value) DESC, {key} LIMIT 20"""


O["cust_top20_revenue"] = top_share("customer_id")
O["cust_value_segment"] = f"""SELECT customer_id, total_orders, total_order_value, {case("total_order_value >= 100000", "High Value", "total_order_value >= 50000", "Medium Value", "Low Value")} AS customer_value_segment FROM {CUST}"""
O["cust_frequency_segment"] = f"""SELECT customer_id, total_orders, {case("total_orders >= 15", "Highly Frequent", "total_orders >= 8", "Frequent", "total_orders >= 3", "Occasional", "Low Frequency")} AS frequency_segment FROM {CUST}"""
O["cust_repeat_share"] = f"""SELECT {case("total_orders = 1", "One-Time", "Repeat")} AS customer_type, count(*) AS customer_count,
 {r("count(*) * 100.0 / (SELECT count(DISTINCT customer_id) FROM d_mart)")} AS customer_share_pct FROM {CUST} GROUP BY 1"""
O["cust_retention_proxy"] = f"""SELECT {case("m > 1", "Multi-Month Customer", "Single-Month Customer")} AS retention_segment, count(*) AS customer_count,
 {r("count(*) * 100.0 / (SELECT count(DISTINCT customer_id) FROM d_mart)")} AS customer_share_pct
 FROM (SELECT customer_id, count(DISTINCT year(order_date) * 100 + month(order_date)) AS m FROM d_mart GROUP BY customer_id) GROUP BY 1"""
UC = "count(DISTINCT customer_id) AS unique_customers"
O["cust_region"] = grouped("region", [UC, N, V, A, DD, LP])
O["cust_experience"] = f"""SELECT customer_id, {N}, {LN}, {D}, {TP}, {case(f"avg(is_delayed) >= 0.50", "Poor Experience", "avg(is_delayed) >= 0.25", "Needs Attention", "Good Experience")} AS experience_segment FROM d_mart GROUP BY customer_id"""
O["cust_high_value_poor"] = f"""SELECT customer_id, total_orders, total_order_value, {r("d")} AS average_delay_min, {r("lr * 100")} AS delay_rate_pct FROM {CUST} WHERE total_order_value >= 50000 AND lr >= 0.25"""
O["cust_delivery_risk"] = f"""SELECT customer_id, total_orders, delayed_orders, {r("d")} AS average_delay_min,
 {case("delayed_orders >= 5 OR d >= 30", "High Risk", "delayed_orders >= 2 OR d >= 15", "Medium Risk", "Low Risk")} AS delivery_risk FROM {CUST}"""
O["cust_monthly_trend"] = grouped(MONTH, ["count(DISTINCT customer_id) AS active_customers", N, V, A, LP])
O["cust_value_deciles"] = f"""SELECT cast(t AS int) AS customer_decile, count(*) AS customers, {dbl("v")} AS order_value,
 {r("cast(sum(v) AS double) * 100.0 / (SELECT cast(sum(order_value) AS double) FROM d_mart)")} AS value_share_pct
 FROM (SELECT v, ntile(10) OVER (ORDER BY v DESC, customer_id) AS t FROM (SELECT customer_id, sum(order_value) AS v FROM d_mart GROUP BY customer_id)) GROUP BY t"""
O["cust_value_vs_experience"] = f"""SELECT {case("total_order_value >= 50000", "High Value", "total_order_value >= 20000", "Medium Value", "Low Value")} AS value_segment, count(*) AS customers,
 {avg("total_orders")} AS avg_orders_per_customer, {avg("total_order_value")} AS avg_customer_value, {avg("d")} AS avg_delay_min, {r("avg(lr) * 100")} AS avg_delay_rate_pct FROM {CUST} GROUP BY 1"""
MX = "max(delivery_delay_min) AS maximum_delay_min"
O["cust_repeated_delays"] = grouped("customer_id", [N, LN, D, MX], tail=f"HAVING {n_if(L)} >= 3")
O["cust_by_weather"] = grouped("weather_condition", [UC, N, V, D, LP])
O["cust_exec_snapshot"] = f"""SELECT count(*) AS total_customers, {n_if("total_orders > 1")} AS repeat_customers, {n_if("total_order_value >= 50000")} AS high_value_customers,
 {n_if("lr >= 0.25")} AS customers_with_high_delay_rate, {avg("total_orders")} AS avg_orders_per_customer, {avg("total_order_value")} AS avg_customer_value, {avg("d")} AS avg_customer_delay_min FROM {CUST}"""

O["drv_overall_kpis"] = f"""SELECT count(DISTINCT driver_id) AS active_drivers, {N}, {r("count(*) * 1.0 / nullif(count(DISTINCT driver_id), 0)")} AS orders_per_driver, {DD},
 {pct(L)} AS overall_delay_rate_pct, {V} FROM d_mart"""
O["drv_performance"] = grouped("driver_id", [N, V, A, f"{avg('delivery_distance_km')} AS average_distance_km", D, LN, LP, TP])
O["drv_top20_volume"] = grouped("driver_id", [N, V, D, TP], tail="ORDER BY count(*) DESC, driver_id LIMIT 20")
O["drv_top20_value"] = grouped("driver_id", [N, V, A, D], tail="ORDER BY sum(order_value) DESC, driver_id LIMIT 20")
O["drv_top20_ontime"] = grouped("driver_id", [N, TP, D, LN], tail="HAVING count(*) >= 10 ORDER BY on_time_rate_pct DESC, average_delay_min, driver_id LIMIT 20")
O["drv_repeat_delays"] = grouped("driver_id", [N, LN, LP, D, MX], tail=f"HAVING {n_if(L)} >= 3")
O["drv_segmentation"] = f"""SELECT driver_id, total_orders, {r("d")} AS average_delay_min, {r("lr * 100")} AS delay_rate_pct,
 {case("total_orders >= 10 AND lr <= 0.10 AND d < 10", "High Performer", "lr <= 0.25 AND d < 20", "Good Performer", "lr <= 0.50 AND d < 30", "Needs Improvement", "High Risk")} AS performance_category FROM {DRV}"""
O["drv_workload_region"] = grouped("region", ["count(DISTINCT driver_id) AS active_drivers", N, f"{r('count(*) * 1.0 / count(DISTINCT driver_id)')} AS orders_per_driver", D, LP])
O["drv_region_performance"] = grouped("region, driver_id", [N, D, TP, V])
O["drv_revenue_contribution"] = top_share("driver_id")
O["drv_distance_efficiency"] = grouped("driver_id", [N, f"{dbl('delivery_distance_km')} AS total_distance_km", f"{avg('delivery_distance_km')} AS average_distance_km", V,
 f"{r('cast(sum(order_value) AS double) / nullif(cast(sum(delivery_distance_km) AS double), 0)')} AS order_value_per_km",
 f"{r(avg('delivery_distance_km', None) + ' / count(*)')} AS distance_per_order_km"])
O["drv_distance_segment"] = grouped("driver_id, " + case("delivery_distance_km < 5", "Short Distance", "delivery_distance_km < 15", "Medium Distance", "delivery_distance_km < 30", "Long Distance", "Very Long Distance") + " AS distance_segment", [N, D, LP])
O["drv_rainy"] = grouped("driver_id", [N, f"{pct(W)} AS rainy_order_share_pct", f"{pct(W + ' AND ' + L)} AS rainy_delay_rate_pct", f"{pct('rainy_flag = 0 AND ' + L)} AS non_rainy_delay_rate_pct", D])
O["drv_weather_risk"] = grouped("driver_id, weather_risk_category", [N, D, LP])
O["drv_daily"] = grouped("order_date, driver_id", [N, D, LN, TP, V])
O["drv_monthly"] = grouped(MONTH + ", driver_id", [N, V, D, TP])
O["drv_workload_deciles"] = f"""SELECT cast(t AS int) AS workload_decile, count(*) AS driver_count, cast(sum(n) AS bigint) AS total_orders, {avg("n")} AS average_orders_per_driver
 FROM (SELECT n, ntile(10) OVER (ORDER BY n DESC, driver_id) AS t FROM (SELECT driver_id, count(*) AS n FROM d_mart GROUP BY driver_id)) GROUP BY t"""
O["drv_overloaded"] = f"""SELECT driver_id, total_orders, {r("d")} AS average_delay_min, {r("lr * 100")} AS delay_rate_pct FROM {DRV}
 WHERE total_orders > (SELECT count(*) * 1.0 / count(DISTINCT driver_id) FROM d_mart) AND (lr >= 0.25 OR d >= 20)"""
O["drv_exceptions"] = grouped("driver_id", [N, LN, MX, D, V], tail=f"HAVING avg(delivery_delay_min) >= 30 OR {n_if(L)} >= 5")
O["drv_exec_snapshot"] = f"""SELECT count(*) AS total_drivers, {n_if("total_orders > 0")} AS active_drivers, {n_if("lr <= 0.10")} AS high_reliability_drivers, {n_if("lr >= 0.50")} AS high_risk_drivers,
 {avg("total_orders")} AS average_orders_per_driver, {avg("total_order_value")} AS average_driver_order_value, {avg("d")} AS average_driver_delay_min, {r("avg(lr) * 100")} AS average_driver_delay_rate_pct FROM {DRV}"""

# orders ----------------------------------------------------------------------------------------------
G, X = "actual_delivery_time_min <= promised_delivery_time_min", "actual_delivery_time_min > promised_delivery_time_min"
AV = f"{avg('order_value')} AS avg_order_value"
KM = f"{avg('delivery_distance_km')} AS avg_distance_km"
KD = f"{avg('delivery_distance_km')} AS avg_delivery_distance_km"
AM = f"{avg('actual_delivery_time_min')} AS avg_actual_time_min"
TM = f"{avg('actual_delivery_time_min')} AS avg_delivery_time_min"
PM = f"{avg('promised_delivery_time_min')} AS avg_promised_time_min"
LT = "CASE WHEN actual_delivery_time_min > promised_delivery_time_min THEN actual_delivery_time_min - promised_delivery_time_min ELSE 0 END"
LM = f"{avg(LT)} AS avg_delay_min"
XN, GN = f"{n_if(X)} AS delayed_orders", f"{n_if(G)} AS on_time_orders"
BUCKET = case("delivery_distance_km < 5", "0-5 km", "delivery_distance_km < 10", "5-10 km", "delivery_distance_km < 20", "10-20 km", "delivery_distance_km < 50", "20-50 km", "50+ km") + " AS distance_bucket"
PACE = avg("cast(CASE WHEN delivery_distance_km > 0 THEN cast(actual_delivery_time_min AS double) / nullif(cast(delivery_distance_km AS double), 0) END AS decimal(24,10))") + " AS avg_minutes_per_km"
LO = "lg_orders"
SHARE = r("count(*) * 100.0 / sum(count(*)) OVER ()")
O["dlv_overall"] = f"SELECT {N}, {AV}, {KM}, {PM}, {AM} FROM lg_orders"
O["dlv_ontime_split"] = grouped(case(G, "On Time", "Delayed") + " AS delivery_performance", ["count(*) AS order_count", f"{SHARE} AS percentage"], LO)
O["dlv_delay_region"] = grouped("region", [N, XN, LM], LO)
O["dlv_status_dist"] = grouped("delivery_status", ["count(*) AS order_count", f"{SHARE} AS percentage"], LO)
O["dlv_order_status_dist"] = grouped("order_status", ["count(*) AS order_count"], LO)
O["dlv_distance_bucket"] = grouped(BUCKET, [N, AM, LM], LO)
O["dlv_warehouse"] = grouped("warehouse_id", [N, AV, KM, AM, LM], LO)
O["dlv_driver"] = grouped("driver_id", ["count(*) AS total_deliveries", KM, AM, f"{n_if(G)} AS on_time_deliveries", f"{pct(G)} AS on_time_rate_pct"], LO)
O["dlv_daily"] = grouped("order_date", [N, XN, AM], LO)
O["dlv_revenue_region"] = grouped("region", [N, V, AV], LO)
O["dlv_severe"] = """SELECT order_id, customer_id, warehouse_id, driver_id, region, delivery_distance_km, promised_delivery_time_min, actual_delivery_time_min,
 actual_delivery_time_min - promised_delivery_time_min AS delay_min FROM lg_orders WHERE actual_delivery_time_min - promised_delivery_time_min > 30"""
O["dlv_kpi_summary"] = f"SELECT {N}, {GN}, {XN}, {pct(G)} AS on_time_delivery_rate_pct, {AV}, {V} FROM lg_orders"
O["rt_distance_region"] = grouped("region", [N, KM, "cast(min(delivery_distance_km) AS double) AS min_distance_km", "cast(max(delivery_distance_km) AS double) AS max_distance_km"], LO)
O["rt_distance_bucket"] = grouped(BUCKET, [N, PM, AM, f"{avg('actual_delivery_time_min - promised_delivery_time_min')} AS avg_time_variance_min"], LO)
SP, SX = f"{avg('speed_kmph')} AS avg_speed_kmph", "cast(max(speed_kmph) AS double) AS max_speed_kmph"
O["rt_gps_region"] = grouped("region", ["count(*) AS gps_records", "count(DISTINCT vehicle_id) AS tracked_vehicles", SP, SX], "lg_gps")
O["rt_vehicle_movement"] = grouped("vehicle_id", ["count(*) AS telemetry_records", SP, SX, f"{n_if('speed_kmph > 0')} AS moving_records", f"{n_if('speed_kmph = 0')} AS stationary_records"], "lg_gps")
OB, TS, TF = "count(*) AS observations", f"{avg('traffic_score')} AS avg_traffic_score", f"{avg('average_speed_kmph')} AS avg_speed_kmph"
TTF = f"{avg('average_speed_kmph')} AS avg_traffic_speed_kmph"
O["rt_traffic_location"] = grouped("location", [OB, TS, TTF, "cast(max(traffic_score) AS double) AS max_traffic_score"], "lg_traffic")
O["rt_traffic_level"] = grouped("traffic_level", [OB, TS, TF], "lg_traffic")
O["rt_traffic_hourly"] = grouped("cast(hour(timestamp) AS int) AS hour_of_day", [OB, TS, TF], "lg_traffic")
O["rt_hotspots"] = grouped("location", [TS, TF, OB], "lg_traffic", "HAVING avg(traffic_score) >= 70")
O["rt_minutes_per_km"] = grouped("region", [N, KM, TM, PACE], LO)
O["rt_delivery_vs_traffic"] = f"""SELECT d.*, t.avg_traffic_score, t.avg_traffic_speed_kmph FROM ({grouped("region", [N, KD, TM, f"{avg('actual_delivery_time_min - promised_delivery_time_min')} AS avg_delivery_variance_min"], LO)}) d
 LEFT JOIN ({grouped("location", [TS, TTF], "lg_traffic")}) t ON d.region = t.location"""
O["rt_kpi_summary"] = f"SELECT {N}, {KD}, {dbl('delivery_distance_km')} AS total_delivery_distance_km, {TM}, {PACE} FROM lg_orders"
O["hwh_master_summary"] = f"""SELECT count(*) AS total_warehouses, cast(sum(capacity_units) AS bigint) AS total_network_capacity_units, {avg("capacity_units")} AS avg_warehouse_capacity_units,
 min(capacity_units) AS minimum_capacity_units, max(capacity_units) AS maximum_capacity_units FROM lg_warehouses"""
O["hwh_capacity_rank"] = "SELECT warehouse_id, warehouse_name, region, capacity_units FROM lg_warehouses"
O["hwh_region_capacity"] = grouped("region", ["count(*) AS warehouse_count", "cast(sum(capacity_units) AS bigint) AS total_capacity_units", f"{avg('capacity_units')} AS avg_capacity_units"], "lg_warehouses")
O["hwh_order_volume"] = grouped("warehouse_id", [N, V, AV, KD], LO)
O["hwh_delivery"] = grouped("warehouse_id", [N, GN, XN, f"{pct(G)} AS on_time_rate_pct", LM], LO)
O["hwh_capacity_ratio"] = f"""SELECT w.warehouse_id, warehouse_name, region, capacity_units, coalesce(n, 0) AS total_orders,
 {r("coalesce(n, 0) * 100.0 / nullif(capacity_units, 0)")} AS order_to_capacity_ratio_pct, coalesce(v, 0) AS total_order_value
 FROM lg_warehouses w LEFT JOIN (SELECT warehouse_id, count(*) AS n, {dbl("order_value")} AS v FROM lg_orders GROUP BY 1) o ON w.warehouse_id = o.warehouse_id"""
O["hwh_region_performance"] = grouped("region", [N, "count(DISTINCT warehouse_id) AS active_warehouses", V, KD, TM, LM], LO)
O["hwh_highest_delay"] = grouped("warehouse_id", [N, LM, f"{pct(X)} AS delay_rate_pct"], LO, "HAVING count(*) >= 10")
O["hwh_value_contribution"] = grouped("warehouse_id", [N, V, f"{r('cast(sum(order_value) AS double) * 100.0 / cast(sum(sum(order_value)) OVER () AS double)')} AS revenue_contribution_pct"], LO)
O["hwh_geo"] = "SELECT warehouse_id, warehouse_name, region, latitude, longitude, capacity_units FROM lg_warehouses"
O["hwh_kpi_summary"] = f"""SELECT w.warehouse_id, warehouse_name, region, capacity_units, coalesce(total_orders, 0) AS total_orders, coalesce(total_order_value, 0) AS total_order_value,
 coalesce(avg_distance_km, 0) AS avg_distance_km, coalesce(avg_delivery_time_min, 0) AS avg_delivery_time_min, coalesce(avg_delay_min, 0) AS avg_delay_min, coalesce(on_time_rate_pct, 0) AS on_time_rate_pct
 FROM lg_warehouses w LEFT JOIN ({grouped("warehouse_id", [N, V, KM, TM, LM, f"{pct(G)} AS on_time_rate_pct"], LO)}) o ON w.warehouse_id = o.warehouse_id"""

# KPIs over the marts ---------------------------------------------------------------------------------
OC = "count(DISTINCT order_id) AS total_orders"
LC = "count(DISTINCT CASE WHEN is_delayed = 1 THEN order_id END) AS delayed_orders"
OT = "count(DISTINCT CASE WHEN is_delayed = 0 THEN order_id END) AS on_time_orders"
V0 = f"{dbl('coalesce(order_value, 0)')} AS total_order_value"
AV0 = f"{avg('order_value', None)} AS average_order_value"
AD0 = f"{avg('delivery_delay_min', None)} AS average_delay_min"
OR0 = f"{n_if('is_delayed = 0')} / cast(count(*) AS double) AS on_time_rate"
O["kpi_exec_snapshot"] = """SELECT * EXCLUDE (orders_with_heavy_rain, orders_with_rain, total_gps_observations, severe_traffic_observations, congested_traffic_observations,
 warehouse_order_volume, warehouse_order_value, average_warehouse_completion_rate, average_warehouse_delay_rate) FROM e_mart"""
O["kpi_region_orders"] = grouped("region", [OC, "count(DISTINCT CASE WHEN delivery_status IN ('delivered', 'completed') THEN order_id END) AS completed_deliveries", V0, AV0])
O["kpi_region_ontime"] = grouped("region", [OC, OT, LC, "count(DISTINCT CASE WHEN is_delayed = 0 THEN order_id END) / cast(count(DISTINCT order_id) AS double) AS on_time_rate"])
O["kpi_region_delay"] = grouped("region", [f"{avg('delivery_delay_min', None)} AS average_delivery_delay_min", "max(delivery_delay_min) AS maximum_delivery_delay_min", LC])
O["kpi_daily"] = grouped("order_date", [OC, LC, AD0, V0])
for key, col in (("kpi_delay_category", "delay_category"), ("kpi_risk_dist", "delivery_risk_category")):
    O[key] = grouped(col, ["count(DISTINCT order_id) AS order_count", f"{dbl('coalesce(order_value, 0)')} AS order_value"])
O["kpi_weather"] = grouped("weather_condition", [OC, AD0, OR0, f"{avg('rainfall_mm', None)} AS average_rainfall_mm"], "d_mart WHERE weather_condition IS NOT NULL")
O["kpi_heavy_rain"] = grouped("heavy_rain_flag", [OC, AD0, OR0])
O["kpi_region_value"] = grouped("region", [V0, OC, AV0])
FLEET = ["count(*) AS gps_observations", "count(DISTINCT vehicle_id) AS vehicles_observed", f"{avg('speed_kmph', None)} AS average_speed_kmph", f"{avg('traffic_score', None)} AS average_traffic_score"]
O["kpi_fleet_region"] = grouped("region", FLEET + ["cast(sum(severe_traffic_flag) AS bigint) AS severe_traffic_observations", "cast(sum(congested_traffic_flag) AS bigint) AS congested_traffic_observations"], "g_mart")
O["kpi_traffic_risk"] = grouped("traffic_risk_category", FLEET, "g_mart")
O["kpi_warehouse_rank"] = """SELECT warehouse_id, region, total_orders, completed_deliveries, total_order_value, completion_rate, delay_rate, average_delivery_delay_min,
 workload_category, warehouse_performance_category, warehouse_risk_category FROM w_mart"""
WH6 = "SELECT warehouse_id, region, total_orders, delay_rate, completion_rate, average_delivery_delay_min, warehouse_risk_category FROM w_mart WHERE "
O["kpi_high_risk_wh"] = WH6 + "warehouse_risk_category IN ('High', 'Critical')"
O["kpi_exceptions"] = WH6 + "warehouse_risk_category IN ('High', 'Critical') OR delay_rate > 0.20"
O["kpi_top100_delayed"] = """SELECT order_id, region, warehouse_id, driver_id, vehicle_id, order_value, delivery_distance_km, promised_delivery_time_min, actual_delivery_time_min,
 delivery_delay_min, delay_category, weather_condition, rainfall_mm, delivery_risk_category FROM d_mart WHERE is_delayed = 1 ORDER BY delivery_delay_min DESC, order_id LIMIT 100"""
O["kpi_distance_category"] = grouped("distance_category", [OC, f"{avg('delivery_distance_km', None)} AS average_distance_km", AD0, OR0, V0])
O["kpi_monthly"] = grouped(MONTH, [OC, V0, AD0, OR0])

# warehouses over the mart ----------------------------------------------------------------------------
WM = "(SELECT m.*, n.warehouse_name, delayed_orders / nullif(cast(total_orders AS double), 0) AS lr FROM w_mart m LEFT JOIN lg_warehouses n ON m.warehouse_id = n.warehouse_id)"
WHO = "warehouse_id, warehouse_name, region, total_orders"
WP = f"{r('delayed_orders * 100.0 / nullif(total_orders, 0)')} AS delay_rate_pct"
WD = f"{r('average_delivery_delay_min')} AS average_delay_min"
WDD = f"{r('average_delivery_delay_min')} AS average_delivery_delay_min"
WA = f"{r('total_order_value / nullif(total_orders, 0)')} AS average_order_value"
WAVG = "(SELECT avg(total_orders) FROM w_mart)"
TOTALS = [f"cast(sum(total_orders) AS bigint) AS total_orders", f"{r('sum(total_order_value)')} AS total_order_value"]
WLP = r("sum(delayed_orders) * 100.0 / nullif(sum(total_orders), 0)")
O["wh_overall"] = f"""SELECT count(DISTINCT warehouse_id) AS total_warehouses, {", ".join(TOTALS)}, {avg("total_orders")} AS average_orders_per_warehouse,
 {avg("average_delivery_delay_min")} AS average_delivery_delay_min, cast(sum(delayed_orders) AS bigint) AS total_delayed_orders, {WLP} AS overall_delay_rate_pct FROM w_mart"""
O["wh_performance"] = f"SELECT {WHO}, total_order_value, {r('average_order_value')} AS average_order_value, {WDD}, delayed_orders, {WP} FROM {WM}"
O["wh_top20_volume"] = f"SELECT {WHO}, total_order_value, {WDD} FROM {WM} ORDER BY total_orders DESC, warehouse_id LIMIT 20"
O["wh_top20_value"] = f"SELECT {WHO}, total_order_value, {WA} FROM {WM} ORDER BY total_order_value DESC, warehouse_id LIMIT 20"
O["wh_delivery_risk"] = f"""SELECT warehouse_id, warehouse_name, total_orders, delayed_orders, {WP}, {WDD},
 {case("lr >= 0.50 OR average_delivery_delay_min >= 30", "High Risk", "lr >= 0.25 OR average_delivery_delay_min >= 15", "Medium Risk", "Low Risk")} AS warehouse_delivery_risk FROM (SELECT * FROM {WM}) AS m"""
O["wh_segmentation"] = f"""SELECT {WHO}, total_order_value, {r("m.average_delivery_delay_min")} AS average_delivery_delay_min,
 {case("total_orders >= 750 AND m.average_delivery_delay_min < 15", "High Performing", "total_orders >= 500 AND m.average_delivery_delay_min < 25", "Stable", "m.average_delivery_delay_min < 35", "Needs Improvement", "High Risk")} AS performance_category FROM {WM} m"""
O["wh_region"] = f"""SELECT region, count(DISTINCT warehouse_id) AS warehouse_count, {", ".join(TOTALS)}, {r("sum(total_orders) * 1.0 / count(DISTINCT warehouse_id)")} AS average_orders_per_warehouse,
 {avg("average_delivery_delay_min")} AS average_delay_min, cast(sum(delayed_orders) AS bigint) AS delayed_orders, {WLP} AS delay_rate_pct FROM w_mart GROUP BY region"""
O["wh_value_share"] = f"SELECT {WHO}, total_order_value, {r('total_order_value * 100.0 / (SELECT sum(total_order_value) FROM w_mart)')} AS value_contribution_pct FROM {WM}"
O["wh_above_avg"] = f"SELECT {WHO}, {r(WAVG)} AS network_average_orders, total_order_value, {WD}, {WP} FROM {WM} WHERE total_orders > {WAVG}"
O["wh_above_avg_poor"] = f"SELECT {WHO}, {r(WAVG)} AS network_average_orders, {WD}, {WP} FROM {WM} WHERE total_orders > {WAVG} AND (average_delivery_delay_min >= 20 OR lr >= 0.25)"
O["wh_below_avg"] = f"SELECT {WHO}, {r(WAVG)} AS network_average_orders, total_order_value, {WD} FROM {WM} WHERE total_orders < {WAVG}"
O["wh_deciles"] = f"""SELECT cast(t AS int) AS workload_decile, count(*) AS warehouse_count, cast(sum(total_orders) AS bigint) AS total_orders, {avg("total_orders")} AS average_orders
 FROM (SELECT total_orders, ntile(10) OVER (ORDER BY total_orders DESC, warehouse_id) AS t FROM w_mart) GROUP BY t"""
O["wh_value_segment"] = f"SELECT {WHO}, total_order_value, {case('total_order_value >= 100000', 'High Value', 'total_order_value >= 50000', 'Medium Value', 'Low Value')} AS value_segment FROM {WM}"
O["wh_aov"] = f"SELECT {WHO}, {WA}, total_order_value FROM {WM}"
O["wh_delay_impact"] = f"SELECT {WHO}, delayed_orders, {WP}, {WD} FROM {WM}"
O["wh_dense_rank"] = f"SELECT {WHO}, {WD}, {WP}, cast(dense_rank() OVER (ORDER BY lr, average_delivery_delay_min) AS int) AS performance_rank FROM {WM}"
O["wh_exceptions"] = f"SELECT {WHO}, delayed_orders, {WD}, {WP} FROM {WM} WHERE average_delivery_delay_min >= 30 OR lr >= 0.50"
SD = "(SELECT stddev_samp(total_orders) FROM w_mart)"
O["wh_network_balance"] = f"""SELECT {WHO}, {r(WAVG)} AS network_avg_orders, {r(SD)} AS network_stddev_orders,
 {case(f"total_orders > {WAVG} + coalesce({SD}, 0)", "Above Normal Workload", f"total_orders < {WAVG} - coalesce({SD}, 0)", "Below Normal Workload", "Within Normal Range")} AS workload_position FROM {WM}"""
O["wh_workload_delay_matrix"] = f"""SELECT {WHO}, {WD}, CASE WHEN total_orders >= {WAVG} THEN 'High' ELSE 'Low' END || ' Workload / ' ||
 CASE WHEN average_delivery_delay_min >= 20 THEN 'High' ELSE 'Controlled' END || ' Delay' AS workload_delay_segment FROM {WM}"""
O["wh_exec_snapshot"] = f"""SELECT count(*) AS total_warehouses, {", ".join(TOTALS)}, {avg("total_orders")} AS average_orders_per_warehouse, {avg("total_order_value")} AS average_warehouse_order_value,
 {avg("average_delivery_delay_min")} AS average_delivery_delay_min, cast(sum(delayed_orders) AS bigint) AS total_delayed_orders, {WLP} AS network_delay_rate_pct,
 {n_if("average_delivery_delay_min >= 30 OR lr >= 0.50")} AS high_risk_warehouses FROM {WM}"""
