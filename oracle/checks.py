"""DuckDB SQL of dashboard measures and data-quality operators."""

from __future__ import annotations

from oracle.base import ORACLE, avg, dbl, n_if, r
from oracle.study import COLUMNS

O = ORACLE
L = "is_delayed = 1"
LR = r("count(*) FILTER (WHERE is_delayed = 1) * 1.0 / count(*)", 4) + " AS delay_rate"
OR = r("count(*) FILTER (WHERE is_delayed = 0) * 1.0 / count(*)", 4) + " AS on_time_rate"
V, D = f"{dbl('order_value')} AS total_order_value", f"{avg('delivery_delay_min')} AS average_delay_min"
EX = f"count(*) AS orders, {V}, {avg('order_value')} AS average_order_value, {D}, {n_if(L)} AS delayed_orders, {OR}, {LR}"
O["bi_executive"] = f"SELECT 'ALL' AS region, {EX} FROM f_orders UNION ALL SELECT region, {EX} FROM f_orders JOIN x_location USING (location_key) GROUP BY region"
BD = f"count(*) AS deliveries, {n_if(L)} AS delayed_deliveries, {D}, cast(max(delivery_delay_min) AS double) AS maximum_delay_min, {LR} FROM d_mart"
SEV = "CASE WHEN delivery_delay_min <= 0 THEN 'On Time' WHEN delivery_delay_min <= 10 THEN 'Minor Delay' WHEN delivery_delay_min <= 30 THEN 'Moderate Delay' WHEN delivery_delay_min <= 60 THEN 'Severe Delay' ELSE 'Critical Delay' END"
O["bi_delivery"] = f"SELECT 'total' AS view, 'ALL' AS key, {BD} UNION ALL SELECT 'severity', {SEV}, {BD} GROUP BY 2 UNION ALL SELECT 'weather', coalesce(weather_condition, 'Unknown'), {BD} GROUP BY 2"
O["bi_fleet"] = f"""SELECT * FROM (SELECT count(DISTINCT driver_key) AS active_drivers, {avg("delivery_delay_min")} AS average_driver_delay_min FROM f_orders)
 CROSS JOIN (SELECT count(DISTINCT vehicle_id) AS active_vehicles, {avg("speed_kmph")} AS average_gps_speed_kmph, {n_if("is_low_signal = 1")} AS low_signal_observations FROM f_gps)"""
O["bi_fleet_risk_matrix"] = f"SELECT driver_id, count(*) AS orders, {OR}, {D}, {V} FROM f_orders JOIN x_driver USING (driver_key) GROUP BY 1"
O["bi_warehouse"] = f"""SELECT count(DISTINCT warehouse_key) AS total_warehouses, count(*) AS warehouse_orders, {r("count(*) * 1.0 / count(DISTINCT warehouse_key)")} AS average_orders_per_warehouse,
 {r("count(*) FILTER (WHERE is_delayed = 1) * 1.0 / count(*)", 4)} AS warehouse_delay_rate FROM f_orders"""
O["bi_warehouse_risk"] = f"""SELECT m.warehouse_id, n.warehouse_name, m.region, total_orders AS orders, total_order_value, delayed_orders, {r("m.delay_rate", 4)} AS delay_rate,
 {r("average_delivery_delay_min")} AS average_delay_min, warehouse_risk_category AS risk_category FROM w_mart m LEFT JOIN lg_warehouses n ON m.warehouse_id = n.warehouse_id"""
O["bi_financial"] = f"""SELECT customer_id, cast(v AS double) AS total_order_value, {r("cast(v AS double) * 100 / cast(sum(v) OVER () AS double)", 4)} AS contribution_pct,
 {r("cast(sum(v) OVER (ORDER BY v DESC, customer_id ROWS UNBOUNDED PRECEDING) AS double) * 100 / cast(sum(v) OVER () AS double)", 4)} AS cumulative_pct
 FROM (SELECT customer_id, sum(order_value) AS v FROM f_orders JOIN x_customer USING (customer_key) GROUP BY 1)"""
O["bi_financial_kpis"] = f"""SELECT {dbl("order_value")} AS total_revenue, {avg("order_value")} AS average_order_value, count(*) AS financial_orders,
 {r("cast(sum(order_value) AS double) / cast(sum(delivery_distance_km) AS double)")} AS revenue_per_km FROM f_orders"""
O["bi_reconcile"] = f"""SELECT t AS total_deliveries, l AS delayed_deliveries, o AS on_time_deliveries, l + o = t AS totals_agree, {r("o * 1.0 / nullif(d, 0)", 4)} AS on_time_to_delivered_ratio, o > d AS ratio_out_of_range FROM (
SELECT count(*) AS t, {n_if(L)} AS l, {n_if("is_delayed = 0")} AS o, {n_if("delivery_status = 'DELIVERED'")} AS d FROM f_delivery)"""


def rule(dataset: str, table: str, name: str, bad: str) -> str:
    return f"SELECT '{dataset}' AS dataset, '{name}' AS rule, {n_if(bad)} AS failed, count(*) AS total FROM {table}"


def rules(items) -> str:
    return " UNION ALL ".join(rule(*i) for i in items)


T = {n: t for n, (t, _) in COLUMNS.items()}
# Columns that must not be blank.
BLANK = {'orders': ['order_id', 'customer_id', 'warehouse_id', 'driver_id', 'vehicle_id'],
 'customers': ['customer_id', 'customer_type', 'region'],
 'drivers': ['driver_id'],
 'vehicles': ['vehicle_id', 'driver_id'],
 'warehouses': ['warehouse_id'],
 'delivery_updates': ['event_id', 'order_id', 'driver_id', 'vehicle_id']}
O["dq_not_blank"] = rules((d, T[d], f"{c} not blank", f"coalesce(trim({c}), '') = ''") for d, cols in BLANK.items() for c in cols)
KEYS = {"orders": "order_id", "customers": "customer_id", "drivers": "driver_id", "vehicles": "vehicle_id", "warehouses": "warehouse_id", "gps_tracking": "vehicle_id+timestamp",
        "weather": "date+location", "traffic": "location+timestamp", "roads": "road_id", "delivery_updates": "event_id"}
O["dq_unique_keys"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, '{k} unique' AS rule, {n_if('c > 1')} AS failed, count(*) AS total FROM (SELECT count(*) AS c FROM {T[d]} GROUP BY {k.replace('+', ', ')})" for d, k in KEYS.items())
# Column, rule, what breaks it.
RANGES = {'orders': [('order_value', 'order_value >= 0', 'order_value < 0'),
            ('delivery_distance_km', 'delivery_distance_km >= 0', 'delivery_distance_km < 0'),
            ('promised_delivery_time_min', 'promised_delivery_time_min >= 0', 'promised_delivery_time_min < 0'),
            ('actual_delivery_time_min', 'actual_delivery_time_min >= 0', 'actual_delivery_time_min < 0')],
 'drivers': [('rating', 'rating >= 0 <= 5', 'rating NOT BETWEEN 0 AND 5'),
             ('experience_years', 'experience_years >= 0', 'experience_years < 0')],
 'vehicles': [('capacity_kg', 'capacity_kg > 0', 'capacity_kg <= 0'), ('odometer_km', 'odometer_km >= 0', 'odometer_km < 0'),
              ('manufacture_year', 'manufacture_year >= 1900 <= 2100', 'manufacture_year NOT BETWEEN 1900 AND 2100')],
 'warehouses': [('latitude', 'latitude >= -90 <= 90', 'latitude NOT BETWEEN -90 AND 90'),
                ('longitude', 'longitude >= -180 <= 180', 'longitude NOT BETWEEN -180 AND 180'),
                ('capacity_units', 'capacity_units > 0', 'capacity_units <= 0')],
 'gps_tracking': [('latitude', 'latitude >= -90 <= 90', 'latitude NOT BETWEEN -90 AND 90'),
                  ('longitude', 'longitude >= -180 <= 180', 'longitude NOT BETWEEN -180 AND 180'),
                  ('speed_kmph', 'speed_kmph >= 0', 'speed_kmph < 0'), ('heading', 'heading >= 0 <= 360', 'heading NOT BETWEEN 0 AND 360'),
                  ('heading', 'heading >= 0 < 360', 'heading < 0 OR heading >= 360')],
 'weather': [('latitude', 'latitude >= -90 <= 90', 'latitude NOT BETWEEN -90 AND 90'),
             ('longitude', 'longitude >= -180 <= 180', 'longitude NOT BETWEEN -180 AND 180'),
             ('humidity_pct', 'humidity_pct >= 0 <= 100', 'humidity_pct NOT BETWEEN 0 AND 100'),
             ('rainfall_mm', 'rainfall_mm >= 0', 'rainfall_mm < 0')],
 'traffic': [('traffic_score', 'traffic_score >= 0 <= 100', 'traffic_score NOT BETWEEN 0 AND 100'),
             ('average_speed_kmph', 'average_speed_kmph >= 0', 'average_speed_kmph < 0')],
 'roads': [('distance_km', 'distance_km > 0', 'distance_km <= 0'), ('lanes', 'lanes > 0', 'lanes <= 0'),
           ('speed_limit_kmph', 'speed_limit_kmph > 0', 'speed_limit_kmph <= 0')],
 'delivery_updates': [('delay_minutes', 'delay_minutes >= 0', 'delay_minutes < 0')]}
O["dq_ranges"] = rules((d, T[d], rule, f"{c} IS NULL OR {broken}") for d, specs in RANGES.items() for c, rule, broken in specs)
# Dataset, column, dataset it refers to.
REFS = [('orders', 'customer_id', 'customers'), ('orders', 'warehouse_id', 'warehouses'), ('orders', 'driver_id', 'drivers'),
 ('orders', 'vehicle_id', 'vehicles'), ('delivery_updates', 'order_id', 'orders'), ('delivery_updates', 'driver_id', 'drivers'),
 ('delivery_updates', 'vehicle_id', 'vehicles'), ('vehicles', 'driver_id', 'drivers')]
O["dq_referential"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, '{c} in {p}' AS rule, count(*) FILTER (WHERE {c} IS NULL OR {c} NOT IN (SELECT {c} FROM {T[p]})) AS failed, count(*) AS total FROM {T[d]}" for d, c, p in REFS)
O["dq_population"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS dataset, (SELECT count(*) FROM (SELECT order_id FROM lg_orders EXCEPT SELECT order_id FROM {t})) AS ids_lost, (SELECT count(*) FROM (SELECT order_id FROM {t} EXCEPT SELECT order_id FROM lg_orders)) AS ids_added,
 (SELECT count(*) FROM lg_orders) AS source_rows, (SELECT count(*) FROM {t}) AS processed_rows""" for n, t in (("orders_clean", "c_orders"), ("delivery_features", "c_features")))
DONE = {"orders_clean": "c_orders", "gps_clean": "c_gps", "weather_clean": "c_weather", "delivery_features": "c_features"}
# Columns of zeros and ones.
FLAGS = {'orders_clean': ['is_delayed'],
 'gps_clean': ['is_moving', 'is_low_signal'],
 'weather_clean': ['is_rainy', 'heavy_rain_flag', 'high_humidity_flag'],
 'delivery_features': ['is_delayed']}
O["dq_binary_flags"] = rules((d, DONE[d], f"{c} in 0,1", f"{c} IS NULL OR {c} NOT IN (0, 1)") for d, cols in FLAGS.items() for c in cols)
# Columns that must not be negative.
NONNEG = {'orders_clean': ['order_value', 'delivery_distance_km', 'delivery_delay_min', 'delivery_per_km_value'],
 'gps_clean': ['speed_kmph'],
 'weather_clean': ['rainfall_mm']}
O["dq_non_negative"] = rules((d, DONE[d], f"{c} not negative", f"{c} IS NULL OR {c} < 0") for d, cols in NONNEG.items() for c in cols)
CLEAN = {
    "orders_clean": "order_id customer_id warehouse_id driver_id vehicle_id order_date region order_status delivery_status order_value delivery_distance_km promised_delivery_time_min actual_delivery_time_min delivery_delay_min is_delayed positive_delay_min delivery_per_km_value",
    "gps_clean": "vehicle_id timestamp region latitude longitude speed_kmph heading vehicle_status ignition_status signal_quality date hour day_of_week weekday_index is_moving is_low_signal",
    "weather_clean": "date location latitude longitude temperature_c humidity_pct rainfall_mm weather_condition is_rainy heavy_rain_flag high_humidity_flag weather_risk",
}
CLEAN["delivery_features"] = CLEAN["orders_clean"] + " temperature_c humidity_pct rainfall_mm is_rainy heavy_rain_flag high_humidity_flag weather_risk order_year order_month order_day order_day_of_week is_weekend delay_ratio delivery_efficiency distance_bucket order_value_bucket delivery_risk weather_delay_risk"
O["dq_empty_columns"] = " UNION ALL ".join(f"SELECT '{d}' AS dataset, '{c} not empty' AS rule, CASE WHEN count({c}) = 0 AND count(*) > 0 THEN 1::BIGINT ELSE 0::BIGINT END AS failed, count(*) AS total FROM {DONE[d]}" for d, cols in CLEAN.items() for c in cols.split())
FD = "fact_delivery"
O["dq_consistency"] = rules([
    (FD, "f_delivery", "delay is actual minus promised", "delivery_delay_min <> actual_delivery_time_min - promised_delivery_time_min"),
    (FD, "f_delivery", "is_delayed agrees with delay", "(is_delayed = 1) <> (delivery_delay_min > 0)"),
    (FD, "f_delivery", "on_time_flag is the opposite of is_delayed", "on_time_flag + is_delayed <> 1"),
    (FD, "f_delivery", "times not negative", "promised_delivery_time_min < 0 OR actual_delivery_time_min < 0"),
    (FD, "f_delivery", "distance not negative", "delivery_distance_km < 0")])
O["dq_calendar"] = """SELECT count(*) AS calendar_days, count(*) - count(DISTINCT full_date) AS duplicate_dates, count(*) - count(DISTINCT date_key) AS duplicate_keys,
 date_diff('day', min(full_date), max(full_date)) + 1 - count(DISTINCT full_date) AS missing_days, count(*) FILTER (WHERE month_number NOT BETWEEN 1 AND 12) AS invalid_months,
 count(*) FILTER (WHERE quarter_number NOT BETWEEN 1 AND 4) AS invalid_quarters, count(*) FILTER (WHERE is_weekend <> (day_of_week IN (6, 7))) AS invalid_weekend_flags FROM x_date"""
PT = "abs(latitude) > 90 OR abs(longitude) > 180"
O["dq_dimensions"] = rules([
    ("dim_customer", "x_customer", "customer_id present", "coalesce(trim(customer_id), '') = ''"), ("dim_customer", "x_customer", "registration not in the future", "registration_date > date '2026-01-01'"),
    ("dim_driver", "x_driver", "driver_id present", "coalesce(trim(driver_id), '') = ''"), ("dim_driver", "x_driver", "experience not negative", "experience_years < 0"), ("dim_driver", "x_driver", "rating within 0..5", "rating < 0 OR rating > 5"),
    ("dim_vehicle", "x_vehicle", "vehicle_id present", "coalesce(trim(vehicle_id), '') = ''"), ("dim_vehicle", "x_vehicle", "capacity positive", "capacity_kg <= 0"), ("dim_vehicle", "x_vehicle", "odometer not negative", "odometer_km < 0"),
    ("dim_vehicle", "x_vehicle", "manufacture year plausible", "manufacture_year < 1900 OR manufacture_year > 2027"),
    ("dim_warehouse", "x_warehouse", "warehouse_id present", "coalesce(trim(warehouse_id), '') = ''"), ("dim_warehouse", "x_warehouse", "capacity positive", "capacity_units <= 0"), ("dim_warehouse", "x_warehouse", "coordinates valid", PT),
    ("dim_warehouse", "x_warehouse", "region present", "coalesce(trim(region), '') = ''"), ("dim_location", "x_location", "location_name present", "coalesce(trim(location_name), '') = ''"), ("dim_location", "x_location", "coordinates valid", PT)])
DAILY = " UNION ALL ".join(f"SELECT '{d}' AS dataset, cast({c} AS date) AS day, count(*) AS row_count FROM {T[d]} WHERE {c} IS NOT NULL GROUP BY 2" for d, c in (("orders", "order_date"), ("gps_tracking", "timestamp"), ("traffic", "timestamp"), ("delivery_updates", "event_timestamp")))
O["dq_row_anomaly"] = f"""SELECT dataset, day, row_count, {r("x * 1.0 / n", 4)} AS trailing_mean, {r("sqrt((n * xx - x * x) / nullif(cast(n * (n - 1) AS double), 0))", 4)} AS trailing_stddev,
 CASE WHEN n >= 7 AND (row_count * n - x) * (row_count * n - x) * (n - 1) > 9 * n * (n * xx - x * x) THEN 1 ELSE 0 END AS is_anomaly FROM (
SELECT *, sum(row_count) OVER w AS x, sum(row_count * row_count) OVER w AS xx, count(*) OVER w AS n FROM ({DAILY}) WINDOW w AS (PARTITION BY dataset ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""
O["dq_report"] = " UNION ALL ".join(O[k] for k in ("dq_not_blank", "dq_unique_keys", "dq_ranges", "dq_referential", "dq_binary_flags", "dq_non_negative", "dq_consistency"))
