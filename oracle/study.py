"""DuckDB SQL of profiles, exploratory summaries, feature tables and route analysis."""

from __future__ import annotations

from oracle.base import ORACLE, avg, dbl, even, n_if, r

O = ORACLE
BAD = n_if("latitude IS NULL OR longitude IS NULL OR abs(latitude) > 90 OR abs(longitude) > 180") + " AS invalid_coordinates"


def profile(src: str, sets: list[list[str]], cols: list[str]) -> str:
    parts = []
    for s in sets:
        label, group = "+".join(s) or "all", f" GROUP BY {', '.join(s)}" if s else ""
        text = " || '|' || ".join(f"coalesce(cast({c} AS varchar), 'NULL')" for c in s) or "'ALL'"
        parts.append(f"SELECT '{label}' AS profile, {text} AS profile_key, {', '.join(cols)} FROM {src}{group}")
    return "\nUNION ALL ".join(parts)


O["prof_customers"] = profile("lg_customers", [[], ["customer_type"], ["region"]], ["count(*) AS customer_count",
 r("avg(date_diff('day', registration_date, (SELECT max(registration_date) FROM lg_customers)))", 0) + " AS avg_customer_age_days"])
O["prof_drivers"] = profile("lg_drivers", [[], ["employment_status"], ["region"], ["license_type"]],
 ["count(*) AS driver_count", f"{avg('rating')} AS avg_rating", f"{avg('experience_years')} AS avg_experience_years"])
O["prof_gps"] = profile("lg_gps", [[], ["region"], ["vehicle_id"], ["signal_quality"], ["vehicle_status", "ignition_status"]],
 ["count(*) AS gps_records", f"{avg('speed_kmph')} AS avg_speed_kmph", "cast(max(speed_kmph) AS double) AS max_speed_kmph", BAD])
O["prof_orders"] = profile("lg_orders", [[], ["delivery_status"], ["region"]], ["count(*) AS total_orders", f"{avg('order_value')} AS avg_order_value", f"{avg('delivery_distance_km')} AS avg_distance_km"])
O["prof_traffic"] = profile("(SELECT *, strftime(timestamp, '%Y-%m-%d %H') AS hour_start FROM lg_traffic)", [[], ["traffic_level"], ["location"], ["hour_start"]],
 ["count(*) AS observations", f"{avg('traffic_score')} AS avg_traffic_score", f"{avg('average_speed_kmph')} AS avg_speed_kmph", BAD])
O["prof_vehicles"] = profile("lg_vehicles", [[], ["vehicle_type"], ["fuel_type"], ["maintenance_status"], ["vehicle_status"]],
 ["count(*) AS vehicle_count", f"{avg('capacity_kg')} AS avg_capacity_kg", f"{avg('odometer_km')} AS avg_odometer_km"])
O["prof_warehouses"] = profile("lg_warehouses", [[], ["region"], ["warehouse_id"]], ["count(*) AS warehouse_count", "cast(sum(capacity_units) AS bigint) AS total_capacity_units",
 f"{avg('capacity_units')} AS avg_capacity_units", "min(capacity_units) AS minimum_capacity", "max(capacity_units) AS maximum_capacity", f"{n_if('latitude IS NULL OR longitude IS NULL')} AS missing_coordinates"])
O["prof_weather"] = profile("lg_weather", [[], ["location"], ["weather_condition"]], ["count(*) AS observations", f"{avg('temperature_c')} AS avg_temperature_c", f"{avg('humidity_pct')} AS avg_humidity_pct",
 f"{avg('rainfall_mm')} AS avg_rainfall_mm", f"{dbl('rainfall_mm')} AS total_rainfall_mm", "cast(max(rainfall_mm) AS double) AS max_rainfall_mm", BAD])

# exploratory -----------------------------------------------------------------------------------------
# Columns of the raw tables, and which of them are numbers.
COLUMNS = {'orders': ('lg_orders',
            ['order_id', 'customer_id', 'warehouse_id', 'driver_id', 'vehicle_id', 'order_date', 'region', 'order_status',
             'delivery_status', 'order_value', 'delivery_distance_km', 'promised_delivery_time_min', 'actual_delivery_time_min']),
 'customers': ('lg_customers', ['customer_id', 'customer_name', 'region', 'customer_type', 'registration_date']),
 'drivers': ('lg_drivers', ['driver_id', 'driver_name', 'region', 'experience_years', 'rating', 'employment_status', 'license_type']),
 'vehicles': ('lg_vehicles',
              ['vehicle_id', 'vehicle_type', 'driver_id', 'fuel_type', 'capacity_kg', 'manufacture_year', 'maintenance_status',
               'vehicle_status', 'odometer_km']),
 'warehouses': ('lg_warehouses', ['warehouse_id', 'warehouse_name', 'region', 'capacity_units', 'latitude', 'longitude']),
 'gps_tracking': ('lg_gps',
                  ['vehicle_id', 'timestamp', 'region', 'latitude', 'longitude', 'speed_kmph', 'heading', 'vehicle_status',
                   'ignition_status', 'signal_quality']),
 'weather': ('lg_weather',
             ['date', 'location', 'latitude', 'longitude', 'temperature_c', 'humidity_pct', 'rainfall_mm', 'weather_condition']),
 'traffic': ('lg_traffic', ['timestamp', 'location', 'latitude', 'longitude', 'traffic_score', 'traffic_level', 'average_speed_kmph']),
 'roads': ('lg_roads',
           ['road_id', 'start_location', 'end_location', 'road_type', 'distance_km', 'lanes', 'speed_limit_kmph', 'road_condition']),
 'delivery_updates': ('lg_updates',
                      ['event_id', 'order_id', 'driver_id', 'vehicle_id', 'event_timestamp', 'region', 'event_type', 'delivery_status',
                       'delay_minutes', 'source'])}
NUMBERS = {'orders': ['order_value', 'delivery_distance_km', 'promised_delivery_time_min', 'actual_delivery_time_min'],
 'customers': [],
 'drivers': ['experience_years', 'rating'],
 'vehicles': ['capacity_kg', 'manufacture_year', 'odometer_km'],
 'warehouses': ['capacity_units', 'latitude', 'longitude'],
 'gps_tracking': ['latitude', 'longitude', 'speed_kmph', 'heading'],
 'weather': ['latitude', 'longitude', 'temperature_c', 'humidity_pct', 'rainfall_mm'],
 'traffic': ['latitude', 'longitude', 'traffic_score', 'average_speed_kmph'],
 'roads': ['distance_km', 'lanes', 'speed_limit_kmph'],
 'delivery_updates': ['delay_minutes']}


O["eda_dataset_summary"] = f"SELECT *, {r('missing_cells * 100.0 / greatest(rows * columns, 1)')} AS missing_cells_pct FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, count(*) AS rows, cast({len(s)} AS bigint) AS columns, cast({' + '.join(f'(count(*) - count({c}))' for c in s)} AS bigint) AS missing_cells, "
    f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS duplicate_rows FROM {t}" for n, (t, s) in COLUMNS.items()) + ")"
O["eda_missing_values"] = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, '{c}' AS column_name, count(*) - count({c}) AS missing_count, {r(f'(count(*) - count({c})) * 100.0 / greatest(count(*), 1)')} AS missing_pct FROM {t}"
    for n, (t, s) in COLUMNS.items() for c in s)
O["eda_numeric_summary"] = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, '{c}' AS column_name, count({c}) AS count, {r(f'cast(sum({c}) AS double) / nullif(count({c}), 0)', 6)} AS mean, "
    f"{r(f'stddev_samp(cast({c} AS double))', 6)} AS std, {r(f'min({c})', 6)} AS min, "
    + ", ".join(f"{r(f'quantile_cont(cast({c} AS double), 0.{q})', 6)} AS q{q}" for q in (25, 50, 75))
    + f", {r(f'max({c})', 6)} AS max FROM {t}" for n, (t, _) in COLUMNS.items() for c in NUMBERS[n])
DELAY = "actual_delivery_time_min - promised_delivery_time_min"
V, A0 = f"{dbl('order_value')} AS total_order_value", f"{avg('order_value', None)} AS average_order_value"
D0, LN = f"{avg(DELAY, None)} AS average_delay_min", f"{n_if(DELAY + ' > 0')} AS delayed_orders"
LP = r(f"count(*) FILTER (WHERE {DELAY} > 0) * 100.0 / count(order_id)")
K0 = f"{avg('delivery_distance_km', None)} AS average_distance_km"
N = "count(order_id) AS total_orders"
O["eda_orders_region"] = f"SELECT region, count(order_id) AS orders, {V}, {A0}, {K0}, {D0}, {LN} FROM lg_orders GROUP BY region"
O["eda_status_share"] = f"SELECT delivery_status, count(*) AS orders, {r('count(*) * 100.0 / (SELECT count(*) FROM lg_orders)')} AS order_share_pct FROM lg_orders GROUP BY 1"


def histogram(table: str, col: str) -> str:
    return f"""SELECT cast(b.bin AS int) AS bin, {r("lo + (hi - lo) / 30 * b.bin", 6)} AS bin_start, {r("lo + (hi - lo) / 30 * (b.bin + 1)", 6)} AS bin_end, count(v) AS observations
 FROM (SELECT unnest(range(30)) AS bin) b CROSS JOIN (SELECT min(cast({col} AS double)) AS lo, max(cast({col} AS double)) AS hi FROM {table}) e
 LEFT JOIN (SELECT cast({col} AS double) AS v FROM {table}) t ON least(floor((v - lo) * 30 / (hi - lo)), 29) = b.bin GROUP BY ALL"""


O["eda_order_value_histogram"] = histogram("lg_orders", "order_value")
O["eda_rain_histogram"] = histogram("lg_weather", "rainfall_mm")
O["ra_speed_histogram"] = histogram("lg_gps", "speed_kmph")
O["ra_traffic_histogram"] = histogram("lg_traffic", "traffic_score")
O["eda_distance_vs_delay"] = f"""SELECT cast(floor(x) AS int) AS distance_km_bin, count(*) AS orders, {avg("x")} AS average_distance_km, {avg("y")} AS average_delay_min,
 (SELECT {r("corr(cast(actual_delivery_time_min - promised_delivery_time_min AS double), cast(delivery_distance_km AS double))", 8)} FROM lg_orders) AS correlation
 FROM (SELECT delivery_distance_km AS x, {DELAY} AS y FROM lg_orders) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1"""
O["eda_customer_activity"] = f"SELECT customer_id, {N}, {V}, {A0}, {D0}, {LN} FROM lg_orders GROUP BY 1"
O["eda_customers_region"] = "SELECT region, count(DISTINCT customer_id) AS customers FROM lg_customers GROUP BY 1"
O["eda_driver_performance"] = f"""SELECT m.*, {r("100 - delay_rate_pct")} AS on_time_rate_pct, d.region FROM (SELECT driver_id, {N}, {V}, {A0}, {D0}, {LN}, {LP} AS delay_rate_pct FROM lg_orders GROUP BY 1) m
 LEFT JOIN lg_drivers d ON m.driver_id = d.driver_id"""
O["eda_warehouse_workload"] = f"""SELECT m.*, w.warehouse_name, w.region, w.capacity_units FROM (SELECT warehouse_id, {N}, {V}, {A0}, {avg(DELAY, None)} AS average_delivery_delay_min, {LN}, {LP} AS delay_rate_pct
 FROM lg_orders GROUP BY 1) m LEFT JOIN lg_warehouses w ON m.warehouse_id = w.warehouse_id"""
O["eda_weather_condition"] = f"""SELECT weather_condition, count(*) AS observations, {avg("temperature_c", None)} AS average_temperature_c, {avg("humidity_pct", None)} AS average_humidity_pct,
 {avg("rainfall_mm", None)} AS average_rainfall_mm FROM lg_weather GROUP BY 1"""
TL = f"SELECT location, count(*) AS observations, {avg('traffic_score', None)} AS average_traffic_score, {avg('average_speed_kmph', None)} AS average_speed_kmph FROM lg_traffic GROUP BY 1"
O["eda_traffic_location"] = TL
O["eda_traffic_level"] = "SELECT traffic_level, count(*) AS observations FROM lg_traffic GROUP BY 1"
SIG = "try_cast(trim(signal_quality) AS decimal(10,2))"
G, SP, SX, SQ = "count(*) AS gps_observations", f"{avg('speed_kmph', None)} AS average_speed_kmph", "cast(max(speed_kmph) AS double) AS maximum_speed_kmph", f"{avg(SIG, None)} AS average_signal_quality"
O["eda_gps_vehicle"] = f"SELECT vehicle_id, {G}, {SP}, {SX}, {SQ}, {n_if("lower(vehicle_status) = 'active'")} AS active_observations FROM lg_gps GROUP BY 1"
O["eda_delivery_events"] = f"SELECT event_type, count(*) AS events, {avg('delay_minutes', None)} AS average_delay_minutes FROM lg_updates GROUP BY 1"
O["eda_update_status"] = "SELECT delivery_status, count(*) AS events FROM lg_updates GROUP BY 1"

# features --------------------------------------------------------------------------------------------


def cal(c: str) -> str:
    return f"""cast(year({c}) AS int) AS feature_year, cast(month({c}) AS int) AS feature_month, cast(day({c}) AS int) AS feature_day, cast(isodow({c}) - 1 AS int) AS feature_day_of_week,
 dayname({c}) AS feature_day_name, cast(weekofyear({c}) AS int) AS feature_week_of_year, CASE WHEN isodow({c}) >= 6 THEN 1 ELSE 0 END AS feature_is_weekend"""


def cut(c: str, *pairs) -> str:
    body = " ".join(f"WHEN {c} <= {e} THEN '{label}'" for e, label in pairs[:-1])
    return f"CASE WHEN {c} IS NULL THEN NULL {body} ELSE '{pairs[-1]}' END"


BANDS = cut("delivery_distance_km", (5, "Short"), (15, "Medium"), (30, "Long"), (50, "Very Long"), "Extreme")
VAL, KMD = "cast(order_value AS double)", "cast(delivery_distance_km AS double)"
FEAT = f"""SELECT *, {DELAY} AS delivery_delay_min, CASE WHEN {DELAY} > 0 THEN 1 ELSE 0 END AS is_delayed, {cal("order_date")}, CASE WHEN day(order_date) = 1 THEN 1 ELSE 0 END AS feature_is_month_start,
 CASE WHEN day(order_date + 1) = 1 THEN 1 ELSE 0 END AS feature_is_month_end, {VAL} / nullif({KMD}, 0) AS order_value_per_km, {KMD} * {VAL} AS distance_value_interaction,
 {KMD} / nullif(cast(promised_delivery_time_min AS double), 0) * 60 AS planned_speed_kmph,
 {cut("order_value", (500, "Very Low"), (1000, "Low"), (2500, "Medium"), (5000, "High"), "Very High")} AS order_value_band, {BANDS} AS distance_band,
 {cut(f"({DELAY})", (0, "On Time"), (10, "Minor Delay"), (30, "Moderate Delay"), (60, "Severe Delay"), "Critical Delay")} AS delay_severity FROM lg_orders"""
O["feat_calendar"] = f"SELECT order_id, order_date, {cal('order_date')} FROM lg_orders"
O["feat_delivery"] = FEAT
SCORE = even("least(cast(least(coalesce(rainfall_mm, 0), 50) AS double) * 2 + cast(greatest(least(coalesce(humidity_pct, 0) - 70, 30), 0) AS double) / 3, 100)")
O["feat_delivery_weather"] = f"""SELECT *, {cut("weather_risk_score", (20, "Low"), (50, "Moderate"), (75, "High"), "Critical")} AS weather_risk_category FROM (
SELECT f.*, w.temperature_c, w.humidity_pct, w.rainfall_mm, w.weather_condition, CASE WHEN rainfall_mm > 0 THEN 1 ELSE 0 END AS is_rainy, CASE WHEN rainfall_mm >= 10 THEN 1 ELSE 0 END AS heavy_rain_flag,
 CASE WHEN humidity_pct >= 80 THEN 1 ELSE 0 END AS high_humidity_flag, {SCORE} AS weather_risk_score
FROM ({FEAT}) f LEFT JOIN lg_weather w ON f.order_date = w.date AND lower(f.region) = lower(w.location))"""
O["feat_gps"] = f"""SELECT * EXCLUDE (signal_quality, s), s AS signal_quality, CASE WHEN coalesce(s, 0) < 50 THEN 1 ELSE 0 END AS is_low_signal,
 {cut("s", (30, "Poor"), (60, "Fair"), (80, "Good"), "Excellent")} AS signal_quality_band FROM (
SELECT *, {cal("timestamp")}, cast(hour(timestamp) AS int) AS gps_hour, CASE WHEN hour(timestamp) IN (7, 8, 9, 17, 18, 19, 20) THEN 1 ELSE 0 END AS is_peak_hour,
 CASE WHEN speed_kmph > 3 THEN 1 ELSE 0 END AS is_moving, CASE WHEN speed_kmph > 80 THEN 1 ELSE 0 END AS is_high_speed,
 {cut("speed_kmph", (3, "Stationary"), (20, "Slow"), (50, "Normal"), (80, "Fast"), "Very Fast")} AS speed_band, try_cast(trim(signal_quality) AS double) AS s,
 CASE WHEN lower(vehicle_status) = 'active' AND lower(ignition_status) IN ('on', '1', 'true') THEN 1 ELSE 0 END AS is_active_vehicle FROM lg_gps)"""
DR = f"cast(count(*) FILTER (WHERE {DELAY} > 0) AS double) / count(order_id) AS delay_rate"
O["feat_customer"] = f"""SELECT *, 1 - delay_rate AS on_time_rate, cast(date_diff('day', first_order_date, last_order_date) AS int) AS customer_lifetime_days,
 {cut("total_order_value", (5000, "Low"), (20000, "Medium"), (50000, "High"), "Very High")} AS customer_value_segment,
 {cut("total_orders", (1, "One-Time"), (3, "Occasional"), (8, "Frequent"), (15, "Highly Frequent"), "Very Highly Frequent")} AS customer_frequency_segment FROM (
SELECT customer_id, {N}, {V}, {A0}, {K0}, {D0}, {LN}, {DR}, min(order_date) AS first_order_date, max(order_date) AS last_order_date, count(DISTINCT order_date) AS active_order_days FROM lg_orders GROUP BY 1)"""
O["feat_driver"] = f"""SELECT *, CASE WHEN on_time_rate >= 0.90 AND average_delay_min < 10 THEN 'High Performer' WHEN on_time_rate >= 0.75 AND average_delay_min < 20 THEN 'Good Performer'
 WHEN on_time_rate >= 0.50 AND average_delay_min < 30 THEN 'Needs Improvement' ELSE 'High Risk' END AS driver_performance_category FROM (
SELECT *, 1 - delay_rate AS on_time_rate FROM (SELECT driver_id, {N}, {V}, {A0}, {K0}, {D0}, {LN}, {DR} FROM lg_orders GROUP BY 1))"""
O["feat_warehouse"] = f"""SELECT * EXCLUDE (k, n), CASE WHEN k <= 1 + (n - 1) * 0.25 THEN 'Low' WHEN k <= 1 + (n - 1) * 0.5 THEN 'Medium' WHEN k <= 1 + (n - 1) * 0.75 THEN 'High' ELSE 'Very High' END AS workload_segment FROM (
SELECT *, row_number() OVER (ORDER BY total_orders, warehouse_id) AS k, count(*) OVER () AS n FROM (SELECT warehouse_id, {N}, {V}, {A0}, {D0}, {LN}, {DR} FROM lg_orders GROUP BY 1))"""

# Type of every feature column.
FEATURE_TYPES = {
    "feat_delivery_weather": {
        "string": [
            "order_id", "customer_id", "warehouse_id", "driver_id", "vehicle_id", "region", "order_status", "delivery_status",
            "feature_day_name", "order_value_band", "distance_band", "delay_severity", "weather_condition", "weather_risk_category",
        ],
        "date": ["order_date"], "decimal(18,2)": ["order_value"], "decimal(12,2)": ["delivery_distance_km"],
        "decimal(8,2)": ["temperature_c", "humidity_pct"], "decimal(10,2)": ["rainfall_mm"],
        "double": ["order_value_per_km", "distance_value_interaction", "planned_speed_kmph", "weather_risk_score"],
        "int": [
            "promised_delivery_time_min", "actual_delivery_time_min", "delivery_delay_min", "is_delayed", "feature_year", "feature_month",
            "feature_day", "feature_day_of_week", "feature_week_of_year", "feature_is_weekend", "feature_is_month_start",
            "feature_is_month_end", "is_rainy", "heavy_rain_flag", "high_humidity_flag",
        ],
    },
    "feat_gps": {
        "string": ["vehicle_id", "region", "vehicle_status", "ignition_status", "feature_day_name", "speed_band", "signal_quality_band"],
        "timestamp_ntz": ["timestamp"], "decimal(10,6)": ["latitude", "longitude"], "decimal(10,2)": ["speed_kmph"],
        "decimal(6,2)": ["heading"], "double": ["signal_quality"],
        "int": [
            "feature_year", "feature_month", "feature_day", "feature_day_of_week", "feature_week_of_year", "feature_is_weekend", "gps_hour",
            "is_peak_hour", "is_moving", "is_high_speed", "is_low_signal", "is_active_vehicle",
        ],
    },
    "feat_customer": {
        "string": ["customer_id", "customer_value_segment", "customer_frequency_segment"],
        "bigint": ["total_orders", "delayed_orders", "active_order_days"],
        "double": ["total_order_value", "average_order_value", "average_distance_km", "average_delay_min", "delay_rate", "on_time_rate"],
        "date": ["first_order_date", "last_order_date"], "int": ["customer_lifetime_days"],
    },
    "feat_driver": {
        "string": ["driver_id", "driver_performance_category"], "bigint": ["total_orders", "delayed_orders"],
        "double": ["total_order_value", "average_order_value", "average_delay_min", "average_distance_km", "delay_rate", "on_time_rate"],
    },
}
FEATURE_SETS = {
    "feat_delivery_weather": "delivery_features", "feat_gps": "gps_features", "feat_customer": "customer_features", "feat_driver": "driver_features",
}
O["feat_summary"] = " UNION ALL ".join(
    f"SELECT '{FEATURE_SETS[q]}' AS feature_dataset, '{c}' AS feature_name, '{kind}' AS data_type, count(*) AS rows, count(*) - count({c}) AS missing_count, "
    f"{r(f'(count(*) - count({c})) * 100.0 / count(*)')} AS missing_pct, count(DISTINCT {c}) AS unique_values FROM ({O[q]})"
    for q, kinds in FEATURE_TYPES.items() for kind, columns in kinds.items() for c in columns)

# route analysis --------------------------------------------------------------------------------------
MV = f"{n_if('speed_kmph > 3')} AS moving_observations"
MP = r("count(*) FILTER (WHERE speed_kmph > 3) * 100.0 / count(*)") + " AS moving_share_pct"
WK = f"coalesce({SIG}, 0) < 50"
O["ra_gps_vehicle"] = f"SELECT vehicle_id, {G}, {SP}, {SX}, {SQ}, {MV}, {n_if(WK)} AS low_signal_observations, {MP}, {r(f'count(*) FILTER (WHERE {WK}) * 100.0 / count(*)')} AS low_signal_share_pct FROM lg_gps GROUP BY 1"
O["ra_gps_region"] = f"SELECT region, {G}, {SP}, {SQ}, {MV}, {MP} FROM lg_gps GROUP BY 1"
LEVEL = lambda c: cut(c, (25, "Low"), (50, "Moderate"), (75, "High"), "Critical")
O["ra_traffic_location"] = f"SELECT *, {LEVEL('average_traffic_score')} AS traffic_level FROM ({TL})"
S, TK, AK, SL = "count(DISTINCT road_id) AS road_segments", f"{dbl('distance_km')} AS total_distance_km", f"{avg('distance_km', None)} AS average_distance_km", f"{avg('speed_limit_kmph', None)} AS average_speed_limit_kmph"
O["ra_road_condition"] = f"SELECT road_condition, {S}, {TK}, {SL} FROM lg_roads GROUP BY 1"
O["ra_road_type"] = f"SELECT road_type, {S}, {TK}, {AK}, {SL} FROM lg_roads GROUP BY 1"
O["ra_road_overview"] = f"SELECT {S}, {TK}, {AK}, {avg('lanes', None)} AS average_lanes, {SL} FROM lg_roads"
O["ra_distance_bands"] = f"""SELECT b.distance_band, count(order_id) AS orders, {avg("delivery_distance_km", None)} AS average_distance_km, coalesce({dbl("order_value")}, 0) AS total_order_value, {A0}, {D0}, {LN},
 {r(f"count(*) FILTER (WHERE {DELAY} > 0) * 100.0 / nullif(count(order_id), 0)")} AS delay_rate_pct
 FROM (VALUES ('Short'), ('Medium'), ('Long'), ('Very Long'), ('Extreme')) b(distance_band) LEFT JOIN (SELECT *, {BANDS} AS band FROM lg_orders) o ON o.band = b.distance_band GROUP BY 1"""
CLIP = lambda c, hi: f"least(greatest({c}, 0.0), {hi}.0)"
RISK = even(CLIP(f"{CLIP('coalesce(average_traffic_score, (SELECT median(average_traffic_score) FROM t))', 100)} * 0.5 + {CLIP('coalesce(average_delivery_delay_min, 0)', 60)} / 60 * 100 * 0.3 + (100 - {CLIP('coalesce(average_signal_quality, 100)', 100)}) * 0.2", 100))
O["ra_region_risk"] = f"""SELECT *, {LEVEL("route_risk_score")} AS route_risk_category FROM (
WITH t AS (SELECT location AS region, count(*) AS traffic_observations, {avg("traffic_score", None)} AS average_traffic_score, {avg("average_speed_kmph", None)} AS average_traffic_speed_kmph FROM lg_traffic GROUP BY 1)
SELECT *, {RISK} AS route_risk_score FROM (SELECT region, {G}, {avg("speed_kmph", None)} AS average_gps_speed_kmph, {SQ} FROM lg_gps GROUP BY 1) g FULL JOIN t USING (region)
 FULL JOIN (SELECT region, count(order_id) AS orders, {avg("delivery_distance_km", None)} AS average_delivery_distance_km, {avg(DELAY, None)} AS average_delivery_delay_min, {LN}, {LP} AS delay_rate_pct FROM lg_orders GROUP BY 1) o USING (region))"""
O["ra_summary"] = """SELECT (SELECT count(DISTINCT vehicle_id) FROM lg_gps) AS vehicles_analyzed, (SELECT count(*) FROM lg_gps) AS gps_observations,
 (SELECT count(DISTINCT location) FROM lg_traffic) AS traffic_locations_analyzed, (SELECT count(DISTINCT road_id) FROM lg_roads) AS road_segments_available, count(*) AS orders_analyzed FROM lg_orders"""
