"""Column contracts of the ten raw datasets and the event topics."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(spec: str) -> T.StructType:
    return T.StructType.fromDDL(spec)


# Dataset columns and types.
RAW = {
    "orders": _schema(
        "order_id string, customer_id string, warehouse_id string, driver_id string, vehicle_id string, "
        "order_date date, region string, order_status string, delivery_status string, order_value decimal(18,2), "
        "delivery_distance_km decimal(12,2), promised_delivery_time_min int, actual_delivery_time_min int"
    ),
    "customers": _schema(
        "customer_id string, customer_name string, region string, customer_type string, registration_date date"
    ),
    "drivers": _schema(
        "driver_id string, driver_name string, region string, experience_years int, rating decimal(4,2), "
        "employment_status string, license_type string"
    ),
    "vehicles": _schema(
        "vehicle_id string, vehicle_type string, driver_id string, fuel_type string, capacity_kg decimal(12,2), "
        "manufacture_year int, maintenance_status string, vehicle_status string, odometer_km decimal(14,2)"
    ),
    "warehouses": _schema(
        "warehouse_id string, warehouse_name string, region string, capacity_units int, latitude decimal(10,6), "
        "longitude decimal(10,6)"
    ),
    "gps_tracking": _schema(
        "vehicle_id string, timestamp timestamp_ntz, region string, latitude decimal(10,6), longitude decimal(10,6), "
        "speed_kmph decimal(10,2), heading decimal(6,2), vehicle_status string, ignition_status string, "
        "signal_quality string"
    ),
    "weather": _schema(
        "date date, location string, latitude decimal(10,6), longitude decimal(10,6), temperature_c decimal(8,2), "
        "humidity_pct decimal(8,2), rainfall_mm decimal(10,2), weather_condition string"
    ),
    "traffic": _schema(
        "timestamp timestamp_ntz, location string, latitude decimal(10,6), longitude decimal(10,6), "
        "traffic_score decimal(8,2), traffic_level string, average_speed_kmph decimal(10,2)"
    ),
    "roads": _schema(
        "road_id string, start_location string, end_location string, road_type string, distance_km decimal(10,2), "
        "lanes int, speed_limit_kmph int, road_condition string"
    ),
    "delivery_updates": _schema(
        "event_id string, order_id string, driver_id string, vehicle_id string, event_timestamp timestamp_ntz, "
        "region string, event_type string, delivery_status string, delay_minutes int, source string"
    ),
}

KEYS = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "drivers": ["driver_id"],
    "vehicles": ["vehicle_id"],
    "warehouses": ["warehouse_id"],
    "gps_tracking": ["vehicle_id", "timestamp"],
    "weather": ["date", "location"],
    "traffic": ["location", "timestamp"],
    "roads": ["road_id"],
    "delivery_updates": ["event_id"],
}

ORDER_EVENT = _schema(
    "order_id string, customer_id string, warehouse_id string, driver_id string, vehicle_id string, order_date string, "
    "region string, order_status string, delivery_status string, order_value double, delivery_distance_km double, "
    "promised_delivery_time_min int, actual_delivery_time_min int"
)
GPS_EVENT = _schema(
    "vehicle_id string, timestamp timestamp, region string, latitude double, longitude double, speed_kmph double, "
    "heading double, vehicle_status string, ignition_status string, signal_quality string"
)
UPDATE_EVENT = _schema(
    "event_id string, order_id string, driver_id string, vehicle_id string, event_timestamp timestamp, region string, "
    "event_type string, delivery_status string, delay_minutes int, source string"
)
TRAFFIC_EVENT = _schema(
    "timestamp timestamp, location string, latitude double, longitude double, traffic_score double, "
    "traffic_level string, average_speed_kmph double"
)
WEATHER_EVENT = _schema(
    "date string, location string, latitude double, longitude double, temperature_c double, humidity_pct double, "
    "rainfall_mm double, weather_condition string"
)
TOPICS = {
    "orders": ORDER_EVENT,
    "gps_tracking": GPS_EVENT,
    "delivery_updates": UPDATE_EVENT,
    "traffic_updates": TRAFFIC_EVENT,
    "weather_updates": WEATHER_EVENT,
}
REQUIRED_EVENT_FIELDS = {
    "orders": ["order_id", "customer_id", "warehouse_id", "order_date"],
    "gps_tracking": ["vehicle_id", "timestamp", "latitude", "longitude"],
}


def missing_columns(df, required) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df, required, dataset: str):
    """Fail before any job starts when columns are absent."""
    gone = missing_columns(df, required)
    if gone:
        raise ValueError(f"{dataset} is missing required columns: {', '.join(gone)}")
    return df
