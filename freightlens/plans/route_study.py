"""Route analysis by vehicle, region, road and distance band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_even, largest, mean, ratio, rows, rows_if, total
from freightlens.functions.rules import KM_CUT, SCORE_CUT_25, upto
from freightlens.operators.profile import histogram
from freightlens.plans.eda import SIGNAL, known
from freightlens.registry import query

MOVING = F.col("speed_kmph") > 3
WEAK = F.coalesce(SIGNAL, F.lit(0)) < 50
PINGS = rows("gps_observations")
SPEED = mean("speed_kmph", "average_speed_kmph", None)
QUALITY = mean(SIGNAL, "average_signal_quality", None)
MOVES = rows_if(MOVING, "moving_observations")
MOVE_PCT = ratio("moving_observations", "gps_observations", 2, 100)

query("ra_gps_vehicle")(
    lambda lake: known(lake.gps_tracking, "vehicle_id").groupBy("vehicle_id").agg(
        PINGS, SPEED, largest("speed_kmph", "maximum_speed_kmph"), QUALITY, MOVES, rows_if(WEAK, "low_signal_observations")
    ).withColumns(
        {"moving_share_pct": MOVE_PCT, "low_signal_share_pct": ratio("low_signal_observations", "gps_observations", 2, 100)}
    ).orderBy(F.desc("average_speed_kmph"), "vehicle_id")
)
query("ra_gps_region")(
    lambda lake: known(lake.gps_tracking, "region").groupBy("region").agg(PINGS, SPEED, QUALITY, MOVES).withColumn(
        "moving_share_pct", MOVE_PCT
    ).orderBy(F.desc("average_speed_kmph"), "region")
)
query("ra_speed_histogram")(lambda lake: histogram(lake.gps_tracking, "speed_kmph").orderBy("bin"))
query("ra_traffic_histogram")(lambda lake: histogram(lake.traffic, "traffic_score").orderBy("bin"))
query("ra_traffic_location")(
    lambda lake: known(lake.traffic, "location").groupBy("location").agg(
        rows("observations"), mean("traffic_score", "average_traffic_score", None), mean("average_speed_kmph", "average_speed_kmph", None)
    ).withColumn("traffic_level", upto("average_traffic_score", SCORE_CUT_25)).orderBy(F.desc("average_traffic_score"), "location")
)
SEGMENTS = F.count_distinct("road_id").alias("road_segments")
LENGTH = total("distance_km", "total_distance_km")
MEAN_LENGTH = mean("distance_km", "average_distance_km", None)
LIMIT = mean("speed_limit_kmph", "average_speed_limit_kmph", None)
query("ra_road_condition")(
    lambda lake: known(lake.roads, "road_condition").groupBy("road_condition").agg(SEGMENTS, LENGTH, LIMIT).orderBy(
        F.desc("road_segments"), "road_condition"
    )
)
query("ra_road_type")(
    lambda lake: known(lake.roads, "road_type").groupBy("road_type").agg(SEGMENTS, LENGTH, MEAN_LENGTH, LIMIT).orderBy(
        F.desc("road_segments"), "road_type"
    )
)
query("ra_road_overview")(lambda lake: lake.roads.agg(SEGMENTS, LENGTH, MEAN_LENGTH, mean("lanes", "average_lanes", None), LIMIT))

DELAY = F.col("actual_delivery_time_min") - F.col("promised_delivery_time_min")


@query("ra_distance_bands")
def distance_bands(lake):
    """All five bands, also those without an order."""
    labels = [label for _, label in KM_CUT]
    bands = lake.spark.range(len(labels)).select(
        F.col("id").cast("int").alias("_i"), F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("id").cast("int") + 1).alias("distance_band")
    )
    m = lake.orders.groupBy(upto("delivery_distance_km", KM_CUT).alias("distance_band")).agg(
        F.count("order_id").alias("_n"), mean("delivery_distance_km", "average_distance_km", None), total("order_value", "_v"),
        mean("order_value", "average_order_value", None), mean(DELAY, "average_delay_min", None), rows_if(DELAY > 0, "_l"),
    )
    return bands.join(m, "distance_band", "left").orderBy("_i").select(
        "distance_band", F.coalesce("_n", F.lit(0)).alias("orders"), "average_distance_km",
        F.coalesce("_v", F.lit(0.0)).alias("total_order_value"), "average_order_value", "average_delay_min",
        F.coalesce("_l", F.lit(0)).alias("delayed_orders"), ratio("_l", "_n", 2, 100).alias("delay_rate_pct"),
    )


def region_risk(gps: DataFrame, traffic: DataFrame, orders: DataFrame) -> DataFrame:
    """Regions seen in GPS, traffic or orders, with a 0-100 risk score."""
    g = known(gps, "region").groupBy("region").agg(PINGS, mean("speed_kmph", "average_gps_speed_kmph", None), QUALITY)
    t = known(traffic, "location").groupBy(F.col("location").alias("region")).agg(
        rows("traffic_observations"), mean("traffic_score", "average_traffic_score", None),
        mean("average_speed_kmph", "average_traffic_speed_kmph", None),
    )
    o = known(orders, "region").groupBy("region").agg(
        F.count("order_id").alias("orders"), mean("delivery_distance_km", "average_delivery_distance_km", None),
        mean(DELAY, "average_delivery_delay_min", None), rows_if(DELAY > 0, "delayed_orders"),
    ).withColumn("delay_rate_pct", ratio("delayed_orders", "orders", 2, 100))
    typical = t.agg(F.median("average_traffic_score").alias("m")).scalar()
    clip = lambda c, hi: F.least(F.greatest(c, F.lit(0.0)), F.lit(float(hi)))
    jam = clip(F.coalesce("average_traffic_score", typical), 100) * 0.50
    late = clip(F.coalesce("average_delivery_delay_min", F.lit(0.0)), 60) / 60 * 100 * 0.30
    weak = (100 - clip(F.coalesce("average_signal_quality", F.lit(100.0)), 100)) * 0.20
    return (
        g.join(t, "region", "outer").join(o, "region", "outer")
        .withColumn("route_risk_score", half_even(clip(jam + late + weak, 100), 2))
        .withColumn("route_risk_category", upto("route_risk_score", SCORE_CUT_25))
    )


query("ra_region_risk")(
    lambda lake: region_risk(lake.gps_tracking, lake.traffic, lake.orders).orderBy(F.desc("route_risk_score"), "region")
)


@query("ra_summary")
def summary(lake):
    one = lambda df, expr: df.agg(expr.alias("v")).scalar()
    per_vehicle = known(lake.gps_tracking, "vehicle_id").groupBy("vehicle_id").agg(rows("n"))
    places = known(lake.traffic, "location").select("location").distinct()
    segments = known(lake.roads, "road_id").select("road_id").distinct()
    return lake.orders.agg(rows("orders_analyzed")).select(
        one(per_vehicle, F.count("vehicle_id")).alias("vehicles_analyzed"),
        F.coalesce(one(per_vehicle, F.sum("n")), F.lit(0)).alias("gps_observations"),
        one(places, F.count("location")).alias("traffic_locations_analyzed"),
        one(segments, F.count("road_id")).alias("road_segments_available"), "orders_analyzed",
    )
