"""Data-quality operators: each returns counts of failing rows, none stops the run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.measures import half_up, ratio, rows
from freightlens.functions.rules import flag, is_blank
from freightlens.operators.profile import column_counts
from freightlens.registry import query
from freightlens.sources.schemas import KEYS

# Identifier columns that must be filled, and accepted ranges, as published.
FILLED = {
    "orders": ["order_id", "customer_id", "warehouse_id", "driver_id", "vehicle_id"],
    "customers": ["customer_id", "customer_type", "region"],
    "drivers": ["driver_id"],
    "vehicles": ["vehicle_id", "driver_id"],
    "warehouses": ["warehouse_id"],
    "delivery_updates": ["event_id", "order_id", "driver_id", "vehicle_id"],
}
RANGES = {
    "orders": [
        ("order_value", 0, None), ("delivery_distance_km", 0, None), ("promised_delivery_time_min", 0, None),
        ("actual_delivery_time_min", 0, None),
    ],
    "drivers": [("rating", 0, 5), ("experience_years", 0, None)],
    "vehicles": [("capacity_kg", "above 0", None), ("odometer_km", 0, None), ("manufacture_year", 1900, 2100)],
    "warehouses": [("latitude", -90, 90), ("longitude", -180, 180), ("capacity_units", "above 0", None)],
    "gps_tracking": [
        ("latitude", -90, 90), ("longitude", -180, 180), ("speed_kmph", 0, None), ("heading", 0, 360), ("heading", 0, "below 360"),
    ],
    "weather": [("latitude", -90, 90), ("longitude", -180, 180), ("humidity_pct", 0, 100), ("rainfall_mm", 0, None)],
    "traffic": [("traffic_score", 0, 100), ("average_speed_kmph", 0, None)],
    "roads": [("distance_km", "above 0", None), ("lanes", "above 0", None), ("speed_limit_kmph", "above 0", None)],
    "delivery_updates": [("delay_minutes", 0, None)],
}
REFERENCES = [
    ("orders", "customer_id", "customers"), ("orders", "warehouse_id", "warehouses"), ("orders", "driver_id", "drivers"),
    ("orders", "vehicle_id", "vehicles"), ("delivery_updates", "order_id", "orders"), ("delivery_updates", "driver_id", "drivers"),
    ("delivery_updates", "vehicle_id", "vehicles"), ("vehicles", "driver_id", "drivers"),
]
LONG = ["dataset", "rule", "failed", "total"]


def rule_counts(df: DataFrame, dataset: str, rules: dict[str, Column]) -> DataFrame:
    """(dataset, rule, failed, total): all rules of one table in one aggregate."""
    names = list(rules)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(rules[n]).alias(f"_r{i}") for i, n in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").alias("failed")) for i, n in enumerate(names)])
    return one.select(F.lit(dataset).alias("dataset"), F.inline(cells), F.col("_n").alias("total")).select(*LONG)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def blank_rules(t: str) -> dict[str, Column]:
    return {f"{c} not blank": is_blank(c) for c in FILLED.get(t, [])}


def range_rules(t: str) -> dict[str, Column]:
    return dict(out_of_range(*spec) for spec in RANGES.get(t, []))


def not_blank(tables) -> DataFrame:
    return union([rule_counts(tables[t], t, blank_rules(t)) for t in FILLED])


def duplicate_keys(tables) -> DataFrame:
    """Keys that occur more than once; partial aggregation keeps a key with many copies cheap."""
    parts = []
    for t, keys in KEYS.items():
        per = tables[t].groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
        parts.append(
            per.agg(F.count_if(F.col("_c") > 1).alias("failed"), F.count(F.lit(1)).alias("total")).select(
                F.lit(t).alias("dataset"), F.lit(f"{'+'.join(keys)} unique").alias("rule"), "failed", "total"
            )
        )
    return union(parts)


def out_of_range(c: str, low, high) -> tuple[str, Column]:
    """Rule name and the test that fails for NULL, too small or too large values."""
    v = F.col(c)
    bad = v.isNull()
    text = [c]
    if isinstance(low, str):
        bad, text = bad | (v <= 0), text + ["> 0"]
    elif low is not None:
        bad, text = bad | (v < low), text + [f">= {low}"]
    if isinstance(high, str):
        bad, text = bad | (v >= int(high.split()[1])), text + [f"< {high.split()[1]}"]
    elif high is not None:
        bad, text = bad | (v > high), text + [f"<= {high}"]
    return " ".join(text), bad


def ranges(tables) -> DataFrame:
    return union([rule_counts(tables[t], t, range_rules(t)) for t in RANGES])


def referential(tables) -> DataFrame:
    """Rows whose reference has no master row."""
    used = {t: tables[t] for t in tables if any(t in (child, parent) for child, _, parent in REFERENCES)}
    masters = {parent: KEYS[parent] for _, _, parent in REFERENCES}
    return one_pass(used, {}, masters, REFERENCES).filter(F.col("rule").contains(" in "))


def population(source: DataFrame, processed: dict[str, DataFrame], key: str) -> DataFrame:
    """Ids lost and ids invented between the source and each processed table.

    Every table is scanned once: rows are counted per id and table, and the counts of an id meet in one row.
    """
    names = list(processed)
    every = union([df.select(F.lit(i).alias("_t"), F.col(key).cast("string").alias("_id")) for i, df in enumerate([source, *processed.values()])])
    counts = every.groupBy("_id").agg(*[F.count_if(F.col("_t") == i).alias(f"_n{i}") for i in range(len(names) + 1)])
    cells = [
        F.struct(
            F.lit(name).alias("dataset"), ((F.col("_n0") > 0) & (F.col(f"_n{i}") == 0)).cast("long").alias("lost"),
            ((F.col("_n0") == 0) & (F.col(f"_n{i}") > 0)).cast("long").alias("added"), F.col("_n0").alias("s"), F.col(f"_n{i}").alias("p"),
        )
        for i, name in enumerate(names, 1)
    ]
    empty = source.sparkSession.createDataFrame([(name, 0, 0, 0, 0) for name in names], "dataset string, lost long, added long, s long, p long")
    return counts.select(F.inline(F.array(*cells))).union(empty).groupBy("dataset").agg(
        F.sum("lost").alias("ids_lost"), F.sum("added").alias("ids_added"), F.sum("s").alias("source_rows"), F.sum("p").alias("processed_rows")
    )


def population(source: DataFrame, processed: dict[str, DataFrame], key: str) -> DataFrame:
    """Ids lost and ids invented between the source and each processed table."""
    src = source.select(key).distinct()
    parts = []
    for name, df in processed.items():
        ids = df.select(key).distinct()
        both = src.withColumn("_s", F.lit(1)).join(ids.withColumn("_p", F.lit(1)), key, "full")
        parts.append(
            both.agg(F.count_if(F.col("_p").isNull()).alias("ids_lost"), F.count_if(F.col("_s").isNull()).alias("ids_added")).select(
                F.lit(name).alias("dataset"), "ids_lost", "ids_added", source.agg(F.count(F.lit(1))).scalar().alias("source_rows"),
                df.agg(F.count(F.lit(1))).scalar().alias("processed_rows"),
            )
        )
    return union(parts)


FLAGS = {
    "orders_clean": ["is_delayed"], "gps_clean": ["is_moving", "is_low_signal"],
    "weather_clean": ["is_rainy", "heavy_rain_flag", "high_humidity_flag"], "delivery_features": ["is_delayed"],
}
NON_NEGATIVE = {
    "orders_clean": ["order_value", "delivery_distance_km", "delivery_delay_min", "delivery_per_km_value"],
    "gps_clean": ["speed_kmph"], "weather_clean": ["rainfall_mm"],
}


def flag_rules(t: str) -> dict[str, Column]:
    return {f"{c} in 0,1": F.col(c).isNull() | ~F.col(c).isin(0, 1) for c in FLAGS.get(t, [])}


def sign_rules(t: str) -> dict[str, Column]:
    return {f"{c} not negative": F.col(c).isNull() | (F.col(c) < 0) for c in NON_NEGATIVE.get(t, [])}


def binary_flags(processed) -> DataFrame:
    return union([rule_counts(processed[t], t, flag_rules(t)) for t in FLAGS])


def non_negative(processed) -> DataFrame:
    return union([rule_counts(processed[t], t, sign_rules(t)) for t in NON_NEGATIVE])


def empty_columns(processed) -> DataFrame:
    parts = [
        column_counts(df, t).select(
            "dataset", F.concat("column_name", F.lit(" not empty")).alias("rule"),
            ((F.col("filled") == 0) & (F.col("rows") > 0)).cast("long").alias("failed"), F.col("rows").alias("total"),
        )
        for t, df in processed.items()
    ]
    return union(parts)


def consistency(fact_delivery: DataFrame) -> DataFrame:
    delay = F.col("actual_delivery_time_min") - F.col("promised_delivery_time_min")
    return rule_counts(
        fact_delivery, "fact_delivery",
        {
            "delay is actual minus promised": F.col("delivery_delay_min") != delay,
            "is_delayed agrees with delay": F.col("is_delayed") != flag(F.col("delivery_delay_min") > 0),
            "on_time_flag is the opposite of is_delayed": F.col("on_time_flag") + F.col("is_delayed") != 1,
            "times not negative": (F.col("promised_delivery_time_min") < 0) | (F.col("actual_delivery_time_min") < 0),
            "distance not negative": F.col("delivery_distance_km") < 0,
        },
    )


def calendar(dim_date: DataFrame) -> DataFrame:
    def twice(c):
        g = dim_date.groupBy(c).agg(F.count(F.lit(1)).alias("_c"))
        return g.agg(F.count_if(F.col("_c") > 1)).scalar()

    ends = dim_date.agg(F.min("full_date").alias("a"), F.max("full_date").alias("b"))
    expected = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("full_date"))
    missing = expected.join(dim_date, "full_date", "left_anti").agg(F.count(F.lit(1))).scalar()
    return dim_date.agg(
        rows("calendar_days"), F.count_if(~F.col("month_number").between(1, 12)).alias("invalid_months"),
        F.count_if(~F.col("quarter_number").between(1, 4)).alias("invalid_quarters"),
        F.count_if(F.col("is_weekend") != (F.col("day_of_week") >= 6)).alias("invalid_weekend_flags"),
    ).select(
        "calendar_days", twice("full_date").alias("duplicate_dates"), twice("date_key").alias("duplicate_keys"),
        missing.alias("missing_days"), "invalid_months", "invalid_quarters", "invalid_weekend_flags",
    )


def dimensions(dims, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    bad_point = (F.col("latitude").isNotNull() & ~F.col("latitude").between(-90, 90)) | (
        F.col("longitude").isNotNull() & ~F.col("longitude").between(-180, 180)
    )
    year = F.col("manufacture_year")
    spec = {
        "customer": {"customer_id present": is_blank("customer_id"), "registration not in the future": F.col("registration_date") > day},
        "driver": {
            "driver_id present": is_blank("driver_id"), "experience not negative": F.col("experience_years") < 0,
            "rating within 0..5": ~F.col("rating").between(0, 5),
        },
        "vehicle": {
            "vehicle_id present": is_blank("vehicle_id"), "capacity positive": F.col("capacity_kg") <= 0,
            "odometer not negative": F.col("odometer_km") < 0, "manufacture year plausible": (year < 1900) | (year > F.year(day) + 1),
        },
        "warehouse": {
            "warehouse_id present": is_blank("warehouse_id"), "capacity positive": F.col("capacity_units") <= 0,
            "coordinates valid": bad_point, "region present": is_blank("region"),
        },
        "location": {"location_name present": is_blank("location_name"), "coordinates valid": bad_point},
    }
    return union([rule_counts(dims[d], f"dim_{d}", rules) for d, rules in spec.items()])


def row_anomalies(tables: dict[str, tuple[DataFrame, str]], window_days: int = 7, sigmas: float = 3.0) -> DataFrame:
    """Daily row counts that leave the trailing mean of the last days by more than some standard deviations.

    The test compares integers (squares of sums), so equality at the limit is exact.
    """
    parts = [
        df.groupBy(F.col(c).cast("date").alias("day")).agg(rows("row_count")).select(F.lit(t).alias("dataset"), "day", "row_count")
        for t, (df, c) in tables.items()
    ]
    daily = union(parts).filter(F.col("day").isNotNull())
    w = Window.partitionBy("dataset").orderBy("day").rowsBetween(-window_days, -1)
    n, x = F.count("row_count").over(w), F.sum("row_count").over(w)
    xx = F.sum(F.col("row_count") * F.col("row_count")).over(w)
    d = daily.withColumns({"_n": n, "_x": x, "_var": n * xx - x * x})
    gap = F.col("row_count") * F.col("_n") - F.col("_x")
    odd = (F.col("_n") >= window_days) & (gap * gap * (F.col("_n") - 1) > F.lit(sigmas * sigmas) * F.col("_n") * F.col("_var"))
    spread = F.sqrt(ratio("_var", F.col("_n") * (F.col("_n") - 1)))
    return d.select(
        "dataset", "day", "row_count", ratio("_x", "_n", 4).alias("trailing_mean"), half_up(spread, 4).alias("trailing_stddev"),
        flag(odd).alias("is_anomaly"),
    )


def processed_tables(lake) -> dict[str, DataFrame]:
    return {
        "orders_clean": lake.orders_clean, "gps_clean": lake.gps_clean, "weather_clean": lake.weather_clean,
        "delivery_features": lake.features,
    }


def one_pass(tables: dict[str, DataFrame], rules: dict[str, dict[str, Column]], keys: dict[str, list[str]], references: list[tuple[str, str, str]]) -> DataFrame:
    """Row rules, unique keys and references of all tables: every table is scanned once, and nothing is joined.

    A row gives one entry per key it defines, one per id it refers to, and one with the pattern of row rules it breaks.
    Entries are counted by (domain, value), map-side first, so a hot id is one entry per task: an id that no row defines is
    lost for every rule that refers to it, and a key defined more than once is not unique.
    """
    entry = "array<struct<domain:string,value:string,said:int>>"  # said: the reference's number, or -1 where the row defines the value
    parts = []
    for t, df in tables.items():
        broken = F.concat(F.lit(""), *[F.when(bad, "1").otherwise("0") for bad in rules.get(t, {}).values()])
        entries = [F.struct(F.lit(f"rules of {t}").alias("domain"), broken.alias("value"), F.lit(-1).alias("said"))]
        if t in keys:
            value = F.col(keys[t][0]).cast("string") if len(keys[t]) == 1 else F.to_json(F.struct(*keys[t]), {"ignoreNullFields": "false"})
            entries.append(F.struct(F.lit(t).alias("domain"), value.alias("value"), F.lit(-1).alias("said")))
        entries += [
            F.struct(F.lit(parent).alias("domain"), F.col(column).cast("string").alias("value"), F.lit(i).alias("said"))
            for i, (child, column, parent) in enumerate(references) if child == t
        ]
        parts.append(df.select(F.inline(F.array(*entries).cast(entry))))
    numbers = range(len(references))
    met = union(parts).groupBy("domain", "value").agg(F.count_if(F.col("said") == -1).alias("made"), *[F.count_if(F.col("said") == i).alias(f"r{i}") for i in numbers])
    unknown = F.col("value").isNull() | (F.col("made") == 0)
    marks = [(t, i, name) for t, given in rules.items() if t in tables for i, name in enumerate(given)]
    sums = {}
    for t in tables:
        if t in keys:
            there = (F.col("domain") == t) & (F.col("made") > 0)
            sums[t, f"{'+'.join(keys[t])} unique"] = F.count_if(there & (F.col("made") > 1)), F.count_if(there)
    for i, (child, column, parent) in enumerate(references):
        n = F.when(F.col("domain") == parent, F.col(f"r{i}"))
        sums[child, f"{column} in {parent}"] = F.sum(F.when(unknown, n)), F.sum(n)
    for t, i, name in marks:
        n = F.when(F.col("domain") == f"rules of {t}", F.col("made"))
        sums[t, name] = F.sum(F.when(F.substring("value", i + 1, 1) == "1", n)), F.sum(n)
    one = met.agg(*[F.coalesce(x, F.lit(0)).alias(f"{k}{i}") for i, pair in enumerate(sums.values()) for k, x in zip("ft", pair)])
    cells = [F.struct(F.lit(t).alias("dataset"), F.lit(name).alias("rule"), F.col(f"f{i}").alias("failed"), F.col(f"t{i}").alias("total")) for i, (t, name) in enumerate(sums)]
    return one.select(F.inline(F.array(*cells))).select(*LONG)


def report(lake) -> DataFrame:
    """All rules in one long table. The raw tables are scanned once for their rules, keys and references together."""
    raw, done = lake.raw_tables(), processed_tables(lake)
    first = one_pass(raw, {t: {**blank_rules(t), **range_rules(t)} for t in raw}, KEYS, REFERENCES)
    parts = [rule_counts(df, t, {**flag_rules(t), **sign_rules(t)}) for t, df in done.items()]
    return union([first, *parts, consistency(lake.fact_delivery)])


def require_quality(long: DataFrame, warn_only: tuple[str, ...] = ()) -> None:
    """Raise when a rule outside warn_only has failing rows (reads one row per failing rule)."""
    bad = long.filter((F.col("failed") > 0) & ~F.col("rule").isin(*warn_only)).select("dataset", "rule", "failed").collect()
    if bad:
        raise ValueError("quality rules failed: " + "; ".join(f"{r.dataset}: {r.rule} ({r.failed})" for r in bad))


AS_OF = "2026-01-01"
query("dq_not_blank")(lambda lake: not_blank(lake.raw_tables()))
query("dq_unique_keys")(lambda lake: duplicate_keys(lake.raw_tables()))
query("dq_ranges")(lambda lake: ranges(lake.raw_tables()))
query("dq_referential")(lambda lake: referential(lake.raw_tables()))
query("dq_population")(
    lambda lake: population(lake.orders, {"orders_clean": lake.orders_clean, "delivery_features": lake.features}, "order_id")
)
query("dq_binary_flags")(lambda lake: binary_flags(processed_tables(lake)))
query("dq_non_negative")(lambda lake: non_negative(processed_tables(lake)))
query("dq_empty_columns")(lambda lake: empty_columns(processed_tables(lake)))
query("dq_consistency")(lambda lake: consistency(lake.fact_delivery))
query("dq_calendar")(lambda lake: calendar(lake.dims["date"]))
query("dq_dimensions")(lambda lake: dimensions(lake.dims, AS_OF))
query("dq_row_anomaly")(
    lambda lake: row_anomalies(
        {
            "orders": (lake.orders, "order_date"), "gps_tracking": (lake.gps_tracking, "timestamp"), "traffic": (lake.traffic, "timestamp"),
            "delivery_updates": (lake.delivery_updates, "event_timestamp"),
        }
    )
)
query("dq_report")(report)
