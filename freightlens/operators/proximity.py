"""Joins on closeness in time: nearest within a tolerance, and point in interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.rules import epoch


def nearest_within(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, left_time: str, right_time: str,
    payload: list[str], tolerance_s: int,
) -> DataFrame:
    """Left join with the right row of the same key closest in time, at most tolerance_s away.

    Both sides are united and cut into (key, time cell) groups, with cells as wide as the tolerance, so one hot key is
    spread over its cells. Within a cell a left row sees the last reading before it and the first one after it. A cell
    borrows the last reading of the cell before it and the first of the cell after it; what lies farther is out of reach.
    So every left row compares two seconds with readings, however many readings a cell has, and goes through one shuffle.
    Of the readings in one second the earliest and the latest are kept: the latest stands for that second where it is the last
    one in reach and the earliest lies beyond. Gaps count whole seconds; equal gaps go to the earlier reading. Left rows
    without key or time match nothing and are spread by their values.
    """
    item = F.struct(F.col(right_time).alias("_t"), *payload)
    per_second = (
        right.select(right_key.alias("_key"), epoch(right_time).alias("_s"), item.alias("_item"))
        .filter(F.col("_key").isNotNull() & F.col("_s").isNotNull())
        .groupBy("_key", "_s")
        .agg(F.min("_item").alias("_lo"), F.max("_item").alias("_hi"))
    )
    cell = F.floor(F.col("_s") / tolerance_s)
    readings = per_second.select("_key", cell.alias("_cell"), F.struct("_s", "_lo", "_hi").alias("_read"))
    ends = readings.groupBy("_key", "_cell").agg(F.min_by("_read", "_read._s").alias("_first"), F.max_by("_read", "_read._s").alias("_last"))
    lent = ends.select(
        "_key",
        F.inline(F.array(
            F.struct((F.col("_cell") + 1).alias("_cell"), F.col("_last").alias("_read")),
            F.struct((F.col("_cell") - 1).alias("_cell"), F.col("_first").alias("_read")),
        )),
    )
    placed = readings.unionByName(lent).select("*", F.col("_read._s").alias("_s"), F.lit(0).alias("_side"))
    probe = left.withColumns({"_key": left_key, "_s": epoch(left_time), "_side": F.lit(1)})
    spread = F.xxhash64(*left.columns)
    probe = probe.withColumn("_cell", F.when(F.col("_key").isNotNull() & F.col("_s").isNotNull(), cell).otherwise(spread))
    both = probe.unionByName(placed, allowMissingColumns=True)
    # Both frames run from the start of the group, once in each direction: a frame that ends with the group is quadratic.
    group = Window.partitionBy("_key", "_cell")
    so_far = lambda order: F.last("_read", ignorenulls=True).over(
        group.orderBy(order, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = both.withColumns({"_prev": so_far(F.asc("_s")), "_next": so_far(F.desc("_s"))}).filter("_side = 1")
    slack = F.make_dt_interval(secs=F.lit(tolerance_s))
    in_reach = F.filter(
        F.array("_prev._lo", "_prev._hi", "_next._lo"),
        lambda x: x["_t"].between(F.col(left_time) - slack, F.col(left_time) + slack),
    )
    best = F.array_min(
        F.transform(in_reach, lambda x: F.struct(F.abs(epoch(left_time) - epoch(x["_t"])).alias("gap"), x.alias("row")))
    )
    return (
        seen.withColumn("_best", best)
        .select(
            *[F.col(c) for c in left.columns],
            F.col("_best.row._t").alias(right_time),
            *[F.col(f"_best.row.{c}").alias(c) for c in payload],
            F.col("_best.gap").alias("time_difference_seconds"),
        )
    )


def points_in_intervals(
    intervals: DataFrame, points: DataFrame, keys: list[str], start: str, end: str, at: str, base_s: int = 1800
) -> DataFrame:
    """Inner join: points of the same keys with start <= at <= end.

    An interval is split into time cells; the cell width grows with its length (x48 per level: half an hour,
    a day, 48 days, ...), so an interval never yields more than about 50 cells however long it is. A point
    is listed once per level. Cells spread one hot key over time, and each match is found in exactly one cell.
    """
    widths = [base_s * 48**i for i in range(4)]
    span = epoch(end) - epoch(start)
    width = F.lit(widths[-1])
    for w in reversed(widths[:-1]):
        width = F.when(span <= w * 48, w).otherwise(width)
    cells = (
        intervals.filter(F.col(start) <= F.col(end))
        .withColumn("_w", width.cast("long"))
        .withColumn("_cell", F.explode(F.sequence(F.floor(epoch(start) / F.col("_w")), F.floor(epoch(end) / F.col("_w")))))
    )
    placed = points.withColumn("_w", F.explode(F.array(*[F.lit(w).cast("long") for w in widths]))).withColumn(
        "_cell", F.floor(epoch(at) / F.col("_w"))
    )
    return (
        cells.join(placed, [*keys, "_w", "_cell"])
        .filter(F.col(at).between(F.col(start), F.col(end)))
        .drop("_w", "_cell")
    )
