"""Exact order statistics of many groups at once, by counting in ranges that narrow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_statistics(
    rows: DataFrame | Callable[[list[tuple]], DataFrame], groups: list[str], value: str, ranks: dict[tuple, list[int]], bins: int = 4096,
    ends: dict[tuple, tuple] | None = None, weight: str | None = None,
) -> dict[tuple, object]:
    """{(*group, rank): value}: the value at each asked 0-based rank of its group, among values that are not NULL.

    Every pass counts the rows of the ranges still open in equal bins, keeps for each rank the bin it lies in, and goes on
    between that bin's smallest and largest value; a rank is found when the two are equal. Counts are merged map-side, so
    nothing is sorted and a group of any size is spread; the driver holds one row per asked rank. The first and last value
    of a range never share a bin, so every pass narrows it; values need not be spread evenly for the result to be exact.
    ends: smallest and largest value per group, where they are known. weight: a column of how often a row counts.
    rows: a table, or a function that gives the rows of the groups it is asked for, so that later passes make fewer rows.
    The asked ranges, at most one per rank, are broadcast: a shuffle on the groups would put each group into one task.
    """
    source = rows if callable(rows) else lambda _: rows
    shape = source(list(ranks))
    spark, kinds = shape.sparkSession, dict(shape.dtypes)
    kind = kinds[value]
    types = ", ".join(f"{g} {kinds[g]}" for g in groups)
    times = F.lit(1).cast("long") if weight is None else F.col(weight)

    def data(asked: list[tuple]) -> DataFrame:
        return source(asked).select(*groups, F.col(value).alias("_v"), times.alias("_w")).where(F.col("_v").isNotNull())

    if ends is None:
        both = data(list(ranks)).groupBy(*groups).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        ends = {tuple(r[: len(groups)]): (r["_lo"], r["_hi"]) for r in both.collect()}
    found, todo = {}, {(*g, rank): (*ends[g], 0) for g, asked in ranks.items() for rank in asked}
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    if kind in ("double", "float"):
        place = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))
    else:
        place = F.expr(f"(_v - _lo) div ((_hi - _lo) div {bins} + 1)")
    while True:
        found |= {k: lo_ for k, (lo_, hi_, _) in todo.items() if lo_ == hi_}
        todo = {k: s for k, s in todo.items() if k not in found}
        if not todo:
            return found
        width = len(groups)
        asked = spark.createDataFrame([(*k[:width], s[0], s[1], k[width], k[width] - s[2]) for k, s in todo.items()], f"{types}, _lo {kind}, _hi {kind}, _rank long, _at long")
        span = [*groups, "_lo", "_hi"]
        spans = spark.createDataFrame(sorted({(*k[:width], s[0], s[1]) for k, s in todo.items()}), f"{types}, _lo {kind}, _hi {kind}")
        inside = data(sorted({k[:width] for k in todo})).join(F.broadcast(spans), groups).where(v.between(lo, hi))
        counts = inside.groupBy(*span, place.alias("_bin")).agg(F.sum("_w").alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        upto = counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*span).orderBy("_bin")))
        here = upto.join(F.broadcast(asked), span).where("_at < _upto and _at >= _upto - _n").select(*groups, "_rank", "_a", "_b", (F.col("_upto") - F.col("_n")).alias("_less"))
        for r in here.collect():
            k = tuple(r[: width + 1])
            todo[k] = (r["_a"], r["_b"], todo[k][2] + r["_less"])
