"""Whole-table profiles: missing cells, exact quartiles, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_up
from freightlens.operators.selection import order_statistics


def column_counts(df: DataFrame, dataset: str, distinct: bool = False) -> DataFrame:
    """(dataset, column_name, rows, filled[, distinct_values]), exact.

    Without distinct values it is one pass with one aggregate per column. With them every row becomes a (column,
    value) row per column, counted by value with partial aggregation before its only shuffle.
    """
    if distinct:
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])
        seen = df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        none = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("value"), F.lit(0).cast("long").alias("n")) for c in df.columns])
        every = seen.union(df.sparkSession.range(1).select(F.inline(none)))  # columns of an empty table, too
        return every.groupBy("column_name").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("filled"),
            F.count("value").alias("distinct_values"),
        ).select(F.lit(dataset).alias("dataset"), "column_name", "rows", "filled", "distinct_values")
    aggs = [F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_f{i}") for i, c in enumerate(df.columns)]]
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("rows"), F.col(f"_f{i}").alias("filled"))
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggs).select(F.lit(dataset).alias("dataset"), F.inline(F.array(*cells)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier row in full (one row)."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return per_row.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def long_values(df: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """Numeric columns as rows (dataset, column_name, value)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.lit(dataset).alias("dataset"), F.inline(cells)).filter(F.col("value").isNotNull())


def describe_columns(long: DataFrame) -> DataFrame:
    """count, mean, std, min, exact quartiles (linear interpolation), max per (dataset, column_name).

    Values are counted once per distinct value, map-side first; sums, squares around the means and the quartiles, by counting
    in narrowing ranges, come from passes over these counts that merge map-side into one row per column or range. Means and
    ranges, one row per column or rank, are broadcast: nothing is sorted or shuffled by column, and no task holds all values
    of a column.
    """
    keys, v, n = ["dataset", "column_name"], F.col("value"), F.col("n")
    spark = long.sparkSession
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")).persist()
    sums = [F.sum(n).alias("count"), F.sum(v.cast("decimal(26,6)") * n).cast("double").alias("sum"), F.min(v).alias("min"), F.max(v).alias("max")]
    first = {(r[0], r[1]): r for r in counts.groupBy(*keys).agg(*sums).collect()}
    means = spark.createDataFrame([(*k, r["sum"] / r["count"]) for k, r in first.items()], "dataset string, column_name string, mean double")
    squares = counts.join(F.broadcast(means), keys).groupBy(*keys).agg(F.sum(n * F.pow(v - F.col("mean"), 2)).alias("ss"))
    spread = {(r[0], r[1]): r["ss"] for r in squares.collect()}
    places = {k: [(q, q * (r["count"] - 1)) for q in (25, 50, 75)] for k, r in first.items()}  # positions in hundredths
    found = order_statistics(counts, keys, "value", {k: sorted({x for _, p in at for x in (p // 100, -(-p // 100))}) for k, at in places.items()}, ends={k: (r["min"], r["max"]) for k, r in first.items()}, weight="n")
    counts.unpersist()
    table = []
    for k, r in first.items():
        n = r["count"]
        quartiles = []
        for q, p in places[k]:
            low, high = found[(*k, p // 100)], found[(*k, -(-p // 100))]
            quartiles.append(low + (high - low) * (q / 100.0 * (n - 1) % 1))
        table.append((*k, n, r["sum"] / n, (spread[k] / (n - 1)) ** 0.5 if n > 1 else None, r["min"], *quartiles, r["max"]))
    return spark.createDataFrame(table, "dataset string, column_name string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed; empty bins are listed."""
    v = F.col(column).cast("double")
    vals = df.filter(v.isNotNull()).groupBy(v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ends = vals.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    idx = F.least(F.floor(F.coalesce(F.try_divide((F.col("_v") - lo) * bins, hi - lo), F.lit(0))), F.lit(bins - 1))
    hits = vals.groupBy(idx.cast("int").alias("bin")).agg(F.sum("_n").alias("_hits"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return grid.join(hits, "bin", "left").select(
        "bin",
        half_up(lo + width * F.col("bin"), 6).alias("bin_start"),
        half_up(lo + width * (F.col("bin") + 1), 6).alias("bin_end"),
        F.coalesce("_hits", F.lit(0)).cast("long").alias("observations"),
    )
