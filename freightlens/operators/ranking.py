"""Ranks and running totals over a whole table, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.session import ensure_checkpoint_dir


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """df sorted over range partitions, with _part and the position _pos inside it.

    The order must be total (end with a unique key); then even equal leading values are split over several
    partitions. The checkpoint pins the partition borders, which come from a sample and must be the same
    for the two passes below, and survives the loss of executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    slot = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", slot)
    placed = placed.withColumn("_part", F.shiftright("_slot", 33)).withColumn(
        "_pos", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    )
    return placed.drop("_slot").checkpoint()


def _offsets(placed: DataFrame, measure: Column) -> DataFrame:
    """Sum of measure in all earlier partitions: one row per partition, so the window is tiny."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = placed.groupBy("_part").agg(F.sum(measure).alias("_m"))
    return per_part.select("_part", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"))


def global_row_number(df: DataFrame, order: list[Column], alias: str = "row_number") -> DataFrame:
    """1-based position of each row in the given total order."""
    placed = _ranged(df, order)
    off = _offsets(placed, F.lit(1))
    return placed.join(off, "_part").withColumn(alias, (F.col("_pos") + F.col("_before") + 1).cast("long")).drop(
        "_part", "_pos", "_before"
    )


def global_ntile(df: DataFrame, tiles: int, order: list[Column], alias: str) -> DataFrame:
    """NTILE(tiles) in the given total order: the first n mod tiles groups hold one row more."""
    ranked = global_row_number(df, order, "_rank")
    n = ranked.agg(F.count(F.lit(1))).scalar()
    size, extra = F.floor(n / tiles), n % tiles
    r = F.col("_rank") - 1
    big = extra * (size + 1)
    tile = F.when(r < big, F.floor(r / (size + 1))).otherwise(extra + F.floor(F.try_divide(r - big, size)))
    return ranked.withColumn(alias, (tile + 1).cast("int")).drop("_rank")


def quartile_of_rank(df: DataFrame, order: list[Column], labels: list[str], alias: str) -> DataFrame:
    """Equal-frequency labels of the row rank with interpolated right-closed borders."""
    k = len(labels)
    ranked = global_row_number(df, order, "_rank")
    n = ranked.agg(F.count(F.lit(1))).scalar()
    step = F.ceil(F.try_divide((F.col("_rank") - 1) * k, n - 1))
    idx = F.greatest(F.lit(1), F.coalesce(step, F.lit(1))).cast("int")
    return ranked.withColumn(alias, F.element_at(F.array(*[F.lit(x) for x in labels]), idx)).drop("_rank")


def global_dense_rank(df: DataFrame, values: dict[str, bool], alias: str) -> DataFrame:
    """DENSE_RANK over columns (name -> ascending); NULLs rank last."""
    order = [F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in values.items()]
    ranked = global_row_number(df.select(*values).distinct(), order, alias)
    left = df.alias("l")
    right = ranked.select(*[F.col(c).alias(f"_v_{c}") for c in values], F.col(alias).cast("int").alias(alias))
    on = None
    for c in values:
        eq = F.col(f"l.{c}").eqNullSafe(F.col(f"_v_{c}"))
        on = eq if on is None else on & eq
    return left.join(right, on).drop(*[f"_v_{c}" for c in values])


def global_running_total(df: DataFrame, measures: dict[str, str], order: list[Column]) -> DataFrame:
    """Inclusive running sums (measure -> alias) in the given total order."""
    placed = _ranged(df, order)
    within = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(*[F.sum(m).alias(f"_s_{a}") for m, a in measures.items()])
    off = parts.select(
        "_part", *[F.coalesce(F.sum(f"_s_{a}").over(before), F.lit(0)).alias(f"_o_{a}") for a in measures.values()]
    )
    out = placed.withColumns({f"_w_{a}": F.sum(m).over(within) for m, a in measures.items()}).join(off, "_part")
    out = out.withColumns({a: F.col(f"_w_{a}") + F.col(f"_o_{a}") for a in measures.values()})
    return out.drop("_part", "_pos", *[f"_w_{a}" for a in measures.values()], *[f"_o_{a}" for a in measures.values()])
