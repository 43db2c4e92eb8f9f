"""Deterministic de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list, tag: str = "_rn") -> DataFrame:
    """One row per key, the first in the given total order.

    The filter on row_number lets Spark place a WindowGroupLimit before the shuffle: each map task
    forwards at most one row per key, so a key with a huge number of copies costs its reducer one row
    per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(tag, F.row_number().over(w)).filter(F.col(tag) == 1).drop(tag)
