"""As-of joins: the latest right row at or before each left row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.operators.dedup import first_per_key


def daily_forward_fill(
    right: DataFrame, key: str, day: str, payload: list[str], best_first: list[Column], last_day: Column
) -> DataFrame:
    """One row per (key, calendar day) carrying the most recent observation, up to last_day.

    Observations are first reduced to one per (key, day), the first in best_first order, before the shuffle; a key
    with very many readings therefore brings at most one row per day into the window. Each observation is then
    spread over the days until the next one of its key, so the result has at most keys x days rows and the as-of
    lookup becomes an equality join. The closing group-by changes no row; it tells the optimizer that (key, day)
    is unique, so it can drop the whole join from queries that use none of the payload.
    """
    known = right.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    once = first_per_key(known, [key, day], best_first)
    nxt = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    upto = F.coalesce(F.date_sub(nxt, 1), F.greatest(last_day, F.col(day)))
    spans = once.select(key, F.struct(*payload).alias("_obs"), F.col(day).alias("_from"), upto.alias("_to"))
    dense = spans.select(
        F.col(key).alias("_key"), F.explode(F.sequence("_from", "_to", F.expr("interval 1 day"))).alias("_day"), "_obs"
    )
    return dense.groupBy("_key", "_day").agg(F.first("_obs").alias("_obs")).select("_key", "_day", "_obs.*")


def asof_by_day(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    left_day: str,
    right_key: str,
    right_day: str,
    payload: list[str],
    best_first: list[Column],
) -> DataFrame:
    """Left join of each left row with the latest right row of its key dated on or before left_day.

    Right-side days end at the last observation day overall; later left rows look up that day.
    The join side is chosen by Spark from its size; nothing is forced to broadcast.
    """
    last_day = right.agg(F.max(right_day)).scalar()
    dense = daily_forward_fill(right, right_key, right_day, payload, best_first, last_day)
    # least() would skip a NULL day and give the row the newest observation.
    day = F.when(F.col(left_day).isNotNull(), F.least(F.col(left_day), last_day))
    probe = left.withColumn("_lk", left_key).withColumn("_ld", day)
    on = (F.col("_lk") == F.col("_key")) & (F.col("_ld") == F.col("_day"))
    return probe.join(dense, on, "left").drop("_lk", "_ld", "_key", "_day")


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    payload: list[str],
    tie_order: list[Column],
    bucket: str = "day",
) -> DataFrame:
    """General as-of join for arbitrary timestamps; of equal times the largest tie_order value wins.

    Both sides are united and cut into (key, bucket) groups, so one hot key is spread over as many tasks
    as it has time buckets. Rows before the first observation in a bucket need the last observation of an
    earlier bucket: that carry is computed on one row per (key, bucket).
    """
    cut = lambda c: F.date_trunc(bucket, F.col(c))
    obs = right.select(
        F.col(key), F.col(right_time).alias("_t"), cut(right_time).alias("_b"), *[c.alias(f"_tie{i}") for i, c in enumerate(tie_order)],
        F.struct(right_time, *payload).alias("_obs"),
    )
    ties = [f"_tie{i}" for i in range(len(tie_order))]
    rank_of = F.struct("_t", *ties)
    last_in_bucket = obs.groupBy(key, "_b").agg(F.max_by("_obs", rank_of).alias("_last"))
    buckets = left.select(key, cut(left_time).alias("_b")).distinct().unionByName(last_in_bucket.select(key, "_b")).distinct()
    per_key = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = buckets.join(last_in_bucket, [key, "_b"], "left").select(
        key, "_b", F.last("_last", ignorenulls=True).over(per_key).alias("_carry")
    )
    names = left.columns
    rows = left.select(
        key, cut(left_time).alias("_b"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
        *[F.lit(None).cast(obs.schema[t].dataType).alias(t) for t in ties],
        F.struct(*names).alias("_row"), F.lit(None).cast(obs.schema["_obs"].dataType).alias("_obs"),
    ).unionByName(
        obs.select(
            key, "_b", "_t", F.lit(0).alias("_side"), *ties,
            F.lit(None).cast(left.select(F.struct(*names).alias("r")).schema["r"].dataType).alias("_row"), "_obs",
        )
    )
    w = Window.partitionBy(key, "_b").orderBy("_t", "_side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("_seen", F.last("_obs", ignorenulls=True).over(w)).filter("_side = 1")
    hit = seen.join(carry, [key, "_b"], "left").withColumn("_hit", F.coalesce("_seen", "_carry"))
    return hit.select("_row.*", *[F.col(f"_hit.{c}").alias(c) for c in [right_time, *payload]])
