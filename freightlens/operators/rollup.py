"""Group reports that count distinct entities next to ordinary measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_up, as_col


def entity_rollup(
    df: DataFrame,
    keys: list,
    entity: str,
    *,
    count: str | None = None,
    count_if: dict[str, Column] | None = None,
    rows: dict[str, Column | None] | None = None,
    sums: dict | None = None,
    means: dict | None = None,
    shares: dict | None = None,
    maxes: dict | None = None,
    max_raw: dict | None = None,
    digits: int | None = 2,
    sets: list[list[str]] | None = None,
) -> DataFrame:
    """COUNT(DISTINCT entity [IF cond]) for many conditions plus sums, means, shares and maxima.

    Spark plans several conditional distinct counts as an Expand that copies each row once per
    condition. Here rows are first reduced to one row per (keys, entity) holding partial sums and
    0/1 flags, then to the keys. The first shuffle is on the entity, so a hot key is spread over all
    tasks; the second carries one partial row per key and task.

    count_if: alias -> cond; rows: alias -> cond or None (row counts); shares: alias -> (num, den)
    conditions, a fraction of rows; means: alias -> column. digits rounds sums and means.
    sets: groupings over subsets of keys, all from one pass; _gid tells them apart as grouping_id(keys, entity) does.
    """
    count_if, rows, sums = count_if or {}, rows or {}, sums or {}
    means, shares, maxes, max_raw = means or {}, shares or {}, maxes or {}, max_raw or {}
    key_cols = [as_col(k) for k in keys]
    key_names = [k if isinstance(k, str) else f"_k{i}" for i, k in enumerate(keys)]

    def hit(cond):
        return F.lit(1) if cond is None else F.when(cond, 1)

    first, second = [], []
    if count:
        second.append(F.count(entity).alias(count))
    for a, cond in count_if.items():
        first.append(F.max(F.when(cond, 1).otherwise(0)).alias(f"e_{a}"))
        second.append(F.count(F.when(F.col(f"e_{a}") == 1, F.col(entity))).alias(a))
    for a, cond in rows.items():
        first.append(F.count(hit(cond)).alias(f"r_{a}"))
        second.append(F.sum(f"r_{a}").alias(a))
    for a, c in sums.items():
        first.append(F.sum(as_col(c)).alias(f"s_{a}"))
        t = F.sum(f"s_{a}").cast("double")
        second.append((t if digits is None else half_up(t, digits)).alias(a))
    for a, c in means.items():
        first += [F.sum(as_col(c)).alias(f"m_{a}"), F.count(as_col(c)).alias(f"n_{a}")]
        m = F.try_divide(F.sum(f"m_{a}").cast("double"), F.sum(f"n_{a}"))
        second.append((m if digits is None else half_up(m, digits)).alias(a))
    for a, (num, den) in shares.items():
        first += [F.count(F.when(num, 1)).alias(f"x_{a}"), F.count(hit(den)).alias(f"y_{a}")]
        second.append(F.try_divide(F.sum(f"x_{a}").cast("double"), F.sum(f"y_{a}")).alias(a))
    for a, c in maxes.items():
        first.append(F.max(as_col(c)).alias(f"p_{a}"))
        second.append(F.max(f"p_{a}").cast("double").alias(a))
    for a, c in max_raw.items():
        first.append(F.max(as_col(c)).alias(f"q_{a}"))
        second.append(F.max(f"q_{a}").alias(a))

    if not first:
        first = [F.lit(1).alias("_one")]
    if sets is not None:
        per_entity = df.groupingSets([[*s, entity] for s in sets], *key_names, entity).agg(F.grouping_id().alias("_gid"), *first)
        return per_entity.groupBy("_gid", *key_names).agg(*second)
    named = [c.alias(n) for c, n in zip(key_cols, key_names)]
    per_entity = df.groupBy(*named, F.col(entity)).agg(*first)
    return per_entity.groupBy(*key_names).agg(*second) if key_names else per_entity.agg(*second)


def entities_per_key(df: DataFrame, keys: list[str], entity: str, alias: str) -> DataFrame:
    """Distinct entities per key on their own, for joining with another rollup of the same keys."""
    return df.select(*keys, entity).distinct().groupBy(*keys).agg(F.count(entity).alias(alias))
