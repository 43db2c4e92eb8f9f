"""General operators against brute force on small frames."""

import datetime as dt
import random

import pytest
from tests.conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

DAY = dt.date(2024, 1, 1)
T0 = dt.datetime(2024, 1, 1)


def test_first_per_key_is_deterministic_and_limits_before_the_shuffle(spark):
    from freightlens.operators.dedup import first_per_key

    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", None), ("b", 2)], "k string, v int").repartition(4)
    out = first_per_key(df, ["k"], [F.col("v").asc_nulls_last()])
    assert rows(out) == [("a", 1), ("b", 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit") :]


def brute_asof(left, right):
    out = []
    for k, t in left:
        best = max((r for r in right if r[0] == k and r[1] <= t), key=lambda r: (r[1], r[2]), default=None)
        out.append((k, t, best[1] if best else None, best[2] if best else None))
    return sorted(out, key=str)


def test_asof_general_matches_brute_force_across_buckets(spark):
    from freightlens.operators.asof import asof_backward

    rnd = random.Random(1)
    at = lambda: T0 + dt.timedelta(minutes=rnd.randrange(0, 14400, 7))
    left = [(rnd.choice("aaab"), at()) for _ in range(200)]
    right = list({(rnd.choice("ac"), at()): None for _ in range(30)})
    right = [(k, t, i) for i, (k, t) in enumerate(right)]
    L = spark.createDataFrame(left, "k string, t timestamp_ntz")
    R = spark.createDataFrame(right, "k string, rt timestamp_ntz, v int")
    got = asof_backward(L, R, "k", "t", "rt", ["v"], [F.col("v")])
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_asof(left, right)


def test_asof_by_day_agrees_with_the_general_form(spark):
    from freightlens.operators.asof import asof_backward, asof_by_day

    rnd = random.Random(2)
    day = lambda: DAY + dt.timedelta(days=rnd.randrange(60))
    L = spark.createDataFrame([(rnd.choice("ab"), day()) for _ in range(150)], "k string, d date")
    obs = list({(rnd.choice("ab"), day()): None for _ in range(12)}) + [("a", DAY + dt.timedelta(days=30))] * 2
    R = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(obs)], "rk string, rd date, v int")
    dense = asof_by_day(L, R.withColumn("seen", F.col("rd")), F.col("k"), "d", "rk", "rd", ["seen", "v"], [F.desc("v")])
    general = asof_backward(
        L.withColumn("t", F.col("d").cast("timestamp_ntz")), R.select(F.col("rk").alias("k"), F.col("rd").cast("timestamp_ntz").alias("rt"), "v"),
        "k", "t", "rt", ["v"], [F.col("v")], bucket="month",
    )
    assert rows(dense.select("k", "d", "v")) == rows(general.select("k", "d", "v"))


def test_unused_weather_join_is_dropped(lake):
    plan = lake.delivery_mart.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "rainfall" not in plan and "Window" not in plan


def test_nearest_within_edges(spark):
    from freightlens.operators.proximity import nearest_within

    at = lambda m, s=0: T0 + dt.timedelta(hours=10, minutes=m, seconds=s)
    L = spark.createDataFrame([("x", at(30)), ("x", at(30, 1)), ("y", at(0)), ("z", at(0)), ("w", None)], "k string, t timestamp_ntz")
    R = spark.createDataFrame(
        [("x", at(0), 1), ("x", at(60), 2), ("y", at(30), 3), ("z", at(30, 1), 4)], "rk string, rt timestamp_ntz, v int"
    )
    got = nearest_within(L, R, F.col("k"), F.col("rk"), "t", "rt", ["v"], 1800)
    assert rows(got.select("k", "t", "v", "time_difference_seconds")) == [
        ("w", None, None, None),
        ("x", at(30), 1, 1800),  # tie at exactly 30 minutes: the earlier reading
        ("x", at(30, 1), 2, 1799),
        ("y", at(0), 3, 1800),
        ("z", at(0), None, None),  # 30 minutes and one second is out of reach
    ]


def test_nearest_within_matches_brute_force(spark):
    from freightlens.operators.proximity import nearest_within

    rnd = random.Random(3)
    at = lambda: T0 + dt.timedelta(seconds=rnd.randrange(40000))
    left = [(rnd.choice("aab"), at()) for _ in range(200)]
    right = [("a" if i % 3 else "b", at(), i) for i in range(40)]
    L = spark.createDataFrame(left, "k string, t timestamp_ntz")
    R = spark.createDataFrame(right, "rk string, rt timestamp_ntz, v int")
    got = {(r.k, r.t, r.rt) for r in nearest_within(L, R, F.col("k"), F.col("rk"), "t", "rt", ["v"], 1800).collect()}
    want = set()
    for k, t in left:
        near = [(abs(t - rt), rt) for rk, rt, _ in right if rk == k and abs(t - rt) <= dt.timedelta(minutes=30)]
        want.add((k, t, min(near)[1] if near else None))
    assert got == want


def test_nearest_within_holds_many_readings_and_rows_without_key(spark):
    """Readings of one second, crowded cells, borrowed readings, fractions of seconds, repeated left rows, nulls, empty sides."""
    from freightlens.operators.proximity import nearest_within

    rnd = random.Random(9)
    us = lambda: T0 + dt.timedelta(microseconds=rnd.randrange(400) * 500_000 + rnd.choice([0, 0, 3_600_000_000]))
    left = [(rnd.choice(["a", "a", "b", None]), rnd.choice([us(), us(), None])) for _ in range(300)]
    left += left[:20]
    right = [(rnd.choice(["a", "b", None]), rnd.choice([us(), us(), None]), i) for i in range(60)]
    L = spark.createDataFrame(left, "k string, t timestamp_ntz")
    R = spark.createDataFrame(right, "rk string, rt timestamp_ntz, v int")
    whole = lambda x: x.replace(microsecond=0)
    for tolerance in (7, 100):
        got = nearest_within(L, R, F.col("k"), F.col("rk"), "t", "rt", ["v"], tolerance)
        assert got.columns == ["k", "t", "rt", "v", "time_difference_seconds"]
        want = []
        for k, t in left:
            near = [(abs(whole(t) - whole(rt)), rt, v) for rk, rt, v in right if t and rt and k and rk == k and abs(t - rt) <= dt.timedelta(seconds=tolerance)]
            gap, rt, v = min(near) if near else (None, None, None)
            want.append((k, t, rt, v, None if gap is None else int(gap.total_seconds())))
        order = lambda r: tuple(str(x) for x in r)
        assert sorted((tuple(r) for r in got.collect()), key=order) == sorted(want, key=order)
    assert nearest_within(L.limit(0), R, F.col("k"), F.col("rk"), "t", "rt", ["v"], 7).count() == 0
    assert nearest_within(L, R.limit(0), F.col("k"), F.col("rk"), "t", "rt", ["v"], 7).filter("v is null").count() == len(left)


def test_points_in_intervals_of_very_different_length(spark):
    from freightlens.operators.proximity import points_in_intervals

    rnd = random.Random(4)
    spans = []
    for i in range(80):
        s = T0 + dt.timedelta(seconds=rnd.randrange(86400 * 300))
        spans.append((i, rnd.choice("ab"), s, s + dt.timedelta(seconds=rnd.choice([0, 60, 5000, 90000, 86400 * 40, 86400 * 400]))))
    points = [(rnd.choice("ab"), T0 + dt.timedelta(seconds=rnd.randrange(86400 * 500)), i) for i in range(120)]
    points.append(("a", spans[0][2], 999))
    I = spark.createDataFrame(spans, "id int, k string, s timestamp_ntz, e timestamp_ntz")
    P = spark.createDataFrame(points, "k string, at timestamp_ntz, p int")
    got = sorted((r.id, r.p) for r in points_in_intervals(I, P, ["k"], "s", "e", "at").collect())
    assert got == sorted((i, p) for i, k, s, e in spans for pk, at, p in points if pk == k and s <= at <= e)


@pytest.mark.parametrize("n", [0, 1, 7, 10, 23, 100])
def test_global_ntile_equals_the_window_function(spark, n):
    from freightlens.operators.ranking import global_ntile

    rnd = random.Random(n)
    df = spark.createDataFrame([(f"id{i:03d}", rnd.choice([5, 5, 5, 1, 9])) for i in range(n)], "id string, v int")
    got = global_ntile(df, 10, [F.desc("v"), F.asc("id")], "t")
    want = df.withColumn("t", F.ntile(10).over(Window.orderBy(F.desc("v"), F.asc("id"))))
    assert rows(got.select("id", "t")) == rows(want.select("id", "t"))


def test_dense_rank_running_total_and_row_number(spark):
    from freightlens.operators.ranking import global_dense_rank, global_row_number, global_running_total

    df = spark.createDataFrame([(i, i % 4, None if i % 5 == 0 else i % 3) for i in range(40)], "id int, a int, b int").repartition(4)
    w = Window.orderBy(F.asc_nulls_last("a"), F.desc_nulls_last("b"))
    got = global_dense_rank(df, {"a": True, "b": False}, "r")
    assert rows(got.select("id", "r")) == rows(df.select("id", F.dense_rank().over(w).alias("r")))
    order = Window.orderBy("a", "id")
    run = global_running_total(df, {"id": "upto"}, [F.col("a"), F.col("id")])
    want = df.select("id", F.sum("id").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    assert rows(run.select("id", "upto")) == rows(want)
    assert rows(global_row_number(df, [F.col("a"), F.col("id")], "n").select("id", "n")) == rows(
        df.select("id", F.row_number().over(order).alias("n"))
    )


@pytest.mark.parametrize("n", [1, 2, 4, 5, 10, 11])
def test_quartiles_of_rank_like_equal_frequency_cut(spark, n):
    import pandas as pd

    from freightlens.operators.ranking import quartile_of_rank

    labels = ["Low", "Medium", "High", "Very High"]
    df = spark.createDataFrame([(i, (i * 7) % 3) for i in range(n)], "id int, v int")
    got = {r.id: r.q for r in quartile_of_rank(df, [F.col("v"), F.col("id")], labels, "q").collect()}
    pdf = df.toPandas().sort_values(["v", "id"])
    if n > 1:
        want = dict(zip(pdf.id, pd.qcut(pdf.v.rank(method="first"), 4, labels=labels)))
    else:
        want = {0: "Low"}
    assert got == want


def test_entity_rollup_counts_like_count_distinct(spark):
    from freightlens.operators.rollup import entity_rollup

    rnd = random.Random(5)
    data = [(rnd.choice("rrs"), rnd.choice([None, *range(12)]), rnd.choice([0, 1]), rnd.choice([None, 1.5, 2.5])) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, id int, late int, v double").withColumn("v", F.col("v").cast("decimal(10,2)"))
    late = F.col("late") == 1
    got = entity_rollup(
        df, ["k"], "id", count="n", count_if={"l": late}, rows={"c": None, "cl": late}, sums={"s": "v"}, means={"m": "v"},
        shares={"p": (late, F.col("v").isNotNull())}, maxes={"x": "v"},
    ).select("k", "n", "l", "c", "cl", "s", "m", "x")
    want = df.groupBy("k").agg(
        F.count_distinct("id").alias("n"), F.count_distinct(F.when(late, F.col("id"))).alias("l"), F.count(F.lit(1)).alias("c"),
        F.count_if(late).alias("cl"), F.sum("v").cast("double").alias("s"), F.round(F.avg("v").cast("double"), 2).alias("m"),
        F.max("v").cast("double").alias("x"),
    )
    assert rows(got) == rows(want)
    sets = entity_rollup(df.withColumn("j", F.col("late")), ["k", "j"], "id", sets=[[], ["k"]], count="n")
    assert rows(sets.filter("_gid = 2").select("k", "n")) == rows(want.select("k", "n"))


def test_describe_equals_pandas(spark):
    from freightlens.operators.profile import describe_columns, long_values

    rnd = random.Random(6)
    df = spark.createDataFrame([(rnd.choice([None, 1, 2, 2, 7, 50]), rnd.random() * 9) for _ in range(101)], "a int, b double")
    got = {r.column_name: r for r in describe_columns(long_values(df, "t", ["a", "b"])).collect()}
    want = df.toPandas().describe()
    for c in "ab":
        for name, label in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][name] == pytest.approx(want[c][label], rel=1e-5)


def test_histogram_edges(spark):
    import numpy as np

    from freightlens.operators.profile import histogram

    values = [0.0, 0.0, 1.0, 2.5, 10.0, 10.0, 3.3]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert [r.observations for r in histogram(df, "v", 5).orderBy("bin").collect()] == list(np.histogram(values, 5)[0])
    same = histogram(spark.createDataFrame([(4.0,), (4.0,)], "v double"), "v", 3)
    assert sum(r.observations for r in same.collect()) == 2


def test_rounding_on_decimal_ties(spark):
    from freightlens.functions.measures import half_even, half_up

    df = spark.createDataFrame([(264.6 / 8,), (1.005,), (2.675,), (0.125,), (-1.005,)], "v double")
    got = df.select(half_up("v", 2).alias("u"), half_even("v", 2).alias("e")).collect()
    assert [r.u for r in got] == [33.08, 1.01, 2.68, 0.13, -1.01]
    assert [r.e for r in got] == [33.08, 1.0, 2.68, 0.12, -1.0]


@pytest.mark.parametrize("kind", ["double", "long"])
def test_order_statistics_are_exact(spark, kind):
    """Skewed, repeated, negative and hugely spread values; groups that are missing; NULL values."""
    import random

    from freightlens.operators.selection import order_statistics

    rng = random.Random(5)
    cast = float if kind == "double" else int
    data = {
        "spread": [cast(rng.choice([-1, 1]) * 10 ** rng.uniform(0, 17)) for _ in range(700)], "same": [cast(7)] * 300, "ties": [cast(rng.randrange(3)) for _ in range(500)],
        "one": [cast(-3)], "near": [cast(10**15 + rng.randrange(4)) for _ in range(200)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in [*vs, None]], f"g string, v {kind}").repartition(5)
    asked = {(g,): sorted({0, len(vs) // 4, len(vs) // 2, len(vs) - 1}) for g, vs in data.items()}
    got = order_statistics(df, ["g"], "v", asked, bins=16)
    assert got == {(g, k): sorted(data[g])[k] for (g,), ks in asked.items() for k in ks}


def test_versions_are_published_whole(spark):
    """A load that fails leaves the version before it current; old versions go when asked."""
    import os

    from freightlens.session import run_dir
    from freightlens.sources.versions import current_version, publish_version

    base = run_dir(spark, "versions")
    assert current_version(spark, base) is None
    one = spark.range(3)
    first = publish_version({"a": one, "b": one.where("id > 0")}, base)
    assert current_version(spark, base) == first
    bad = one.select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        publish_version({"a": spark.range(9), "b": bad}, base)
    assert current_version(spark, base) == first and spark.read.parquet(f"{first}/a").count() == 3
    reader = spark.read.parquet(f"{first}/a")
    second = publish_version({"a": spark.range(5)}, base)
    assert current_version(spark, base) == second and reader.count() == 3
    third = publish_version({"a": spark.range(6)}, base, keep=2)
    path = lambda f: f.removeprefix("file:")
    assert current_version(spark, base) == third and not os.path.exists(path(first)) and os.path.exists(path(second))


def test_order_statistics_do_not_gather_a_group(spark):
    """Rows of a group are counted where they lie: only counts are shuffled, and no step joins by the group alone."""
    from freightlens.operators.selection import order_statistics

    df = spark.range(60_000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 60_013).cast("double").alias("v"))
    joins = []
    real = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    before = type(df).join
    type(df).join = lambda self, *a, **k: joins.append(before(self, *a, **k)) or joins[-1]
    try:
        got = order_statistics(df, ["g"], "v", {(0,): [0, 15_000], (1,): [29_999]}, bins=64)
    finally:
        type(df).join = before
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", real)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    values = {g: sorted(float(i * 7919 % 60_013) for i in range(60_000) if i % 2 == g) for g in (0, 1)}
    assert got == {(g, k): values[g][k] for g, k in ((0, 0), (0, 15_000), (1, 29_999))}
    plans = [j._jdf.queryExecution().executedPlan().toString() for j in joins]
    assert plans and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)


def test_profiles_do_not_shuffle_values_by_column(spark, monkeypatch):
    """Means and ranges go to the values: with no size limit that would let Spark choose it, no join gathers a column."""
    from freightlens.operators.profile import describe_columns

    joins, names = [], ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    long = spark.range(1000).selectExpr("'t' AS dataset", "if(id % 2 = 0, 'a', 'b') AS column_name", "cast(id AS double) AS value")
    real, before = type(long).join, spark.conf.get(names[0])
    monkeypatch.setattr(type(long), "join", lambda self, *a, **k: joins.append(real(self, *a, **k)) or joins[-1])
    for n in names:
        spark.conf.set(n, "-1")
    try:
        got = {r.column_name: (r["count"], r["mean"], r.min, r.q25, r.q50, r.q75, r.max) for r in describe_columns(long).collect()}
    finally:
        spark.conf.set(names[0], before)
        spark.conf.unset(names[1])
    assert got == {"a": (500, 499.0, 0.0, 249.5, 499.0, 748.5, 998.0), "b": (500, 500.0, 1.0, 250.5, 500.0, 749.5, 999.0)}
    plans = [j._jdf.queryExecution().executedPlan().toString() for j in joins]
    assert plans and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)
