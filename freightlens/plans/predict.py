"""Delay classifier: leakage-free features, balanced logistic regression, evaluation."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_even, ratio, rows, rows_if
from freightlens.operators.least_squares import logistic_fit
from freightlens.operators.ranking import global_running_total
from freightlens.operators.selection import order_statistics
from freightlens.plans.ml_features import delivery_weather
from freightlens.plans.star import surrogate
from freightlens.registry import query
from freightlens.session import shared_dir
from freightlens.sources.versions import current_version, derived_once, input_version, publish_version

TARGET = "is_delayed"
# Columns that would leak the outcome, identify a row, or are left out, as published.
LEAKAGE = (
    "actual_delivery_time_min", "delivery_delay_min", "positive_delay_min", "is_delayed", "delay_severity", "delivery_risk",
    "weather_delay_risk", "delay_ratio", "delivery_efficiency",
)
IDENTIFIERS = ("order_id", "customer_id", "warehouse_id", "driver_id", "vehicle_id")
EXCLUDED = (
    "customer_name", "driver_name", "region", "weather_condition", "weather_risk_category", "order_status", "delivery_status",
)
NUMERIC = ("double", "float", "int", "bigint", "smallint", "decimal", "boolean")


def with_target(df: DataFrame, check: bool = True) -> DataFrame:
    """The 0/1 label, from the delay when the column is absent; rows without a label are dropped."""
    if TARGET not in df.columns:
        late = F.col("actual_delivery_time_min") - F.col("promised_delivery_time_min")
        df = df.withColumn(TARGET, F.when(late.isNotNull(), (late > 0).cast("int")))
    label = F.least(F.greatest(F.col(TARGET).try_cast("int"), F.lit(0)), F.lit(1))
    out = df.withColumn(TARGET, label).filter(F.col(TARGET).isNotNull())
    if check:
        require_classes({r[TARGET] for r in out.select(TARGET).distinct().collect()})
    return out


def require_classes(found) -> None:
    if len(found) < 2:
        raise ValueError("the target has one class only; delayed and on-time orders are both needed")


def calendar_columns(df: DataFrame, day: str = "order_date") -> DataFrame:
    return df.withColumns(
        {
            "order_year": F.year(day), "order_month": F.month(day), "order_day_of_week": F.weekday(day),
            "order_day_of_month": F.dayofmonth(day), "order_week_of_year": F.weekofyear(day),
            "order_is_weekend": (F.weekday(day) >= 5).cast("int"),
        }
    ).drop(day)


@dataclass
class FeatureSet:
    data: DataFrame
    numeric: list[str]
    categorical: list[str]


def feature_set(df: DataFrame, check: bool = True) -> FeatureSet:
    """Usable columns by name and type alone: leakage, ids and excluded columns out, every other number and text in."""
    d = calendar_columns(with_target(df, check))
    left = [(c, k) for c, k in d.dtypes if c not in {*LEAKAGE, *IDENTIFIERS, *EXCLUDED}]
    numeric = [c for c, k in left if k.startswith(NUMERIC)]
    categorical = [c for c, k in left if k == "string"]
    if not numeric and not categorical:
        raise ValueError("no usable predictive features remain")
    ids = [c for c in IDENTIFIERS if c in d.columns]
    keep = d.select(*ids, TARGET, *[F.col(c).cast("double").alias(c) for c in numeric], *categorical)
    return FeatureSet(keep, numeric, categorical)


def split_sizes(counts: dict[int, int], test_share: float) -> dict[int, int]:
    """Test rows per class: the test set is the share of all rows, rounded up; training rows are dealt to the classes in
    proportion, and what rounding down leaves goes to the largest remainders (the smaller label on ties)."""
    n = sum(counts.values())
    train = n - math.ceil(Fraction(str(test_share)) * n)
    dealt = {c: k * train // n for c, k in counts.items()}
    for c in sorted(counts, key=lambda c: (-(counts[c] * train % n), c))[: train - sum(dealt.values())]:
        dealt[c] += 1
    return {c: counts[c] - dealt[c] for c in counts}


DRAW = "_u"


def drawn(df: DataFrame, seed: int = 42) -> DataFrame:
    """With the hash of the order id by which rows are split."""
    return df.withColumn(DRAW, surrogate("order_id", TARGET, F.lit(str(seed))))


def stratified_split(df: DataFrame, test_share: float = 0.20, seed: int = 42) -> DataFrame:
    """Marks an exact share of each class as test: the rows with the smallest hash of the order id, stable under reordering.

    The hash that divides a class is found by counting in narrowing ranges, so no class is sorted or gathered in one task.
    Rows of one order id have one hash and stay together. A table that was stored with its hash keeps it.
    """
    if not 0 < test_share < 1:
        raise ValueError("the test share must be between 0 and 1")
    hashed = df if DRAW in df.columns else drawn(df, seed)
    counts = {r[TARGET]: r["n"] for r in df.groupBy(TARGET).agg(rows("n")).collect()}
    last = {(c,): [k - 1] for c, k in split_sizes(counts, test_share).items() if k}
    border = order_statistics(hashed, [TARGET], DRAW, last)
    in_test = F.lit(False)
    for (c, _), value in border.items():
        in_test = in_test | ((F.col(TARGET) == c) & (F.col(DRAW) <= value))
    return hashed.withColumn("split", F.when(in_test, "test").otherwise("train")).drop(DRAW)


@dataclass
class DelayModel:
    """Imputation, scaling, levels and coefficients; `gradient` is the largest gradient component per row at the optimum."""

    numeric: list[str]
    categorical: list[str]
    medians: list[float]
    means: list[float]
    spreads: list[float]
    modes: list[str | None]
    levels: list[list[str]]
    coefficients: list[float]
    gradient: float

    def inputs(self) -> list[str]:
        return [*self.numeric, *(f"{c}={v}" for c, levels in zip(self.categorical, self.levels) for v in levels)]

    def design(self) -> list[Column]:
        """A constant, scaled numbers and one column per level; unseen levels are all zeros."""
        numbers = [(F.coalesce(F.col(c), F.lit(m)) - F.lit(a)) / F.lit(s) for c, m, a, s in zip(self.numeric, self.medians, self.means, self.spreads)]
        hot = [(F.coalesce(F.col(c), F.lit(m)) == v).cast("double") for c, m, levels in zip(self.categorical, self.modes, self.levels) for v in levels]
        return [F.lit(1.0), *numbers, *(F.coalesce(h, F.lit(0.0)) for h in hot)]

    def probability(self) -> Column:
        z = F.lit(0.0)
        for w, x in zip(self.coefficients, self.design()):
            z = z + F.lit(w) * x
        return 1 / (1 + F.exp(-z))


def medians(df: DataFrame, columns: list[str]) -> list[float]:
    """Exact medians of double columns (0 for a column without values)."""
    seen = df.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(columns) for f in (F.count, F.min, F.max)]).first()

    def cells(asked: list[tuple]) -> DataFrame:
        """(column, value) rows of the columns whose median is not known yet."""
        return df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(columns[i]).alias("v")) for i, in asked])))

    ranks = {(i,): sorted({(n - 1) // 2, n // 2}) for i in range(len(columns)) if (n := seen[f"count{i}"])}
    ends = {(i,): (seen[f"min{i}"], seen[f"max{i}"]) for i, in ranks}
    found = order_statistics(cells, ["c"], "v", ranks, ends=ends) if ranks else {}
    return [sum(found[i, k] for k in ranks[i,]) / len(ranks[i,]) if (i,) in ranks else 0.0 for i in range(len(columns))]


def text_counts(df: DataFrame, columns: list[str]) -> list[dict[str, int]]:
    """Rows per level of each text column, NULL left out (as many entries as the model has inputs)."""
    levels = [{} for _ in columns]
    if columns:
        cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(columns)])
        for r in df.select(F.inline(cells)).where(F.col("v").isNotNull()).groupBy("c", "v").agg(rows("n")).collect():
            levels[r["c"]][r["v"]] = r["n"]
    return levels


def fit_model(fs: FeatureSet, train: DataFrame) -> DelayModel:
    """Exact median imputation and scaling for numbers, mode imputation and levels for text, balanced logistic regression
    with a unit squared penalty, solved to its optimum."""
    counts = {r[TARGET]: r["n"] for r in train.groupBy(TARGET).agg(rows("n")).collect()}
    n = sum(counts.values())
    middle = medians(train, fs.numeric) if fs.numeric else []
    filled = [F.coalesce(F.col(c), F.lit(m)) for c, m in zip(fs.numeric, middle)]
    sums = [f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(filled) for f in (F.avg, F.var_pop)]
    stats = train.agg(*sums).first() if sums else {}
    numbers, seen = range(len(filled)), text_counts(train, fs.categorical)
    model = DelayModel(
        fs.numeric, fs.categorical, middle, [stats[f"avg{i}"] for i in numbers], [math.sqrt(stats[f"var_pop{i}"]) or 1.0 for i in numbers],
        [min(c, key=lambda v: (-c[v], v.encode()), default=None) for c in seen], [sorted(c, key=str.encode) for c in seen], [], 0.0,
    )
    weight = F.when(F.col(TARGET) == 1, n / (2.0 * counts[1])).otherwise(n / (2.0 * counts[0]))
    design = model.design()
    ready = train.select(F.array(*design).alias("x"), F.col(TARGET).cast("double").alias("y"), weight.alias("w"))
    model.coefficients, model.gradient = logistic_fit(ready, len(design))
    return model


def score(model: DelayModel, test: DataFrame) -> DataFrame:
    """order ids, actual and predicted class, and the probability of a delay."""
    ids = [c for c in IDENTIFIERS if c in test.columns]
    scored = test.withColumn("raw_probability", model.probability())
    return scored.select(
        *ids, F.col(TARGET).alias("actual_is_delayed"), (F.col("raw_probability") > 0.5).cast("int").alias("predicted_is_delayed"),
        half_even("raw_probability", 4).alias("delay_probability"), "raw_probability",
    )


A, P = F.col("actual_is_delayed"), F.col("predicted_is_delayed")
TP, FP = F.count_if((A == 1) & (P == 1)), F.count_if((A == 0) & (P == 1))
FN, TN = F.count_if((A == 1) & (P == 0)), F.count_if((A == 0) & (P == 0))


def _safe(n: Column, d: Column) -> Column:
    return F.coalesce(F.try_divide(n, d), F.lit(0.0)).cast("double")


def roc_points(scored: DataFrame) -> DataFrame:
    """False and true positive rates at each probability threshold, from the highest down.

    Rows are first counted per distinct probability; the running counts over the sorted thresholds come from
    range-partitioned partial sums, so no task holds all rows.
    """
    per = scored.groupBy("raw_probability").agg(F.sum(A).cast("long").alias("_p"), F.sum(1 - A).cast("long").alias("_n"))
    run = global_running_total(per, {"_p": "_tp", "_n": "_fp"}, [F.desc("raw_probability")])
    total = run.agg(F.struct(F.sum("_p").alias("p"), F.sum("_n").alias("n")).alias("t")).scalar()
    return run.withColumn("_t", total).select(
        F.col("raw_probability").alias("threshold"), "_p", "_n", "_fp", "_tp",
        F.try_divide("_fp", F.col("_t.n")).alias("false_positive_rate"), F.try_divide("_tp", F.col("_t.p")).alias("true_positive_rate"),
    )


def auc(points: DataFrame) -> Column:
    """Area under the ROC curve (trapezoids), as a scalar: each step adds its new negatives times the mean height."""
    height = F.col("_tp") - F.col("_p") / 2.0
    area = F.sum(F.col("_n") * height)
    return points.agg(F.try_divide(area, F.sum("_p") * F.sum("_n")).alias("auc")).scalar()


def metrics(scored: DataFrame) -> DataFrame:
    precision, recall = _safe(TP, TP + FP), _safe(TP, TP + FN)
    return scored.agg(
        _safe(TP + TN, F.count(F.lit(1))).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        _safe(2 * TP, 2 * TP + FP + FN).alias("f1_score"), F.count(F.lit(1)).alias("test_rows"),
    ).withColumn("roc_auc", auc(roc_points(scored)))


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    def row(label, tp, fp, fn):
        return F.struct(
            F.lit(label).alias("class"), _safe(tp, tp + fp).alias("precision"), _safe(tp, tp + fn).alias("recall"),
            _safe(2 * tp, 2 * tp + fp + fn).alias("f1_score"), (tp + fn).alias("support"),
        )

    c = scored.agg(TP.alias("tp"), FP.alias("fp"), FN.alias("fn"), TN.alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    classes = c.select("*", row("On Time", tn, fn, fp).alias("neg"), row("Delayed", tp, fp, fn).alias("pos"))
    n = tp + fp + fn + tn

    def mean_row(label, wa, wb):
        return F.struct(
            F.lit(label).alias("class"),
            *[(F.col(f"neg.{m}") * wa + F.col(f"pos.{m}") * wb).alias(m) for m in ("precision", "recall", "f1_score")],
            n.alias("support"),
        )

    acc = _safe(tp + tn, n)
    accuracy = F.struct(
        F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1_score"), n.alias("support")
    )
    weighted = mean_row("weighted avg", _safe(F.col("neg.support"), n), _safe(F.col("pos.support"), n))
    return classes.select(
        F.inline(F.array(F.col("neg"), F.col("pos"), accuracy, mean_row("macro avg", F.lit(0.5), F.lit(0.5)), weighted))
    )


def confusion(scored: DataFrame) -> DataFrame:
    name = lambda c: F.when(c == 1, "Delayed").otherwise("On Time")
    return scored.groupBy(name(A).alias("actual"), name(P).alias("predicted")).agg(rows("orders"))


def coefficients(model: DelayModel, spark) -> DataFrame:
    """Name, value and direction of each model input, largest effect first (as many rows as features)."""
    df = spark.createDataFrame(list(zip(model.inputs(), model.coefficients[1:])), "feature string, coefficient double")
    c = F.bround("coefficient", 6) + 0.0
    return df.select(
        "feature", c.alias("coefficient"), F.abs(c).alias("absolute_coefficient"),
        F.when(c >= 0, "Higher delay risk").otherwise("Lower delay risk").alias("direction"),
    ).orderBy(F.desc("absolute_coefficient"), "feature")


def predictions_summary(scored: DataFrame) -> DataFrame:
    p = F.col("delay_probability")
    return scored.agg(
        rows("prediction_rows"), rows_if(P == 1, "predicted_delayed_orders"), rows_if(P == 0, "predicted_on_time_orders"),
        half_even(F.avg(p) * 100, 2).alias("average_delay_probability_pct"),
        half_even(ratio(F.count_if(p >= 0.70), F.count(F.lit(1)), None, 100), 2).alias("high_risk_predictions_pct"),
    )


def model_input(lake) -> DataFrame:
    """The delivery feature table, the first choice of the model's inputs."""
    return delivery_weather(lake.orders, lake.weather)


def trained(lake) -> tuple[DelayModel, DataFrame]:
    """The model and the scored test rows of the input as it is now.

    Both are written once per version of the input files; later calls, also of other sessions, read them. The prepared
    rows are written first, by columns and with the hash that splits them: each pass of the split, imputation, scaling and
    fit reads the columns it needs from that table, and none joins the weather again.
    """
    spark = lake.spark
    fs = feature_set(model_input(lake), check=False)
    base = f"{shared_dir(spark)}/models/delay-{input_version(fs.data)}"
    folder = current_version(spark, base)
    if folder is None:
        prepared = derived_once("prepared", drawn(fs.data), base)
        require_classes({r[TARGET] for r in prepared.select(TARGET).distinct().collect()})
        parts = stratified_split(prepared)
        model = fit_model(fs, parts.filter("split = 'train'"))
        kept = spark.createDataFrame([(json.dumps(asdict(model)),)], "model string").coalesce(1)
        folder = publish_version({"model": kept, "scored": score(model, parts.filter("split = 'test'"))}, base)
    model = DelayModel(**json.loads(spark.read.parquet(f"{folder}/model").first()["model"]))
    return model, spark.read.parquet(f"{folder}/scored")


query("dp_target")(lambda lake: with_target(lake.orders_clean.drop(TARGET)).select("order_id", TARGET))


@query("dp_features")
def features(lake):
    return feature_set(model_input(lake)).data


query("dp_split")(
    lambda lake: stratified_split(with_target(lake.orders_clean)).groupBy(TARGET, "split").agg(rows("orders")).orderBy(TARGET, "split")
)
query("dp_pipeline")(lambda lake: trained(lake)[1].drop("raw_probability"))
query("dp_evaluate")(lambda lake: metrics(trained(lake)[1]))
query("dp_class_report")(lambda lake: class_report(trained(lake)[1]))
query("dp_confusion")(lambda lake: confusion(trained(lake)[1]))
query("dp_roc")(
    lambda lake: roc_points(trained(lake)[1]).select(F.bround("threshold", 8).alias("threshold"), "false_positive_rate", "true_positive_rate").orderBy(F.desc("threshold"))
)
query("dp_coefficients")(lambda lake: coefficients(trained(lake)[0], lake.spark))
query("dp_predictions_summary")(lambda lake: predictions_summary(trained(lake)[1]))
