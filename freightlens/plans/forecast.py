"""Daily demand forecast: calendar features and a linear model."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.measures import half_even, half_up, ratio
from freightlens.functions.rules import flag, upto
from freightlens.operators.least_squares import least_squares
from freightlens.registry import query

FEATURES = [
    "day_index", "day_of_week", "day_of_month", "month", "quarter", "week_of_year", "is_weekend", "dow_sin", "dow_cos", "month_sin",
    "month_cos",
]
DEMAND_CUT = ((100, "Low"), (200, "Moderate"), (400, "High"), (None, "Very High"))


def daily_demand(orders: DataFrame) -> DataFrame:
    """Orders per calendar day between the first and the last order date; days without an order count 0."""
    seen = orders.filter(F.col("order_date").isNotNull()).groupBy(F.col("order_date").alias("date")).agg(
        F.count("order_id").alias("_n")
    )
    ends = seen.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    return days.join(seen, "date", "left").select("date", F.coalesce("_n", F.lit(0)).alias("order_count"))


def time_features(df: DataFrame, first_day) -> DataFrame:
    """Trend and calendar columns; first_day is the day with index 0."""
    dow, month = F.weekday("date"), F.month("date")
    turn = 2 * math.pi
    return df.withColumns(
        {
            "day_index": F.datediff("date", first_day), "day_of_week": dow, "day_of_month": F.dayofmonth("date"), "month": month,
            "quarter": F.quarter("date"), "week_of_year": F.weekofyear("date"), "is_weekend": flag(dow >= 5),
            "dow_sin": F.sin(turn * dow / 7), "dow_cos": F.cos(turn * dow / 7),
            "month_sin": F.sin(turn * month / 12), "month_cos": F.cos(turn * month / 12),
        }
    )


def with_features(daily: DataFrame) -> DataFrame:
    return time_features(daily, daily.agg(F.min("date")).scalar())


def chrono_split(daily: DataFrame, test_share: float = 0.20) -> DataFrame:
    """Marks the last ceil(share) of the days as test. The series has every calendar day, so a day's position is
    its distance from the first day and no sort is needed."""
    ends = daily.agg(F.struct(F.min("date").alias("a"), F.max("date").alias("b")).alias("e")).scalar()
    d = daily.withColumn("_e", ends)
    n = F.datediff("_e.b", "_e.a") + 1
    held = F.greatest(F.lit(1), F.ceil(n * test_share))
    held = F.when(held >= n, 1).otherwise(held)
    return d.withColumn("split", F.when(F.datediff("date", "_e.a") >= n - held, "test").otherwise("train")).drop("_e")


def require_history(daily: DataFrame, days: int = 10) -> DataFrame:
    n = daily.limit(days).count()
    if n < days:
        raise ValueError(f"at least {days} daily observations are needed, found {n}")
    return daily


def fit(train: DataFrame) -> Column:
    """Ordinary least squares by the normal equations: the prediction as an expression over the features."""
    fitted = least_squares(train, FEATURES, "order_count")
    if fitted is None:
        raise ValueError("there are no days to fit a model on")
    return fitted


def predict(model: Column, df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", model)


def scores(predicted: DataFrame) -> DataFrame:
    """MAE, RMSE and R2 of unclipped predictions."""
    y, e = F.col("order_count").cast("double"), F.col("order_count") - F.col("prediction")
    n = F.count(F.lit(1))
    ss = F.sum(y * y) - F.sum(y) * F.sum(y) / n
    return predicted.agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.try_divide(F.sum(e * e), ss)).alias("r2"),
        n.alias("test_days"),
    )


def test_predictions(predicted: DataFrame) -> DataFrame:
    return predicted.select("date", "order_count", half_even(F.greatest("prediction", F.lit(0.0)), 2).alias("predicted_orders"))


def future_days(daily: DataFrame, days: int) -> DataFrame:
    if days <= 0:
        raise ValueError("the number of forecast days must be positive")
    last = daily.agg(F.max("date").alias("b"))
    return last.select(F.explode(F.sequence(F.date_add("b", 1), F.date_add("b", days), F.expr("interval 1 day"))).alias("date"))


def forecast(daily: DataFrame, days: int = 30) -> DataFrame:
    """Fit on all days and predict the next ones."""
    model = fit(with_features(daily))
    future = time_features(future_days(daily, days), daily.agg(F.min("date")).scalar())
    orders = F.bround(F.greatest("prediction", F.lit(0.0))).cast("long")
    return predict(model, future).withColumn("predicted_orders", orders).select(
        "date", "day_of_week", "month", "is_weekend", "predicted_orders", upto("predicted_orders", DEMAND_CUT).alias("demand_level")
    )


def evaluated(daily: DataFrame) -> DataFrame:
    """The test days with predictions of a model fitted on the days before them."""
    parts = chrono_split(with_features(daily))
    return predict(fit(parts.filter("split = 'train'")), parts.filter("split = 'test'"))


def summary(daily: DataFrame, days: int = 30) -> DataFrame:
    history = daily.agg(
        F.count(F.lit(1)).alias("historical_days"), F.sum("order_count").alias("historical_total_orders"),
        ratio(F.sum("order_count"), F.count(F.lit(1)), 2).alias("historical_average_daily_orders"),
        F.max("order_count").alias("historical_peak_daily_orders"),
    )
    ahead = forecast(daily, days).agg(
        F.struct(
            F.count(F.lit(1)).alias("forecast_days"), F.sum("predicted_orders").alias("forecast_total_orders"),
            ratio(F.sum("predicted_orders"), F.count(F.lit(1)), 2).alias("forecast_average_daily_orders"),
            F.max("predicted_orders").alias("forecast_peak_daily_orders"),
        ).alias("f")
    )
    errors = scores(evaluated(daily)).select(
        F.struct(
            half_up("mae", 2).alias("forecast_mae"), half_up("rmse", 2).alias("forecast_rmse"), half_up("r2", 4).alias("forecast_r2")
        ).alias("e")
    )
    return history.withColumns({"_f": ahead.scalar(), "_e": errors.scalar()}).select(
        *history.columns, "_f.*", "_e.*"
    )


def _daily(lake) -> DataFrame:
    return daily_demand(lake.stg_orders)


query("fc_daily_demand")(_daily)
query("fc_time_features")(lambda lake: with_features(_daily(lake)))
query("fc_chrono_split")(lambda lake: chrono_split(require_history(_daily(lake))))


@query("fc_linear_model")
def linear_model(lake):
    """Fitted values and residuals over the whole history."""
    daily = with_features(_daily(lake))
    p = predict(fit(daily), daily)
    return p.select("date", "order_count", F.bround("prediction", 6).alias("prediction"), F.bround(F.col("order_count") - F.col("prediction"), 6).alias("residual"))


@query("fc_evaluate")
def evaluate(lake):
    return scores(evaluated(_daily(lake)))


query("fc_test_predictions")(lambda lake: test_predictions(evaluated(_daily(lake))))
query("fc_forecast")(lambda lake: forecast(_daily(lake)))
query("fc_summary")(lambda lake: summary(_daily(lake)))
