"""DuckDB SQL of the forecast and the delay classifier: both models are fitted again, by elimination and Newton steps."""

from __future__ import annotations

from oracle.base import CTES, ORACLE, even, n_if, r
from oracle.star import key

O = ORACLE
CTES["y_daily"] = """SELECT d.d AS date, count(o.order_id) AS order_count FROM (
SELECT cast(unnest(generate_series(cast(min(order_date) AS timestamp), cast(max(order_date) AS timestamp), INTERVAL 1 DAY)) AS date) AS d FROM lg_orders) d
LEFT JOIN lg_orders o ON o.order_date = d.d GROUP BY 1"""
FEAT = """SELECT *, cast(date_diff('day', (SELECT min(date) FROM y_daily), date) AS int) AS day_index, cast(isodow(date) - 1 AS int) AS day_of_week, cast(day(date) AS int) AS day_of_month,
 cast(month(date) AS int) AS month, cast(quarter(date) AS int) AS quarter, cast(weekofyear(date) AS int) AS week_of_year, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
 sin(2 * pi() * (isodow(date) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(date) - 1) / 7) AS dow_cos, sin(2 * pi() * month(date) / 12) AS month_sin, cos(2 * pi() * month(date) / 12) AS month_cos FROM y_daily"""
O["fc_daily_demand"] = "SELECT * FROM y_daily"
O["fc_chrono_split"] = "SELECT date, order_count, CASE WHEN row_number() OVER (ORDER BY date DESC) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM y_daily"
O["fc_time_features"] = FEAT
O["dp_target"] = "SELECT order_id, is_delayed FROM c_orders"


def solved(matrix: str) -> str:
    """The solution of a symmetric positive system, a list of rows that end with the right side, by elimination."""
    return f"""(WITH RECURSIVE e(k, m) AS (SELECT 1, ({matrix}) UNION ALL SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
 ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END) FROM e WHERE k <= len(m)) SELECT list_transform(m, lambda r: r[len(r)]) FROM e ORDER BY k DESC LIMIT 1)"""


# forecast: normal equations on correlations
FC = ["day_index", "day_of_week", "day_of_month", "month", "quarter", "week_of_year", "is_weekend", "dow_sin", "dow_cos", "month_sin", "month_cos"]
CTES["y_feat"] = FEAT
CTES["y_parts"] = f"SELECT y_feat.*, split FROM y_feat JOIN ({O['fc_chrono_split']}) s USING (date)"
CTES["y_ahead"] = FEAT.replace("FROM y_daily", "FROM (SELECT cast(b + cast(unnest(range(1, 31)) AS int) AS date) AS date FROM (SELECT max(date) AS b FROM y_daily))", 2).replace(
    "(SELECT min(date) FROM (SELECT cast(b + cast(unnest(range(1, 31)) AS int) AS date) AS date FROM (SELECT max(date) AS b FROM y_daily)))", "(SELECT min(date) FROM y_daily)")


def linear(name: str, train: str) -> None:
    """CTEs of the means, spreads and weights of a least-squares model over `train`; fitted(name) is its prediction."""
    columns = [*FC, "order_count"]
    CTES[f"{name}_s"] = "SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in columns) + f" FROM {train}"
    z = lambda c: f"(({c} - a_{c}) / s_{c})"
    rows = ", ".join("[" + ", ".join(f"avg({z(a)} * {z(b)})" for b in columns) + "]" for a in FC)
    CTES[f"{name}_w"] = f"SELECT {solved(f'SELECT [{rows}] FROM {train}, {name}_s')} AS w"


def fitted(name: str) -> str:
    return "(a_order_count + s_order_count * (" + " + ".join(f"w[{i}] * ({c} - a_{c}) / s_{c}" for i, c in enumerate(FC, 1)) + "))"


linear("y_all", "y_feat")
linear("y_train", "(SELECT * FROM y_parts WHERE split = 'train')")
Y6 = lambda e: f"round({e}, 6)"
O["fc_linear_model"] = f"SELECT date, order_count, {Y6(fitted('y_all'))} AS prediction, {Y6('order_count - ' + fitted('y_all'))} AS residual FROM y_feat, y_all_s, y_all_w"
CTES["y_tested"] = f"SELECT date, order_count, {fitted('y_train')} AS prediction FROM y_parts, y_train_s, y_train_w WHERE split = 'test'"
CTES["y_scores"] = """SELECT avg(abs(order_count - prediction)) AS mae, sqrt(avg((order_count - prediction) ** 2)) AS rmse,
 1 - sum((order_count - prediction) ** 2) / (count(*) * var_pop(order_count)) AS r2, count(*) AS test_days FROM y_tested"""
O["fc_evaluate"] = "SELECT * FROM y_scores"
O["fc_test_predictions"] = f"SELECT date, order_count, {even('greatest(prediction, 0)')} AS predicted_orders FROM y_tested"
CTES["y_forecast"] = f"""SELECT *, CASE WHEN predicted_orders <= 100 THEN 'Low' WHEN predicted_orders <= 200 THEN 'Moderate' WHEN predicted_orders <= 400 THEN 'High' ELSE 'Very High' END AS demand_level
 FROM (SELECT date, day_of_week, month, is_weekend, cast(greatest({fitted('y_all')}, 0) AS bigint) AS predicted_orders FROM y_ahead, y_all_s, y_all_w)"""
O["fc_forecast"] = "SELECT * FROM y_forecast"
O["fc_summary"] = f"""SELECT h.*, f.*, {r("mae")} AS forecast_mae, {r("rmse")} AS forecast_rmse, {r("r2", 4)} AS forecast_r2 FROM
 (SELECT count(*) AS historical_days, cast(sum(order_count) AS bigint) AS historical_total_orders, {r("sum(order_count) / count(*)")} AS historical_average_daily_orders, max(order_count) AS historical_peak_daily_orders FROM y_daily) h,
 (SELECT count(*) AS forecast_days, cast(sum(predicted_orders) AS bigint) AS forecast_total_orders, {r("sum(predicted_orders) / count(*)")} AS forecast_average_daily_orders, max(predicted_orders) AS forecast_peak_daily_orders FROM y_forecast) f, y_scores"""

# delay classifier: Newton's method on the same penalized loss
SHARES = """SELECT n0, n1, n0 + n1 - cast(ceil((n0 + n1) / 5) AS bigint) AS train FROM (SELECT count(*) FILTER (WHERE is_delayed = 0) AS n0, count(*) FILTER (WHERE is_delayed = 1) AS n1 FROM {t})"""


def parted(source: str) -> str:
    """The rows of source with an exact share of each class, those of the smallest hashes, as test."""
    return f"""SELECT s.* EXCLUDE (u, nth, n0, n1, train, more), CASE WHEN nth <= CASE WHEN is_delayed = 0 THEN n0 - n0 * train // (n0 + n1) - CASE WHEN more = 0 THEN train - n0 * train // (n0 + n1) - n1 * train // (n0 + n1) ELSE 0 END
 ELSE n1 - n1 * train // (n0 + n1) - CASE WHEN more = 1 THEN train - n0 * train // (n0 + n1) - n1 * train // (n0 + n1) ELSE 0 END END THEN 'test' ELSE 'train' END AS split
 FROM (SELECT d.*, row_number() OVER (PARTITION BY is_delayed ORDER BY u) AS nth, n0, n1, train, CASE WHEN n0 * train % (n0 + n1) >= n1 * train % (n0 + n1) THEN 0 ELSE 1 END AS more
 FROM (SELECT *, {key("order_id || '|' || cast(is_delayed AS varchar) || '|42'")} AS u FROM {source}) d, ({SHARES.format(t=source)}) k) s"""


O["dp_split"] = f"SELECT is_delayed, split, count(*) AS orders FROM ({parted('c_orders')}) GROUP BY ALL"
IDS = ["order_id", "customer_id", "warehouse_id", "driver_id", "vehicle_id"]
NUMBERS = [
    "order_value", "delivery_distance_km", "promised_delivery_time_min", "feature_year", "feature_month", "feature_day", "feature_day_of_week",
    "feature_week_of_year", "feature_is_weekend", "feature_is_month_start", "feature_is_month_end", "order_value_per_km", "distance_value_interaction",
    "planned_speed_kmph", "temperature_c", "humidity_pct", "rainfall_mm", "is_rainy", "heavy_rain_flag", "high_humidity_flag", "weather_risk_score",
]
DAYS = {
    "order_year": "year(order_date)", "order_month": "month(order_date)", "order_day_of_week": "isodow(order_date) - 1", "order_day_of_month": "day(order_date)",
    "order_week_of_year": "weekofyear(order_date)", "order_is_weekend": "CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END",
}
TEXTS = ["feature_day_name", "order_value_band", "distance_band"]
ALL = [*NUMBERS, *DAYS]
CTES["q_rows"] = f"""SELECT {', '.join(IDS)}, is_delayed, {', '.join(f'cast({c} AS double) AS {c}' for c in NUMBERS)}, {', '.join(f'cast({e} AS double) AS {c}' for c, e in DAYS.items())},
 {', '.join(TEXTS)} FROM ({O['feat_delivery_weather']})"""
O["dp_features"] = "SELECT * FROM q_rows"
CTES["q_parts"] = parted("q_rows")
MODE = lambda c: f"(SELECT {c} FROM q_parts WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
CTES["q_middle"] = "SELECT " + ", ".join(f"coalesce(median({c}), 0) AS m_{c}" for c in ALL) + " FROM q_parts WHERE split = 'train'"
CTES["q_filled"] = f"""SELECT {', '.join(IDS)}, is_delayed, split, {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in ALL)}, {', '.join(f'coalesce({c}, {MODE(c)}) AS {c}' for c in TEXTS)} FROM q_parts, q_middle"""
CTES["q_stats"] = ("SELECT count(*) / (2.0 * count(*) FILTER (WHERE is_delayed = 0)) AS w0, count(*) / (2.0 * count(*) FILTER (WHERE is_delayed = 1)) AS w1, "
 + ", ".join(f"avg({c}) AS a_{c}, CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in ALL)
 + ", " + ", ".join(f"list_sort(list(DISTINCT {c})) AS l_{c}" for c in TEXTS) + " FROM q_filled WHERE split = 'train'")
HOT = " || ".join(f"list_transform(l_{c}, lambda v: CASE WHEN {c} = v THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)" for c in TEXTS)
CTES["q_x"] = f"""SELECT {', '.join(IDS)}, is_delayed AS y, split, CASE WHEN is_delayed = 1 THEN w1 ELSE w0 END AS w,
 [1.0::DOUBLE, {', '.join(f'({c} - a_{c}) / s_{c}' for c in ALL)}] || {HOT} AS x FROM q_filled, q_stats"""
CTES["q_beta0"] = "SELECT list_transform(x, lambda v: 0.0::DOUBLE) AS b FROM q_x LIMIT 1"
STEPS = 9
for k in range(STEPS):
    CTES[f"q_at{k}"] = f"SELECT x, y, w, 1 / (1 + exp(-list_dot_product(x, b))) AS p FROM q_x, q_beta{k} WHERE split = 'train'"
    CTES[f"q_half{k}"] = f"""SELECT i, j, sum(w * p * (1 - p) * x[i] * x[j]) AS h FROM (SELECT x, w, p, unnest(range(1, len(x) + 1)) AS i FROM q_at{k}), LATERAL (SELECT unnest(range(i, len(x) + 1)) AS j) GROUP BY 1, 2"""
    CTES[f"q_grad{k}"] = f"SELECT i, sum(w * (p - y) * x[i]) AS g FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM q_at{k}) GROUP BY 1"
    CTES[f"q_mat{k}"] = f"""SELECT list(row ORDER BY i) AS m FROM (SELECT i, list(h ORDER BY j) || [any_value(g)] AS row FROM (
 SELECT a.i, a.j, a.h + CASE WHEN a.i = a.j AND a.i > 1 THEN 1 ELSE 0 END AS h, g.g + CASE WHEN a.i > 1 THEN b[a.i] ELSE 0 END AS g
 FROM (SELECT i, j, h FROM q_half{k} UNION ALL SELECT j, i, h FROM q_half{k} WHERE i <> j) a JOIN q_grad{k} g ON g.i = a.i, q_beta{k}) GROUP BY i)"""
    CTES[f"q_beta{k + 1}"] = f"SELECT list_transform(b, lambda v, i: v - d[i]) AS b FROM q_beta{k}, (SELECT {solved(f'SELECT m FROM q_mat{k}')} AS d)"
CTES["q_scored"] = f"""SELECT {', '.join(IDS)}, y, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS c, p FROM (SELECT *, 1 / (1 + exp(-list_dot_product(x, b))) AS p FROM q_x, q_beta{STEPS} WHERE split = 'test')"""
CTES["q_counts"] = """SELECT cast(count(*) FILTER (WHERE y = 1 AND c = 1) AS double) AS tp, cast(count(*) FILTER (WHERE y = 0 AND c = 1) AS double) AS fp,
 cast(count(*) FILTER (WHERE y = 1 AND c = 0) AS double) AS fn, cast(count(*) FILTER (WHERE y = 0 AND c = 0) AS double) AS tn, count(*) AS n FROM q_scored"""
Z = lambda a, b: f"coalesce(({a}) / nullif({b}, 0), 0)"
O["dp_pipeline"] = f"SELECT {', '.join(IDS)}, y AS actual_is_delayed, c AS predicted_is_delayed, {even('p', 4)} AS delay_probability FROM q_scored"
CTES["q_roc"] = """SELECT p, cast(sum(n1) OVER (ORDER BY p DESC) AS double) AS tp, cast(sum(n0) OVER (ORDER BY p DESC) AS double) AS fp, n0, n1, sum(n1) OVER () AS t1, sum(n0) OVER () AS t0
 FROM (SELECT p, sum(y) AS n1, sum(1 - y) AS n0 FROM q_scored GROUP BY p)"""
O["dp_evaluate"] = f"""SELECT {Z("tp + tn", "n")} AS accuracy, {Z("tp", "tp + fp")} AS precision, {Z("tp", "tp + fn")} AS recall, {Z("2 * tp", "2 * tp + fp + fn")} AS f1_score, n AS test_rows,
 (SELECT sum(n0 * (tp - n1 / 2.0)) / (sum(n0) * sum(n1)) FROM q_roc) AS roc_auc FROM q_counts"""
O["dp_roc"] = "SELECT round(p, 8) AS threshold, fp / t0 AS false_positive_rate, tp / t1 AS true_positive_rate FROM q_roc"
ONE = lambda label, tp, fp, fn: f"""SELECT '{label}' AS class, {Z(tp, f"{tp} + {fp}")} AS precision, {Z(tp, f"{tp} + {fn}")} AS recall, {Z(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}")} AS f1_score, cast({tp} + {fn} AS bigint) AS support FROM q_counts"""
MEAN = lambda label, e: f"SELECT '{label}', {', '.join(e.format(c=c) for c in ('precision', 'recall', 'f1_score'))}, cast(sum(support) AS bigint) FROM k"
O["dp_class_report"] = f"""WITH k AS ({ONE("On Time", "tn", "fn", "fp")} UNION ALL {ONE("Delayed", "tp", "fp", "fn")})
SELECT * FROM k UNION ALL SELECT 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n FROM q_counts UNION ALL {MEAN("macro avg", "avg({c})")} UNION ALL {MEAN("weighted avg", "sum({c} * support) / sum(support)")}"""
NAMED = lambda c: f"CASE WHEN {c} = 1 THEN 'Delayed' ELSE 'On Time' END"
O["dp_confusion"] = f"SELECT {NAMED('y')} AS actual, {NAMED('c')} AS predicted, count(*) AS orders FROM q_scored GROUP BY ALL"
O["dp_coefficients"] = f"""SELECT feature, coefficient, abs(coefficient) AS absolute_coefficient, CASE WHEN coefficient >= 0 THEN 'Higher delay risk' ELSE 'Lower delay risk' END AS direction
 FROM (SELECT unnest([{', '.join(f"'{c}'" for c in ALL)}] || {' || '.join(f"list_transform(l_{c}, lambda v: '{c}=' || v)" for c in TEXTS)}) AS feature, unnest(list_transform(b[2:], lambda v: round(v, 6) + 0.0)) AS coefficient FROM q_stats, q_beta{STEPS})"""
O["dp_predictions_summary"] = f"""SELECT count(*) AS prediction_rows, {n_if("c = 1")} AS predicted_delayed_orders, {n_if("c = 0")} AS predicted_on_time_orders,
 {even("avg(" + even("p", 4) + ") * 100")} AS average_delay_probability_pct, {even("count(*) FILTER (WHERE " + even("p", 4) + " >= 0.70) * 100.0 / count(*)")} AS high_risk_predictions_pct FROM q_scored"""
