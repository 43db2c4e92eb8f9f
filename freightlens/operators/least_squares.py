"""Least squares and penalized logistic regression from sums of products, gathered in one pass over the rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least_squares(df: DataFrame, features: list[str], target: str) -> Column | None:
    """The fitted value as an expression over the features, or None for an empty table.

    One aggregate gathers the Gram matrix of features and target (a fixed number of sums, whatever the number of rows). The
    normal equations are solved on correlations, so scales of the columns don't matter; constant columns get no weight, and
    of solutions that are equally good the smallest is taken.
    """
    columns = [F.col(c).cast("double") for c in [*features, target]]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)],
        *[F.sum(columns[i] * columns[j]).alias(f"p{i}_{j}") for i, j in pairs],
    ).first()
    n = sums["n"]
    if not n:
        return None
    mean = np.array([sums[f"s{i}"] for i in range(len(columns))]) / n
    cov = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = sums[f"p{i}_{j}"] / n - mean[i] * mean[j]
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    used = [i for i in range(len(features)) if sd[i] > 1e-12 * max(1.0, abs(mean[i]))]
    scale = sd[used]
    corr = cov[np.ix_(used, used)] / np.outer(scale, scale)
    weights = np.linalg.lstsq(corr, cov[used, -1] / scale, rcond=1e-12)[0] / scale if used else np.zeros(0)
    out = F.lit(float(mean[-1]))
    for w, i in zip(weights, used):
        out = out + F.lit(float(w)) * (columns[i] - F.lit(float(mean[i])))
    return out


def _sums(width: int, beta: list[float]):
    """Per task one row of sums at the given coefficients: gradient, upper triangle of the curvature, loss."""

    def gather(batches):
        import pyarrow as pa

        b = np.array(beta)
        grad, curve, loss = np.zeros(width), np.zeros((width, width)), 0.0
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, width)
            y, w = np.asarray(batch.column("y")), np.asarray(batch.column("w"))
            z = x @ b
            p = 1 / (1 + np.exp(-z))
            grad += x.T @ (w * (p - y))
            curve += x.T @ (x * (w * p * (1 - p))[:, None])
            loss += float((w * (np.logaddexp(0, z) - y * z)).sum())
        values = np.concatenate([grad, curve[np.triu_indices(width)], [loss]])
        yield pa.RecordBatch.from_arrays([pa.array([values.tolist()], pa.list_(pa.float64()))], ["sums"])

    return gather


def _gathered(rows: DataFrame, beta: np.ndarray, penalty: float):
    width = len(beta)
    sums = rows.mapInArrow(_sums(width, beta.tolist()), "sums array<double>").select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(len(sums))
    for r in sums:
        flat[r["i"]] = r["v"]
    ridge = np.full(width, penalty)
    ridge[0] = 0
    curve = np.zeros((width, width))
    curve[np.triu_indices(width)] = flat[width:-1]
    curve = curve + np.triu(curve, 1).T + np.diag(ridge)
    return flat[:width] + ridge * beta, curve, float(flat[-1] + 0.5 * (ridge * beta * beta).sum())


def logistic_fit(rows: DataFrame, width: int, penalty: float = 1.0, tolerance: float = 1e-10, most: int = 50) -> tuple[list[float], float]:
    """(coefficients, largest gradient component per row) of rows (x array<double> with x[0] = 1, y double, w double).

    Newton's method on the weighted log loss with a squared penalty on all but the first coefficient. Each step is one pass
    that gathers width * (width + 3) / 2 sums; only those reach the driver. The loss is convex, so a gradient near zero
    proves that the coefficients are the optimum: a fit whose gradient stays above the tolerance raises.
    """
    beta = np.zeros(width)
    n = rows.count()
    grad, curve, loss = _gathered(rows, beta, penalty)
    for _ in range(most):
        if np.abs(grad).max() <= tolerance * max(1, n):
            return beta.tolist(), float(np.abs(grad).max() / max(1, n))
        step, share = np.linalg.solve(curve, grad), 1.0
        while True:
            tried = _gathered(rows, beta - share * step, penalty)
            if tried[2] <= loss + 1e-9 * abs(loss) or share < 1e-6:
                break
            share /= 2
        beta, (grad, curve, loss) = beta - share * step, tried
    raise ArithmeticError(f"no optimum found: largest gradient component {np.abs(grad).max() / max(1, n):g} per row")
