"""Linear models from mergeable sums: ridge in one pass, balanced logistic regression in a few.

Each pass is one aggregate over the rows: the sums of w x x' and w x y of the
standardised features, some dozens of columns whatever the number of rows. Only these
sums come to the driver, where the small system is solved by a Cholesky factor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class LinearModel:
    """Intercept, and per feature its weight on the standardised scale, mean and deviation."""

    features: list[str]
    weights: list[float]
    intercept: float
    means: list[float]
    deviations: list[float]

    def score(self) -> Column:
        """Intercept plus weighted features, as a native expression."""
        scaled = _scaled(self.features, self.means, self.deviations)
        return sum((F.lit(w) * x for w, x in zip(self.weights, scaled)), F.lit(self.intercept))

    def probability(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.score()))

    def table(self, df: DataFrame) -> DataFrame:
        """feature, weight, mean and deviation; the intercept is a row of its own."""
        rows = [("intercepto", self.intercept, None, None), *zip(self.features, self.weights, self.means, self.deviations)]
        return df.sparkSession.createDataFrame(rows, "feature string, peso double, media double, desviacion double")


def _known(feature: str) -> Column:
    return F.coalesce(F.col(f"`{feature}`").cast("double"), F.lit(0.0))


def _scaled(features: Sequence[str], means: Sequence[float], deviations: Sequence[float]) -> list[Column]:
    """Features less their mean, in deviations; 0 for one that does not vary."""
    return [(_known(f) - m) / d if d else F.lit(0.0) for f, m, d in zip(features, means, deviations)]


def _moments(df: DataFrame, features: Sequence[str], *more: Column):
    """Count, means and sample deviations of the features (NULL counts as 0), and further aggregates."""
    row = df.agg(F.count(F.lit(1)), *[f(_known(c)) for c in features for f in (F.avg, F.stddev)], *more).first()
    k = len(features)
    values = [0.0 if v is None or v != v else float(v) for v in row[1 : 1 + 2 * k]]
    return row[0], values[::2], values[1::2], list(row[1 + 2 * k :])


def _sums(df: DataFrame, xs: Sequence[Column], weight: Column, target: Column) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weight x x' and of x target over all rows, in one aggregate."""
    k = len(xs)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    wide = df.select(weight.alias("_w"), target.alias("_y"), *[x.alias(f"_x{i}") for i, x in enumerate(xs)])
    row = wide.agg(*[F.sum(F.col("_w") * F.col(f"_x{i}") * F.col(f"_x{j}")) for i, j in pairs],
                   *[F.sum(F.col(f"_x{i}") * F.col("_y")) for i in range(k)]).first()
    values = [0.0 if v is None else float(v) for v in row]
    gram = np.zeros((k, k))
    for (i, j), v in zip(pairs, values):
        gram[i, j] = gram[j, i] = v
    return gram, np.array(values[len(pairs) :])


def _solve(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    factor = np.linalg.cholesky(gram)
    return np.linalg.solve(factor.T, np.linalg.solve(factor, right))


def ridge(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0) -> LinearModel:
    """Least squares on standardised features with ``alpha`` times the squared weights; the intercept is free.

    Rows without a target are left out; a NULL feature counts as 0. Without rows all is 0.
    """
    features = list(features)
    rows = df.where(F.col(target).isNotNull())
    n, means, deviations, (mean,) = _moments(rows, features, F.avg(F.col(target).cast("double")))
    if not n:
        return LinearModel(features, [0.0] * len(features), 0.0, means, deviations)
    centred = F.col(target).cast("double") - F.lit(float(mean))
    gram, right = _sums(rows, _scaled(features, means, deviations), F.lit(1.0), centred)
    weights = _solve(gram + alpha * np.eye(len(features)), right)
    return LinearModel(features, [float(w) for w in weights], float(mean), means, deviations)


def balanced_logistic(
    df: DataFrame, features: Sequence[str], target: str, c: float = 1.0, tolerance: float = 1e-10, most: int = 50
) -> LinearModel:
    """Logistic regression by iteratively reweighted least squares, each class with half of all weight.

    ``1 / c`` weighs half the squared weights of the standardised features; the intercept
    is free. Class weights are literals of the aggregate, so no row is joined. It ends
    once a step moves no weight by more than ``tolerance``. With one class only, all
    weights are 0 and the intercept is far on its side.
    """
    features = list(features)
    y = F.col(target).cast("double")
    rows = df.where(F.col(target).isNotNull())
    n, means, deviations, (ones,) = _moments(rows, features, F.sum(y))
    if not n or not 0 < ones < n:
        return LinearModel(features, [0.0] * len(features), 0.0 if not n else 30.0 if ones else -30.0, means, deviations)
    weight = F.when(y == 1, F.lit(n / (2.0 * ones))).otherwise(F.lit(n / (2.0 * (n - ones))))
    xs = [F.lit(1.0), *_scaled(features, means, deviations)]
    penalty = np.diag([0.0] + [1.0 / c] * len(features))
    b = np.zeros(len(xs))
    for _ in range(most):
        p = LinearModel(features, b[1:].tolist(), float(b[0]), means, deviations).probability()
        curvature, slope = _sums(rows, xs, weight * p * (1.0 - p), weight * (y - p))
        step = _solve(curvature + penalty, slope - penalty @ b)
        b = b + step
        if np.abs(step).max() <= tolerance:
            break
    return LinearModel(features, b[1:].tolist(), float(b[0]), means, deviations)
