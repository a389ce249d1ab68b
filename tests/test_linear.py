"""Ridge and balanced logistic regression against MLlib, and odd inputs."""

import numpy as np
import pytest

from urbanflux.operators import linear, models


def rows(spark, n=400):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, 3)) * [1.0, 50.0, 0.1] + [0.0, 1e4, 5.0]
    y = 2 * x[:, 0] + 0.03 * x[:, 1] + rng.normal(size=n)
    label = (x[:, 0] + rng.normal(size=n) > 1).astype(int)
    data = [(*map(float, r), 7.0, float(v), int(c)) for r, v, c in zip(x, y, label)] + [(None, 1e4, 5.0, 7.0, None, None)]
    return spark.createDataFrame(data, "a double, b double, c double, same double, y double, target int").repartition(3)


def test_ridge_equals_mllib(spark):
    df, names = rows(spark), ["a", "b", "c", "same"]
    mine, theirs = linear.ridge(df, names, "y", alpha=3.0), models.fit_ridge(df, names, (), "y", alpha=3.0)
    assert mine.weights == pytest.approx(list(theirs.stages[-1].coefficients), abs=1e-6)
    assert mine.intercept == pytest.approx(theirs.stages[-1].intercept, abs=1e-6)
    known = df.where("y is not null")
    scored = models.predict(theirs, known.withColumn("mine", mine.score()), names, "pred", floor=None)
    assert max(abs(r.mine - r.pred) for r in scored.collect()) < 1e-6


def test_logistic_equals_mllib(spark):
    df, names = rows(spark).where("target is not null"), ["a", "b", "c", "same"]
    mine = linear.balanced_logistic(df, names, "target", c=0.5)
    theirs = models.fit_good_zone_classifier(df, names, c=0.5)
    assert mine.weights == pytest.approx(list(theirs.stages[-1].coefficients), abs=1e-4)
    scored = models.predict_probability(theirs, df.withColumn("mine", mine.probability()), names, "prob")
    assert max(abs(r.mine - r.prob) for r in scored.collect()) < 1e-4


def test_gradient_is_zero(spark):
    df, names = rows(spark).where("target is not null"), ["a", "b", "c"]
    model = linear.balanced_logistic(df, names, "target")
    data = np.array([[r.a, r.b, r.c, r.target] for r in df.collect()])
    x = (data[:, :3] - model.means) / model.deviations
    y, p = data[:, 3], 1 / (1 + np.exp(-(model.intercept + x @ model.weights)))
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    gradient = np.append(x.T @ (w * (y - p)) - model.weights, (w * (y - p)).sum())
    assert np.abs(gradient).max() < 1e-6


def test_odd_inputs(spark):
    df = rows(spark)
    empty = df.limit(0)
    assert linear.ridge(empty, ["a"], "y").weights == [0.0] and linear.balanced_logistic(empty, ["a"], "target").intercept == 0.0
    assert linear.balanced_logistic(df.where("target = 1"), ["a"], "target").intercept > 10
    assert [r.feature for r in linear.ridge(df, ["a", "same"], "y").table(df).collect()] == ["intercepto", "a", "same"]
