import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.operators import evaluation, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    data = [
        (float(x), float(z), "a" if c else "b", float(3 * x - 2 * z + 5 * c + rng.normal(0, 0.1)), int(x + z > 0))
        for x, z, c in zip(rng.normal(0, 1, 800), rng.normal(0, 1, 800), rng.integers(0, 2, 800))
    ]
    return spark.createDataFrame(data, "x double, z double, s string, y double, lab int")


def test_ridge_explains_a_line(rows):
    model = models.fit_ridge(rows, ["x", "z"], ["s"], "y")
    out = models.predict(model, rows, ["x", "z"], "p", floor=None)
    assert evaluation.regression_metrics(out, "y", "p").first().r2 > 0.99
    assert out.columns == [*rows.columns, "p"]
    unseen = rows.limit(3).withColumn("s", F.lit("new"))
    assert models.predict(model, unseen, ["x", "z"], "p", floor=None).where("p is null").count() == 0


def test_forest_beats_the_mean_and_clips(rows):
    model = models.fit_demand_forest(rows, ["x", "z"], "y", trees=10, depth=6)
    out = models.predict(model, rows, ["x", "z"], "p", floor=0.0)
    assert out.agg(F.min("p")).first()[0] >= 0
    raw = models.predict(model, rows, ["x", "z"], "p", floor=None)
    assert evaluation.regression_metrics(raw, "y", "p").first().r2 > 0.5
    rank = models.feature_ranking(model, models.model_matrix(rows, ["x", "z"])).collect()
    assert {r.feature for r in rank} == {"x", "z"} and rank[0].impacto >= rank[1].impacto


def test_boosting_beats_the_mean(rows):
    model = models.fit_boosted_tips(rows, ["x", "z"], ["s"], "y", rounds=5, depth=4)
    out = models.predict(model, rows, ["x", "z"], "p", floor=None)
    assert evaluation.regression_metrics(out, "y", "p").first().r2 > 0.3


def test_balanced_classifier(rows):
    weighted = models.balanced_weights(rows, "lab").groupBy("lab").agg(F.sum("peso").alias("w")).collect()
    assert [round(r.w, 6) for r in weighted] == [400.0, 400.0]
    model = models.fit_good_zone_classifier(rows, ["x", "z"], "lab")
    out = models.predict_probability(model, rows, ["x", "z"], "p")
    assert evaluation.ranking_metrics(out, "lab", "p").first().auc > 0.98


def test_refit_uses_every_part(rows):
    half = rows.where("x > 0")
    model = models.refit(models.fit_ridge, half, rows.where("x <= 0").drop("lab"), numeric=["x", "z"], categorical=[], target="y")
    assert evaluation.regression_metrics(models.predict(model, rows, ["x", "z"], "p", None), "y", "p").first().n == 800


def test_label_codes(spark):
    train = spark.createDataFrame([(7,), (3,), (7,), (None,)], "z int")
    d = models.label_dictionary(train, "z")
    df = spark.createDataFrame([(3,), (7,), (9,)], "z int")
    assert [r.e for r in models.encode_labels(df, d, "z", "e").orderBy("z").collect()] == [0, 1, -1]
    assert [r.e for r in models.encode_labels(df, d, "z", "e", unseen=0).orderBy("z").collect()] == [0, 1, 0]


def test_dummies(spark):
    df = spark.createDataFrame([("b",), ("a",), ("zz",)], "c string")
    cats = {"c": ["a", "b"]}
    assert [tuple(r) for r in models.dummy_columns(df, cats).collect()] == [(1,), (0,), (0,)]
    many = spark.range(3000).selectExpr("concat('c', lpad(cast(id as string), 4, '0')) as c").union(spark.sql("select null"))
    assert models.category_values(many, "c") == [f"c{i:04d}" for i in range(3000)]


def test_a_stored_model_scores_alike(rows, tmp_path):
    model = models.fit_ridge(rows, ["x", "z"], ["s"], "y")
    path = str(tmp_path / "ridge")
    models.save_model(model, path)
    models.save_model(model, path)  # in place of the first
    again = models.predict(models.load_model(path), rows, ["x", "z"], "p", floor=None)
    once = models.predict(model, rows, ["x", "z"], "p", floor=None)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))
