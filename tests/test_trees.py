"""Tree ensembles as node tables: scores, importance and sums against MLlib and SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.operators import models, trees


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = [
        (i, float(x), float(z), float(w), "ab"[c], float(np.exp(x) * (z > 0) + w * c + rng.normal(0, 0.1)))
        for i, (x, z, w, c) in enumerate(zip(rng.normal(0, 1, 600), rng.normal(0, 1, 600), rng.integers(0, 4, 600), rng.integers(0, 2, 600)))
    ]
    return spark.createDataFrame(data, "id long, x double, z double, w double, s string, y double").repartition(3)


@pytest.fixture(scope="module", params=["forest", "boosted"])
def fitted(request, spark, rows):
    if request.param == "forest":
        model = models.fit_demand_forest(rows, ["x", "z", "w"], "y", trees=7, depth=5)
    else:
        model = models.fit_boosted_tips(rows, ["x", "z", "w"], ["s"], "y", rounds=6, depth=4)
    return request.param, model, trees.node_table(spark, model)


def test_scores_equal_the_model(fitted, rows):
    _, model, nodes = fitted
    out = trees.score_by_nodes(rows, model, nodes, "mine").select("_pred", "mine").collect()
    assert len(out) == 600 and max(abs(r.mine - r._pred) for r in out) < 1e-9


def test_sql_scores_from_the_table(fitted, rows):
    """Another engine walks the same table level by level."""
    _, model, nodes = fitted
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(rows).select("id", F.posexplode(vector_to_array("features")).alias("variable", "v"))
    x, table = scored.toPandas(), nodes.toPandas()  # noqa: F841
    theirs = {r.id: r._pred for r in model.transform(rows).select("id", "_pred").collect()}
    con = duckdb.connect()
    con.register("x", x)
    con.register("nodes", table)
    got = con.execute("""
        WITH RECURSIVE walk AS (
          SELECT i.id, n.arbol, n.nodo, n.variable, n.corte, n.izquierda, n.derecha, n.valor, n.peso
          FROM (SELECT DISTINCT id FROM x) i, nodes n WHERE n.nodo = 0
          UNION ALL
          SELECT w.id, n.arbol, n.nodo, n.variable, n.corte, n.izquierda, n.derecha, n.valor, n.peso
          FROM walk w JOIN x ON x.id = w.id AND x.variable = w.variable
          JOIN nodes n ON n.arbol = w.arbol AND n.nodo = CASE WHEN x.v <= w.corte THEN w.izquierda ELSE w.derecha END
        ) SELECT id, sum(peso * valor) AS pred FROM walk WHERE variable < 0 GROUP BY id
    """).fetchall()
    assert len(got) == 600 and max(abs(p - theirs[i]) for i, p in got) < 1e-9


def test_importance_equals_the_model(fitted):
    kind, model, nodes = fitted
    mine = {r.variable: r.importancia for r in trees.importance(nodes, per_tree=kind == "forest").collect()}
    for i, value in enumerate(model.stages[-1].featureImportances.toArray()):
        assert mine.get(i, 0.0) == pytest.approx(value, abs=1e-9)


def test_sums_of_the_nodes(fitted):
    _, _, nodes = fitted
    assert trees.inconsistent_nodes(nodes).count() == 0
    broken = nodes.withColumn("filas", F.when((F.col("arbol") == 0) & (F.col("nodo") == 0), F.col("filas") + 1).otherwise(F.col("filas")))
    assert trees.inconsistent_nodes(broken).count() == 1


def test_a_tree_of_one_leaf(spark, rows):
    same = rows.withColumn("y", F.lit(2.5))
    model = models.fit_demand_forest(same, ["x", "z"], "y", trees=2, depth=3)
    nodes = trees.node_table(spark, model)
    assert {r.mine for r in trees.score_by_nodes(same, model, nodes, "mine").collect()} == {2.5}
    assert trees.importance(nodes, True).count() == 0


def test_categories_without_threshold_are_refused(spark, rows):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    rows = rows.withColumn("s", F.concat("s", F.col("w").cast("string")))
    stages = [StringIndexer(inputCol="s", outputCol="i"), VectorAssembler(inputCols=["i"], outputCol="features"),
              RandomForestRegressor(labelCol="y", featuresCol="features", numTrees=2, seed=1)]
    model = Pipeline(stages=stages).fit(rows)
    with pytest.raises(Exception, match="no threshold"):
        trees.node_table(spark, model).collect()
