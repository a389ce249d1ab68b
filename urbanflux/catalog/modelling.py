"""Registered queries: baselines, models, metrics, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as C
from ..operators import context, evaluation, linear, models, scoring, splits, supply, trees
from ..operators.imputation import fill_passengers, fill_tips
from ..plans import feature_chain
from ..session import written_table
from . import base as B
from .base import query
from .windows import COMPARED_SQL, compared, features, good_zones


@query("N1_baselines", """
SELECT origen_id, timestamp_hora, target, demanda::DOUBLE AS pred_naive, media_hist AS pred_media_hist FROM features WHERE split = 'test'
""", "pred_media_hist")
def baselines(spark, sf):
    return compared(spark, sf).select("origen_id", "timestamp_hora", "target", "pred_naive", "pred_media_hist")


_METRICS = """count(*) AS n, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
  1 - avg((y - p) * (y - p)) / nullif(var_pop(y), 0) AS r2, avg(p - y) AS bias"""
_MAPES = {
    "min1": "avg(abs((y - p) / greatest(y, 1))) * 100",
    "eps": "avg(abs((y - p) / (y + 1e-8))) * 100",
    "gt05": "coalesce(avg(abs((y - p) / y)) FILTER (y > 0.5::DOUBLE) * 100, 0)",
    "gt1": "coalesce(avg(abs((y - p) / y)) FILTER (y > 1) * 100, 0)",
}


@query("N7_regression_metrics", " UNION ALL ".join(
    f"SELECT '{rule}' AS regla, {_METRICS}, {mape} AS mape FROM (SELECT precio_total_est AS y, precio_base + 0.5::DOUBLE AS p FROM trips)"
    for rule, mape in _MAPES.items()), "mae rmse r2 bias mape", 4)
def regression_metrics(spark, sf):
    """A flat surcharge as the price prediction under the four MAPE denominators."""
    t = B.trips(spark, sf).select("precio_total_est", (F.col("precio_base") + 0.5).alias("p"))
    return evaluation.metrics_by_rule(t, "precio_total_est", "p")


@query("N7_metrics_by_zone", f"""
SELECT origen_id, {_METRICS}, {_MAPES['min1']} AS mape FROM (
  SELECT origen_id, target::DOUBLE AS y, media_hist AS p FROM features WHERE split = 'test') GROUP BY 1
""", "mae rmse r2 bias mape")
def metrics_by_zone(spark, sf):
    return evaluation.regression_metrics(compared(spark, sf), "target", "pred_media_hist", by=["origen_id"])


_SCORED = "(SELECT origen_id, ventana_inicio, target, tasa_historica FROM good_zones WHERE split = 'test')"


def rated(spark, sf):
    """Test windows with the historical rate as the score."""
    return good_zones(spark, sf).where("split = 'test'")


@query("N8_confusion", f"""
SELECT target AS real, (tasa_historica >= 0.33::DOUBLE)::INTEGER AS prediccion, count(*) AS casos FROM {_SCORED} GROUP BY 1, 2
""")
def confusion(spark, sf):
    typed = evaluation.with_error_types(rated(spark, sf), "tasa_historica")
    return evaluation.confusion(typed, "target", "pred_baseline")


@query("N8_classification_metrics", f"""
SELECT n, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1,
       (2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fn + fp) * (tn + fp)) / n AS f1_ponderado, (tp + tn) / n AS exactitud
FROM (SELECT count(*) AS n, count(*) FILTER (target = 1 AND p = 1) AS tp, count(*) FILTER (target = 0 AND p = 1) AS fp,
             count(*) FILTER (target = 1 AND p = 0) AS fn, count(*) FILTER (target = 0 AND p = 0) AS tn
      FROM (SELECT target, (tasa_historica >= 0.5::DOUBLE)::INTEGER AS p FROM {_SCORED}))
""", "precision recall f1 f1_ponderado exactitud")
def classification_metrics(spark, sf):
    typed = evaluation.with_error_types(rated(spark, sf), "tasa_historica")
    return evaluation.classification_metrics(typed, "target", "pred_modelo")


@query("N8_ranking_metrics", f"""
WITH s AS (SELECT tasa_historica AS v, sum(target) AS p, sum(1 - target) AS n FROM {_SCORED} GROUP BY 1),
c AS (SELECT *, sum(p) OVER (ORDER BY v DESC) AS cp, sum(n) OVER (ORDER BY v DESC) AS cn, sum(p) OVER () AS tp, sum(n) OVER () AS tn FROM s)
SELECT sum(p * ((tn - cn) + n / 2.0::DOUBLE))::DOUBLE / (max(tp) * max(tn)) AS auc,
       sum(p * cp::DOUBLE / (cp + cn)) / max(tp) AS precision_media FROM c
""", "auc precision_media")
def ranking_metrics(spark, sf):
    rows = rated(spark, sf).withColumn("tasa_historica", F.round("tasa_historica", 12))
    return evaluation.ranking_metrics(rows, "target", "tasa_historica")


@query("N9_prediction_comparison", f"""
SELECT origen_id, timestamp_hora, error_modelo, error_naive, error_media_hist, mejora_vs_naive, mejora_vs_media_hist,
       pred_modelo / greatest(target, 1) AS ratio_modelo_real FROM {COMPARED_SQL}
""", "error_modelo error_naive error_media_hist mejora_vs_naive mejora_vs_media_hist ratio_modelo_real")
def prediction_comparison(spark, sf):
    return compared(spark, sf).select(
        "origen_id", "timestamp_hora", "error_modelo", "error_naive", "error_media_hist", "mejora_vs_naive",
        "mejora_vs_media_hist", "ratio_modelo_real",
    )


@query("N9_behaviour_summary", f"""
SELECT avg((round(error_modelo, 9) < error_naive AND round(error_modelo, 9) < round(error_media_hist, 9))::INTEGER) AS mejor,
       avg((round(error_modelo, 9) > error_naive AND round(error_modelo, 9) > round(error_media_hist, 9))::INTEGER) AS peor,
       avg((round(error_modelo, 9) <= 3)::INTEGER) AS casi_exacto,
       avg((target >= (SELECT quantile_cont(target, 0.95) FROM {COMPARED_SQL}))::INTEGER) AS picos FROM {COMPARED_SQL}
""", "mejor peor casi_exacto picos")
def behaviour_summary(spark, sf):
    rows = compared(spark, sf)
    # equal errors reached in another order of additions must tie
    rows = rows.withColumns({c: F.round(c, 9) for c in ("error_modelo", "error_media_hist")})
    return evaluation.behaviour_summary(rows)


for _key in ("origen_id", "hora", "dia_semana"):
    def _profile(spark, sf, key=_key):
        return evaluation.error_profile(compared(spark, sf), [key])

    query(f"N10_error_profile_{_key}", f"""
SELECT {_key}, count(*) AS n_casos, sum(demanda)::BIGINT AS total_viajes, avg(target) AS demanda_media_real,
       avg(pred_modelo) AS pred_media, avg(error_modelo) AS error_medio FROM {COMPARED_SQL} GROUP BY 1
""", "demanda_media_real pred_media error_medio")(_profile)


_TYPED = f"""(SELECT *, (tasa_historica >= 0.5::DOUBLE)::INTEGER AS pred_modelo, CASE WHEN tasa_historica >= 0.5::DOUBLE AND target = 0 THEN 'Falso Positivo'
  WHEN tasa_historica < 0.5::DOUBLE AND target = 1 THEN 'Falso Negativo' ELSE 'Acierto' END AS tipo_analisis FROM {_SCORED})"""


@query("N11_error_types", f"""
SELECT tipo_analisis, count(*) AS casos, avg((tasa_historica >= 0.33::DOUBLE)::INTEGER) AS base_positiva FROM {_TYPED} GROUP BY 1
""", "base_positiva")
def error_types(spark, sf):
    typed = evaluation.with_error_types(rated(spark, sf), "tasa_historica")
    return typed.groupBy("tipo_analisis").agg(F.count(F.lit(1)).alias("casos"), F.avg("pred_baseline").alias("base_positiva"))


@query("N11_false_alarms", f"""
SELECT origen_id, ventana_inicio, tasa_historica FROM {_TYPED} WHERE tipo_analisis = 'Falso Positivo'
ORDER BY round(tasa_historica, 9) DESC, origen_id, ventana_inicio LIMIT 10
""", "tasa_historica")
def false_alarms(spark, sf):
    typed = evaluation.with_error_types(rated(spark, sf), "tasa_historica")
    rounded = typed.withColumn("tasa_historica", F.round("tasa_historica", 9))
    return evaluation.error_cases(rounded, "Falso Positivo", "tasa_historica").select("origen_id", "ventana_inicio", "tasa_historica")


@query("N11_zone_accuracy", f"""
SELECT origen_id, count(*) AS total_muestras, avg((pred_modelo = target)::INTEGER) AS precision_media, avg(target) AS tasa_real_exito
FROM {_TYPED} GROUP BY 1
""", "precision_media tasa_real_exito")
def zone_accuracy(spark, sf):
    return evaluation.zone_accuracy(evaluation.with_error_types(rated(spark, sf), "tasa_historica"))


@query("N12_cascade_proxies", """
SELECT origen_id, ventana_inicio, g.split, oferta_inferida AS lag_1h, tasa_historica * m AS lag_24h, oferta_inferida * 0.1::DOUBLE AS roll_std_3h,
       tasa_historica * m AS media_hist, viento_kmh * 0.621::DOUBLE AS velocidad_mph, day(ventana_inicio)::INTEGER AS dia_mes
FROM good_zones g JOIN (SELECT split, avg(oferta_inferida) AS m FROM good_zones GROUP BY 1) USING (split)
""", "lag_1h lag_24h roll_std_3h media_hist velocidad_mph")
def cascade_proxies(spark, sf):
    out = supply.demand_model_proxies(good_zones(spark, sf), by_split="split")
    return out.select(
        "origen_id", "ventana_inicio", "split", "lag_1h", "lag_24h", "roll_std_3h", "media_hist", "velocidad_mph", "dia_mes"
    )


@query("N14_accept_score", """
SELECT id, s AS rentabilidad_score, CASE WHEN s >= 0.55::DOUBLE THEN 'ACEPTAR' ELSE 'RECHAZAR' END AS decision,
       CASE WHEN retorno > 0.6::DOUBLE THEN 'ALTA' ELSE 'MODERADA' END AS encadenado FROM (
  SELECT id, retorno, 0.45::DOUBLE * least(propina / 4.0::DOUBLE, 1) + 0.25::DOUBLE * least(velocidad_mph / 20.0::DOUBLE, 1) + 0.30::DOUBLE * retorno AS s
  FROM (SELECT id, coalesce(propina, 0) AS propina, velocidad_mph, coalesce(num_pasajeros, 0) / 6.0::DOUBLE AS retorno FROM trips))
""")
def accept_score(spark, sf):
    t = B.trips(spark, sf).select(
        "id", F.coalesce("propina", F.lit(0.0)).alias("propina"), "velocidad_mph",
        (F.coalesce("num_pasajeros", F.lit(0)) / 6.0).alias("retorno"),
    )
    return scoring.with_decision(t, "propina", "velocidad_mph", "retorno").select("id", "rentabilidad_score", "decision", "encadenado")


@query("N16_model_comparison", f"""
WITH m AS (
  SELECT 'Naive' AS modelo, {_METRICS}, {_MAPES['min1']} AS mape FROM (SELECT target::DOUBLE AS y, demanda::DOUBLE AS p FROM features WHERE split = 'test')
  UNION ALL SELECT 'Media_hist', {_METRICS}, {_MAPES['min1']} FROM (SELECT target::DOUBLE AS y, media_hist AS p FROM features WHERE split = 'test')
  UNION ALL SELECT 'Media_24h', {_METRICS}, {_MAPES['min1']} FROM (SELECT target::DOUBLE AS y, roll_mean_24h AS p FROM features WHERE split = 'test'))
SELECT *, (max(rmse) OVER () - rmse) / max(rmse) OVER () * 100 AS mejora_rmse_pct FROM m
""", "mae rmse r2 bias mape mejora_rmse_pct")
def model_comparison(spark, sf):
    rows = compared(spark, sf)
    named = {"Naive": "pred_naive", "Media_hist": "pred_media_hist", "Media_24h": "pred_modelo"}
    return evaluation.compare_models(rows, "target", named)


@query("N18_zone_options", """
SELECT DISTINCT origen_id, origen_id || ' · ' || origen_zona || ' (' || origen_barrio || ')' AS etiqueta FROM report
""")
def zone_options(spark, sf):
    from .quality import report

    return scoring.zone_options(report(spark, sf))


# --- linear models against closed forms ------------------------------------------------

_RIDGE_SQL = """
WITH m AS (SELECT avg(distancia) AS m1, stddev(distancia) AS s1, avg(duracion_min) AS m2, stddev(duracion_min) AS s2,
                  avg(velocidad_mph) AS m0 FROM trips),
g AS (SELECT sum(a * a) + 1 AS aa, sum(a * b) AS ab, sum(b * b) + 1 AS bb, sum(a * y) AS ay, sum(b * y) AS byy
      FROM (SELECT (distancia - m1) / s1 AS a, (duracion_min - m2) / s2 AS b, velocidad_mph - m0 AS y FROM trips CROSS JOIN m)),
r AS (SELECT (bb * ay - ab * byy) / (aa * bb - ab * ab) AS w1, (aa * byy - ab * ay) / (aa * bb - ab * ab) AS w2, m.* FROM g CROSS JOIN m)
"""
_RIDGE = ("distancia", "duracion_min")


@query("N4_ridge_weights", _RIDGE_SQL + """
SELECT 'intercepto' AS feature, m0 AS peso, NULL::DOUBLE AS media, NULL::DOUBLE AS desviacion FROM r
UNION ALL SELECT 'distancia', w1, m1, s1 FROM r UNION ALL SELECT 'duracion_min', w2, m2, s2 FROM r
""", "peso media desviacion", 8)
def ridge_weights(spark, sf):
    t = B.trips(spark, sf)
    return linear.ridge(t, _RIDGE, "velocidad_mph").table(t)


@query("N4_ridge_scores", _RIDGE_SQL + """
SELECT id, m0 + w1 * ((distancia - m1) / s1) + w2 * ((duracion_min - m2) / s2) AS pred FROM trips CROSS JOIN r
""", "pred", 6)
def ridge_scores(spark, sf):
    """The speed of every trip by the ridge line through distance and duration."""
    t = B.trips(spark, sf)
    return t.select("id", linear.ridge(t, _RIDGE, "velocidad_mph").score().alias("pred"))


_LOGIT = ("oferta_inferida", "espera_media")


def _newton(step):
    """One Newton step of the balanced logistic regression: sums at the weights, then the 3 x 3 system by Cramer's rule."""
    det = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
    return f"""
q{step} AS MATERIALIZED (SELECT max(b0) AS b0, max(b1) AS b1, max(b2) AS b2, sum(w * (y - p)) AS g0, sum(w * (y - p) * x1) - max(b1) AS g1,
  sum(w * (y - p) * x2) - max(b2) AS g2, sum(v) AS h00, sum(v * x1) AS h01, sum(v * x2) AS h02, sum(v * x1 * x1) + 1 AS h11,
  sum(v * x1 * x2) AS h12, sum(v * x2 * x2) + 1 AS h22
  FROM (SELECT *, w * p * (1 - p) AS v FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM x CROSS JOIN b{step}))),
b{step + 1} AS MATERIALIZED (SELECT
  b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / {det} AS b0,
  b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / {det} AS b1,
  b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / {det} AS b2 FROM q{step})"""


_STEPS = 12


@query("N3_logistic_scores", f"""
WITH z AS MATERIALIZED (SELECT origen_id, ventana_inicio, split, target::DOUBLE AS y, coalesce(oferta_inferida, 0)::DOUBLE AS f1,
                               coalesce(espera_media, 0)::DOUBLE AS f2 FROM good_zones),
m AS MATERIALIZED (SELECT avg(f1) AS m1, stddev(f1) AS s1, avg(f2) AS m2, stddev(f2) AS s2, count(*) AS n, sum(y) AS ones FROM z
                   WHERE split = 'train' AND y IS NOT NULL),
x AS MATERIALIZED (SELECT y, (f1 - m1) / s1 AS x1, (f2 - m2) / s2 AS x2, n / (2.0::DOUBLE * CASE WHEN y = 1 THEN ones ELSE n - ones END) AS w
                   FROM z CROSS JOIN m WHERE split = 'train' AND y IS NOT NULL),
b0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2),{",".join(_newton(i) for i in range(_STEPS))}
SELECT origen_id, ventana_inicio, 1 / (1 + exp(-(b0 + b1 * ((f1 - m1) / s1) + b2 * ((f2 - m2) / s2)))) AS exito_prob
FROM z CROSS JOIN m CROSS JOIN b{_STEPS} WHERE split = 'test'
""", "exito_prob", 7)
def logistic_scores(spark, sf):
    """Chance of every test window by the balanced regression on supply and mean wait."""
    rows = _window_rows(spark, sf)
    model = linear.balanced_logistic(_part(rows, "train"), _LOGIT, "target")
    return _part(rows, "test").select("origen_id", "ventana_inicio", model.probability().alias("exito_prob"))


# --- fitted models: compared by rows only ---------------------------------------------

def _demand_rows(spark, sf):
    return written_table(features(spark, sf), "demand-features")


def _window_rows(spark, sf):
    return written_table(good_zones(spark, sf), "good-zones")


def _tip_rows(spark, sf):
    rich = written_table(B.enriched(spark, sf).drop("tipo_pago"), "enriched")
    final = written_table(fill_passengers(fill_tips(rich), "id"), "final")
    return written_table(feature_chain.tip_table(final, ["id"]), "tips")


def _part(df, name):
    return df.where(F.col("split") == name)


def _demand_model(rows):
    return models.fit_demand_forest(_part(rows, "train"))


@query("N2_demand_forest")
def demand_forest(spark, sf):
    rows = _demand_rows(spark, sf)
    model = _demand_model(rows)
    test = models.predict(model, _part(rows, "test"), C.P1_FEATURES, "pred_rf")
    named = {"RandomForest": "pred_rf", "Naive": "demanda", "Media_hist": "media_hist"}
    return evaluation.compare_models(test, "target", named)


_ZONE_FEATURES = tuple(c for c in scoring.CLASSIFIER_FEATURES if c != "demanda_p1")


_ZONE_NUMERIC = tuple(c for c in _ZONE_FEATURES if c != "zona_enc")


def _classifier(rows, with_cascade=False):
    feats = scoring.CLASSIFIER_FEATURES if with_cascade else _ZONE_FEATURES
    dictionary = models.label_dictionary(_part(rows, "train"), "origen_id")
    coded = models.encode_labels(rows, dictionary, "origen_id", "zona_enc")
    return models.fit_good_zone_classifier(_part(coded, "train"), feats), dictionary, coded, feats


@query("N3_good_zone_classifier")
def good_zone_classifier(spark, sf):
    model, _, coded, feats = _classifier(_window_rows(spark, sf))
    test = models.predict_probability(model, _part(coded, "test"), feats, "exito_prob")
    typed = evaluation.with_error_types(test, "exito_prob")
    quality = evaluation.classification_metrics(typed, "target", "pred_modelo")
    ranking = evaluation.ranking_metrics(test, "target", "exito_prob").select(F.struct("auc", "precision_media").alias("r"))
    return quality.withColumns({"auc": ranking.scalar()["auc"], "precision_media": ranking.scalar()["precision_media"]})


@query("N4_speed_ridge")
def speed_ridge(spark, sf):
    rows = written_table(feature_chain.speed_table(B.enriched(spark, sf)), "speed")
    model = models.fit_ridge(_part(rows, "train"), C.P4_NUMERIC, C.P4_CATEGORICAL, "velocidad_mph")
    fitted = models.predict(model, rows, C.P4_NUMERIC, "pred", floor=None)
    return evaluation.regression_metrics(fitted, "velocidad_mph", "pred", "gt1", by=["split"])


@query("N4_tip_ridge")
def tip_ridge(spark, sf):
    rows = _tip_rows(spark, sf)
    model = models.fit_ridge(_part(rows, "train"), C.P5_NUMERIC, C.P5_CATEGORICAL, "propina")
    fitted = models.predict(model, rows, C.P5_NUMERIC, "pred", floor=None)
    return evaluation.regression_metrics(fitted, "propina", "pred", "eps", by=["split"])


@query("N5_boosted_tips")
def boosted_tips(spark, sf):
    rows = _tip_rows(spark, sf)
    model = models.fit_boosted_tips(_part(rows, "train"))
    fitted = models.predict(model, rows, C.P5_NUMERIC, "pred")
    return evaluation.regression_metrics(fitted, "propina", "pred", "gt05", by=["split"])


@query("N6_feature_vectors")
def feature_vectors(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    t = models.model_matrix(B.enriched(spark, sf), ("distancia", "duracion_min", "temp_c"))
    stages = models.feature_stages(("distancia", "duracion_min", "temp_c"), ("tipo_vehiculo", "origen_barrio"))
    vectors = Pipeline(stages=stages).fit(t).transform(t)
    return vectors.select("id", F.posexplode(vector_to_array("features")).alias("posicion", "valor"))


# --- fitted trees as tables of nodes: the table must say what the model says -------------

def _compared(df, model, label):
    """Rows per split, and how many the table of nodes scores otherwise than the model."""
    nodes = written_table(trees.node_table(df.sparkSession, model), "nodes")
    scored = trees.score_by_nodes(df.where(F.col(label).isNotNull()), model, nodes, "_tabla")
    differs = F.coalesce(F.abs(F.col("_tabla") - F.col("_pred")) > 1e-9, F.lit(True))
    return scored.groupBy("split").agg(F.count(F.lit(1)).alias("filas"), F.count_if(differs).alias("distintas"))


_AGREED = "SELECT split, count(*) AS filas, 0::BIGINT AS distintas FROM {} WHERE {} IS NOT NULL GROUP BY 1"


@query("N2_forest_nodes", _AGREED.format("features", "target"))
def forest_nodes(spark, sf):
    """Every row scored by the forest's node table."""
    rows = _demand_rows(spark, sf)
    return _compared(models.model_matrix(rows, C.P1_FEATURES), _demand_model(rows), "target")


@query("N5_boosted_nodes", _AGREED.format("good_zones", "target"))
def boosted_nodes(spark, sf):
    """The label of every window by boosted trees on scaled features, scored by their node table."""
    rows = _window_rows(spark, sf)
    model = models.fit_boosted_tips(_part(rows, "train"), _ZONE_NUMERIC, (), "target", rounds=20)
    return _compared(models.model_matrix(rows, _ZONE_NUMERIC), model, "target")


@query("N17_refit_nodes", _AGREED.format("features", "target"))
def refit_nodes(spark, sf):
    """The forest of all three parts, scored by its node table."""
    rows = _demand_rows(spark, sf)
    model = models.refit(models.fit_demand_forest, *[_part(rows, name) for name in ("train", "val", "test")])
    return _compared(models.model_matrix(rows, C.P1_FEATURES), model, "target")


@query("N2_root_nodes", """
WITH y AS (SELECT target::DOUBLE AS y FROM good_zones WHERE split = 'train' AND target IS NOT NULL)
SELECT count(*)::DOUBLE AS filas, avg(y) AS valor, var_pop(y) AS impureza, 0::BIGINT AS inconsistentes FROM y
""", "valor impureza")
def root_nodes(spark, sf):
    """Rows, mean and variance at the root of the first boosted tree, and nodes whose sums do not add up."""
    rows = _part(_window_rows(spark, sf), "train")
    model = models.fit_boosted_tips(rows, _ZONE_NUMERIC, (), "target", rounds=3, subsample=1.0)
    nodes = written_table(trees.node_table(spark, model), "nodes")
    off = trees.inconsistent_nodes(nodes).agg(F.count(F.lit(1)).alias("inconsistentes"))
    root = nodes.where("arbol = 0 AND nodo = 0").select("filas", "valor", "impureza")
    return root.withColumn("inconsistentes", off.scalar())


@query("N15_importance_of_nodes", " UNION ALL ".join(
    f"SELECT '{name}' AS feature, false AS distinta" for name in C.P1_FEATURES))
def importance_of_nodes(spark, sf):
    """Whether a feature's importance by the gains of its nodes differs from the model's."""
    rows = _demand_rows(spark, sf)
    model = _demand_model(rows)
    mine = trees.importance(trees.node_table(spark, model), per_tree=True)
    ranking = models.feature_ranking(model, models.model_matrix(rows, C.P1_FEATURES))
    order = spark.createDataFrame(list(enumerate(C.P1_FEATURES)), "variable int, feature string")
    both = ranking.join(order, "feature").join(mine, "variable", "left")
    off = F.abs(F.coalesce("importancia", F.lit(0.0)) - F.col("peso")) > 1e-9
    return both.select("feature", off.alias("distinta"))


@query("N15_feature_ranking")
def feature_ranking(spark, sf):
    rows = _demand_rows(spark, sf)
    model = _demand_model(rows)
    return models.feature_ranking(model, models.model_matrix(rows, C.P1_FEATURES))


@query("N17_refit")
def refit(spark, sf):
    rows = _demand_rows(spark, sf)
    model = models.refit(models.fit_demand_forest, _part(rows, "train"), _part(rows, "val"))
    test = models.predict(model, _part(rows, "test"), C.P1_FEATURES, "pred_rf")
    return evaluation.regression_metrics(test, "target", "pred_rf")


def _taxi_models(spark, sf):
    """Demand forest, cascade feature, classifier and the taxi context."""
    forest = _demand_model(_demand_rows(spark, sf))
    windows = written_table(feature_chain.with_cascade(_window_rows(spark, sf), forest), "cascade")
    classifier, dictionary, _, _ = _classifier(windows, with_cascade=True)
    ctx = written_table(context.context_table(_part(windows, "train"), C.CONTEXT_P2_MEANS), "context-taxi")
    return forest, classifier, dictionary, ctx


def _moments(t):
    return t.withColumns({
        "hora_float": F.hour("fecha_inicio") + F.minute("fecha_inicio") / 60.0, "dia_mes": F.dayofmonth("fecha_inicio"),
    })


@query("N13_zone_potential")
def zone_potential(spark, sf):
    """Every trip asks for the potential of its pickup zone and time."""
    forest, classifier, dictionary, ctx = _taxi_models(spark, sf)
    asked = _moments(B.trips(spark, sf)).select("id", "origen_id", "hora_float", "dia_semana", "dia_mes", "mes_num")
    out = scoring.zone_potential(scoring.moment_columns(asked), ctx, forest, classifier, dictionary)
    return out.select("id", "origen_id", "nivel_contexto", F.col("demanda_p1").alias("demanda_estimada"), "exito_prob", "recomendacion")


@query("N14_trip_decisions")
def trip_decisions(spark, sf):
    """Every trip asks whether to accept it."""
    forest, classifier, dictionary, ctx = _taxi_models(spark, sf)
    tips = _tip_rows(spark, sf)
    ctx5 = written_table(context.context_table(_part(tips, "train"), C.CONTEXT_P5_MEANS, C.CONTEXT_P5_MODES), "context-ride")
    speeds = written_table(feature_chain.speed_table(B.enriched(spark, sf)), "speed")
    speed_model = models.fit_ridge(_part(speeds, "train"), C.P4_NUMERIC, C.P4_CATEGORICAL, "velocidad_mph")
    tip_model = models.fit_ridge(_part(tips, "train"), C.P5_NUMERIC, C.P5_CATEGORICAL, "propina")
    requests = _moments(B.trips(spark, sf)).select(
        "id", "origen_id", "destino_id", "precio_base", "tipo_vehiculo", "hora_float", "dia_semana", "dia_mes", "mes_num"
    )
    out = scoring.trip_decisions(requests, ["id"], ctx, ctx5, forest, classifier, dictionary, speed_model, tip_model)
    return out.select("id", "propina", "velocidad_mph", "retorno_prob", "rentabilidad_score", "decision", "encadenado")


@query("H7_best_zones")
def best_zones(spark, sf):
    """Best three zones for every weekday and hour present in the trips."""
    forest, _, _, ctx = _taxi_models(spark, sf)
    t = B.trips(spark, sf)
    moments = t.groupBy("dia_semana", F.col("hora").cast("double").alias("hora_float")).agg(
        F.min("mes_num").alias("mes_num"), F.min(F.dayofmonth("fecha_inicio")).alias("dia_mes")
    )
    return scoring.best_zones(B.zones(spark, sf), moments, ctx, forest)
