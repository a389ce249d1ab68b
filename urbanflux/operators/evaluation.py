"""Model quality as aggregate queries over predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import contract as C
from ..functions.order_statistics import score_curve

MAPE_RULES = ("min1", "eps", "gt05", "gt1")


def _mape(y: Column, p: Column, rule: str) -> Column:
    if rule == "min1":
        return F.avg(F.abs((y - p) / F.greatest(y, F.lit(1.0)))) * 100
    if rule == "eps":
        return F.avg(F.abs(F.try_divide(y - p, y + F.lit(1e-8)))) * 100
    if rule in ("gt05", "gt1"):
        floor = 0.5 if rule == "gt05" else 1.0
        return F.coalesce(F.avg(F.when(y > floor, F.abs((y - p) / y))) * 100, F.lit(0.0))
    raise ValueError(f"unknown MAPE rule {rule!r}; one of {MAPE_RULES}")


_METRICS = ("n", "mae", "rmse", "r2", "bias")


def _metrics_with(df: DataFrame, y: str, pred: str, by: Sequence[str], mapes: dict[str, str]) -> DataFrame:
    """The metrics with one MAPE column per entry of ``mapes`` (name to rule)."""
    t, p = F.col(y).cast("double"), F.col(pred).cast("double")
    rows = df.where(t.isNotNull() & p.isNotNull())
    mse = F.avg((t - p) * (t - p))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(t - p)).alias("mae"),
        F.sqrt(mse).alias("rmse"),
        (1 - F.try_divide(mse, F.var_pop(t))).alias("r2"),
        F.avg(p - t).alias("bias"),
        *[_mape(t, p, rule).alias(name) for name, rule in mapes.items()],
    )


def regression_metrics(df: DataFrame, y: str, pred: str, rule: str = "min1", by: Sequence[str] = ()) -> DataFrame:
    """n, MAE, RMSE, R2, bias and MAPE under one of four denominators."""
    return _metrics_with(df, y, pred, by, {"mape": rule})


def metrics_by_rule(
    df: DataFrame, y: str, pred: str, rules: Sequence[str] = MAPE_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """The metrics under several denominators, one row per ``regla``, from one pass over the rows."""
    wide = _metrics_with(df, y, pred, by, {f"_mape_{r}": r for r in rules})
    each = F.array(*[F.struct(F.lit(r).alias("regla"), F.col(f"_mape_{r}").alias("mape")) for r in rules])
    return wide.select(*by, *_METRICS, F.inline(each))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("real"), F.col(pred).alias("prediccion")).agg(
        F.count(F.lit(1)).alias("casos")
    )


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall and F1 of the positive class, and support-weighted F1."""
    cell = lambda a, b: F.count_if((F.col(label) == a) & (F.col(pred) == b)).cast("double")
    c = df.agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    f1_pos, f1_neg = safe(2 * tp, 2 * tp + fp + fn), safe(2 * tn, 2 * tn + fn + fp)
    n = tp + fp + fn + tn
    return c.select(
        n.cast("bigint").alias("n"),
        safe(tp, tp + fp).alias("precision"),
        safe(tp, tp + fn).alias("recall"),
        f1_pos.alias("f1"),
        safe(f1_pos * (tp + fn) + f1_neg * (tn + fp), n).alias("f1_ponderado"),
        safe(tp + tn, n).alias("exactitud"),
    )


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC (ties count half) and average precision."""
    curve = score_curve(df, label, score)
    below_neg = F.col("total_neg") - F.col("cum_neg")
    wins = F.sum(F.col("pos") * (below_neg + F.col("neg") / 2.0))
    hits = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    pos, neg = F.max("total_pos").cast("double"), F.max("total_neg").cast("double")
    return curve.agg(
        F.try_divide(wins, pos * neg).alias("auc"), F.try_divide(hits, pos).alias("precision_media")
    )


# --- comparison with the two baselines ----------------------------------------

def with_prediction_errors(
    df: DataFrame, model: str, target: str = "target", naive: str = "demanda", historic: str = "media_hist"
) -> DataFrame:
    """Model, persistence and historical mean side by side with their errors."""
    y = F.col(target).cast("double")
    m = F.greatest(F.col(model).cast("double"), F.lit(0.0))
    out = df.withColumns({
        "pred_modelo": m, "pred_naive": F.col(naive).cast("double"), "pred_media_hist": F.col(historic),
    })
    out = out.withColumns({
        f"error_{n}": F.abs(y - F.col(f"pred_{n}")) for n in ("modelo", "naive", "media_hist")
    })
    return out.withColumns({
        "mejora_vs_naive": F.col("error_naive") - F.col("error_modelo"),
        "mejora_vs_media_hist": F.col("error_media_hist") - F.col("error_modelo"),
        "ratio_modelo_real": F.col("pred_modelo") / F.greatest(y, F.lit(1.0)),
        "sesgo": y - F.col("pred_modelo"),
    })


def behaviour_summary(compared: DataFrame, target: str = "target") -> DataFrame:
    """Share of rows where the model is best, worst, within 3, and share of peaks."""
    m, a, b = F.col("error_modelo"), F.col("error_naive"), F.col("error_media_hist")
    share = lambda c: F.avg(c.cast("int"))
    peak = compared.agg(F.percentile(target, F.lit(0.95)).alias("q")).scalar()
    return compared.agg(
        share((m < a) & (m < b)).alias("mejor"),
        share((m > a) & (m > b)).alias("peor"),
        share(m <= 3).alias("casi_exacto"),
        share(F.col(target) >= peak).alias("picos"),
    )


def example_rows(compared: DataFrame, kind: str, k: int = 10, target: str = "target", margin: float = 15.0) -> DataFrame:
    """Clear wins, worst misses, well-hit peaks, under- or over-predictions."""
    tie = ["origen_id", "timestamp_hora"]
    if kind == "mejores":
        wins = (F.col("mejora_vs_naive") > margin) & (F.col("mejora_vs_media_hist") > margin)
        return compared.where(wins).orderBy("error_modelo", F.desc(target), *tie).limit(k)
    if kind == "peores":
        return compared.orderBy(F.desc("error_modelo"), *tie).limit(k)
    if kind == "picos":
        # demand counts repeat, so their distinct values are few
        cut = compared.agg(F.percentile(target, F.lit(0.99)).alias("q")).scalar()
        return compared.where(F.col(target) >= cut).orderBy("error_modelo", *tie).limit(k)
    if kind == "infra":
        return compared.orderBy(F.desc("sesgo"), *tie).limit(k)
    if kind == "sobre":
        return compared.orderBy(F.asc("sesgo"), *tie).limit(k)
    raise ValueError(f"unknown kind of example: {kind}")


def error_profile(compared: DataFrame, keys: Sequence[str], target: str = "target") -> DataFrame:
    """Cases, real and predicted mean, and mean error per zone, hour or weekday."""
    return compared.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_casos"),
        F.sum("demanda").alias("total_viajes"),
        F.avg(target).alias("demanda_media_real"),
        F.avg("pred_modelo").alias("pred_media"),
        F.avg("error_modelo").alias("error_medio"),
    )


def hardest_zones(compared: DataFrame, k: int = 10) -> DataFrame:
    return error_profile(compared, ["origen_id"]).orderBy(F.desc("error_medio"), "origen_id").limit(k)


def busiest_zones(compared: DataFrame, k: int = 10) -> DataFrame:
    return error_profile(compared, ["origen_id"]).orderBy(F.desc("total_viajes"), "origen_id").limit(k)


def representative_zones(df: DataFrame, value: str = "demanda") -> DataFrame:
    """Zones with the highest, the closest-to-median and the lowest total."""
    totals = df.groupBy("origen_id").agg(F.sum(value).alias("total"))
    middle = totals.agg(F.percentile("total", F.lit(0.5)).alias("q")).scalar()
    zone = lambda rank: F.min_by("origen_id", F.struct(rank, F.col("origen_id")))
    ranked = totals.withColumn("_d", F.abs(F.col("total") - middle))
    return ranked.agg(
        zone(-F.col("total")).alias("zona_alta"),
        zone(F.col("_d")).alias("zona_media"),
        zone(F.col("total")).alias("zona_baja"),
    )


# --- good-zone classifier ------------------------------------------------------

def with_error_types(df: DataFrame, score: str, label: str = "target", rate: str = "tasa_historica") -> DataFrame:
    """Prediction at 0.5, the historical-rate baseline and the kind of error."""
    pred = (F.col(score) >= 0.5).cast("int")
    y = F.col(label)
    kind = (
        F.when((pred == 1) & (y == 0), "Falso Positivo")
        .when((pred == 0) & (y == 1), "Falso Negativo")
        .otherwise("Acierto")
    )
    return df.withColumns({
        "pred_modelo": pred,
        "pred_baseline": (F.col(rate) >= C.BASELINE_RATE).cast("int"),
        "acierto": (pred == y).cast("int"),
        "tipo_analisis": kind,
    })


def error_cases(typed: DataFrame, kind: str, score: str, k: int = 10) -> DataFrame:
    """Most confident hits and false positives, least confident misses."""
    first = F.asc(score) if kind == "Falso Negativo" else F.desc(score)
    return typed.where(F.col("tipo_analisis") == kind).orderBy(first, "origen_id", "ventana_inicio").limit(k)


def zone_accuracy(typed: DataFrame, label: str = "target") -> DataFrame:
    return typed.groupBy("origen_id").agg(
        F.count(label).alias("total_muestras"),
        F.avg("acierto").alias("precision_media"),
        F.avg(label).alias("tasa_real_exito"),
    )


# --- comparison of models ------------------------------------------------------

def compare_models(df: DataFrame, y: str, predictions: Mapping[str, str], best_by: str = "rmse") -> DataFrame:
    """Metric rows of several models, the best first, with gain over the last in percent.

    ``predictions`` names each model's column. The columns are stacked, so that one
    pass over the rows serves all models.
    """
    stacked = F.array(*[
        F.struct(F.lit(m).alias("modelo"), F.col(p).cast("double").alias("_p")) for m, p in predictions.items()
    ])
    rows = regression_metrics(df.select(F.col(y).alias("_y"), F.inline(stacked)), "_y", "_p", by=["modelo"])
    worst = F.max("rmse").over(Window.partitionBy())
    rows = rows.withColumn("mejora_rmse_pct", F.try_divide(worst - F.col("rmse"), worst) * 100)
    order = F.asc(best_by) if best_by in ("rmse", "mae", "mape") else F.desc(best_by)
    return rows.orderBy(order, "modelo")
