"""Batch answers: zone potential, trip accept or reject, best zones, options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from .context import lookup_context, with_defaults
from .models import encode_labels, predict, predict_probability
from .supply import demand_model_proxies

_P2_CONTEXT = ("oferta_inferida", "tasa_historica", "espera_media", "n_viajes", *(
    "temp_c", "precipitation", "viento_kmh", "lluvia", "nieve", "es_festivo", "num_eventos"
))
CLASSIFIER_FEATURES = (*[c for c in C.P2_FEATURES if c != "origen_id"], "zona_enc")


def moment_columns(requests: DataFrame, hour: str = "hora_float") -> DataFrame:
    """Whole and cyclic hour and weekend flag of requests with ``hora_float`` and ``dia_semana``."""
    sin, cos = X.cyclic(hour)
    weekend = X.weekend("dia_semana")
    return requests.withColumns({
        "hora": F.floor(hour).cast("int"), "hora_sen": sin, "hora_cos": cos,
        "es_fin_semana": weekend, "es_finde": weekend,
    })


def zone_demand(requests: DataFrame, context: DataFrame, demand_model: PipelineModel) -> DataFrame:
    """Expected demand of (origen_id, moment) requests from the historical context."""
    means = [c for c in _P2_CONTEXT if c in context.columns]
    found = lookup_context(requests, context, means).drop("_n_contexto", "_filas")
    found = with_defaults(found, C.CONTEXT_DEFAULTS_P2)
    found = found.withColumn("n_viajes", F.coalesce("n_viajes", "oferta_inferida")) if "n_viajes" in means else (
        found.withColumn("n_viajes", F.col("oferta_inferida"))
    )
    supply = context.agg(F.avg("oferta_inferida").alias("m")).scalar()
    proxied = demand_model_proxies(found, mean_supply=F.coalesce(supply, F.col("oferta_inferida")))
    return predict(demand_model, proxied, C.P1_FEATURES, "demanda_p1")


def zone_potential(
    requests: DataFrame, context: DataFrame, demand_model: PipelineModel, classifier: PipelineModel,
    zone_dictionary: DataFrame,
) -> DataFrame:
    """Expected demand, success probability and recommendation per request."""
    demand = zone_demand(requests, context, demand_model)
    coded = encode_labels(demand, zone_dictionary, "origen_id", "zona_enc", unseen=0)
    scored = predict_probability(classifier, coded, CLASSIFIER_FEATURES, "exito_prob")
    return scored.withColumn(
        "recomendacion", F.when(F.col("exito_prob") > C.POTENTIAL_HIGH, "ALTA").otherwise("MODERADA")
    )


def trip_inputs(requests: DataFrame, context: DataFrame) -> DataFrame:
    """Trip requests with their context values, defaults and estimated total price.

    Requests bring ``precio_base`` and ``tipo_vehiculo``; context columns that clash
    with them keep a ``ctx_`` prefix.
    """
    means = [c for c in C.CONTEXT_P5_MEANS if c in context.columns and c not in ("hora_sen", "hora_cos", "es_fin_semana")]
    modes = [c for c in ("origen_zona", "origen_barrio", "evento_tipo", "franja_horaria") if c in context.columns]
    found = lookup_context(requests, context, means, modes, prefix="ctx_")
    found = with_defaults(found, C.CONTEXT_DEFAULTS_P5, prefix="ctx_")
    base = F.col("precio_base")
    extras = F.greatest(
        F.coalesce("ctx_precio_total_est", base + C.EXTRA_PRICE_DEFAULT) - F.coalesce("ctx_precio_base", base),
        F.lit(0.0),
    )
    plain = {c: F.col(f"ctx_{c}") for c in C.CONTEXT_DEFAULTS_P5}
    return found.withColumns({
        **plain,
        "precio_total_est": base + extras,
        "tipo_vehiculo": X.vehicle_type("tipo_vehiculo"),
        "hay_lluvia": X.has_rain("ctx_lluvia", "ctx_precipitation"),
        "hay_nieve": X.has_rain("ctx_nieve"),
    }).drop(*[c for c in found.columns if c.startswith("ctx_")])


def accept_score(tip: Column | str, speed: Column | str, back: Column | str) -> Column:
    """Weighted score of tip, speed and chance of a return trip."""
    w = C.ACCEPT_WEIGHTS
    return (
        w["propina"] * F.least(X.col(tip) / C.TIP_SCALE, F.lit(1.0))
        + w["velocidad"] * F.least(X.col(speed) / C.SPEED_SCALE, F.lit(1.0))
        + w["retorno"] * X.col(back)
    )


def with_decision(df: DataFrame, tip: str, speed: str, back: str) -> DataFrame:
    return df.withColumn("rentabilidad_score", accept_score(tip, speed, back)).withColumns({
        "decision": F.when(F.col("rentabilidad_score") >= C.ACCEPT_SCORE, "ACEPTAR").otherwise("RECHAZAR"),
        "encadenado": F.when(F.col(back) > C.POTENTIAL_HIGH, "ALTA").otherwise("MODERADA"),
    })


def trip_decisions(
    requests: DataFrame,
    key: Sequence[str],
    context_p2: DataFrame,
    context_p5: DataFrame,
    demand_model: PipelineModel,
    classifier: PipelineModel,
    zone_dictionary: DataFrame,
    speed_model: PipelineModel,
    tip_model: PipelineModel,
    speed_features: Sequence[str] = C.P4_NUMERIC,
) -> DataFrame:
    """Accept or reject ride requests.

    Speed and tip come from the origin's context; the chance of a return trip is the
    potential of the destination at the arrival time.
    """
    moment = moment_columns(requests)
    inputs = trip_inputs(moment, context_p5)
    speedy = predict(speed_model, inputs, speed_features, "velocidad_mph")
    tipped = predict(tip_model, speedy, C.P5_NUMERIC, "propina")

    later = X.arrival("hora_float", "dia_semana", "duracion_min")
    arrivals = tipped.select(
        *key, F.col("destino_id").alias("origen_id"), "mes_num", "dia_mes",
        *[later[c].alias(c) for c in ("hora_float", "hora", "dia_semana", "es_fin_semana", "hora_sen", "hora_cos")],
        later["es_fin_semana"].alias("es_finde"),
    )
    returns = zone_potential(arrivals, context_p2, demand_model, classifier, zone_dictionary).select(
        *key, F.col("hora").alias("hora_llegada"), F.col("exito_prob").alias("retorno_prob")
    )
    joined = tipped.join(returns, list(key))
    return with_decision(joined, "propina", "velocidad_mph", "retorno_prob")


def best_zones(
    zones: DataFrame, moment: DataFrame, context: DataFrame, demand_model: PipelineModel, k: int = 3
) -> DataFrame:
    """The ``k`` zones with the highest expected demand for each weekday and hour asked.

    ``moment`` holds hora_float, dia_semana, dia_mes and mes_num; each row is spread over
    the zones of the lookup, a closed list of a few hundred.
    """
    listed = zones.agg(F.collect_list(F.struct(F.col("LocationID").alias("origen_id"), "Zone", "Borough"))).scalar()
    rows = moment.select("hora_float", "dia_semana", "dia_mes", "mes_num", F.inline(listed))
    scored = zone_demand(moment_columns(rows), context, demand_model)
    from pyspark.sql.window import Window

    order = Window.partitionBy("dia_semana", "hora").orderBy(F.desc("demanda_p1"), "origen_id")
    return (
        scored.withColumn("posicion", F.row_number().over(order))
        .where(F.col("posicion") <= k)
        .select("dia_semana", "hora", "posicion", F.col("Zone").alias("nombre"), F.col("Borough").alias("barrio"),
                F.col("demanda_p1").alias("demanda"))
    )


def zone_options(summary: DataFrame) -> DataFrame:
    """Distinct zones with a display label, in id order."""
    label = F.concat(
        F.col("origen_id").cast("string"), F.lit(" · "), F.coalesce("origen_zona", F.lit("Zona")),
        F.when(F.coalesce(F.length("origen_barrio"), F.lit(0)) > 0, F.concat(F.lit(" ("), "origen_barrio", F.lit(")"))).otherwise(""),
    )
    zones = summary.select("origen_id", "origen_zona", "origen_barrio").distinct()
    return zones.select("origen_id", label.alias("etiqueta")).orderBy("origen_id")
