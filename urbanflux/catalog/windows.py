"""Registered queries: window functions, sorts, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as C
from ..operators import anomalies, demand, evaluation, reports, sequences, splits
from ..plans import feature_chain
from . import base as B
from .base import query
from .quality import _REPORT_COLS, _REPORT_DOUBLES, report


def zone_hours(spark, sf):
    return demand.zone_hour_demand(B.enriched(spark, sf))


def features(spark, sf):
    """Demand features with the chronological split."""
    return feature_chain.demand_table(B.enriched(spark, sf), span=B.trips(spark, sf))


def labelled(spark, sf):
    return feature_chain.labelled_windows(B.enriched(spark, sf), arrivals=B.trips(spark, sf))


def good_zones(spark, sf):
    return feature_chain.supply_table(B.enriched(spark, sf), arrivals=B.trips(spark, sf))


def counts(spark, sf):
    return demand.zone_hour_counts(B.trips(spark, sf))


@query("G1_lags", "SELECT origen_id, timestamp_hora, lag_1h::DOUBLE AS lag_1h, lag_2h::DOUBLE AS lag_2h, lag_3h::DOUBLE AS lag_3h, "
       "lag_6h::DOUBLE AS lag_6h, lag_12h::DOUBLE AS lag_12h, lag_24h::DOUBLE AS lag_24h FROM series")
def lags(spark, sf):
    z = demand.with_lags(counts(spark, sf))
    return z.select("origen_id", "timestamp_hora", *[F.col(f"lag_{n}h").cast("double") for n in C.LAGS])


@query("G2_next_target", "SELECT origen_id, timestamp_hora, demanda, target::DOUBLE AS target FROM series")
def next_target(spark, sf):
    return demand.with_target(counts(spark, sf)).withColumn("target", F.col("target").cast("double"))


@query("G3_rolling", "SELECT origen_id, timestamp_hora, roll_mean_3h, roll_std_3h, roll_mean_24h, roll_std_24h FROM series",
       "roll_mean_3h roll_std_3h roll_mean_24h roll_std_24h")
def rolling(spark, sf):
    return demand.with_rolling(counts(spark, sf)).drop("demanda")


@query("G4_good_zone_label", "SELECT origen_id, ventana_inicio, tasa_exito, target FROM labelled", "tasa_exito")
def good_zone_label(spark, sf):
    return labelled(spark, sf).select("origen_id", "ventana_inicio", "tasa_exito", "target")


@query("G5_market_share", """
SELECT origen_barrio, tipo_vehiculo, count(*) AS viajes,
       count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY origen_barrio) AS pct FROM zoned GROUP BY 1, 2
""", "pct")
def market_share(spark, sf):
    return reports.market_share(_zoned(spark, sf), "origen_barrio")


@query("G5_month_share", """
SELECT mes_num, tipo_vehiculo, count(*) AS viajes, count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY mes_num) AS pct
FROM fares GROUP BY 1, 2
""", "pct")
def month_share(spark, sf):
    return reports.market_share(B.fares(spark, sf), "mes_num")


@query("G5_class_hour_profile", """
SELECT tipo_zona, hora, count(*) AS num_viajes, count(*) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY tipo_zona) AS proporcion
FROM (SELECT hora, CASE WHEN contains(lower(origen_zona), 'nation_2') OR contains(lower(destino_zona), 'nation_2')
      THEN 'Midtown (Business)' ELSE 'Resto NYC' END AS tipo_zona FROM zoned) GROUP BY 1, 2
""", "proporcion")
def class_hour_profile(spark, sf):
    return reports.class_hour_profile(_zoned(spark, sf), ("NATION_2",), "Midtown (Business)")


def _zoned(spark, sf):
    from ..operators.enrichment import with_zones

    return with_zones(B.trips(spark, sf), B.zones(spark, sf))


@query("G6_demand_score", "SELECT origen_id, franja_horaria, score_demanda_0_100 FROM levels")
def demand_score(spark, sf):
    from ..sources.demand_inputs import demand_rows

    summary = demand.band_summary(demand_rows([B.trips(spark, sf)]))
    return demand.with_score(summary).select("origen_id", "franja_horaria", "score_demanda_0_100")


@query("G7_peak_hours", "SELECT * FROM peaks", "demanda_hora_pico")
def peak_hours(spark, sf):
    from ..sources.demand_inputs import demand_rows

    return demand.peak_hours(demand_rows([B.trips(spark, sf)]))


_HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"


@query("G8_positional_split", f"""
SELECT split, count(*) AS filas, min(fecha_inicio) AS primera, max(fecha_inicio) AS ultima,
       sum(id) ::BIGINT AS suma_id FROM (
  SELECT *, CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT id, fecha_inicio, count(*) OVER () AS n,
               row_number() OVER (ORDER BY fecha_inicio, {_HASH.format('id::VARCHAR')}, id) AS rn FROM trips)) GROUP BY 1
""")
def positional_split(spark, sf):
    out = splits.split_by_position(B.trips(spark, sf), "fecha_inicio", ["id"])
    return out.groupBy("split").agg(
        F.count(F.lit(1)).alias("filas"), F.min("fecha_inicio").alias("primera"), F.max("fecha_inicio").alias("ultima"),
        F.sum("id").alias("suma_id"),
    )


@query("G8_positional_split_ties", f"""
SELECT split, count(*) AS filas, min(fecha_inicio) AS primera, max(fecha_inicio) AS ultima, sum(o_orderkey)::BIGINT AS suma FROM (
  SELECT *, CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT o_orderkey, o_orderdate AS fecha_inicio, count(*) OVER () AS n,
               row_number() OVER (ORDER BY o_orderdate, {_HASH.format('o_orderkey::VARCHAR')}, o_orderkey) AS rn FROM orders)) GROUP BY 1
""")
def positional_split_ties(spark, sf):
    """Daily times: many rows share the boundary time."""
    o = B.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("fecha_inicio"))
    out = splits.split_by_position(o, "fecha_inicio", ["o_orderkey"])
    return out.groupBy("split").agg(
        F.count(F.lit(1)).alias("filas"), F.min("fecha_inicio").alias("primera"), F.max("fecha_inicio").alias("ultima"),
        F.sum("o_orderkey").alias("suma"),
    )


@query("G9_consecutive_run", """
WITH d AS (SELECT origen_id, timestamp_hora, demanda,
             CASE WHEN timestamp_hora - lag(timestamp_hora) OVER w = INTERVAL 1 HOUR THEN 0 ELSE 1 END AS nuevo,
             row_number() OVER w AS pos FROM series WINDOW w AS (PARTITION BY origen_id ORDER BY timestamp_hora)),
r AS (SELECT *, sum(nuevo) OVER (PARTITION BY origen_id ORDER BY timestamp_hora) AS run FROM d),
l AS (SELECT *, count(*) OVER (PARTITION BY origen_id, run) AS len,
             row_number() OVER (PARTITION BY origen_id, run ORDER BY timestamp_hora) AS k FROM r),
c AS (SELECT *, min(CASE WHEN len >= 24 THEN run END) OVER (PARTITION BY origen_id) AS chosen FROM l)
SELECT origen_id, timestamp_hora, demanda FROM c WHERE (chosen IS NOT NULL AND run = chosen AND k <= 24) OR (chosen IS NULL AND pos <= 24)
""")
def consecutive_run(spark, sf):
    return sequences.first_run(counts(spark, sf), 24).select("origen_id", "timestamp_hora", "demanda")


@query("G10_sequences", """
SELECT origen_id, timestamp_hora, array_to_string(secuencia, ',') AS secuencia, y FROM (
  SELECT origen_id, timestamp_hora, target::DOUBLE AS y,
         list(demanda) OVER (PARTITION BY origen_id ORDER BY timestamp_hora ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS secuencia
  FROM (SELECT * FROM series WHERE target IS NOT NULL)) WHERE len(secuencia) = 12
""")
def sequence_rows(spark, sf):
    z = demand.with_target(counts(spark, sf)).where("target is not null")
    seq = sequences.feature_sequences(z, ["demanda"], 12)
    text = F.array_join(F.transform("secuencia", lambda s: s["demanda"].cast("int").cast("string")), ",")
    return seq.select("origen_id", "timestamp_hora", text.alias("secuencia"), "y")


@query("G11_neighbourhood", """
WITH caso AS (SELECT origen_id, timestamp_hora AS caso FROM zone_hours ORDER BY demanda DESC, origen_id, timestamp_hora LIMIT 1)
SELECT origen_id, timestamp_hora, demanda, caso FROM zone_hours JOIN caso USING (origen_id)
WHERE timestamp_hora BETWEEN caso - INTERVAL 12 HOUR AND caso + INTERVAL 11 HOUR
""")
def neighbourhood(spark, sf):
    z = counts(spark, sf)
    case = z.orderBy(F.desc("demanda"), "origen_id", "timestamp_hora").limit(1)
    return sequences.around_cases(z, case).select("origen_id", "timestamp_hora", "demanda", "caso")


@query("G12_tercile_levels", "SELECT origen_id, franja_horaria, demanda_media, nivel_demanda FROM levels", "demanda_media")
def tercile_levels(spark, sf):
    from ..sources.demand_inputs import demand_rows

    summary = demand.band_summary(demand_rows([B.trips(spark, sf)]))
    return demand.with_level(summary).select("origen_id", "franja_horaria", "demanda_media", "nivel_demanda")


@query("G13_split_overlap", """
SELECT max(timestamp_hora) FILTER (split = 'train') < min(timestamp_hora) FILTER (split = 'val') AS train_antes_de_val,
       max(timestamp_hora) FILTER (split = 'val') < min(timestamp_hora) FILTER (split = 'test') AS val_antes_de_test FROM features
""")
def split_overlap(spark, sf):
    return splits.split_overlap(features(spark, sf), "timestamp_hora")


# --- sorts and top-k ---------------------------------------------------------------

@query("H1_sorted_write", """
SELECT tipo_vehiculo, year(fecha_inicio)::INTEGER AS anio, mes_num AS mes, count(*) AS viajes, min(fecha_inicio) AS primera FROM fares GROUP BY 1, 2, 3
""")
def sorted_write(spark, sf):
    """Trips written by service and month in time order, then read back."""
    from ..session import scratch_path
    from ..sources.sinks import write_trips

    path = scratch_path(spark, "trips")
    write_trips(B.fares(spark, sf), path)
    return spark.read.parquet(path).groupBy("tipo_vehiculo", "anio", "mes").agg(
        F.count(F.lit(1)).alias("viajes"), F.min("fecha_inicio").alias("primera")
    )


@query("H2_top_demand", f"""
SELECT {_REPORT_COLS} FROM report WHERE nivel_demanda = 'alta' ORDER BY demanda_media DESC, origen_id, franja_horaria LIMIT 20
""", _REPORT_DOUBLES)
def top_demand(spark, sf):
    return demand.top_demand(report(spark, sf).where("nivel_demanda = 'alta'"), 20)


COMPARED_SQL = """
(SELECT *, greatest(roll_mean_24h, 0) AS pred_modelo, demanda::DOUBLE AS pred_naive, media_hist AS pred_media_hist,
        abs(target - greatest(roll_mean_24h, 0)) AS error_modelo, abs(target - demanda)::DOUBLE AS error_naive,
        abs(target - media_hist) AS error_media_hist, target - greatest(roll_mean_24h, 0) AS sesgo,
        abs(target - demanda) - abs(target - greatest(roll_mean_24h, 0)) AS mejora_vs_naive,
        abs(target - media_hist) - abs(target - greatest(roll_mean_24h, 0)) AS mejora_vs_media_hist
 FROM features WHERE split = 'test')
"""


def compared(spark, sf):
    """Test rows with the trailing daily mean standing in for a fitted model."""
    test = features(spark, sf).where("split = 'test'")
    return evaluation.with_prediction_errors(test, "roll_mean_24h")


_CASE_ORDER = {
    "mejores": ("WHERE mejora_vs_naive > 1 AND mejora_vs_media_hist > 1", "round(error_modelo, 9), target DESC"),
    "peores": ("", "round(error_modelo, 9) DESC"),
    "picos": (f"WHERE target >= (SELECT quantile_cont(target, 0.99) FROM {COMPARED_SQL})", "round(error_modelo, 9)"),
    "infra": ("", "round(sesgo, 9) DESC"),
    "sobre": ("", "round(sesgo, 9)"),
}

for _kind, (_where, _order) in _CASE_ORDER.items():
    def _examples(spark, sf, kind=_kind):
        rows = compared(spark, sf)
        # equal errors reached in another order of additions must tie
        rows = rows.withColumns({c: F.round(c, 9) for c in ("error_modelo", "sesgo")})
        return evaluation.example_rows(rows, kind, margin=1.0).select("origen_id", "timestamp_hora", "target", "error_modelo")

    query(f"H3_examples_{_kind}", f"""
SELECT origen_id, timestamp_hora, target, error_modelo FROM {COMPARED_SQL} {_where} ORDER BY {_order}, origen_id, timestamp_hora LIMIT 10
""", "error_modelo")(_examples)


@query("H4_hardest_zones", f"""
SELECT origen_id, count(*) AS n_casos, sum(demanda)::BIGINT AS total_viajes, avg(target) AS demanda_media_real,
       avg(pred_modelo) AS pred_media, avg(error_modelo) AS error_medio FROM {COMPARED_SQL}
GROUP BY 1 ORDER BY error_medio DESC, origen_id LIMIT 10
""", "demanda_media_real pred_media error_medio")
def hardest_zones(spark, sf):
    return evaluation.hardest_zones(compared(spark, sf))


@query("H4_busiest_zones", f"""
SELECT origen_id, count(*) AS n_casos, sum(demanda)::BIGINT AS total_viajes, avg(target) AS demanda_media_real,
       avg(pred_modelo) AS pred_media, avg(error_modelo) AS error_medio FROM {COMPARED_SQL}
GROUP BY 1 ORDER BY total_viajes DESC, origen_id LIMIT 10
""", "demanda_media_real pred_media error_medio")
def busiest_zones(spark, sf):
    return evaluation.busiest_zones(compared(spark, sf))


@query("H5_representative_zones", """
WITH t AS (SELECT origen_id, sum(demanda) AS total FROM zone_hours GROUP BY 1), m AS (SELECT quantile_cont(total, 0.5) AS q FROM t)
SELECT (SELECT origen_id FROM t ORDER BY total DESC, origen_id LIMIT 1) AS zona_alta,
       (SELECT origen_id FROM t, m ORDER BY abs(total - q), origen_id LIMIT 1) AS zona_media,
       (SELECT origen_id FROM t ORDER BY total, origen_id LIMIT 1) AS zona_baja
""")
def representative_zones(spark, sf):
    return evaluation.representative_zones(counts(spark, sf))


@query("H6_top_routes_borough", """
SELECT origen_barrio, destino_barrio, count(*) AS viajes FROM zoned GROUP BY 1, 2 ORDER BY viajes DESC, 1, 2 LIMIT 5
""")
def top_routes_borough(spark, sf):
    from ..operators.flows import top_routes

    return top_routes(_zoned(spark, sf), "origen_barrio", "destino_barrio", 5)


@query("H6_top_routes_zone", """
SELECT origen_zona, destino_zona, count(*) AS viajes FROM zoned GROUP BY 1, 2 ORDER BY viajes DESC, 1, 2 LIMIT 15
""")
def top_routes_zone(spark, sf):
    from ..operators.flows import top_routes

    return top_routes(_zoned(spark, sf), "origen_zona", "destino_zona", 15)


@query("H6_dearest_zones", """
SELECT origen_zona, avg(precio_total_est) AS precio_medio, count(*) AS num_viajes FROM zoned
WHERE precio_total_est > 2 AND precio_total_est < 200 GROUP BY 1 ORDER BY precio_medio DESC, 1 LIMIT 15
""", "precio_medio")
def dearest_zones(spark, sf):
    return reports.price_by_zone(_zoned(spark, sf)).orderBy(F.desc("precio_medio"), "origen_zona").limit(15)


@query("K5_volume_anomalies", """
WITH d AS (SELECT fecha_inicio::DATE AS fecha, count(*) AS total_viajes, max(lluvia) AS lluvia, max(nieve) AS nieve,
             max(es_festivo) AS es_festivo, max(num_eventos) AS num_eventos, (max(num_eventos) > 0)::INTEGER AS hay_evento
           FROM enriched GROUP BY 1),
e AS (SELECT d.*, CASE WHEN total_viajes > m + 1.0::DOUBLE * s THEN 'Anomalía Alta' WHEN total_viajes < m - 1.0::DOUBLE * s THEN 'Anomalía Baja'
           ELSE 'Normal' END AS estado FROM d CROSS JOIN (SELECT avg(total_viajes) AS m, stddev(total_viajes) AS s FROM d))
SELECT *, CASE WHEN estado = 'Normal' THEN 'Normal' ELSE estado || ' (' ||
  coalesce(nullif(concat_ws(', ', CASE WHEN hay_evento = 1 THEN 'evento' END, CASE WHEN lluvia = 1 THEN 'lluvia' END,
  CASE WHEN nieve = 1 THEN 'nieve' END, CASE WHEN es_festivo = 1 THEN 'festivo' END), ''), 'sin causa obvia') || ')' END AS estado_detalle FROM e
""", dates="fecha")
def volume_anomalies(spark, sf):
    """One deviation here, so that both kinds of day occur in a month."""
    return anomalies.volume_anomalies(B.enriched(spark, sf), z=1.0)


@query("K6_price_anomalies", """
WITH d AS (SELECT fecha_inicio::DATE AS fecha, avg(precio_total_est) AS precio_promedio, count(*) AS num_viajes,
             avg(velocidad_mph) AS velocidad_promedio, max(lluvia) AS lluvia, max(nieve) AS nieve FROM enriched GROUP BY 1)
SELECT d.*, precio_promedio > m + 2 * s AS anomalia_precio FROM d CROSS JOIN
  (SELECT avg(precio_promedio) AS m, stddev(precio_promedio) AS s FROM d)
""", "precio_promedio velocidad_promedio", dates="fecha")
def price_anomalies(spark, sf):
    return anomalies.price_anomalies(reports.daily_measures(B.enriched(spark, sf)))
