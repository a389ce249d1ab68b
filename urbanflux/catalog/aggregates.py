"""Registered queries: aggregations and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..operators import context, demand, flows, profiling, reports, splits, supply
from ..sources import dimensions as D
from ..sources.demand_inputs import demand_rows
from . import base as B
from .base import query
from .joins import CONTEXT_MEANS
from .scalars import AIRPORT_ZONES
from .windows import _zoned, features, zone_hours


@query("F1_zone_hour_demand", """
SELECT origen_id, timestamp_hora, demanda, temp_c, precipitation, viento_kmh, velocidad_mph, lluvia, nieve, es_festivo,
       num_eventos, hora, dia_semana, dia_mes, mes_num, es_finde FROM zone_hours
""", "temp_c precipitation viento_kmh velocidad_mph num_eventos")
def zone_hour_demand(spark, sf):
    return zone_hours(spark, sf)


@query("F2_zone_windows", """
SELECT origen_id, ventana_inicio, n_viajes, tasa_exito, espera_media, temp_c, precipitation, viento_kmh, lluvia, nieve,
       es_festivo, num_eventos, hora, dia_semana, es_finde, hora_sen, hora_cos, mes_num FROM zone_windows
""", "tasa_exito espera_media temp_c precipitation viento_kmh num_eventos hora_sen hora_cos")
def zone_windows(spark, sf):
    return supply.zone_windows(B.enriched(spark, sf))


@query("F3_inferred_supply", "SELECT * FROM supply")
def inferred_supply(spark, sf):
    return supply.inferred_supply(B.trips(spark, sf))


@query("F4_two_phase_mean", """
SELECT origen_id, sum(propina) AS suma, count(propina) AS casos, sum(propina) / nullif(count(propina), 0) AS media FROM trips GROUP BY 1
""", "suma media", 4)
def two_phase_mean(spark, sf):
    """Sum over count per key; Spark merges partial sums and counts by itself."""
    return B.trips(spark, sf).groupBy("origen_id").agg(
        F.sum("propina").alias("suma"), F.count("propina").alias("casos"), F.avg("propina").alias("media")
    )


@query("F5_context_table", """
SELECT origen_id, mes_num, dia_semana, hora, avg(distancia) AS distancia, avg(duracion_min) AS duracion_min,
       avg(velocidad_mph) AS velocidad_mph, avg(precio_base) AS precio_base, avg(espera_min) AS espera_min,
       avg(propina) AS propina, count(*) AS "_n_contexto" FROM trips GROUP BY 1, 2, 3, 4
""", " ".join(CONTEXT_MEANS))
def context_means(spark, sf):
    return context.context_table(B.trips(spark, sf), CONTEXT_MEANS)


_MODE = """(SELECT origen_id, mes_num, dia_semana, hora, {c} FROM (SELECT origen_id, mes_num, dia_semana, hora, {c}, row_number() OVER (
  PARTITION BY origen_id, mes_num, dia_semana, hora ORDER BY count(*) DESC, {c}) AS rn FROM zoned GROUP BY 1, 2, 3, 4, 5) WHERE rn = 1)"""


@query("F6_context_modes", f"""
SELECT origen_id, mes_num, dia_semana, hora, tipo_vehiculo, destino_barrio, destino_zona FROM {_MODE.format(c='tipo_vehiculo')}
JOIN {_MODE.format(c='destino_barrio')} USING (origen_id, mes_num, dia_semana, hora)
JOIN {_MODE.format(c='destino_zona')} USING (origen_id, mes_num, dia_semana, hora)
""")
def context_modes(spark, sf):
    """All modes from one pass that counts first."""
    modes = ("tipo_vehiculo", "destino_barrio", "destino_zona")
    return context.context_table(_zoned(spark, sf), (), modes).drop("_n_contexto")


@query("F7_band_summary", "SELECT * FROM band_summary", "demanda_media demanda_mediana demanda_total")
def band_summary(spark, sf):
    return demand.band_summary(demand_rows([B.trips(spark, sf)]))


_INDEX = """
SELECT {by}, propina_media, pasajeros_medios, volumen_viajes,
  (CASE WHEN max(propina_media) OVER () = min(propina_media) OVER () THEN 0 ELSE (propina_media - min(propina_media) OVER ())
     / (max(propina_media) OVER () - min(propina_media) OVER ()) END * 0.4::DOUBLE
 + CASE WHEN max(pasajeros_medios) OVER () = min(pasajeros_medios) OVER () THEN 0 ELSE (pasajeros_medios - min(pasajeros_medios) OVER ())
     / (max(pasajeros_medios) OVER () - min(pasajeros_medios) OVER ()) END * 0.3::DOUBLE
 + CASE WHEN max(volumen_viajes) OVER () = min(volumen_viajes) OVER () THEN 0 ELSE (volumen_viajes - min(volumen_viajes) OVER ())
     / (max(volumen_viajes) OVER () - min(volumen_viajes) OVER ()) END * 0.3::DOUBLE) * 100 AS "Poder_Adquisitivo"
FROM (SELECT {by}, {mean} AS propina_media, {mean2} AS pasajeros_medios, count(*) AS volumen_viajes FROM zoned GROUP BY 1)
"""


@query("F8_purchasing_power_borough", _INDEX.format(
    by="origen_barrio", mean="sum(propina) / count(*)", mean2="sum(num_pasajeros) / count(*)::DOUBLE"),
    "propina_media pasajeros_medios Poder_Adquisitivo")
def power_borough(spark, sf):
    return reports.purchasing_power(_zoned(spark, sf), "origen_barrio")


@query("F8_purchasing_power_zone", _INDEX.format(by="origen_id", mean="avg(propina)", mean2="avg(num_pasajeros)"),
       "propina_media pasajeros_medios Poder_Adquisitivo")
def power_zone(spark, sf):
    return reports.purchasing_power(_zoned(spark, sf), "origen_id", over_known=True)


@query("F9_daily_events", "SELECT * FROM city_days", dates="fecha")
def daily_events(spark, sf):
    return B.city_days(spark, sf)


@query("F10_zone_pairs", "SELECT origen_id, destino_id, count(*) AS viajes FROM trips GROUP BY 1, 2")
def zone_pairs(spark, sf):
    return flows.pair_counts(B.trips(spark, sf), "origen_id", "destino_id")


@query("F10_borough_pairs", "SELECT origen_barrio, destino_barrio, count(*) AS viajes FROM zoned GROUP BY 1, 2")
def borough_pairs(spark, sf):
    return flows.pair_counts(_zoned(spark, sf), "origen_barrio", "destino_barrio")


@query("F11_monthly_service", """
SELECT mes_num, tipo_vehiculo, avg(precio_total_est) AS precio_medio, count(distancia) AS num_viajes FROM fares GROUP BY 1, 2
""", "precio_medio")
def monthly_service(spark, sf):
    return reports.monthly_service(B.fares(spark, sf))


@query("F12_daily_measures", """
SELECT fecha_inicio::DATE AS fecha, avg(precio_total_est) AS precio_promedio, count(*) AS num_viajes,
       avg(velocidad_mph) AS velocidad_promedio, max(lluvia) AS lluvia, max(nieve) AS nieve FROM enriched GROUP BY 1
""", "precio_promedio velocidad_promedio", dates="fecha")
def daily_measures(spark, sf):
    return reports.daily_measures(B.enriched(spark, sf))


@query("F13_mean_trips_per_hour", """
SELECT hora, tipo_vehiculo, avg(n) AS num_viajes FROM (
  SELECT fecha_inicio::DATE AS f, hora, tipo_vehiculo, count(*) AS n FROM trips GROUP BY 1, 2, 3) GROUP BY 1, 2
""", "num_viajes")
def mean_trips_per_hour(spark, sf):
    return reports.mean_trips_per_hour(B.trips(spark, sf))


@query("F14_demand_in_rain", """
SELECT es_lluvia, avg(n) AS viajes_dia, CASE WHEN es_lluvia THEN 'Lluvia' ELSE 'Normal' END AS tipo_dia FROM (
  SELECT fecha_inicio::DATE AS f, lluvia = 1 AS es_lluvia, count(*) AS n FROM enriched GROUP BY 1, 2) GROUP BY 1
""", "viajes_dia")
def demand_in_rain(spark, sf):
    return reports.demand_in_rain(B.enriched(spark, sf))


#: Every numeric column of trips; a test holds this list against the table's schema.
PROFILE = (
    "id", "origen_id", "destino_id", "distancia", "espera_min", "precio_base", "precio_total_est", "propina", "tipo_pago", "num_pasajeros",
    "duracion_min", "velocidad_mph", "hora", "dia_semana", "es_fin_semana", "hora_sen", "hora_cos", "mes_num",
)


def _per_column(expr):
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, {expr.format(c=c)} FROM trips" for c in PROFILE)


@query("F15_numeric_profile", _per_column(
    "count({c}) AS count, avg({c}) AS mean, stddev({c}) AS std, min({c}) AS min, max({c}) AS max, "
    "quantile_cont({c}, 0.01) AS p01, quantile_cont({c}, 0.05) AS p05, quantile_cont({c}, 0.25) AS p25, "
    "quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, quantile_cont({c}, 0.95) AS p95, quantile_cont({c}, 0.99) AS p99"),
    "mean std min max p01 p05 p25 p50 p75 p95 p99")
def numeric_profile(spark, sf):
    return profiling.numeric_profile(B.trips(spark, sf), PROFILE)


@query("F16_shape_profile", _per_column("skewness({c}) AS skew, kurtosis({c}) AS kurtosis"), "skew kurtosis")
def shape_profile(spark, sf):
    return profiling.shape_profile(B.trips(spark, sf), PROFILE)


@query("F17_null_profile", """
SELECT * FROM (
  SELECT 'espera_min' AS variable, count(*) - count(espera_min) AS nulos, (count(*) - count(espera_min)) * 100.0::DOUBLE / count(*) AS porcentaje FROM trips
  UNION ALL SELECT 'propina', count(*) - count(propina), (count(*) - count(propina)) * 100.0::DOUBLE / count(*) FROM trips
  UNION ALL SELECT 'num_pasajeros', count(*) - count(num_pasajeros), (count(*) - count(num_pasajeros)) * 100.0::DOUBLE / count(*) FROM trips)
""", "porcentaje")
def null_profile(spark, sf):
    return profiling.null_profile(B.trips(spark, sf))


_CATS = ("tipo_vehiculo", "origen_zona", "destino_barrio", "franja_horaria")
_CAT_ROWS = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS valor, count(*) AS n FROM zoned GROUP BY 2" for c in _CATS)


@query("F18_category_profile", f"""
SELECT variable, valor, n, posicion::INTEGER AS posicion, cardinalidad FROM (
  SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, valor NULLS LAST) AS posicion,
         count(valor) OVER (PARTITION BY variable) AS cardinalidad FROM ({_CAT_ROWS})) WHERE posicion <= 15
""")
def category_profile(spark, sf):
    return profiling.category_profile(_zoned(spark, sf), _CATS)


@query("F19_iqr_outliers", " UNION ALL ".join(f"""
SELECT '{c}' AS variable, max(lo) AS inferior, max(hi) AS superior, count(*) FILTER ({c} < lo OR {c} > hi) AS atipicos,
       count(*) FILTER ({c} < lo OR {c} > hi) * 100.0::DOUBLE / count(*) AS pct
FROM trips CROSS JOIN (SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM
  (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM trips))""" for c in PROFILE), "inferior superior pct")
def iqr_outliers(spark, sf):
    return profiling.iqr_outliers(B.trips(spark, sf), PROFILE)


_PAIRS = [(a, b) for i, a in enumerate(C.CORRELATION_COLUMNS) for b in C.CORRELATION_COLUMNS[i:]]
_RANK = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"


def _correlated(rich):
    """Enriched trips with the further columns that are correlated."""
    return rich.withColumns({
        "hora_inicio": F.col("hora"), "es_finde": F.col("es_fin_semana"), "duracion_calc_min": X.minutes_between("fecha_inicio", "fecha_fin"),
        "ingreso_por_milla": F.col("precio_total_est") / F.nullif("distancia", F.lit(0.0)),
        "ingreso_por_min": F.col("precio_total_est") / F.nullif("duracion_min", F.lit(0.0)),
    })


@query("F20_spearman", """
WITH numbers AS MATERIALIZED (
  SELECT *, hora AS hora_inicio, es_fin_semana AS es_finde, date_diff('second', fecha_inicio, fecha_fin) / 60.0::DOUBLE AS duracion_calc_min,
         precio_total_est / nullif(distancia, 0) AS ingreso_por_milla, precio_total_est / nullif(duracion_min, 0) AS ingreso_por_min FROM enriched),
pairs AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN min(ra) < max(ra) AND min(rb) < max(rb) THEN corr(ra, rb) END AS rho FROM "
    f"(SELECT {_RANK.format(c=a)} AS ra, {_RANK.format(c=b)} AS rb FROM numbers WHERE {a} IS NOT NULL AND {b} IS NOT NULL)" for a, b in _PAIRS) + """)
SELECT a AS variable_a, b AS variable_b, rho FROM pairs UNION ALL SELECT b, a, rho FROM pairs WHERE a <> b
""", "rho")
def spearman(spark, sf):
    return profiling.spearman(_correlated(B.enriched(spark, sf)), C.CORRELATION_COLUMNS)


@query("F21_time_range", """
SELECT 'fecha_inicio' AS variable, min(fecha_inicio) AS minimo, max(fecha_inicio) AS maximo FROM fares
UNION ALL SELECT 'fecha_fin', min(fecha_fin), max(fecha_fin) FROM fares
""")
def time_range(spark, sf):
    return profiling.time_range(B.fares(spark, sf), ["fecha_inicio", "fecha_fin"])


for _name, _c in (("price", "precio_total_est"), ("distance", "distancia"), ("duration", "duracion_min")):
    def _hist(spark, sf, column=_c):
        return reports.histogram(B.trips(spark, sf), column)

    query(f"F22_histogram_{_name}", f"""
WITH k AS (SELECT tipo_vehiculo AS grupo, {_c} AS v FROM trips WHERE {_c} > 0
           AND {_c} <= (SELECT quantile_cont({_c}, 0.99) FROM trips WHERE {_c} > 0)),
e AS (SELECT grupo, min(v) AS lo, max(v) AS hi, count(*) AS n FROM k GROUP BY 1),
b AS (SELECT k.grupo, lo, hi, n, least(floor((v - lo) / ((hi - lo) / 60)), 59)::INTEGER AS bin, count(*) AS casos
      FROM k JOIN e ON k.grupo = e.grupo GROUP BY 1, 2, 3, 4, 5)
SELECT grupo, bin, lo + bin * ((hi - lo) / 60) AS desde, casos, casos / (n * ((hi - lo) / 60)) AS densidad FROM b
""", "desde densidad")(_hist)


@query("F23_price_by_zone", """
SELECT origen_zona, avg(precio_total_est) AS precio_medio, count(*) AS num_viajes FROM zoned
WHERE precio_total_est > 2 AND precio_total_est < 200 GROUP BY 1
""", "precio_medio")
def price_by_zone(spark, sf):
    return reports.price_by_zone(_zoned(spark, sf))


@query("F24_class_price_per_mile", """
SELECT tipo_zona, avg(p) AS precio_medio_milla, quantile_cont(p, 0.5) AS precio_mediano_milla, count(*) AS viajes FROM (
  SELECT precio_total_est / distancia AS p, CASE WHEN contains(lower(origen_zona), 'nation_1') OR contains(lower(destino_zona), 'nation_1')
         THEN 'Residencial Premium (UES/Chelsea)' ELSE 'Resto NYC' END AS tipo_zona FROM zoned WHERE precio_total_est > 0) GROUP BY 1
""", "precio_medio_milla precio_mediano_milla")
def class_price_per_mile(spark, sf):
    return reports.class_price_per_mile(_zoned(spark, sf), ("NATION_1",), "Residencial Premium (UES/Chelsea)")


@query("F25_box_summary", """
WITH q AS (SELECT tipo_vehiculo AS g, quantile_cont(precio_total_est, 0.25) AS q1, quantile_cont(precio_total_est, 0.5) AS mediana,
             quantile_cont(precio_total_est, 0.75) AS q3 FROM trips GROUP BY 1)
SELECT tipo_vehiculo, q1, mediana, q3,
       min(precio_total_est) FILTER (precio_total_est BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS bigote_bajo,
       max(precio_total_est) FILTER (precio_total_est BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS bigote_alto,
       count(*) FILTER (NOT precio_total_est BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS atipicos,
       count(*) AS n FROM trips JOIN q ON g = tipo_vehiculo GROUP BY 1, 2, 3, 4
""", "q1 mediana q3 bigote_bajo bigote_alto")
def box_summary(spark, sf):
    return reports.box_summary(B.trips(spark, sf), "precio_total_est", "tipo_vehiculo")


@query("F26_price_trend", """
SELECT tipo_vehiculo, regr_slope(precio_total_est, temp_c) AS pendiente, regr_intercept(precio_total_est, temp_c) AS ordenada,
       corr(precio_total_est, temp_c) AS correlacion, count(*) AS n FROM enriched GROUP BY 1
""", "pendiente ordenada correlacion")
def price_trend(spark, sf):
    return reports.linear_trend(B.enriched(spark, sf), "precio_total_est", "temp_c", ["tipo_vehiculo"])


@query("F26_demand_trend", """
SELECT regr_slope(viajes, temp_c) AS pendiente, regr_intercept(viajes, temp_c) AS ordenada, corr(viajes, temp_c) AS correlacion, count(*) AS n
FROM (SELECT temp_c, count(*) AS viajes FROM enriched GROUP BY 1)
""", "pendiente ordenada correlacion")
def demand_trend(spark, sf):
    return reports.linear_trend(reports.trips_by(B.enriched(spark, sf), "temp_c"), "viajes", "temp_c")


@query("F27_trips_per_temperature", "SELECT temp_c, count(*) AS viajes FROM enriched GROUP BY 1", "temp_c")
def trips_per_temperature(spark, sf):
    return reports.trips_by(B.enriched(spark, sf), "temp_c")


@query("F28_market_headline", """
SELECT *, viajes_taxi * 100.0::DOUBLE / total_viajes AS pct_taxi, viajes_vtc * 100.0::DOUBLE / total_viajes AS pct_vtc,
       precio_vtc - precio_taxi AS precio_dif, (precio_vtc - precio_taxi) / precio_taxi * 100 AS precio_dif_pct FROM (
  SELECT count(*) AS total_viajes, count(*) FILTER (tipo_vehiculo = 'Yellow Taxi') AS viajes_taxi,
         count(*) FILTER (tipo_vehiculo = 'VTC') AS viajes_vtc, avg(distancia) AS distancia_media, avg(duracion_min) AS duracion_media,
         avg(velocidad_mph) AS velocidad_media, avg(precio_total_est) FILTER (tipo_vehiculo = 'Yellow Taxi') AS precio_taxi,
         avg(precio_total_est) FILTER (tipo_vehiculo = 'VTC') AS precio_vtc FROM trips)
""", "distancia_media duracion_media velocidad_media precio_taxi precio_vtc pct_taxi pct_vtc precio_dif precio_dif_pct")
def market_headline(spark, sf):
    return reports.market_headline(B.trips(spark, sf))


@query("F29_airport_vs_rest", """
SELECT CASE WHEN contains(lower(origen_zona), 'nation_3') OR contains(lower(origen_zona), 'nation_7') OR contains(lower(destino_zona), 'nation_3')
       OR contains(lower(destino_zona), 'nation_7') THEN 'Aeropuerto' ELSE 'Resto' END AS tipo_viaje,
       avg(distancia) AS distancia_media, avg(precio_total_est) AS precio_medio FROM zoned GROUP BY 1
""", "distancia_media precio_medio")
def airport_vs_rest(spark, sf):
    return reports.class_means(_zoned(spark, sf), AIRPORT_ZONES)


@query("F30_event_timeline", """
SELECT fecha_inicio::DATE AS fecha, count(*) AS viajes, bool_or(num_eventos > 70) AS hubo_evento FROM enriched GROUP BY 1
""", dates="fecha")
def event_timeline(spark, sf):
    """A day counts as an event day here above 70 events, as every day has some."""
    e = B.enriched(spark, sf).withColumn("num_eventos", F.col("num_eventos") - 70)
    return reports.event_timeline(e)


@query("F31_rain_holiday_peak", """
SELECT lluvia = 1 AS es_lluvia, es_festivo = 1 AS es_festivo, (hora BETWEEN 8 AND 10) OR (hora BETWEEN 17 AND 19) AS hora_pico,
       count(*) AS viajes FROM enriched GROUP BY 1, 2, 3
""")
def rain_holiday_peak(spark, sf):
    return reports.rain_holiday_peak(B.enriched(spark, sf))


_SPEED = """
SELECT hora, tipo_vehiculo, avg(velocidad_mph) AS velocidad_mph,
       avg(velocidad_mph) - 1.96::DOUBLE * stddev(velocidad_mph) / sqrt(count(*)) AS ic_bajo,
       avg(velocidad_mph) + 1.96::DOUBLE * stddev(velocidad_mph) / sqrt(count(*)) AS ic_alto, count(*) AS n
FROM zoned WHERE duracion_min > 5 AND velocidad_mph > 0 AND velocidad_mph < 60 {more} GROUP BY 1, 2
"""


@query("F32_speed_by_hour", _SPEED.format(more=""), "velocidad_mph ic_bajo ic_alto")
def speed_by_hour(spark, sf):
    return reports.speed_by_hour(B.trips(spark, sf))


@query("F32_speed_by_hour_borough", _SPEED.format(more="AND origen_barrio = 'EUROPE'"), "velocidad_mph ic_bajo ic_alto")
def speed_by_hour_borough(spark, sf):
    return reports.speed_by_hour(_zoned(spark, sf), borough=" europe ")


@query("F32_borough_suggestions", """
SELECT DISTINCT "Borough" AS barrio FROM zones WHERE contains(lower("Borough"), 'me') ORDER BY 1
""")
def borough_suggestions(spark, sf):
    return reports.borough_suggestions(B.zones(spark, sf), " ME")


_PER_MILE = """
SELECT {key}, tipo_vehiculo, avg(precio_total_est / distancia) AS precio_por_milla FROM {table}
WHERE distancia > 0.5::DOUBLE AND precio_total_est > 2 AND precio_total_est / distancia < 20 GROUP BY 1, 2
"""


@query("F33_price_per_mile_hour", _PER_MILE.format(key="hora", table="trips"), "precio_por_milla")
def price_per_mile_hour(spark, sf):
    return reports.price_per_mile_by(B.trips(spark, sf), F.col("hora"))


@query("F33_price_per_mile_month", _PER_MILE.format(key="mes_num", table="fares"), "precio_por_milla")
def price_per_mile_month(spark, sf):
    return reports.price_per_mile_by(B.fares(spark, sf), F.col("mes_num"))


@query("F34_trips_by_day", "SELECT fecha_inicio::DATE AS fecha, tipo_vehiculo, count(*) AS viajes FROM fares GROUP BY 1, 2", dates="fecha")
def trips_by_day(spark, sf):
    return reports.trips_by(B.fares(spark, sf), F.to_date("fecha_inicio").alias("fecha"), "tipo_vehiculo")


@query("F34_trips_by_borough", "SELECT origen_barrio, count(*) AS viajes FROM zoned GROUP BY 1")
def trips_by_borough(spark, sf):
    return reports.trips_by(_zoned(spark, sf), "origen_barrio")


@query("F34_top_zones", "SELECT origen_zona, count(*) AS viajes FROM zoned GROUP BY 1 ORDER BY viajes DESC, 1 LIMIT 10")
def top_zones(spark, sf):
    return reports.top_zones(_zoned(spark, sf))


@query("F35_monthly_precipitation", "SELECT mes_num, count(*) AS viajes, avg(precipitation) AS precipitation FROM enriched GROUP BY 1",
       "precipitation")
def monthly_precipitation(spark, sf):
    return reports.monthly_precipitation(B.enriched(spark, sf))


@query("F35_sky_counts", """
SELECT CASE WHEN precipitation > 0 THEN 'Lluvia/Nieve' ELSE 'Despejado' END AS estado_cielo, tipo_vehiculo, count(*) AS viajes
FROM enriched GROUP BY 1, 2
""")
def sky_counts(spark, sf):
    return reports.sky_counts(B.enriched(spark, sf))


@query("F36_split_summary", """
SELECT split, count(*) AS filas, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct, min(timestamp_hora) AS fecha_inicio,
       max(timestamp_hora) AS fecha_fin, floor(date_diff('microsecond', min(timestamp_hora), max(timestamp_hora)) / 8.64e10)::INTEGER AS dias,
       avg((target > 0)::INTEGER) AS tasa_positiva, avg(target) AS media, stddev(target) AS std, min(target)::DOUBLE AS min,
       max(target)::DOUBLE AS max, quantile_cont(target::DOUBLE, 0.25) AS p25, quantile_cont(target::DOUBLE, 0.5) AS mediana,
       quantile_cont(target::DOUBLE, 0.75) AS p75 FROM features GROUP BY 1
""", "pct tasa_positiva media std min max p25 mediana p75")
def split_summary(spark, sf):
    return splits.split_summary(features(spark, sf), "timestamp_hora", "target")
