"""Registered queries: filters, quality rules, imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..operators import cleaning, context, demand, enrichment, imputation, reports
from ..operators.models import model_matrix
from ..session import written_table
from ..sources.dimensions import unique_by_key
from . import base as B
from .base import query


@query("C1_ends_after_start", "SELECT l_orderkey, l_linenumber, l_partkey FROM fares WHERE fecha_fin > fecha_inicio")
def ends_after_start(spark, sf):
    f = B.fares(spark, sf).where(cleaning.ends_after_start())
    return f.select("l_orderkey", "l_linenumber", "l_partkey")


@query("C2_physical_limits", """
SELECT event_id FROM ek WHERE value / 10 > 0.1::DOUBLE AND value / 10 < 200 AND k > 1 AND k < 180
""")
def physical_limits(spark, sf):
    e = B.raw_events(spark, sf).select("event_id", (F.col("value") / 10).alias("distancia"), F.col("k").alias("duracion_min"))
    return e.where(cleaning.physical_limits()).select("event_id")


@query("C3_known_zones", """
SELECT tpep_pickup_datetime AS fecha_inicio, "PULocationID" AS origen_id, "DOLocationID" AS destino_id FROM raw_yellow
WHERE "PULocationID" NOT IN (264, 265) AND "DOLocationID" NOT IN (264, 265)
""")
def known_zones(spark, sf):
    y = cleaning.rename_raw(B.raw_yellow(spark, sf), "yellow")
    return y.where(cleaning.known_zones()).select("fecha_inicio", "origen_id", "destino_id")


_COMMON_YELLOW = """
FROM raw_yellow WHERE tpep_dropoff_datetime > tpep_pickup_datetime AND trip_distance > 0.1::DOUBLE AND trip_distance < 200
  AND date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) > 1
  AND date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) < 180
  AND "PULocationID" NOT IN (264, 265) AND "DOLocationID" NOT IN (264, 265)
"""


@query("C4_null_rules", f"""
SELECT count(*) AS filas_basicas, count(*) FILTER (passenger_count IS NOT NULL AND congestion_surcharge IS NOT NULL) AS filas_estrictas
{_COMMON_YELLOW}
""")
def null_rules(spark, sf):
    y = cleaning.rename_raw(B.raw_yellow(spark, sf), "yellow")
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    strict = count(cleaning.common_rules(y, "yellow"))
    return count(cleaning.common_rules(y, "yellow", strict_nulls=False)).select(
        F.col("n").alias("filas_basicas"), strict.scalar().alias("filas_estrictas")
    )


@query("C5_clean_yellow", f"""
SELECT tpep_pickup_datetime AS fecha_inicio, tpep_dropoff_datetime AS fecha_fin, "PULocationID" AS origen_id,
       "DOLocationID" AS destino_id, passenger_count::INTEGER AS num_pasajeros, trip_distance AS distancia,
       CASE WHEN payment_type = 1 THEN tip_amount END AS propina, payment_type AS tipo_pago,
       date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)::DOUBLE AS duracion_min,
       trip_distance / (date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0::DOUBLE) AS velocidad_mph,
       'yellow' AS tipo_vehiculo, fare_amount AS precio_base, total_amount AS precio_total_est, 0.0::DOUBLE AS espera_min
{_COMMON_YELLOW} AND passenger_count BETWEEN 0 AND 8 AND congestion_surcharge IS NOT NULL
  AND fare_amount >= 0 AND fare_amount < 500 AND total_amount > 0 AND total_amount < 500
""", "distancia propina duracion_min velocidad_mph precio_base precio_total_est espera_min")
def clean_yellow(spark, sf):
    return cleaning.clean_trips(B.raw_yellow(spark, sf), "yellow")


@query("C6_clean_fhvhv", """
SELECT pickup_datetime AS fecha_inicio, dropoff_datetime AS fecha_fin, "PULocationID" AS origen_id, "DOLocationID" AS destino_id,
       trip_miles AS distancia, (k - 3)::DOUBLE AS duracion_min, trip_miles / ((k - 3) / 60.0::DOUBLE) AS velocidad_mph,
       'fhvhv' AS tipo_vehiculo, base_passenger_fare AS precio_base,
       base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge AS precio_total_est,
       ((k * 2) % 130 - 3)::DOUBLE AS espera_min, tips AS propina
FROM raw_fhvhv
WHERE dropoff_datetime > pickup_datetime AND trip_miles > 0.1::DOUBLE AND trip_miles < 200 AND k - 3 > 1 AND k - 3 < 180
  AND "PULocationID" NOT IN (264, 265) AND "DOLocationID" NOT IN (264, 265) AND on_scene_datetime IS NOT NULL
  AND base_passenger_fare > 0 AND base_passenger_fare < 500 AND trip_time > 30 AND trip_time < 21600
  AND (k * 2) % 130 - 3 BETWEEN 0 AND 120 AND tolls >= 0
  AND base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge < 500
""", "distancia duracion_min velocidad_mph precio_base precio_total_est espera_min propina")
def clean_fhvhv(spark, sf):
    return cleaning.clean_trips(B.raw_fhvhv(spark, sf), "fhvhv")


@query("C7_month_of_file", "SELECT l_orderkey, l_linenumber, l_partkey, fecha_inicio FROM fares WHERE mes_num = month(fecha_fin)")
def month_of_file(spark, sf):
    """The month of the drop-off plays the month in the file name."""
    f = cleaning.in_month(B.fares(spark, sf), F.month("fecha_fin"))
    return f.select("l_orderkey", "l_linenumber", "l_partkey", "fecha_inicio")


@query("C8_unreliable_tips", """
SELECT pickup_datetime AS fecha_inicio, CASE WHEN tips <> 0 THEN tips END AS propina FROM raw_fhvhv
WHERE base_passenger_fare > 0 AND base_passenger_fare < 500 AND trip_time > 30 AND trip_time < 21600
  AND (k * 2) % 130 - 3 BETWEEN 0 AND 120 AND tolls >= 0
  AND base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge < 500
""", "propina")
def unreliable_tips(spark, sf):
    """With a payment column, a zero ride-hail tip is unknown."""
    f = B.raw_fhvhv(spark, sf).withColumn("payment_type", F.lit(1))
    typed = cleaning.coerce_types(cleaning.rename_raw(f, "fhvhv")).withColumns({
        "duracion_min": F.lit(1.0), "velocidad_mph": F.lit(1.0), "tipo_vehiculo": F.lit("fhvhv"),
    })
    return cleaning.fhvhv_rules(typed).select("fecha_inicio", "propina")


@query("C9_speed_band", "SELECT id, velocidad_mph FROM trips WHERE velocidad_mph BETWEEN 2 AND 85", "velocidad_mph")
def speed_band(spark, sf):
    return B.trips(spark, sf).where(cleaning.speed_band()).select("id", "velocidad_mph")


for _name, _column in (("price", "precio_total_est"), ("distance", "distancia"), ("duration", "duracion_min")):
    def _trim(spark, sf, column=_column):
        return cleaning.trim_above(B.trips(spark, sf), column).select("id", column)

    query(f"C10_trim_p99_{_name}", f"""
SELECT id, {_column} FROM trips WHERE {_column} > 0
  AND {_column} <= (SELECT quantile_cont({_column}, 0.99) FROM trips WHERE {_column} > 0)
""", _column)(_trim)


@query("C11_report_filters", """
SELECT (SELECT count(*) FROM trips WHERE distancia > 0.5::DOUBLE AND precio_total_est > 2 AND precio_total_est / distancia < 20) AS por_milla,
       (SELECT count(*) FROM trips WHERE precio_total_est > 2 AND precio_total_est < 200) AS precios,
       (SELECT count(*) FROM trips WHERE duracion_min > 5 AND velocidad_mph > 0 AND velocidad_mph < 60) AS velocidades
""")
def report_filters(spark, sf):
    return B.trips(spark, sf).agg(
        F.count_if(reports.per_mile_rule()).alias("por_milla"), F.count_if(reports.price_rule()).alias("precios"),
        F.count_if(reports.speed_rule(5.0)).alias("velocidades"),
    )


@query("C12_unique_lookup", """
SELECT c_nationkey, c_mktsegment, c_custkey FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_custkey) AS rn FROM customer) WHERE rn = 1
""")
def unique_lookup(spark, sf):
    c = B.table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", "c_custkey")
    return unique_by_key(c, ["c_nationkey"], ["c_mktsegment", "c_custkey"])


@query("C12_duplicate_rows", """
SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)))::BIGINT AS duplicadas FROM lineitem
""")
def duplicate_rows(spark, sf):
    return cleaning.duplicate_rows(B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


def report(spark, sf):
    from ..plans.demand_report import demand_report

    return demand_report([B.trips(spark, sf)], B.zones(spark, sf))


_REPORT_COLS = (
    "origen_id, franja_horaria, demanda_media, demanda_mediana, demanda_total, horas_observadas, hora_pico, "
    "demanda_hora_pico, nivel_demanda, score_demanda_0_100, origen_barrio, origen_zona, origen_service_zone"
)
_REPORT_DOUBLES = "demanda_media demanda_mediana demanda_total demanda_hora_pico score_demanda_0_100"


@query("C13_demand_query", f"""
SELECT {_REPORT_COLS} FROM report WHERE contains(lower(origen_barrio), 'asia') AND franja_horaria = 'manana' AND demanda_media >= 1
""", _REPORT_DOUBLES)
def demand_query(spark, sf):
    return demand.query_demand(report(spark, sf), zona="Ásia", franja="Mañana", demanda_min=1.0)


@query("C13_demand_query_level", f"""
SELECT {_REPORT_COLS} FROM report WHERE nivel_demanda = 'alta'
""", _REPORT_DOUBLES)
def demand_query_level(spark, sf):
    return demand.query_demand(report(spark, sf), nivel="ALTA")


@query("C14_demand_form", f"""
SELECT {_REPORT_COLS} FROM report
""", _REPORT_DOUBLES)
def demand_form(spark, sf):
    """Empty form fields mean no filter."""
    return demand.query_demand(report(spark, sf), zona="", franja=" ", nivel="", demanda_min="", require_filter=False)


# --- imputation -----------------------------------------------------------------

@query("D1_service_defaults", """
SELECT tipo_vehiculo, id, CASE WHEN tipo_vehiculo = 'VTC' THEN espera_min ELSE coalesce(espera_min, 0) END AS espera_min,
       (CASE WHEN tipo_vehiculo = 'VTC' THEN num_pasajeros ELSE coalesce(num_pasajeros, 1) END)::DOUBLE AS num_pasajeros FROM trips
""", "espera_min num_pasajeros")
def service_defaults(spark, sf):
    t = B.trips(spark, sf).select("tipo_vehiculo", "id", "espera_min", F.col("num_pasajeros").cast("double").alias("num_pasajeros"))
    taxi = cleaning.service_defaults(t.where("tipo_vehiculo <> 'VTC'"), "yellow")
    return taxi.unionByName(cleaning.service_defaults(t.where("tipo_vehiculo = 'VTC'"), "fhvhv"))


@query("D2_weather_gaps", "SELECT id, temp_c, precipitation, viento_kmh, lluvia, nieve FROM enriched", "temp_c precipitation viento_kmh")
def weather_gaps(spark, sf):
    trips, zones, weather = B.trips(spark, sf), B.zones(spark, sf), written_table(B.weather(spark, sf), "weather")
    t = enrichment.with_weather(enrichment.with_zones(trips, zones), weather)
    medians = enrichment.weather_medians(trips, zones, weather)
    return enrichment.fill_weather(t, medians=medians).select("id", "temp_c", "precipitation", "viento_kmh", "lluvia", "nieve")


_TIP_MEDIAN = "(SELECT quantile_cont(propina, 0.5) FROM trips WHERE propina > 0)"


@query("D3_tip_median", f"SELECT id, coalesce(propina, {_TIP_MEDIAN}) AS propina FROM trips", "propina")
def tip_median(spark, sf):
    return imputation.fill_tips(B.trips(spark, sf), false_zeros=False).select("id", "propina")


@query("D4_false_zero_tips", f"""
SELECT id, CASE WHEN propina IS NULL OR (propina = 0 AND precio_total_est > 10) THEN {_TIP_MEDIAN} ELSE propina END AS propina FROM trips
""", "propina")
def false_zero_tips(spark, sf):
    return imputation.fill_tips(B.trips(spark, sf)).select("id", "propina")


@query("D5_passenger_draw", """
SELECT id, coalesce(num_pasajeros, v)::INTEGER AS num_pasajeros FROM (
  SELECT id, num_pasajeros, ('0x' || substr(md5(id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM trips) t
JOIN (SELECT num_pasajeros AS v, (cum - c) / n::DOUBLE AS desde, cum / n::DOUBLE AS hasta
      FROM (SELECT num_pasajeros, count(*) AS c, sum(count(*)) OVER (ORDER BY num_pasajeros) AS cum,
                   sum(count(*)) OVER () AS n FROM trips WHERE num_pasajeros IS NOT NULL GROUP BY 1)) d
  ON u >= desde AND u < hasta
""")
def passenger_draw(spark, sf):
    return imputation.fill_passengers(B.trips(spark, sf), "id").select("id", "num_pasajeros")


@query("D6_historic_mean", """
SELECT z.origen_id, z.timestamp_hora, coalesce(m, (SELECT avg(demanda) FROM zone_hours, hour_cuts WHERE timestamp_hora < corte_train)) AS media_hist
FROM zone_hours z LEFT JOIN (SELECT origen_id, hora, dia_semana, avg(demanda) AS m FROM zone_hours, hour_cuts
  WHERE timestamp_hora < corte_train GROUP BY 1, 2, 3) USING (origen_id, hora, dia_semana)
""", "media_hist")
def historic_mean(spark, sf):
    from ..operators import splits

    t = B.trips(spark, sf)
    cut = splits.cut_columns(splits.time_cuts(t))[0]
    z = demand.zone_hour_counts(t).withColumns(X.calendar("timestamp_hora"))
    out = demand.with_group_mean(z, z.where(F.col("timestamp_hora") < cut), "demanda", "media_hist")
    return out.select("origen_id", "timestamp_hora", "media_hist")


@query("D7_lag_gaps", "SELECT origen_id, timestamp_hora, lag_6h, lag_12h, lag_24h FROM features", "lag_6h lag_12h lag_24h")
def lag_gaps(spark, sf):
    from .windows import features

    return features(spark, sf).select("origen_id", "timestamp_hora", "lag_6h", "lag_12h", "lag_24h")


@query("D8_model_matrix", """
SELECT id, coalesce(propina, 0)::DOUBLE AS propina, coalesce(espera_min, 0)::DOUBLE AS espera_min,
       coalesce(num_pasajeros, 0)::DOUBLE AS num_pasajeros FROM trips
""", "propina espera_min num_pasajeros")
def matrix(spark, sf):
    cols = ["propina", "espera_min", "num_pasajeros"]
    return model_matrix(B.trips(spark, sf).select("id", *cols), cols)


@query("D9_context_defaults", """
SELECT t.id, coalesce(w.temp_c, 15)::DOUBLE AS temp_c, coalesce(w.viento_kmh, 10)::DOUBLE AS viento_kmh,
       'desconocido' AS origen_zona FROM zoned t
LEFT JOIN weather w ON w.fecha_hora = date_trunc('hour', fecha_inicio) AND w.borough = origen_barrio
""", "temp_c viento_kmh")
def context_defaults(spark, sf):
    t = enrichment.with_weather(enrichment.with_zones(B.trips(spark, sf), B.zones(spark, sf)), written_table(B.weather(spark, sf), "weather"))
    wanted = {c: C.CONTEXT_DEFAULTS_P5[c] for c in ("temp_c", "viento_kmh", "origen_zona")}
    return context.with_defaults(t.drop("origen_zona"), wanted).select("id", *wanted)
