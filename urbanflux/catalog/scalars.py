"""Registered queries: projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..operators import cleaning
from ..sources import dimensions as D
from . import base as B
from .base import query


def _list(names):
    return ", ".join(names)


@query("B1_rename_yellow", """
SELECT tpep_pickup_datetime AS fecha_inicio, tpep_dropoff_datetime AS fecha_fin, "PULocationID" AS origen_id,
       "DOLocationID" AS destino_id, passenger_count AS num_pasajeros, trip_distance AS distancia,
       fare_amount AS tarifa_base, extra, mta_tax, tip_amount AS propina, tolls_amount AS peajes,
       improvement_surcharge AS recargo_mejora, congestion_surcharge AS recargo_congestion,
       total_amount AS precio_total, payment_type AS tipo_pago, "RatecodeID" AS codigo_tarifa FROM raw_yellow
""", "distancia tarifa_base propina precio_total num_pasajeros recargo_congestion")
def rename_yellow(spark, sf):
    return cleaning.rename_raw(B.raw_yellow(spark, sf), "yellow")


@query("B2_rename_fhvhv", """
SELECT hvfhs_license_num AS plataforma, dispatching_base_num AS base_despacho, request_datetime AS fecha_solicitud,
       on_scene_datetime AS fecha_llegada_conductor, pickup_datetime AS fecha_inicio, dropoff_datetime AS fecha_fin,
       "PULocationID" AS origen_id, "DOLocationID" AS destino_id, trip_miles AS distancia, trip_time AS duracion_seg,
       base_passenger_fare AS tarifa_base, tolls AS peajes, bcf AS black_car_fund, sales_tax AS impuesto_ventas,
       congestion_surcharge AS recargo_congestion, tips AS propina, driver_pay AS pago_conductor,
       shared_request_flag AS solicitud_compartida FROM raw_fhvhv
""", "distancia tarifa_base black_car_fund impuesto_ventas propina pago_conductor")
def rename_fhvhv(spark, sf):
    return cleaning.rename_raw(B.raw_fhvhv(spark, sf), "fhvhv")


@query("B3_lenient_types", """
SELECT id, try_cast(fecha_texto AS TIMESTAMP) AS fecha, try_cast(numero_texto AS DOUBLE) AS numero,
       try_cast(try_cast(entero_texto AS DOUBLE) AS INTEGER)::DOUBLE AS entero
FROM (SELECT event_id AS id, CASE WHEN k % 6 = 0 THEN 'sin fecha' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS fecha_texto,
             CASE WHEN k % 5 = 0 THEN 'n/d' ELSE value::VARCHAR END AS numero_texto,
             CASE WHEN k % 4 = 0 THEN '' ELSE (k || '.0') END AS entero_texto FROM ek)
""", "numero entero")
def lenient_types(spark, sf):
    k = F.col("k")
    text = B.raw_events(spark, sf).select(
        F.col("event_id").alias("id"),
        F.when(k % 6 == 0, "sin fecha").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("a"),
        F.when(k % 5 == 0, "n/d").otherwise(F.col("value").cast("string")).alias("b"),
        F.when(k % 4 == 0, "").otherwise(F.concat(k.cast("string"), F.lit(".0"))).alias("c"),
    )
    return text.select(
        "id", X.lenient_timestamp("a").alias("fecha"), X.lenient_double("b").alias("numero"),
        X.lenient_int("c").cast("double").alias("entero"),
    )


@query("B4_narrow_types", """
SELECT l_orderkey::INTEGER AS l_orderkey, l_linenumber, (l_extendedprice::FLOAT)::DOUBLE AS precio FROM lineitem
""", "precio", 3)
def narrow_types(spark, sf):
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("precio"))
    return cleaning.narrow_types(li).withColumn("precio", F.col("precio").cast("double"))


@query("B5_duration_minutes", """
SELECT id, date_diff('microsecond', fecha_inicio, fecha_fin) / 6e7 AS minutos FROM trips
""")
def duration(spark, sf):
    return B.trips(spark, sf).select("id", X.minutes_between("fecha_inicio", "fecha_fin").alias("minutos"))


@query("B6_speed", "SELECT id, distancia / (duracion_min / 60.0::DOUBLE) AS mph FROM trips")
def speed(spark, sf):
    return B.trips(spark, sf).select("id", X.speed_mph("distancia", "duracion_min").alias("mph"))


@query("B7_wait_minutes", """
SELECT pickup_datetime AS fecha_inicio, date_diff('microsecond', request_datetime, pickup_datetime) / 6e7 AS espera_min
FROM raw_fhvhv
""", "espera_min")
def wait(spark, sf):
    f = cleaning.rename_raw(B.raw_fhvhv(spark, sf), "fhvhv")
    return f.select("fecha_inicio", X.minutes_between("fecha_solicitud", "fecha_inicio").alias("espera_min"))


@query("B8_rebuilt_price", """
SELECT pickup_datetime AS fecha_inicio, base_passenger_fare + coalesce(tolls, 0) + coalesce(bcf, 0)
       + coalesce(sales_tax, 0) + coalesce(congestion_surcharge, 0) AS precio_total_est
FROM raw_fhvhv WHERE tolls >= 0
""", "precio_total_est")
def rebuilt_price(spark, sf):
    f = cleaning.coerce_types(cleaning.rename_raw(B.raw_fhvhv(spark, sf), "fhvhv"))
    parts = [c for c in C.PRICE_COMPONENTS if c in f.columns]
    for c in parts:
        f = f.where(F.coalesce(F.col(c), F.lit(0.0)) >= 0)
    return f.select("fecha_inicio", X.rebuilt_total("tarifa_base", [F.col(c) for c in parts]).alias("precio_total_est"))


@query("B9_calendar_fields", """
SELECT id, hora, dia_semana, day(fecha_inicio)::INTEGER AS dia_mes, mes_num, es_fin_semana AS es_finde FROM trips
""")
def calendar_fields(spark, sf):
    t = B.trips(spark, sf).select("id", "fecha_inicio")
    return t.withColumns(X.calendar("fecha_inicio")).drop("fecha_inicio")


@query("B10_time_bands", """
SELECT id, franja_horaria AS titulo, CASE franja_horaria WHEN 'Madrugada' THEN 'madrugada' WHEN 'Mañana' THEN 'manana'
       WHEN 'Mediodia' THEN 'mediodia' WHEN 'Tarde' THEN 'tarde' ELSE 'noche' END AS simple FROM trips
""")
def time_bands(spark, sf):
    hour = F.hour("fecha_inicio")
    return B.trips(spark, sf).select(
        "id", X.time_band(hour).alias("titulo"), X.time_band(hour, "plain").alias("simple")
    )


@query("B11_cyclic_hour", """
SELECT id, sin(2 * pi() * h / 24) AS hora_sen, cos(2 * pi() * h / 24) AS hora_cos
FROM (SELECT id, hour(fecha_inicio) + minute(fecha_inicio) / 60.0::DOUBLE AS h FROM trips)
""", "hora_sen hora_cos")
def cyclic_hour(spark, sf):
    sin, cos = X.cyclic(F.hour("fecha_inicio") + F.minute("fecha_inicio") / 60.0)
    return B.trips(spark, sf).select("id", sin.alias("hora_sen"), cos.alias("hora_cos"))


@query("B12_floor_times", """
SELECT id, date_trunc('hour', fecha_inicio) AS por_hora, time_bucket(INTERVAL 10 MINUTE, fecha_inicio) AS por_10min FROM trips
""")
def floor_times(spark, sf):
    return B.trips(spark, sf).select(
        "id", X.floor_minutes("fecha_inicio").alias("por_hora"), X.floor_minutes("fecha_inicio", 10).alias("por_10min")
    )


@query("B13_income_traffic", """
SELECT id, CASE WHEN duracion_min > 0 THEN precio_base / duracion_min ELSE 0 END AS rentabilidad_base_min,
       (velocidad_mph < 10)::INTEGER AS trafico_denso FROM trips
""")
def income_traffic(spark, sf):
    return B.trips(spark, sf).select(
        "id", X.income_per_minute().alias("rentabilidad_base_min"), X.dense_traffic().alias("trafico_denso")
    )


@query("B14_income_ratios", """
SELECT id, precio_total_est / nullif(distancia, 0) AS por_milla, precio_total_est / nullif(duracion_min, 0) AS por_min,
       propina / nullif(num_pasajeros % 3, 0) AS por_resto FROM trips
""")
def income_ratios(spark, sf):
    return B.trips(spark, sf).select(
        "id", X.ratio("precio_total_est", "distancia").alias("por_milla"),
        X.ratio("precio_total_est", "duracion_min").alias("por_min"),
        X.ratio("propina", F.col("num_pasajeros") % 3).alias("por_resto"),
    )


@query("B15_success_flag", "SELECT id, (coalesce(espera_min, 99) <= 10)::INTEGER AS exito FROM trips")
def success_flag(spark, sf):
    return B.trips(spark, sf).select("id", X.success("espera_min").alias("exito"))


@query("B16_weather_flags", """
SELECT fecha_hora, borough, (precipitation > 0.1::DOUBLE)::INTEGER AS lluvia, (lluvia > 0)::INTEGER AS hay_lluvia,
       (lluvia > 0 OR precipitation > 0)::INTEGER AS hay_lluvia_servicio, (nieve > 0)::INTEGER AS hay_nieve FROM weather
""")
def weather_flags(spark, sf):
    return B.weather(spark, sf).select(
        "fecha_hora", "borough", X.weather_flag("precipitation").alias("lluvia"), X.has_rain("lluvia").alias("hay_lluvia"),
        X.has_rain("lluvia", "precipitation").alias("hay_lluvia_servicio"), X.has_rain("nieve").alias("hay_nieve"),
    )


@query("B17_season_sky", """
SELECT l_orderkey, l_linenumber, CASE WHEN mes_num IN (12, 1, 2) THEN 'Invierno' WHEN mes_num IN (3, 4, 5) THEN 'Primavera'
       WHEN mes_num IN (6, 7, 8) THEN 'Verano' ELSE 'Otoño' END AS temporada,
       CASE WHEN propina > 0 THEN 'Lluvia/Nieve' ELSE 'Despejado' END AS estado_cielo FROM fares
""")
def season_sky(spark, sf):
    return B.fares(spark, sf).select(
        "l_orderkey", "l_linenumber", X.season("mes_num").alias("temporada"), X.sky("propina").alias("estado_cielo")
    )


@query("B18_text_match", """
SELECT p_partkey, contains(lower(p_name), 'ring') AS coincide, p_type AS tipo FROM part
""")
def text_match(spark, sf):
    return B.table(spark, sf, "part").select(
        "p_partkey", X.contains_text(F.upper("p_name"), " RÍNG ").alias("coincide"), F.col("p_type").alias("tipo")
    )


AIRPORT_ZONES = ("NATION_3", "nation_7")


@query("B19_zone_classes", """
SELECT id, CASE WHEN contains(lower(origen_zona), 'nation_3') OR contains(lower(origen_zona), 'nation_7')
       OR contains(lower(destino_zona), 'nation_3') OR contains(lower(destino_zona), 'nation_7')
       THEN 'Aeropuerto' ELSE 'Resto' END AS tipo_viaje FROM zoned
""")
def zone_classes(spark, sf):
    from ..operators.enrichment import with_zones

    zoned = with_zones(B.trips(spark, sf), B.zones(spark, sf))
    return zoned.select("id", X.zone_class(AIRPORT_ZONES, "Aeropuerto", "Resto").alias("tipo_viaje"))


@query("B20_event_impact", "SELECT fecha, event_type, attendance, impacto FROM city_events", dates="fecha")
def event_impact(spark, sf):
    return D.city_events(D.snake_case(B.raw_city_events(spark, sf)))


@query("B21_weekday_names", """
SELECT id, dayname(fecha_inicio) AS dia_en, CASE dia_semana WHEN 0 THEN 'Lunes' WHEN 1 THEN 'Martes' WHEN 2 THEN 'Miércoles'
       WHEN 3 THEN 'Jueves' WHEN 4 THEN 'Viernes' WHEN 5 THEN 'Sábado' ELSE 'Domingo' END AS dia_es,
       dia_semana AS numero FROM trips
""")
def weekday_names(spark, sf):
    named = B.trips(spark, sf).select(
        "id", X.weekday_name("dia_semana").alias("dia_en"), X.weekday_name("dia_semana", C.WEEKDAYS_ES).alias("dia_es")
    )
    return named.withColumn("numero", X.weekday_number("dia_en"))


@query("B22_vehicle_types", """
SELECT id, CASE v WHEN '1' THEN 'Yellow Taxi' WHEN '2' THEN 'VTC' WHEN ' VTC ' THEN 'VTC' ELSE v END AS tipo
FROM (SELECT id, CASE WHEN tipo_pago < 3 THEN tipo_pago::VARCHAR WHEN tipo_pago = 3 THEN ' VTC ' ELSE 'Limusina' END AS v FROM trips)
""")
def vehicle_types(spark, sf):
    p = F.col("tipo_pago")
    code = F.when(p < 3, p.cast("string")).when(p == 3, " VTC ").otherwise("Limusina")
    return B.trips(spark, sf).select("id", X.vehicle_type(code).alias("tipo"))


@query("B23_month_edges", """
SELECT DISTINCT strftime(fecha_inicio, '%Y-%m') AS mes, date_trunc('month', fecha_inicio)::DATE AS primero,
       last_day(fecha_inicio::DATE) AS ultimo FROM fares
""", dates="primero ultimo")
def month_edges(spark, sf):
    months = B.fares(spark, sf).select(F.date_format("fecha_inicio", "yyyy-MM").alias("mes")).distinct()
    return months.select("mes", X.month_edge("mes").alias("primero"), X.month_edge("mes", last=True).alias("ultimo"))


@query("B24_arrival_time", """
SELECT id, h - 24 * floor(h / 24) AS hora_float, floor(h - 24 * floor(h / 24))::INTEGER AS hora,
       ((dia_semana + floor(h / 24)) % 7)::INTEGER AS dia_semana,
       (((dia_semana + floor(h / 24)) % 7) >= 5)::INTEGER AS es_fin_semana
FROM (SELECT id, dia_semana, hour(fecha_inicio) + minute(fecha_inicio) / 60.0::DOUBLE + duracion_min / 60.0::DOUBLE AS h FROM trips)
""", "hora_float")
def arrival_time(spark, sf):
    t = B.trips(spark, sf).withColumn("h", F.hour("fecha_inicio") + F.minute("fecha_inicio") / 60.0)
    out = X.arrival("h", "dia_semana", "duracion_min")
    return t.select("id", *[out[c].alias(c) for c in ("hora_float", "hora", "dia_semana", "es_fin_semana")])


@query("B25_log_target", """
SELECT origen_id, timestamp_hora, ln(1 + demanda) AS log_demanda, greatest(exp(ln(1 + demanda)) - 1, 0) AS vuelta FROM zone_hours
""", "log_demanda vuelta")
def log_target(spark, sf):
    from ..operators.demand import zone_hour_counts

    z = zone_hour_counts(B.trips(spark, sf)).withColumn("log_demanda", X.log_target("demanda"))
    return z.select("origen_id", "timestamp_hora", "log_demanda", X.unlog_target("log_demanda").alias("vuelta"))
