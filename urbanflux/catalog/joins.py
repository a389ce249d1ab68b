"""Registered queries: joins and the hierarchical context lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..operators import context, demand, enrichment, reports, supply
from ..operators.models import encode_labels, label_dictionary
from ..session import written_table
from ..sources import dimensions as D
from . import base as B
from .base import query
from .windows import counts, good_zones


@query("E1_zone_names", "SELECT id, origen_zona, origen_barrio, destino_zona, destino_barrio FROM zoned")
def zone_names(spark, sf):
    z = enrichment.with_zones(B.trips(spark, sf), B.zones(spark, sf))
    return z.select("id", "origen_zona", "origen_barrio", "destino_zona", "destino_barrio")


@query("E2_hourly_weather", """
SELECT id, temp_c, precipitation, viento_kmh, lluvia::DOUBLE AS lluvia, nieve::DOUBLE AS nieve FROM weathered
""", "temp_c precipitation viento_kmh")
def hourly_weather(spark, sf):
    t = enrichment.with_weather(enrichment.with_zones(B.trips(spark, sf), B.zones(spark, sf)), written_table(B.weather(spark, sf), "weather"))
    return t.select("id", "temp_c", "precipitation", "viento_kmh", *[F.col(c).cast("double") for c in ("lluvia", "nieve")])


@query("E3_holidays", """
SELECT id, coalesce(es_festivo, 0) AS es_festivo FROM trips LEFT JOIN holidays ON fecha = fecha_inicio::DATE
""")
def holiday_flag(spark, sf):
    return enrichment.with_holidays(B.trips(spark, sf), written_table(B.holidays(spark, sf), "holidays")).select("id", "es_festivo")


@query("E4_city_events", "SELECT id, evento_tipo, num_eventos FROM enriched")
def city_event_columns(spark, sf):
    return enrichment.with_city_events(B.trips(spark, sf), written_table(B.city_days(spark, sf), "city-days")).select("id", "evento_tipo", "num_eventos")


@query("E5_supply", "SELECT origen_id, ventana_inicio, n_viajes, oferta_inferida FROM labelled", "oferta_inferida")
def supply_join(spark, sf):
    t = B.trips(spark, sf)
    windows = t.groupBy("origen_id", X.floor_minutes("fecha_inicio", 10).alias("ventana_inicio")).agg(
        F.count("espera_min").alias("n_viajes")
    )
    return supply.with_supply(windows, supply.inferred_supply(t))


@query("E6_historic_rate", "SELECT origen_id, ventana_inicio, split, tasa_historica FROM good_zones", "tasa_historica")
def historic_rate(spark, sf):
    return good_zones(spark, sf).select("origen_id", "ventana_inicio", "split", "tasa_historica")


@query("E7_busiest_zone_rows", """
SELECT origen_id, timestamp_hora, demanda FROM zone_hours WHERE origen_id IN (
  SELECT origen_id FROM zone_hours GROUP BY 1 ORDER BY sum(demanda) DESC, origen_id LIMIT 10)
""")
def busiest_zone_rows(spark, sf):
    z = counts(spark, sf)
    top = z.groupBy("origen_id").agg(F.sum("demanda").alias("d")).orderBy(F.desc("d"), "origen_id").limit(10)
    return z.join(top, "origen_id", "left_semi")


@query("E8_label_encoding", """
SELECT f.zona, f.timestamp_hora, coalesce(i, -1) AS zona_enc, coalesce(i, 0) AS zona_srv
FROM (SELECT origen_id + (CASE WHEN hora >= 20 THEN 10 ELSE 0 END) AS zona, timestamp_hora, demanda FROM zone_hours) f
LEFT JOIN (SELECT origen_id AS zona, (row_number() OVER (ORDER BY origen_id) - 1)::INTEGER AS i FROM
           (SELECT DISTINCT origen_id FROM zone_hours)) USING (zona)
""")
def label_encoding(spark, sf):
    """All zones are in the dictionary; requests of the late hours ask for zones ten further, some of them unseen."""
    z = counts(spark, sf).withColumnRenamed("origen_id", "zona")
    dictionary = label_dictionary(z, "zona")
    asked = z.withColumn("zona", F.col("zona") + F.when(F.hour("timestamp_hora") >= 20, 10).otherwise(0))
    both = encode_labels(encode_labels(asked, dictionary, "zona", "zona_enc"), dictionary, "zona", "zona_srv", unseen=0)
    return both.select("zona", "timestamp_hora", "zona_enc", "zona_srv")


@query("E9_calendar_spine", """
SELECT d::DATE AS fecha, coalesce(c, 0) AS pedidos FROM
(SELECT unnest(generate_series(min(o_orderdate)::DATE - 7, max(o_orderdate)::DATE + 7, INTERVAL 1 DAY)) AS d FROM orders)
LEFT JOIN (SELECT o_orderdate::DATE AS f, count(*) AS c FROM orders GROUP BY 1) ON f = d::DATE
""", dates="fecha")
def calendar_spine(spark, sf):
    """All orders by day, on a calendar that reaches a week beyond them."""
    o = B.table(spark, sf, "orders")
    first, last = F.date_sub(F.to_date(F.min("o_orderdate")), 7), F.date_add(F.to_date(F.max("o_orderdate")), 7)
    span = o.agg(F.struct(first.alias("a"), last.alias("b")).alias("s"))
    days = D.calendar_days(spark, span.scalar()["a"], span.scalar()["b"])
    facts = o.groupBy(F.to_date("o_orderdate").alias("fecha")).agg(F.count(F.lit(1)).alias("pedidos"))
    return days.join(facts, "fecha", "left").select("fecha", F.coalesce("pedidos", F.lit(0)).alias("pedidos"))


@query("E9_holiday_calendar", """
SELECT fecha, coalesce(f, 0) AS es_festivo FROM event_days LEFT JOIN (
  SELECT fecha, 1 AS f FROM holidays WHERE es_festivo = 1) USING (fecha)
""", dates="fecha")
def holiday_calendar(spark, sf):
    return D.holiday_calendar(B.holidays(spark, sf).where("es_festivo = 1"), B.event_days(spark, sf))


CONTEXT_MEANS = ("distancia", "duracion_min", "velocidad_mph", "precio_base", "espera_min", "propina")
CONTEXT_MODES = ("tipo_vehiculo", "franja_horaria")


def small_context(spark, sf):
    """Context of all trips; requests are shifted, so that some keys have no exact match."""
    return context.context_table(B.trips(spark, sf), CONTEXT_MEANS, CONTEXT_MODES)


_CONTEXT_SQL = """
ctx AS (
  SELECT origen_id, mes_num, dia_semana, hora, avg(distancia) AS distancia, avg(duracion_min) AS duracion_min,
         avg(velocidad_mph) AS velocidad_mph, avg(precio_base) AS precio_base, avg(espera_min) AS espera_min,
         avg(propina) AS propina, count(*) AS n_ctx
  FROM trips GROUP BY 1, 2, 3, 4),
tv AS (SELECT * FROM (SELECT origen_id, mes_num, dia_semana, hora, tipo_vehiculo, row_number() OVER (
         PARTITION BY origen_id, mes_num, dia_semana, hora ORDER BY count(*) DESC, tipo_vehiculo) AS rn
       FROM trips GROUP BY 1, 2, 3, 4, 5) WHERE rn = 1),
cm AS (SELECT ctx.*, tv.tipo_vehiculo FROM ctx JOIN tv USING (origen_id, mes_num, dia_semana, hora))
"""


def _level(i, keys):
    cols = ", ".join(keys)
    join = " AND ".join(f"{k} IS NOT DISTINCT FROM m_{k}" for k in keys)
    renamed = ", ".join(f"{k} AS m_{k}" for k in keys)
    return f"""
l{i} AS (SELECT * FROM (SELECT {cols}, avg(distancia) AS distancia, avg(precio_base) AS precio_base, avg(espera_min) AS espera_min,
         avg(n_ctx) AS n_ctx, count(*) AS filas FROM cm GROUP BY {cols}) JOIN (
         SELECT {renamed}, tipo_vehiculo AS tv FROM (SELECT {cols}, tipo_vehiculo, row_number() OVER (PARTITION BY {cols}
         ORDER BY count(*) DESC, tipo_vehiculo) AS rn FROM cm GROUP BY {cols}, tipo_vehiculo) WHERE rn = 1) ON {join})"""


_LEVELS_SQL = ",".join(_level(i, keys) for i, (_, keys) in enumerate(C.CONTEXT_LEVELS))
_PICK = {
    name: "coalesce(" + ", ".join(f"l{i}.{source}" for i in range(5)) + ")"
    for name, source in (
        ("distancia", "distancia"), ("precio_base", "precio_base"), ("n", "n_ctx"), ("filas", "filas"), ("tv", "tv")
    )
}
_HIT = "CASE " + " ".join(
    f"WHEN l{i}.filas IS NOT NULL THEN '{name}'" for i, (name, _) in enumerate(C.CONTEXT_LEVELS)
) + " ELSE 'sin contexto' END"


@query("E10_context_lookup", f"""
WITH {_CONTEXT_SQL},{_LEVELS_SQL},
req AS (SELECT id, origen_id + (CASE WHEN tipo_pago = 4 AND num_pasajeros IS NULL THEN 100 ELSE 0 END) AS origen_id,
        (CASE WHEN tipo_pago = 2 THEN mes_num + 1 ELSE mes_num END) AS mes_num,
        (CASE WHEN tipo_pago = 3 THEN (dia_semana + 3) % 7 ELSE dia_semana END) AS dia_semana, hora FROM trips)
SELECT r.id, {_HIT} AS nivel_contexto, {_PICK['distancia']} AS distancia, {_PICK['precio_base']} AS precio_base,
       {_PICK['n']} AS n_contexto, {_PICK['filas']}::DOUBLE AS filas, {_PICK['tv']} AS tipo_vehiculo
FROM req r {" ".join(f"LEFT JOIN l{i} ON " + " AND ".join(f"l{i}.{k} = r.{k}" for k in keys) for i, (_, keys) in enumerate(C.CONTEXT_LEVELS))}
""", "distancia precio_base n_contexto filas")
def context_lookup(spark, sf):
    """Every trip asks for a context, some for months, weekdays or zones it lacks."""
    t = B.trips(spark, sf)
    requests = t.select(
        "id",
        (F.col("origen_id") + F.when((F.col("tipo_pago") == 4) & F.col("num_pasajeros").isNull(), 100).otherwise(0)).alias("origen_id"),
        F.when(F.col("tipo_pago") == 2, F.col("mes_num") + 1).otherwise(F.col("mes_num")).alias("mes_num"),
        F.when(F.col("tipo_pago") == 3, (F.col("dia_semana") + 3) % 7).otherwise(F.col("dia_semana")).alias("dia_semana"),
        "hora",
    )
    out = context.lookup_context(requests, small_context(spark, sf), ("distancia", "precio_base"), ("tipo_vehiculo",))
    return out.select(
        "id", "nivel_contexto", "distancia", "precio_base", F.col("_n_contexto").alias("n_contexto"),
        F.col("_filas").cast("double").alias("filas"), "tipo_vehiculo",
    )


@query("E11_peak_beside_summary", """
SELECT origen_id, franja_horaria, demanda_media, hora_pico, demanda_hora_pico FROM levels
""", "demanda_media demanda_hora_pico")
def peak_beside_summary(spark, sf):
    from ..sources.demand_inputs import demand_rows

    rows = demand_rows([B.trips(spark, sf)])
    out = demand.band_summary(rows).join(demand.peak_hours(rows), ["origen_id", "franja_horaria"], "left")
    return out.select("origen_id", "franja_horaria", "demanda_media", "hora_pico", "demanda_hora_pico")
