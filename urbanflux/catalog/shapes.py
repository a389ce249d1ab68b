"""Registered queries: reshaping, set operations, samples, splits, graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as C
from ..operators import flows, models, reports, splits
from . import base as B
from .base import query
from .windows import _HASH, _zoned

_PIVOT = ", ".join(f"count(*) FILTER (dayname(fecha_inicio) = '{d}') AS \"{d}\"" for d in C.WEEKDAYS_EN)


@query("I1_hour_weekday_all", f"SELECT hora, {_PIVOT} FROM trips GROUP BY 1")
def hour_weekday_all(spark, sf):
    return reports.hour_weekday_matrix(B.trips(spark, sf))


@query("I1_hour_weekday_service", f"SELECT hora, {_PIVOT} FROM trips WHERE tipo_vehiculo = 'VTC' GROUP BY 1")
def hour_weekday_service(spark, sf):
    return reports.hour_weekday_matrix(B.trips(spark, sf), service="VTC")


@query("I1_hour_weekday_zone", f"SELECT hora, {_PIVOT} FROM zoned WHERE origen_zona = 'NATION_5' GROUP BY 1")
def hour_weekday_zone(spark, sf):
    return reports.hour_weekday_matrix(_zoned(spark, sf), zone="NATION_5")


_BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query("I2_borough_matrix", "SELECT origen_barrio, " + ", ".join(
    f"count(*) FILTER (destino_barrio = '{b}') AS \"{b}\"" for b in _BOROUGHS) + " FROM zoned GROUP BY 1")
def borough_matrix(spark, sf):
    pairs = flows.pair_counts(_zoned(spark, sf), "origen_barrio", "destino_barrio")
    return flows.od_matrix(pairs, "origen_barrio", "destino_barrio", _BOROUGHS)


@query("I2_top_zone_matrix", """
WITH top AS (SELECT origen_zona, destino_zona, count(*) AS viajes FROM zoned GROUP BY 1, 2 ORDER BY viajes DESC, 1, 2 LIMIT 15)
SELECT origen_zona, destino_zona, coalesce(viajes, 0) AS viajes FROM (SELECT DISTINCT origen_zona FROM top)
CROSS JOIN (SELECT DISTINCT destino_zona FROM top) LEFT JOIN top USING (origen_zona, destino_zona)
""")
def top_zone_matrix(spark, sf):
    """Every cell of the matrix of the 15 busiest routes, zeros included, in long form."""
    top = flows.top_routes(_zoned(spark, sf), "origen_zona", "destino_zona", 15)
    return flows.matrix_cells(flows.od_matrix(top, "origen_zona", "destino_zona"), "origen_zona", "destino_zona")


@query("I3_price_gap_by_month", """
SELECT mes_num, "Yellow Taxi", "VTC", "VTC" - "Yellow Taxi" AS dif_abs, ("VTC" - "Yellow Taxi") / "Yellow Taxi" * 100 AS dif_pct FROM (
  SELECT mes_num, avg(precio_total_est) FILTER (tipo_vehiculo = 'Yellow Taxi') AS "Yellow Taxi",
         avg(precio_total_est) FILTER (tipo_vehiculo = 'VTC') AS "VTC" FROM fares GROUP BY 1)
""", ("Yellow Taxi", "VTC", "dif_abs", "dif_pct"))
def price_gap_by_month(spark, sf):
    return reports.price_gap_by_month(B.fares(spark, sf))


@query("I4_market_share_matrix", """
SELECT origen_barrio, count(*) FILTER (tipo_vehiculo = 'Yellow Taxi') * 100.0::DOUBLE / count(*) AS taxi,
       count(*) FILTER (tipo_vehiculo = 'VTC') * 100.0::DOUBLE / count(*) AS vtc FROM zoned GROUP BY 1
""", "taxi vtc")
def market_share_matrix(spark, sf):
    wide = reports.market_share_matrix(_zoned(spark, sf))
    return wide.select("origen_barrio", F.col("Yellow Taxi").alias("taxi"), F.col("VTC").alias("vtc"))


@query("I5_dummy_columns", """
SELECT id, (tipo_vehiculo = 'Yellow Taxi')::INTEGER AS taxi, (franja_horaria = 'Mañana')::INTEGER AS manana,
       (franja_horaria = 'Mediodia')::INTEGER AS mediodia, (franja_horaria = 'Noche')::INTEGER AS noche,
       (franja_horaria = 'Tarde')::INTEGER AS tarde FROM trips
""")
def dummy_columns(spark, sf):
    """0/1 columns per category, the first one dropped."""
    t = B.trips(spark, sf).select("id", "tipo_vehiculo", "franja_horaria")
    cats = {c: models.category_values(t, c) for c in ("tipo_vehiculo", "franja_horaria")}
    wide = models.dummy_columns(t, cats)
    return wide.select(
        "id", F.col("`tipo_vehiculo_Yellow Taxi`").alias("taxi"), F.col("franja_horaria_Mañana").alias("manana"),
        F.col("franja_horaria_Mediodia").alias("mediodia"), F.col("franja_horaria_Noche").alias("noche"),
        F.col("franja_horaria_Tarde").alias("tarde"),
    )


@query("I6_union_by_name", """
SELECT tipo_vehiculo, count(*) AS viajes, count(propina) AS con_propina, count(num_pasajeros) AS con_pasajeros FROM (
  SELECT tipo_vehiculo, propina, NULL AS num_pasajeros FROM trips WHERE tipo_vehiculo = 'VTC'
  UNION ALL SELECT tipo_vehiculo, NULL, num_pasajeros FROM trips WHERE tipo_vehiculo <> 'VTC') GROUP BY 1
""")
def union_by_name(spark, sf):
    t = B.trips(spark, sf)
    vtc = t.where("tipo_vehiculo = 'VTC'").select("tipo_vehiculo", "propina")
    taxi = t.where("tipo_vehiculo <> 'VTC'").select("tipo_vehiculo", "num_pasajeros")
    both = vtc.unionByName(taxi, allowMissingColumns=True)
    return both.groupBy("tipo_vehiculo").agg(
        F.count(F.lit(1)).alias("viajes"), F.count("propina").alias("con_propina"), F.count("num_pasajeros").alias("con_pasajeros")
    )


@query("I7_zone_nodes", "SELECT origen_id AS zona_id FROM trips UNION SELECT destino_id FROM trips")
def zone_nodes(spark, sf):
    return flows.zone_nodes(B.trips(spark, sf))


@query("J1_fraction_sample", f"SELECT id, fecha_inicio FROM trips WHERE {_HASH.format('id::VARCHAR')} % 100 < 40")
def fraction_sample(spark, sf):
    return splits.fraction_sample(B.trips(spark, sf).select("id", "fecha_inicio"), 40, "id")


@query("J2_capped_sample", f"SELECT id FROM trips ORDER BY {_HASH.format('id::VARCHAR')}, id LIMIT 500")
def capped_sample(spark, sf):
    return splits.capped_sample(B.trips(spark, sf).select("id"), 500, "id")


@query("J3_time_split", """
SELECT id, CASE WHEN fecha_inicio < corte_train THEN 'train' WHEN fecha_inicio < corte_val THEN 'val' ELSE 'test' END AS split
FROM trips CROSS JOIN hour_cuts
""")
def time_split(spark, sf):
    t = B.trips(spark, sf)
    cuts = splits.cut_columns(splits.time_cuts(t))
    return splits.split_by_time(t.select("id", "fecha_inicio"), "fecha_inicio", cuts).select("id", "split")


@query("J4_month_split", """
SELECT CASE WHEN mes_num IN (10, 11) THEN 'test' WHEN mes_num = 9 THEN 'val' ELSE 'train' END AS split, count(*) AS viajes,
       sum(precio_base) AS importe FROM fares GROUP BY 1
""", "importe", 2)
def month_split(spark, sf):
    return splits.split_by_month(B.fares(spark, sf)).groupBy("split").agg(
        F.count(F.lit(1)).alias("viajes"), F.sum("precio_base").alias("importe")
    )


# --- graph ------------------------------------------------------------------------

_GRAPH = """
WITH p AS (SELECT origen_id AS o, destino_id AS d, count(*) AS c FROM fares GROUP BY 1, 2),
s AS (SELECT o, d FROM p WHERE c > (SELECT quantile_cont(c, 0.75) FROM p)),
edges AS (SELECT o AS src, d AS dst FROM s UNION SELECT d, o FROM s),
nodes AS (SELECT origen_id AS zona_id FROM fares UNION SELECT destino_id FROM fares),
deg AS (SELECT zona_id, count(dst) AS vecinos FROM nodes LEFT JOIN edges ON src = zona_id AND dst <> zona_id GROUP BY 1)
"""


@query("K1_flow_edges", _GRAPH + "SELECT src, dst FROM edges")
def flow_edges(spark, sf):
    return flows.flow_edges(B.fares(spark, sf))


@query("K2_graph_stats", _GRAPH + """
SELECT count(*) AS nodos, (sum(vecinos) / 2)::BIGINT AS conexiones, avg(vecinos) AS media_vecinos,
       (SELECT zona_id FROM deg ORDER BY vecinos DESC, zona_id LIMIT 1) AS zona_max, max(vecinos) AS vecinos_max FROM deg
""", "media_vecinos")
def graph_stats(spark, sf):
    f = B.fares(spark, sf)
    return flows.graph_stats(flows.zone_nodes(f), flows.flow_edges(f))


@query("K3_neighbours", _GRAPH + """
SELECT src, dst, coalesce("Zone" || ' (' || "Borough" || ')', 'Zona ID ' || dst) AS vecino FROM edges LEFT JOIN zones ON "LocationID" = dst
WHERE src <> dst
""")
def neighbours(spark, sf):
    return flows.neighbours(flows.flow_edges(B.fares(spark, sf)), B.zones(spark, sf))


@query("K4_neighbour_average", _GRAPH + """
SELECT zona_id, coalesce(avg(f.velocidad_mph), 0) AS velocidad_mph, coalesce(avg(f.distancia), 0) AS distancia FROM nodes
LEFT JOIN edges ON src = zona_id LEFT JOIN (SELECT origen_id, avg(velocidad_mph) AS velocidad_mph, avg(distancia) AS distancia
FROM fares GROUP BY 1) f ON f.origen_id = dst GROUP BY 1
""", "velocidad_mph distancia")
def neighbour_average(spark, sf):
    f = B.fares(spark, sf)
    features = f.groupBy(F.col("origen_id").alias("zona_id")).agg(
        F.avg("velocidad_mph").alias("velocidad_mph"), F.avg("distancia").alias("distancia")
    )
    return flows.neighbour_average(flows.zone_nodes(f), flows.flow_edges(f), features, ["velocidad_mph", "distancia"])
