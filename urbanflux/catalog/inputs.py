"""Registered queries: scans, sources, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.demand import zone_hour_counts
from ..plans import etl
from ..plans.demand_report import demand_report
from ..session import scratch_path
from ..sources import dimensions as D
from ..sources import sinks
from ..sources import trips as T
from ..sources.demand_inputs import demand_rows
from . import base as B
from .base import query


@query("A1_monthly_scan", """
SELECT CASE tipo_vehiculo WHEN 'VTC' THEN 'fhvhv' ELSE 'yellow' END AS servicio,
       year(fecha_inicio)::INTEGER AS anio_archivo, mes_num AS mes_archivo, count(*) AS viajes, sum(precio_base) AS importe
FROM fares WHERE (year(fecha_inicio) = 1998 AND mes_num = 12) OR (year(fecha_inicio) = 1999 AND mes_num <= 11)
GROUP BY 1, 2, 3
""", "importe", 2)
def monthly_scan(spark, sf):
    """Write monthly files of both services, then scan one rolling year by file name."""
    root = scratch_path(spark, "monthly")
    service = F.when(F.col("tipo_vehiculo") == "VTC", "fhvhv").otherwise("yellow")
    files = B.fares(spark, sf).select(
        "fecha_inicio", "precio_base", service.alias("servicio"), F.year("fecha_inicio").alias("anio"),
        F.concat(service, F.date_format("fecha_inicio", "'_tripdata_'yyyy-MM'.parquet'")).alias("archivo"),
    )
    files.repartitionByRange("servicio", "archivo", F.xxhash64("fecha_inicio", "precio_base")).write.partitionBy("servicio", "anio", "archivo").parquet(root)
    months = T.rolling_year_months(1999)
    both = T.monthly_trips(spark, root, "yellow", months).unionByName(T.monthly_trips(spark, root, "fhvhv", months))
    return both.groupBy("servicio", "anio_archivo", "mes_archivo").agg(
        F.count(F.lit(1)).alias("viajes"), F.sum("precio_base").alias("importe")
    )


@query("A1_months_of_two_schemas", """
SELECT servicio, mes, count(*) AS viajes, sum(precio) AS importe, 0::BIGINT AS nulos FROM (
  SELECT 'VTC' AS servicio, ("DOLocationID" % 2 * 2 + 1)::INTEGER AS mes,
         base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge + ("DOLocationID" % 2) * 1.5::DOUBLE AS precio
  FROM raw_fhvhv
  WHERE dropoff_datetime > pickup_datetime AND trip_miles > 0.1::DOUBLE AND trip_miles < 200 AND k - 3 > 1 AND k - 3 < 180
    AND "PULocationID" NOT IN (264, 265) AND "DOLocationID" NOT IN (264, 265) AND on_scene_datetime IS NOT NULL
    AND base_passenger_fare > 0 AND base_passenger_fare < 500 AND trip_time > 30 AND trip_time < 21600
    AND (k * 2) % 130 - 3 BETWEEN 0 AND 120 AND tolls >= 0
    AND base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge + ("DOLocationID" % 2) * 1.5::DOUBLE < 500
  UNION ALL
  SELECT 'Yellow Taxi', ("DOLocationID" % 2 * 2 + 1)::INTEGER, total_amount FROM raw_yellow
  WHERE tpep_dropoff_datetime > tpep_pickup_datetime AND trip_distance > 0.1::DOUBLE AND trip_distance < 200
    AND date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) > 1
    AND date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) < 180
    AND "PULocationID" NOT IN (264, 265) AND "DOLocationID" NOT IN (264, 265)
    AND passenger_count BETWEEN 0 AND 8 AND congestion_surcharge IS NOT NULL
    AND fare_amount >= 0 AND fare_amount < 500 AND total_amount > 0 AND total_amount < 500
) GROUP BY 1, 2
""", "importe", 2)
def months_of_two_schemas(spark, sf):
    """Raw months of both services to the final table.

    Trips to odd zones move two months on, into files that have a fee more and, for street
    hails, whole passenger counts. Zone ids are those of the raw files.
    """
    root = scratch_path(spark, "two_schemas")
    raws = {"yellow": B.raw_yellow(spark, sf), "fhvhv": B.raw_fhvhv(spark, sf)}
    for service, raw in raws.items():
        times = [c for c, kind in raw.dtypes if kind == "timestamp_ntz"]
        early = raw.where("DOLocationID % 2 = 0")
        late = raw.where("DOLocationID % 2 = 1").withColumns({c: F.col(c) + F.make_dt_interval(F.lit(60)) for c in times})
        late = late.withColumn("cbd_congestion_fee", F.lit(1.5))
        if service == "yellow":
            late = late.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        for month, rows in ((1, early), (3, late)):
            rows.write.parquet(f"{root}/{service}/2024/{service}_tripdata_2024-{month:02d}.parquet")
    clean = etl.clean_months(spark, root, ["yellow", "fhvhv"], [(2024, 1), (2024, 3)])
    dims = {
        "zones": B.zones(spark, sf).withColumn("LocationID", F.col("LocationID") + 240), "weather": B.weather(spark, sf),
        "holidays": B.holidays(spark, sf), "events": B.city_days(spark, sf),
    }
    final = etl.build_final_table(clean, dims, ["fecha_inicio", "origen_id", "destino_id", "distancia"])
    empty = sum(F.count_if(F.col(c).isNull()) for c in ("precio_total_est", "propina", "num_pasajeros", "temp_c", "evento_tipo"))
    return final.groupBy(F.col("tipo_vehiculo").alias("servicio"), F.col("mes_num").alias("mes")).agg(
        F.count(F.lit(1)).alias("viajes"), F.sum("precio_total_est").alias("importe"), empty.alias("nulos")
    )


@query("A2_present_columns", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders", "o_totalprice", 4)
def present_columns(spark, sf):
    wanted = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_missing"]
    return T.present_columns(B.table(spark, sf, "orders"), wanted)


@query("A3_zone_lookup_csv", """
SELECT "LocationID"::INTEGER AS "LocationID", "Borough", "Zone",
       CASE WHEN service_zone = 'Yellow Zone' THEN NULL ELSE service_zone END AS service_zone FROM zones
""")
def zone_lookup(spark, sf):
    path = scratch_path(spark, "zones")
    marked = B.zones(spark, sf).withColumn(
        "service_zone", F.when(F.col("service_zone") == "Yellow Zone", "N/A").otherwise(F.col("service_zone"))
    )
    marked.unionByName(marked).write.option("header", True).csv(path)
    return D.read_zone_lookup(spark, path)


@query("A4_demand_shapes", """
WITH four AS (
  SELECT origen_id, hora, demanda FROM demand_rows UNION ALL SELECT origen_id, hora, demanda FROM demand_rows
  UNION ALL SELECT origen_id, hora, demanda FROM demand_rows UNION ALL SELECT origen_id, hora, demanda FROM demand_rows)
SELECT origen_id, hora, count(*) AS filas, sum(demanda) AS demanda FROM four GROUP BY 1, 2
""", "demanda")
def demand_shapes(spark, sf):
    """The same demand in the four accepted shapes."""
    t = B.trips(spark, sf)
    timed = zone_hour_counts(t)
    hourly = timed.select("origen_id", F.hour("timestamp_hora").alias("hora"), "demanda")
    shapes = [hourly, timed, t.select("origen_id", "fecha_inicio"), hourly.withColumnRenamed("demanda", "n_viajes")]
    return demand_rows(shapes).groupBy("origen_id", "hora").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("demanda").alias("demanda")
    )


@query("A5_weather_payload", "SELECT fecha_hora, borough, temp_c, precipitation, viento_kmh, lluvia, nieve FROM weather",
       "temp_c precipitation viento_kmh")
def weather_payload(spark, sf):
    """Readings packed as hourly arrays per borough and month, then parsed back."""
    w = B.weather(spark, sf)
    hours = F.array_sort(F.collect_list(F.struct(
        F.date_format("fecha_hora", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("temp_c").alias("temperature_2m"),
        "precipitation", F.col("precipitation").alias("rain"), (F.col("nieve") * 0.2).alias("snowfall"),
        F.col("viento_kmh").alias("windspeed_10m"),
    )))
    packed = w.groupBy("borough", F.date_format("fecha_hora", "yyyy-MM").alias("mes")).agg(hours.alias("h"))
    names = ("time", "temperature_2m", "precipitation", "rain", "snowfall", "windspeed_10m")
    body = F.struct(F.struct(*[F.col(f"h.{n}").alias(n) for n in names]).alias("hourly"))
    return D.parse_weather(packed.select("borough", F.to_json(body).alias("payload")))


_DAYS = "SELECT ts::DATE AS fecha, sum(k) AS s FROM ek GROUP BY 1"


@query("A6_holiday_payload", f"SELECT fecha FROM ({_DAYS}) WHERE s % 7 = 0 OR s % 3 = 0", dates="fecha")
def holiday_payload(spark, sf):
    days = B.raw_events(spark, sf).groupBy(F.to_date("ts").alias("fecha")).agg(F.sum("k").alias("s"))
    s = F.col("s")
    item = F.struct(
        F.date_format("fecha", "yyyy-MM-dd").alias("date"), (s % 7 == 0).alias("global"),
        F.when(s % 3 == 0, F.array(F.lit("US-CT"), F.lit("US-NY"))).when(s % 3 == 1, F.array(F.lit("US-CA"))).alias("counties"),
    )
    packed = days.groupBy(F.date_format("fecha", "yyyy-MM").alias("mes")).agg(F.to_json(F.collect_list(item)).alias("payload"))
    return D.parse_holidays(packed, "2024-01", "2024-12")


@query("A7_city_events_csv", """
SELECT fecha, event_type, impacto, count(*) AS eventos FROM city_events WHERE year(fecha) = 2024 GROUP BY 1, 2, 3
""", dates="fecha")
def city_events_csv(spark, sf):
    path = scratch_path(spark, "city-events")
    B.raw_city_events(spark, sf).write.option("header", True).csv(path)
    events = D.city_events(D.read_city_events(spark, path), 2024)
    return events.groupBy("fecha", "event_type", "impacto").agg(F.count(F.lit(1)).alias("eventos"))


@query("A8_report_sinks", """
SELECT f AS formato, n AS filas, d AS demanda_total FROM
(SELECT count(*) AS n, sum(demanda_total) AS d FROM report), (VALUES ('csv'), ('json'), ('parquet')) v(f)
""", "demanda_total")
def report_sinks(spark, sf):
    """Write the demand report in three formats and read each back."""
    path = scratch_path(spark, "report")
    formats = ("parquet", "csv", "json")
    report = demand_report([B.trips(spark, sf)], B.zones(spark, sf))
    sinks.write_report(report, path, formats)
    out = None
    for fmt in formats:
        back = spark.read.schema(report.schema).option("header", True).format(fmt).load(f"{path}/{fmt}")
        row = back.agg(F.lit(fmt).alias("formato"), F.count(F.lit(1)).alias("filas"), F.sum("demanda_total").alias("demanda_total"))
        out = row if out is None else out.unionByName(row)
    return out


@query("A9_reused_table", "SELECT origen_id, franja_horaria, demanda_total FROM report", "demanda_total")
def reused_table(spark, sf):
    """The second read finds the table of the same inputs and does not build again."""
    path = scratch_path(spark, "reused")
    inputs = [f"{sf}/events.parquet"]
    build = lambda: demand_report([B.trips(spark, sf)]).select("origen_id", "franja_horaria", "demanda_total")

    def never():
        raise AssertionError("the stored table was not reused")

    sinks.reused_table(spark, path, inputs, build)
    return sinks.reused_table(spark, path, inputs, never)


@query("A10_file_profile", """
SELECT count(*) AS filas, 6 AS columnas, min(ts) AS primera, max(ts) AS ultima,
       (SELECT count(*) FROM (SELECT ts < lag(ts) OVER (ORDER BY event_id) AS b FROM events) WHERE b) AS desordenadas
FROM events
""")
def file_profile(spark, sf):
    e = B.table(spark, sf, "events")
    order = T.out_of_order(e, "event_id", "ts").select("desordenadas")
    return T.file_profile(e, "ts").withColumn("desordenadas", order.scalar())


@query("A10_edge_rows", """
SELECT event_id, ts, extremo FROM (
  (SELECT event_id, ts, 'inicio' AS extremo FROM events ORDER BY ts, event_id LIMIT 5)
  UNION ALL (SELECT event_id, ts, 'fin' AS extremo FROM events ORDER BY ts DESC, event_id DESC LIMIT 5))
""")
def edge_rows(spark, sf):
    return T.edge_rows(B.table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"])
