"""Trips and dimension tables derived from the given tables, and the query registry.

Every registered query names its Spark callable and, where SQL can express it, the
equivalent statement over the same tables. ``rnd`` lists floating-point outputs that
both sides round in the same way before they are compared, since engines add doubles
in different orders; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators.enrichment import enrich_trips
from ..operators.imputation import with_calendar
from ..session import written_tables
from ..sources import dimensions as D


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, rnd: str | tuple[str, ...] = "", digits: int = 9, dates: str = ""):
    """Register a query; ``rnd`` columns are rounded and ``dates`` become text on both sides."""
    cols = rnd.split() if isinstance(rnd, str) else list(rnd)
    days = dates.split()

    def wrap(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            out = fn(spark, sf)
            if not cols and not days:
                return out
            shown = {
                **{c: F.round(F.col(f"`{c}`"), digits) + F.lit(0.0) for c in cols},
                **{c: F.col(f"`{c}`").cast("string") for c in days},
            }
            return out.select(*[shown.get(c, F.col(f"`{c}`")).alias(c) for c in out.columns])

        text = sql
        if sql is not None:
            body = f"({sql.strip()})"
            if cols or days:
                changed = ", ".join(
                    [f'round("{c}"::DOUBLE, {digits}) + 0.0::DOUBLE AS "{c}"' for c in cols]
                    + [f'"{c}"::VARCHAR AS "{c}"' for c in days]
                )
                body = f"(SELECT * REPLACE ({changed}) FROM {body} AS q)"
            text = f"{COMMON_SQL} SELECT * FROM {body} AS result"
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, text)
        return fn

    return wrap


# declared, so that opening a table starts no job to read a file footer
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


# --- zones ----------------------------------------------------------------------

def zones(spark: SparkSession, sf: str) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        (F.col("n_nationkey") + 1).alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 2 == 0, "Boro Zone").otherwise("Yellow Zone").alias("service_zone"),
    )


# --- trips from events: times within the day ---------------------------------------

def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with ``k`` from their JSON text.

    A generator reads the text once per row; as a plain expression it would be copied
    into every filter and column that uses ``k``.
    """
    e = table(spark, sf, "events")
    return e.select("*", F.json_tuple("props", "k").alias("_k")).withColumn("k", F.col("_k").cast("int")).drop("_k")


def trips(spark: SparkSession, sf: str) -> DataFrame:
    e = raw_events(spark, sf)
    k = F.col("k")
    t = e.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("fecha_inicio"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k, F.lit(0))).alias("fecha_fin"),
        (F.col("user_id") % 25 + 1).cast("int").alias("origen_id"),
        (k % 25 + 1).alias("destino_id"),
        (F.col("value") / 10).alias("distancia"),
        F.when(k % 11 != 0, (k % 25).cast("double")).alias("espera_min"),
        F.when(F.col("event_type").isin("purchase", "signup"), "VTC").otherwise("Yellow Taxi").alias("tipo_vehiculo"),
        F.col("value").alias("precio_base"),
        (F.col("value") * 1.1).alias("precio_total_est"),
        F.when(k % 4 == 0, F.col("value") * 0.15).when(k % 4 == 1, F.lit(0.0))
        .when(k % 4 == 2, F.col("value") * 0.1).alias("propina"),
        (k % 4 + 1).alias("tipo_pago"),
        F.when(k % 7 != 0, k % 7).alias("num_pasajeros"),
    )
    t = t.withColumn("duracion_min", X.minutes_between("fecha_inicio", "fecha_fin"))
    t = t.where("distancia > 0.1 and distancia < 200 and duracion_min > 1 and duracion_min < 180")
    t = t.withColumn("velocidad_mph", X.speed_mph("distancia", "duracion_min"))
    return with_calendar(t).withColumn("mes_num", F.month("fecha_inicio"))


# --- raw files of both services, with rows on either side of every rule ----------------

def raw_yellow(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("k"), F.col("value")
    e = raw_events(spark, sf).where("event_type not in ('purchase', 'signup')")
    return e.select(
        (F.col("user_id") % 2 + 1).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k - 3, F.lit(0))).alias("tpep_dropoff_datetime"),
        F.when(k % 13 != 0, (k % 10).cast("double")).alias("passenger_count"),
        (v / 10).alias("trip_distance"),
        F.lit(1.0).alias("RatecodeID"),
        (F.col("user_id") % 25 + 241).cast("int").alias("PULocationID"),
        (k % 25 + 241).alias("DOLocationID"),
        (k % 4 + 1).alias("payment_type"),
        (v * 1.5 - 2.0).alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (v * 0.15).alias("tip_amount"),
        (k % 5).cast("double").alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (v * 1.5 + 3.0).alias("total_amount"),
        F.when(k % 17 != 0, F.lit(2.5)).alias("congestion_surcharge"),
    )


def raw_fhvhv(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("k"), F.col("value")
    e = raw_events(spark, sf).where("event_type in ('purchase', 'signup')")
    minutes = lambda m: F.make_dt_interval(F.lit(0), F.lit(0), m, F.lit(0))
    return e.select(
        F.lit("HV0003").alias("hvfhs_license_num"),
        F.concat(F.lit("B"), F.col("user_id").cast("string")).alias("dispatching_base_num"),
        (F.col("ts") - minutes((k * 2) % 130 - 3)).alias("request_datetime"),
        F.when(k % 19 != 0, F.col("ts")).alias("on_scene_datetime"),
        F.col("ts").alias("pickup_datetime"),
        (F.col("ts") + minutes(k - 3)).alias("dropoff_datetime"),
        (F.col("user_id") % 25 + 241).cast("int").alias("PULocationID"),
        (k % 25 + 241).alias("DOLocationID"),
        (v / 10).alias("trip_miles"),
        ((k - 3) * 60).cast("bigint").alias("trip_time"),
        (v * 1.5 - 2.0).alias("base_passenger_fare"),
        F.when(k % 9 == 0, -1.0).otherwise((k % 5).cast("double")).alias("tolls"),
        (v * 0.03).alias("bcf"),
        (v * 0.09).alias("sales_tax"),
        F.lit(2.75).alias("congestion_surcharge"),
        F.when(k % 3 == 0, 0.0).otherwise(v * 0.1).alias("tips"),
        (v * 0.7).alias("driver_pay"),
        F.lit("N").alias("shared_request_flag"),
    )


# --- trips from orders and lineitem: many months, daily times -----------------------

def fares(spark: SparkSession, sf: str) -> DataFrame:
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(s, li.l_suppkey == s.s_suppkey)
    )
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("o_orderdate").alias("fecha_inicio"),
        F.col("l_shipdate").alias("fecha_fin"),
        (F.col("c_nationkey") + 1).alias("origen_id"),
        (F.col("s_nationkey") + 1).alias("destino_id"),
        F.col("l_quantity").alias("distancia"),
        (F.col("l_linenumber") * 3.0).alias("espera_min"),
        F.when(F.col("l_returnflag") == "R", "VTC").otherwise("Yellow Taxi").alias("tipo_vehiculo"),
        (F.col("l_extendedprice") / 1000).alias("precio_base"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 1000).alias("precio_total_est"),
        (F.col("l_extendedprice") * F.col("l_tax") / 1000).alias("propina"),
        F.col("l_linenumber").alias("num_pasajeros"),
        F.month("o_orderdate").alias("mes_num"),
        (F.col("l_quantity") * 1.5 + F.col("l_linenumber")).alias("duracion_min"),
    ).withColumn("velocidad_mph", X.speed_mph("distancia", "duracion_min"))


# --- dimensions derived from events --------------------------------------------------

def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Readings per hour and borough, computed from the integers in the events."""
    region = table(spark, sf, "region")
    e = raw_events(spark, sf).withColumn("b", F.col("k") % 5)
    g = e.groupBy(X.floor_minutes("ts").alias("fecha_hora"), "b").agg(
        F.sum("k").alias("s"), F.max("k").alias("m"), F.min("k").alias("w"), F.count(F.lit(1)).alias("n")
    )
    return g.join(region, g.b == region.r_regionkey).select(
        "fecha_hora",
        F.col("r_name").alias("borough"),
        ((F.col("s") % 300) / 10.0 - 5.0).alias("temp_c"),
        ((F.col("m") % 4) / 10.0).alias("precipitation"),
        (F.col("w") % 40).cast("double").alias("viento_kmh"),
        ((F.col("m") % 4) > 1).cast("int").alias("lluvia"),
        ((F.col("n") % 3) > 1).cast("int").alias("nieve"),
    )


def event_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every date between the first and last event."""
    span = table(spark, sf, "events").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("fecha"))


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    days = raw_events(spark, sf).groupBy(F.to_date("ts").alias("fecha")).agg(F.sum("k").alias("s"))
    return days.select("fecha", (F.col("s") % 7 == 0).cast("int").alias("es_festivo"))


def raw_city_events(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups read as permits: a kind, an attendance in text and a date in text."""
    e = raw_events(spark, sf).where("event_type = 'signup'")
    return e.select(
        F.when(F.col("k") == 7, "Parade").when(F.col("k") < 5, "Street Fair").otherwise("Sport - Adult").alias("Event Type"),
        F.when(F.col("k") % 10 == 3, "unknown").otherwise((F.col("user_id") * 8).cast("string")).alias("Attendance"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date and Time"),
    )


def city_days(spark: SparkSession, sf: str) -> DataFrame:
    events = D.city_events(D.snake_case(raw_city_events(spark, sf)))
    return D.daily_events(events, event_days(spark, sf))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with context columns.

    The dimensions are written first, as they would be in production: Catalyst then
    knows their real size and broadcasts them, or not, on that ground. As plans over
    the events they would look as large as the events and force the trips to shuffle.
    """
    stored = written_tables({
        "weather": weather(spark, sf), "holidays": holidays(spark, sf), "daily": city_days(spark, sf),
    })
    return enrich_trips(trips(spark, sf), zones(spark, sf), **stored)


# The same tables in SQL. A statement pays only for the ones it names.
COMMON_SQL = """
WITH zones AS (
  SELECT n_nationkey + 1 AS "LocationID", r_name AS "Borough", n_name AS "Zone",
         CASE WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
), ek AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), trips AS (
  SELECT *, hour(fecha_inicio)::INTEGER AS hora, (isodow(fecha_inicio) - 1)::INTEGER AS dia_semana,
         (CASE WHEN isodow(fecha_inicio) >= 6 THEN 1 ELSE 0 END)::INTEGER AS es_fin_semana,
         CASE WHEN hour(fecha_inicio) < 6 THEN 'Madrugada' WHEN hour(fecha_inicio) < 12 THEN 'Mañana'
              WHEN hour(fecha_inicio) < 16 THEN 'Mediodia' WHEN hour(fecha_inicio) < 20 THEN 'Tarde'
              ELSE 'Noche' END AS franja_horaria,
         sin(2 * pi() * hour(fecha_inicio) / 24) AS hora_sen, cos(2 * pi() * hour(fecha_inicio) / 24) AS hora_cos,
         month(fecha_inicio)::INTEGER AS mes_num,
         distancia / (duracion_min / 60.0::DOUBLE) AS velocidad_mph
  FROM (
    SELECT event_id AS id, ts AS fecha_inicio, ts + k * INTERVAL 1 MINUTE AS fecha_fin,
           (user_id % 25 + 1)::INTEGER AS origen_id, (k % 25 + 1)::INTEGER AS destino_id,
           value / 10 AS distancia,
           CASE WHEN k % 11 <> 0 THEN (k % 25)::DOUBLE END AS espera_min,
           CASE WHEN event_type IN ('purchase', 'signup') THEN 'VTC' ELSE 'Yellow Taxi' END AS tipo_vehiculo,
           value AS precio_base, value * 1.1::DOUBLE AS precio_total_est,
           CASE WHEN k % 4 = 0 THEN value * 0.15::DOUBLE WHEN k % 4 = 1 THEN 0.0::DOUBLE
                WHEN k % 4 = 2 THEN value * 0.1::DOUBLE END AS propina,
           k % 4 + 1 AS tipo_pago,
           CASE WHEN k % 7 <> 0 THEN k % 7 END AS num_pasajeros,
           k::DOUBLE AS duracion_min
    FROM ek
  ) WHERE distancia > 0.1::DOUBLE AND distancia < 200 AND duracion_min > 1 AND duracion_min < 180
), raw_yellow AS (
  SELECT user_id % 2 + 1 AS "VendorID", ts AS tpep_pickup_datetime, ts + (k - 3) * INTERVAL 1 MINUTE AS tpep_dropoff_datetime,
         CASE WHEN k % 13 <> 0 THEN (k % 10)::DOUBLE END AS passenger_count, value / 10 AS trip_distance,
         1.0::DOUBLE AS "RatecodeID", (user_id % 25 + 241)::INTEGER AS "PULocationID", k % 25 + 241 AS "DOLocationID",
         k % 4 + 1 AS payment_type, value * 1.5::DOUBLE - 2 AS fare_amount, 0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax,
         value * 0.15::DOUBLE AS tip_amount, (k % 5)::DOUBLE AS tolls_amount, 0.3::DOUBLE AS improvement_surcharge,
         value * 1.5::DOUBLE + 3 AS total_amount, CASE WHEN k % 17 <> 0 THEN 2.5::DOUBLE END AS congestion_surcharge
  FROM ek WHERE event_type NOT IN ('purchase', 'signup')
), raw_fhvhv AS (
  SELECT 'HV0003' AS hvfhs_license_num, 'B' || user_id AS dispatching_base_num,
         ts - ((k * 2) % 130 - 3) * INTERVAL 1 MINUTE AS request_datetime,
         CASE WHEN k % 19 <> 0 THEN ts END AS on_scene_datetime, ts AS pickup_datetime,
         ts + (k - 3) * INTERVAL 1 MINUTE AS dropoff_datetime, (user_id % 25 + 241)::INTEGER AS "PULocationID",
         k % 25 + 241 AS "DOLocationID", value / 10 AS trip_miles, ((k - 3) * 60)::BIGINT AS trip_time,
         value * 1.5::DOUBLE - 2 AS base_passenger_fare,
         CASE WHEN k % 9 = 0 THEN -1.0::DOUBLE ELSE (k % 5)::DOUBLE END AS tolls, value * 0.03::DOUBLE AS bcf,
         value * 0.09::DOUBLE AS sales_tax, 2.75::DOUBLE AS congestion_surcharge,
         CASE WHEN k % 3 = 0 THEN 0.0::DOUBLE ELSE value * 0.1::DOUBLE END AS tips, value * 0.7::DOUBLE AS driver_pay,
         'N' AS shared_request_flag, k
  FROM ek WHERE event_type IN ('purchase', 'signup')
), fares AS (
  SELECT *, distancia / (duracion_min / 60.0::DOUBLE) AS velocidad_mph FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate AS fecha_inicio, l_shipdate AS fecha_fin,
           c_nationkey + 1 AS origen_id, s_nationkey + 1 AS destino_id, l_quantity AS distancia,
           l_linenumber * 3.0::DOUBLE AS espera_min,
           CASE WHEN l_returnflag = 'R' THEN 'VTC' ELSE 'Yellow Taxi' END AS tipo_vehiculo,
           l_extendedprice / 1000 AS precio_base,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS precio_total_est,
           l_extendedprice * l_tax / 1000 AS propina, l_linenumber AS num_pasajeros,
           month(o_orderdate)::INTEGER AS mes_num,
           l_quantity * 1.5::DOUBLE + l_linenumber AS duracion_min
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN supplier ON l_suppkey = s_suppkey
  )
), weather AS (
  SELECT fecha_hora, r_name AS borough, (s % 300) / 10.0::DOUBLE - 5.0::DOUBLE AS temp_c,
         (m % 4) / 10.0::DOUBLE AS precipitation, (w % 40)::DOUBLE AS viento_kmh,
         ((m % 4) > 1)::INTEGER AS lluvia, ((n % 3) > 1)::INTEGER AS nieve
  FROM (SELECT date_trunc('hour', ts) AS fecha_hora, k % 5 AS b, sum(k) AS s, max(k) AS m, min(k) AS w,
               count(*) AS n FROM ek GROUP BY 1, 2)
       JOIN region ON b = r_regionkey
), event_days AS (
  SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY))::DATE AS fecha FROM events
), holidays AS (
  SELECT ts::DATE AS fecha, (sum(k) % 7 = 0)::INTEGER AS es_festivo FROM ek GROUP BY 1
), city_events AS (
  SELECT ts::DATE AS fecha, event_type_name AS event_type, attendance,
         CASE WHEN coalesce(try_cast(attendance AS DOUBLE), 0) >= 5000 OR event_type_name = 'Parade' THEN 'Masivo'
              WHEN coalesce(try_cast(attendance AS DOUBLE), 0) >= 1000 OR event_type_name = 'Street Fair' THEN 'Medio'
              ELSE 'Pequeño' END AS impacto
  FROM (SELECT ts, CASE WHEN k = 7 THEN 'Parade' WHEN k < 5 THEN 'Street Fair' ELSE 'Sport - Adult' END AS event_type_name,
               CASE WHEN k % 10 = 3 THEN 'unknown' ELSE (user_id * 8)::VARCHAR END AS attendance
        FROM ek WHERE event_type = 'signup')
), city_days AS (
  SELECT d.fecha,
         coalesce(CASE max(CASE impacto WHEN 'Masivo' THEN 3 WHEN 'Medio' THEN 2 WHEN 'Pequeño' THEN 1 END)
                  WHEN 3 THEN 'Masivo' WHEN 2 THEN 'Medio' WHEN 1 THEN 'Pequeño' END, 'No hay') AS evento_tipo,
         count(impacto)::INTEGER AS num_eventos
  FROM event_days d LEFT JOIN city_events e ON d.fecha = e.fecha GROUP BY 1
), zoned AS (
  SELECT t.*, o."Zone" AS origen_zona, o."Borough" AS origen_barrio, d."Zone" AS destino_zona, d."Borough" AS destino_barrio
  FROM trips t LEFT JOIN zones o ON o."LocationID" = origen_id LEFT JOIN zones d ON d."LocationID" = destino_id
), weathered AS (
  SELECT z.*, temp_c, precipitation, viento_kmh, lluvia, nieve
  FROM zoned z LEFT JOIN weather w ON w.fecha_hora = date_trunc('hour', fecha_inicio) AND w.borough = origen_barrio
), enriched AS (
  SELECT w.* REPLACE (coalesce(w.temp_c, m.t, 0) AS temp_c, coalesce(w.viento_kmh, m.v, 0) AS viento_kmh,
                      coalesce(w.precipitation, 0)::DOUBLE AS precipitation, coalesce(w.lluvia, 0) AS lluvia,
                      coalesce(w.nieve, 0) AS nieve),
         coalesce(h.es_festivo, 0) AS es_festivo, coalesce(c.evento_tipo, 'No hay') AS evento_tipo,
         coalesce(c.num_eventos, 0) AS num_eventos
  FROM weathered w
       LEFT JOIN (SELECT tipo_vehiculo, mes_num, quantile_cont(temp_c, 0.5) AS t, quantile_cont(viento_kmh, 0.5) AS v
                  FROM weathered GROUP BY 1, 2) m USING (tipo_vehiculo, mes_num)
       LEFT JOIN holidays h ON h.fecha = w.fecha_inicio::DATE
       LEFT JOIN city_days c ON c.fecha = w.fecha_inicio::DATE
), zone_hours AS (
  SELECT *, hour(timestamp_hora)::INTEGER AS hora, (isodow(timestamp_hora) - 1)::INTEGER AS dia_semana,
         day(timestamp_hora)::INTEGER AS dia_mes, month(timestamp_hora)::INTEGER AS mes_num,
         (CASE WHEN isodow(timestamp_hora) >= 6 THEN 1 ELSE 0 END)::INTEGER AS es_finde
  FROM (SELECT origen_id, date_trunc('hour', fecha_inicio) AS timestamp_hora, count(*) AS demanda,
               avg(temp_c) AS temp_c, avg(precipitation) AS precipitation, avg(viento_kmh) AS viento_kmh,
               avg(velocidad_mph) AS velocidad_mph, max(lluvia) AS lluvia, max(nieve) AS nieve,
               max(es_festivo) AS es_festivo, avg(num_eventos) AS num_eventos
        FROM enriched GROUP BY 1, 2)
), hour_cuts AS (
  SELECT date_trunc('hour', a + to_microseconds((us * 0.70::DOUBLE)::BIGINT)) AS corte_train,
         date_trunc('hour', a + to_microseconds((us * 0.85::DOUBLE)::BIGINT)) AS corte_val
  FROM (SELECT min(fecha_inicio) AS a, date_diff('microsecond', min(fecha_inicio), max(fecha_inicio)) AS us FROM trips)
), window_cuts AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, a + to_microseconds((us * 0.70::DOUBLE)::BIGINT)) AS corte_train,
         time_bucket(INTERVAL 10 MINUTE, a + to_microseconds((us * 0.85::DOUBLE)::BIGINT)) AS corte_val
  FROM (SELECT min(fecha_inicio) AS a, date_diff('microsecond', min(fecha_inicio), max(fecha_inicio)) AS us FROM trips)
), series AS (
  SELECT *, lead(demanda) OVER w AS target, lag(demanda, 1) OVER w AS lag_1h, lag(demanda, 2) OVER w AS lag_2h,
         lag(demanda, 3) OVER w AS lag_3h, lag(demanda, 6) OVER w AS lag_6h, lag(demanda, 12) OVER w AS lag_12h,
         lag(demanda, 24) OVER w AS lag_24h,
         avg(demanda) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll_mean_3h,
         coalesce(stddev(demanda) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS roll_std_3h,
         avg(demanda) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS roll_mean_24h,
         coalesce(stddev(demanda) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS roll_std_24h
  FROM zone_hours WINDOW w AS (PARTITION BY origen_id ORDER BY timestamp_hora)
), features AS (
  SELECT s.* REPLACE (coalesce(lag_6h, media_hist)::DOUBLE AS lag_6h, coalesce(lag_12h, media_hist)::DOUBLE AS lag_12h,
                      coalesce(lag_24h, media_hist)::DOUBLE AS lag_24h)
  FROM (
    SELECT s.*, coalesce(h.m, (SELECT avg(demanda) FROM zone_hours, hour_cuts WHERE timestamp_hora < corte_train)) AS media_hist,
           CASE WHEN timestamp_hora < corte_train THEN 'train' WHEN timestamp_hora < corte_val THEN 'val' ELSE 'test' END AS split
    FROM series s CROSS JOIN hour_cuts
         LEFT JOIN (SELECT origen_id, hora, dia_semana, avg(demanda) AS m FROM zone_hours, hour_cuts
                    WHERE timestamp_hora < corte_train GROUP BY 1, 2, 3) h USING (origen_id, hora, dia_semana)
  ) s WHERE target IS NOT NULL AND lag_1h IS NOT NULL AND lag_2h IS NOT NULL AND lag_3h IS NOT NULL
), supply AS (
  SELECT destino_id AS origen_id, time_bucket(INTERVAL 10 MINUTE, fecha_fin) AS ventana_inicio, count(*) AS oferta_inferida
  FROM trips GROUP BY 1, 2
), zone_windows AS (
  SELECT *, hour(ventana_inicio)::INTEGER AS hora, (isodow(ventana_inicio) - 1)::INTEGER AS dia_semana,
         (CASE WHEN isodow(ventana_inicio) >= 6 THEN 1 ELSE 0 END)::INTEGER AS es_finde,
         sin(2 * pi() * hour(ventana_inicio) / 24) AS hora_sen, cos(2 * pi() * hour(ventana_inicio) / 24) AS hora_cos,
         month(ventana_inicio)::INTEGER AS mes_num
  FROM (SELECT origen_id, time_bucket(INTERVAL 10 MINUTE, fecha_inicio) AS ventana_inicio, count(espera_min) AS n_viajes,
               avg(CASE WHEN espera_min <= 10 THEN 1 ELSE 0 END) AS tasa_exito, avg(espera_min) AS espera_media,
               avg(temp_c) AS temp_c, avg(precipitation) AS precipitation, avg(viento_kmh) AS viento_kmh,
               max(lluvia) AS lluvia, max(nieve) AS nieve, max(es_festivo) AS es_festivo, avg(num_eventos) AS num_eventos
        FROM enriched GROUP BY 1, 2)
), labelled AS (
  SELECT w.*, coalesce(oferta_inferida, 0)::DOUBLE AS oferta_inferida, (tasa_exito >= q)::INTEGER AS target,
         CASE WHEN ventana_inicio < corte_train THEN 'train' WHEN ventana_inicio < corte_val THEN 'val' ELSE 'test' END AS split
  FROM zone_windows w CROSS JOIN window_cuts LEFT JOIN supply USING (origen_id, ventana_inicio)
       JOIN (SELECT ventana_inicio, quantile_cont(tasa_exito, 0.67) AS q FROM zone_windows GROUP BY 1) USING (ventana_inicio)
), good_zones AS (
  SELECT l.*, coalesce(r, (SELECT avg(target) FROM labelled WHERE split = 'train')) AS tasa_historica
  FROM labelled l LEFT JOIN (SELECT origen_id, hora, dia_semana, avg(target) AS r FROM labelled WHERE split = 'train'
                             GROUP BY 1, 2, 3) USING (origen_id, hora, dia_semana)
), demand_rows AS (
  SELECT origen_id, hour(h)::INTEGER AS hora, c::DOUBLE AS demanda
  FROM (SELECT origen_id, date_trunc('hour', fecha_inicio) AS h, count(*) AS c FROM trips GROUP BY 1, 2)
), banded AS (
  SELECT *, CASE WHEN hora < 6 THEN 'madrugada' WHEN hora < 12 THEN 'manana' WHEN hora < 16 THEN 'mediodia'
                 WHEN hora < 20 THEN 'tarde' ELSE 'noche' END AS franja_horaria FROM demand_rows
), band_summary AS (
  SELECT origen_id, franja_horaria, avg(demanda) AS demanda_media, quantile_cont(demanda, 0.5) AS demanda_mediana,
         sum(demanda) AS demanda_total, count(*) AS horas_observadas FROM banded GROUP BY 1, 2
), peaks AS (
  SELECT origen_id, franja_horaria, hora AS hora_pico, m AS demanda_hora_pico
  FROM (SELECT *, row_number() OVER (PARTITION BY origen_id, franja_horaria ORDER BY m DESC, hora DESC) AS rn
        FROM (SELECT origen_id, franja_horaria, hora, avg(demanda) AS m FROM banded GROUP BY 1, 2, 3)) WHERE rn = 1
), levels AS (
  SELECT b.*, hora_pico, demanda_hora_pico,
         CASE WHEN demanda_media <= q1 THEN 'baja' WHEN demanda_media <= q2 THEN 'media' ELSE 'alta' END AS nivel_demanda,
         round(((rank() OVER (ORDER BY demanda_media)) + ((count(*) OVER (PARTITION BY demanda_media)) - 1) / 2.0::DOUBLE)
               / (count(*) OVER ()) * 100.0::DOUBLE, 2) AS score_demanda_0_100
  FROM band_summary b JOIN peaks USING (origen_id, franja_horaria)
       CROSS JOIN (SELECT quantile_cont(demanda_media, 0.33) AS q1, quantile_cont(demanda_media, 0.66) AS q2 FROM band_summary)
), report AS (
  SELECT l.*, "Borough" AS origen_barrio, "Zone" AS origen_zona, service_zone AS origen_service_zone
  FROM levels l LEFT JOIN zones ON "LocationID" = origen_id
)
"""
