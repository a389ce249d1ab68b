"""Context columns on clean trips: zones, weather, holidays, city events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..session import closed_domain
from ..sources.dimensions import one_per_hour


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone and borough of both ends. ``zones`` has one row per ``LocationID``."""
    for end in ("origen", "destino"):
        side = zones.select(
            F.col("LocationID").alias(f"{end}_id"),
            F.col("Zone").alias(f"{end}_zona"),
            F.col("Borough").alias(f"{end}_barrio"),
        )
        trips = trips.join(side, f"{end}_id", "left")
    return trips


def with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of the pickup hour and borough."""
    hourly = one_per_hour(weather).withColumnsRenamed({"fecha_hora": "_hora", "borough": "origen_barrio"})
    keyed = trips.withColumn("_hora", X.floor_minutes("fecha_inicio"))
    return keyed.join(hourly, ["_hora", "origen_barrio"], "left").drop("_hora")


_MEASURES = ("temp_c", "viento_kmh")


def _weighted_medians(counts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return counts.groupBy(*by).agg(*[F.percentile(m, F.lit(0.5), F.col("c")).alias(f"_{m}") for m in _MEASURES])


def weather_medians(
    trips: DataFrame, zones: DataFrame, weather: DataFrame, by: tuple[str, ...] = ("tipo_vehiculo", "mes_num")
) -> DataFrame:
    """Median readings over the trips of each file, without joining a trip.

    Trips are counted per file, hour and pickup zone; zones and readings are joined to
    these counts, which are as few as the zones times the hours of the files.
    """
    hourly = one_per_hour(weather).select(F.col("fecha_hora").alias("_hora"), "borough", *_MEASURES)
    boroughs = zones.select(F.col("LocationID").alias("origen_id"), F.col("Borough").alias("borough"))
    counts = trips.groupBy(*by, X.floor_minutes("fecha_inicio").alias("_hora"), "origen_id").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.join(boroughs, "origen_id", "left").groupBy(*by, "_hora", "borough").agg(F.sum("c").alias("c"))
    return _weighted_medians(counts.join(hourly, ["_hora", "borough"], "left"), by)


def fill_weather(
    trips: DataFrame, by: tuple[str, ...] = ("tipo_vehiculo", "mes_num"), medians: DataFrame | None = None
) -> DataFrame:
    """Flags and precipitation to 0; temperature and wind to the median of their file.

    A file is one service and month. ``medians`` are those of ``weather_medians``; without
    them trips are first counted per distinct pair of readings, at most one per hour and
    borough of the month, and the medians are weighted by those counts: one pass, and no
    task holds the readings of all trips.
    """
    if medians is None:
        medians = _weighted_medians(trips.groupBy(*by, *_MEASURES).agg(F.count(F.lit(1)).alias("c")), by)
    filled = trips.join(closed_domain(medians), list(by), "left")
    return filled.withColumns({
        **{m: F.coalesce(F.col(m), F.col(f"_{m}"), F.lit(0.0)) for m in _MEASURES},
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in ("lluvia", "nieve")},
        "precipitation": F.coalesce("precipitation", F.lit(0.0)),
    }).drop(*[f"_{m}" for m in _MEASURES])


def with_holidays(trips: DataFrame, holidays: DataFrame) -> DataFrame:
    days = holidays.select(F.col("fecha").alias("_fecha"), "es_festivo")
    joined = trips.withColumn("_fecha", F.to_date("fecha_inicio")).join(days, "_fecha", "left")
    return joined.withColumn("es_festivo", F.coalesce("es_festivo", F.lit(0))).drop("_fecha")


def with_city_events(trips: DataFrame, daily: DataFrame) -> DataFrame:
    days = daily.select(F.col("fecha").alias("_fecha"), "evento_tipo", "num_eventos")
    joined = trips.withColumn("_fecha", F.to_date("fecha_inicio")).join(days, "_fecha", "left")
    return joined.withColumns({
        "evento_tipo": F.coalesce("evento_tipo", F.lit(C.NO_EVENT)),
        "num_eventos": F.coalesce("num_eventos", F.lit(0)),
    }).drop("_fecha")


def enrich_trips(
    trips: DataFrame, zones: DataFrame, weather: DataFrame, holidays: DataFrame, daily: DataFrame
) -> DataFrame:
    if "mes_num" not in trips.columns:
        trips = trips.withColumn("mes_num", F.month("fecha_inicio"))
    medians = weather_medians(trips, zones, weather)
    out = fill_weather(with_weather(with_zones(trips, zones), weather), medians=medians)
    return with_city_events(with_holidays(out, holidays), daily)
