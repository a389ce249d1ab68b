"""Exploratory reports. Each is one or two aggregations over trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import contract as C
from ..functions import columns as X
from ..functions.moments import normal_interval
from ..functions.order_statistics import exact_quantiles
from ..session import written_table
from .cleaning import trim_above

SERVICE = "tipo_vehiculo"
SERVICES = tuple(C.SERVICE_LABELS.values())


def trip_count(name: str = "viajes") -> Column:
    return F.count(F.lit(1)).alias(name)


# --- quality filters of the reports -------------------------------------------

def per_mile_rule() -> Column:
    """Price per mile below $20 on trips over half a mile and $2."""
    dear = (F.col("distancia") > 0.5) & (F.col("precio_total_est") > 2.0)
    return dear & (X.ratio("precio_total_est", "distancia") < 20)


def price_rule() -> Column:
    return (F.col("precio_total_est") > 2) & (F.col("precio_total_est") < 200)


def speed_rule(min_minutes: float | None = None) -> Column:
    """Speeds between 0 and 60 mph, recomputed on trips of at least ``min_minutes``."""
    if min_minutes is None:
        return (F.col("velocidad_mph") > 0) & (F.col("velocidad_mph") < 60)
    speed = X.speed_mph("distancia", "duracion_min")
    return (F.col("duracion_min") > min_minutes) & (speed > 0) & (speed < 60)


def price_per_mile(trips: DataFrame) -> DataFrame:
    return trips.where(per_mile_rule()).withColumn("precio_por_milla", X.ratio("precio_total_est", "distancia"))


def usual_prices(trips: DataFrame) -> DataFrame:
    return trips.where(price_rule())


def usual_speeds(trips: DataFrame, min_minutes: float | None = None) -> DataFrame:
    kept = trips.where(speed_rule(min_minutes))
    return kept if min_minutes is None else kept.withColumn("velocidad_mph", X.speed_mph("distancia", "duracion_min"))


# --- index ----------------------------------------------------------------------

def _unit(c: str) -> Column:
    """Min-max over the whole (zone or borough) summary; a constant column gives 0."""
    everything = Window.partitionBy()
    lo, hi = F.min(c).over(everything), F.max(c).over(everything)
    return F.when(hi == lo, 0.0).otherwise((F.col(c) - lo) / (hi - lo))


def purchasing_power(trips: DataFrame, by: str, over_known: bool = False) -> DataFrame:
    """Index 0-100 per zone or borough from tips, passengers and trips.

    Means divide by all trips of the group, or by the known values only.
    """
    known = trips.where(F.col(by).isNotNull())
    n = F.count(F.lit(1))
    mean = (lambda c: F.avg(c)) if over_known else (lambda c: F.coalesce(F.sum(c), F.lit(0.0)) / n)
    stats = known.groupBy(by).agg(
        mean("propina").alias("propina_media"), mean("num_pasajeros").alias("pasajeros_medios"),
        n.alias("volumen_viajes"),
    )
    w = C.INDEX_WEIGHTS
    index = (
        _unit("propina_media") * w["propina"] + _unit("pasajeros_medios") * w["num_pasajeros"]
        + _unit("volumen_viajes") * w["viajes"]
    ) * 100.0
    return stats.withColumn("Poder_Adquisitivo", index)


# --- by month, day, hour ---------------------------------------------------------

def monthly_service(trips: DataFrame) -> DataFrame:
    return trips.groupBy("mes_num", SERVICE).agg(
        F.avg("precio_total_est").alias("precio_medio"), F.count("distancia").alias("num_viajes")
    )


def daily_measures(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.to_date("fecha_inicio").alias("fecha")).agg(
        F.avg("precio_total_est").alias("precio_promedio"),
        F.count("fecha_inicio").alias("num_viajes"),
        F.avg("velocidad_mph").alias("velocidad_promedio"),
        F.max("lluvia").alias("lluvia"),
        F.max("nieve").alias("nieve"),
    )


def mean_trips_per_hour(trips: DataFrame) -> DataFrame:
    """Trips per day, hour and service, then the mean over days."""
    per_day = trips.groupBy(F.to_date("fecha_inicio").alias("fecha"), F.hour("fecha_inicio").alias("hora"), SERVICE)
    counts = per_day.agg(trip_count("num_viajes"))
    return counts.groupBy("hora", SERVICE).agg(F.avg("num_viajes").alias("num_viajes"))


def demand_in_rain(trips: DataFrame) -> DataFrame:
    per_day = trips.groupBy(
        F.to_date("fecha_inicio").alias("fecha"), F.col("lluvia").cast("boolean").alias("es_lluvia")
    ).agg(trip_count("viajes_dia"))
    return per_day.groupBy("es_lluvia").agg(F.avg("viajes_dia").alias("viajes_dia")).withColumn(
        "tipo_dia", F.when(F.col("es_lluvia"), "Lluvia").otherwise("Normal")
    )


def speed_by_hour(trips: DataFrame, borough: str | None = None, min_minutes: float | None = 5.0) -> DataFrame:
    """Mean speed by hour and service with a normal 95 % interval."""
    if borough is not None:
        wanted = F.lower(F.trim(F.lit(borough)))
        trips = trips.where(F.lower(F.trim(F.col("origen_barrio"))) == wanted)
    lo, hi = normal_interval("velocidad_mph")
    return usual_speeds(trips, min_minutes).groupBy(F.hour("fecha_inicio").alias("hora"), SERVICE).agg(
        F.avg("velocidad_mph").alias("velocidad_mph"), lo.alias("ic_bajo"), hi.alias("ic_alto"),
        trip_count("n"),
    )


def borough_suggestions(zones: DataFrame, borough: str) -> DataFrame:
    """Borough names that contain the text, for an unknown borough."""
    names = zones.select(F.trim("Borough").alias("barrio")).where(F.col("barrio").isNotNull()).distinct()
    hit = F.contains(F.lower("barrio"), F.lower(F.trim(F.lit(borough))))
    return names.where(hit)


def price_per_mile_by(trips: DataFrame, key: Column) -> DataFrame:
    return price_per_mile(trips).groupBy(key, SERVICE).agg(F.avg("precio_por_milla").alias("precio_por_milla"))


def trips_by(trips: DataFrame, *keys: Column | str) -> DataFrame:
    return trips.groupBy(*keys).agg(trip_count())


def monthly_precipitation(trips: DataFrame) -> DataFrame:
    return trips.groupBy("mes_num").agg(
        F.count(SERVICE).alias("viajes"), F.avg("precipitation").alias("precipitation")
    )


def sky_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy(X.sky().alias("estado_cielo"), SERVICE).agg(trip_count())


# --- market ----------------------------------------------------------------------

def market_headline(trips: DataFrame) -> DataFrame:
    """Trips, shares, means and the price gap between services in one row."""
    is_taxi, is_vtc = (F.col(SERVICE) == s for s in SERVICES)
    price = F.col("precio_total_est")
    row = trips.agg(
        trip_count("total_viajes"),
        F.count_if(is_taxi).alias("viajes_taxi"),
        F.count_if(is_vtc).alias("viajes_vtc"),
        F.avg("distancia").alias("distancia_media"),
        F.avg("duracion_min").alias("duracion_media"),
        F.avg("velocidad_mph").alias("velocidad_media"),
        F.avg(F.when(is_taxi, price)).alias("precio_taxi"),
        F.avg(F.when(is_vtc, price)).alias("precio_vtc"),
    )
    gap = F.col("precio_vtc") - F.col("precio_taxi")
    return row.withColumns({
        "pct_taxi": F.try_divide(F.col("viajes_taxi"), F.col("total_viajes")) * 100.0,
        "pct_vtc": F.try_divide(F.col("viajes_vtc"), F.col("total_viajes")) * 100.0,
        "precio_dif": gap,
        "precio_dif_pct": F.try_divide(gap, F.col("precio_taxi")) * 100.0,
    })


def shares(counts: DataFrame, group: Sequence[str], value: str = "viajes", name: str = "pct", scale: float = 100.0) -> DataFrame:
    """Share of each row in the total of its group; ``counts`` is already aggregated."""
    total = F.sum(value).over(Window.partitionBy(*group))
    return counts.withColumn(name, F.col(value) / total * scale)


def market_share(trips: DataFrame, key: str) -> DataFrame:
    return shares(trips_by(trips.where(F.col(key).isNotNull()), key, SERVICE), [key])


def market_share_matrix(trips: DataFrame, key: str = "origen_barrio") -> DataFrame:
    wide = market_share(trips, key).groupBy(key).pivot(SERVICE, list(SERVICES)).agg(F.first("pct"))
    return wide.fillna(0.0)


def price_gap_by_month(trips: DataFrame) -> DataFrame:
    wide = trips.groupBy("mes_num").pivot(SERVICE, list(SERVICES)).agg(F.avg("precio_total_est"))
    taxi, vtc = (F.col(s) for s in SERVICES)
    return wide.withColumns({
        "dif_abs": vtc - taxi, "dif_pct": F.try_divide(vtc - taxi, taxi) * 100.0,
    })


def hour_weekday_matrix(
    trips: DataFrame, service: str | None = None, zone: str | None = None, fill: bool = True
) -> DataFrame:
    """Trips by hour (rows) and weekday (columns): all, one service or one zone."""
    if service is not None:
        trips = trips.where(F.col(SERVICE) == service)
    if zone is not None:
        trips = trips.where(F.col("origen_zona") == zone)
    named = trips.select(
        F.hour("fecha_inicio").alias("hora"), X.weekday_name(X.weekday("fecha_inicio")).alias("dia")
    )
    wide = named.groupBy("hora").pivot("dia", list(C.WEEKDAYS_EN)).agg(F.count(F.lit(1)))
    return wide.fillna(0) if fill else wide


# --- zones -----------------------------------------------------------------------

def price_by_zone(trips: DataFrame) -> DataFrame:
    known = usual_prices(trips).where(F.col("origen_zona").isNotNull())
    return known.groupBy("origen_zona").agg(
        F.avg("precio_total_est").alias("precio_medio"), F.count("precio_total_est").alias("num_viajes")
    )


def top_zones(trips: DataFrame, k: int = 10) -> DataFrame:
    known = trips.where(F.col("origen_zona").isNotNull())
    return trips_by(known, "origen_zona").orderBy(F.desc("viajes"), "origen_zona").limit(k)


def class_means(trips: DataFrame, words: Sequence[str], inside: str = "Aeropuerto", outside: str = "Resto") -> DataFrame:
    """Mean distance and price of trips that touch a zone class, and of the rest."""
    valid = trips.where((F.col("distancia") > 0) & (F.col("precio_total_est") > 0))
    return valid.groupBy(X.zone_class(words, inside, outside).alias("tipo_viaje")).agg(
        F.avg("distancia").alias("distancia_media"), F.avg("precio_total_est").alias("precio_medio")
    )


def class_price_per_mile(trips: DataFrame, words: Sequence[str], inside: str, outside: str = "Resto NYC") -> DataFrame:
    """Mean, exact median and count of price per mile by zone class."""
    valid = trips.where((F.col("distancia") > 0) & (F.col("precio_total_est") > 0)).select(
        X.zone_class(words, inside, outside).alias("tipo_zona"),
        X.ratio("precio_total_est", "distancia").alias("precio_por_milla"),
    )
    means = valid.groupBy("tipo_zona").agg(F.avg("precio_por_milla").alias("precio_medio_milla"), trip_count())
    median = exact_quantiles(valid, ["precio_por_milla"], [0.5], by=["tipo_zona"]).select(
        "tipo_zona", F.col("q0").alias("precio_mediano_milla")
    )
    return means.join(median, "tipo_zona")


def class_hour_profile(trips: DataFrame, words: Sequence[str], inside: str, outside: str = "Resto NYC") -> DataFrame:
    """Share of each class's trips by hour."""
    counts = trips.groupBy(
        X.zone_class(words, inside, outside).alias("tipo_zona"), F.hour("fecha_inicio").alias("hora")
    ).agg(trip_count("num_viajes"))
    return shares(counts, ["tipo_zona"], "num_viajes", "proporcion", 1.0)


# --- distributions -----------------------------------------------------------------

def histogram(trips: DataFrame, column: str, bins: int = 60, by: str | None = SERVICE, trim: float | None = 0.99) -> DataFrame:
    """Equal-width density histogram per service between its own min and max.

    Values above the overall quantile ``trim`` are left out first.
    """
    kept = trim_above(trips, column, trim) if trim is not None else trips.where(F.col(column) > 0)
    values = kept.select((F.col(by) if by else F.lit("todos")).alias("grupo"), F.col(column).cast("double").alias("v"))
    edges = values.groupBy("grupo").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_no = F.least(F.floor(F.coalesce(F.try_divide(F.col("v") - F.col("lo"), width), F.lit(0.0))), F.lit(bins - 1))
    placed = values.join(written_table(edges, "histogram_edges"), "grupo").withColumn("bin", bin_no.cast("int"))
    return placed.groupBy("grupo", "lo", "hi", "n", "bin").agg(trip_count("casos")).select(
        "grupo", "bin",
        (F.col("lo") + F.col("bin") * width).alias("desde"),
        "casos",
        F.try_divide(F.col("casos").cast("double"), F.col("n") * width).alias("densidad"),
    )


def box_summary(trips: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 ranges, and points beyond."""
    values = trips.select(F.col(by), F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    q = written_table(exact_quantiles(values, ["v"], (0.25, 0.5, 0.75), by=[by]).select(
        by, F.col("q0").alias("q1"), F.col("q1").alias("mediana"), F.col("q2").alias("q3")
    ), "quartiles")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return values.join(q, by).groupBy(by, "q1", "mediana", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("bigote_bajo"),
        F.max(F.when(inside, F.col("v"))).alias("bigote_alto"),
        F.count_if(~inside).alias("atipicos"),
        trip_count("n"),
    )


def linear_trend(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("pendiente"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("ordenada"),
        F.corr(F.col(y).cast("double"), F.col(x).cast("double")).alias("correlacion"),
        trip_count("n"),
    )


# --- weather and events --------------------------------------------------------------

def event_timeline(trips: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Daily trips with a flag for days with any city event."""
    per_day = trips.groupBy(F.to_date("fecha_inicio").alias("fecha")).agg(
        trip_count(), F.bool_or(F.col("num_eventos") > 0).alias("hubo_evento")
    )
    if days is None:
        return per_day
    return days.join(per_day, "fecha", "left").select(
        "fecha", F.coalesce("viajes", F.lit(0)).alias("viajes"), F.coalesce("hubo_evento", F.lit(False)).alias("hubo_evento")
    )


def rain_holiday_peak(trips: DataFrame) -> DataFrame:
    hour = F.hour("fecha_inicio")
    return trips.groupBy(
        F.col("lluvia").cast("boolean").alias("es_lluvia"),
        F.col("es_festivo").cast("boolean").alias("es_festivo"),
        (hour.between(8, 10) | hour.between(17, 19)).alias("hora_pico"),
    ).agg(trip_count())
