"""Zone, weather, holiday and city-event tables from their raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
WEATHER_SCHEMA = (
    "hourly struct<time:array<string>,temperature_2m:array<double>,precipitation:array<double>,"
    "rain:array<double>,snowfall:array<double>,windspeed_10m:array<double>>"
)
HOLIDAY_SCHEMA = "array<struct<date:string,`global`:boolean,counties:array<string>>>"


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV; ``N/A`` and empty cells are NULL. One row per zone id."""
    raw = spark.read.schema(ZONE_SCHEMA).option("header", True).option("nullValue", "N/A").csv(path)
    return unique_by_key(raw, ["LocationID"], ["Borough", "Zone", "service_zone"])


def unique_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep one row per key, the first by ``order``; combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return kept.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def parse_weather(payloads: DataFrame, borough: str = "borough", payload: str = "payload") -> DataFrame:
    """Hourly-array payloads to one row per hour and borough with derived flags."""
    hourly = F.col("_p.hourly")
    rows = payloads.select(
        F.col(borough).alias("borough"), F.from_json(payload, WEATHER_SCHEMA).alias("_p")
    ).select(
        "borough",
        F.inline(F.arrays_zip(*[
            hourly[name].alias(name) for name in (
                "time", "temperature_2m", "precipitation", "rain", "snowfall", "windspeed_10m"
            )
        ])),
    )
    return rows.select(
        X.lenient_timestamp("time").alias("fecha_hora"),
        "borough",
        F.col("temperature_2m").alias("temp_c"),
        "precipitation",
        F.col("windspeed_10m").alias("viento_kmh"),
        X.weather_flag("rain").alias("lluvia"),
        X.weather_flag("snowfall").alias("nieve"),
    )


def one_per_hour(weather: DataFrame) -> DataFrame:
    """A repeated local hour must not multiply trips: mean of measures, max of flags."""
    return weather.groupBy("fecha_hora", "borough").agg(
        F.avg("temp_c").alias("temp_c"),
        F.avg("precipitation").alias("precipitation"),
        F.avg("viento_kmh").alias("viento_kmh"),
        F.max("lluvia").alias("lluvia"),
        F.max("nieve").alias("nieve"),
    )


def parse_holidays(payloads: DataFrame, start: str, end: str, payload: str = "payload") -> DataFrame:
    """Federal and New York holidays inside [start, end]; the dates are unique."""
    items = payloads.select(F.inline(F.from_json(payload, HOLIDAY_SCHEMA)))
    local = F.coalesce(F.array_contains("counties", "US-NY"), F.lit(False))
    return (
        items.where(F.coalesce(F.col("global"), F.lit(False)) | local)
        .select(F.col("date").try_cast("date").alias("fecha"))
        .where(F.col("fecha").between(X.month_edge(F.lit(start)), X.month_edge(F.lit(end), last=True)))
        .distinct()
    )


def calendar_days(spark: SparkSession, start: Column | str, end: Column | str) -> DataFrame:
    """Every date from ``start`` to ``end``; text bounds may be ``YYYY-MM``."""
    first = X.month_edge(F.lit(start)) if isinstance(start, str) else start
    last = X.month_edge(F.lit(end), last=True) if isinstance(end, str) else end
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("fecha"))


def calendar_months(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``YYYY-MM`` of every month from ``start`` to ``end``."""
    months = F.sequence(X.month_edge(F.lit(start)), X.month_edge(F.lit(end)), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("d")).select(F.date_format("d", "yyyy-MM").alias("mes"))


def holiday_calendar(holidays: DataFrame, days: DataFrame) -> DataFrame:
    marked = holidays.select("fecha").distinct().withColumn("_h", F.lit(1))
    return days.join(marked, "fecha", "left").select("fecha", F.coalesce("_h", F.lit(0)).alias("es_festivo"))


def read_city_events(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    return snake_case(raw)


def snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def city_events(raw: DataFrame, year: int | None = None) -> DataFrame:
    """One row per event with its date and impact; unreadable dates and other years drop out."""
    dated = raw.withColumn("fecha", X.lenient_timestamp("date_and_time").cast("date"))
    kept = dated.where(F.col("fecha").isNotNull())
    if year is not None:
        kept = kept.where(F.year("fecha") == year)
    return kept.select("fecha", "event_type", "attendance", X.event_impact().alias("impacto"))


def daily_events(events: DataFrame, days: DataFrame) -> DataFrame:
    """Highest impact and event count per day over a full calendar."""
    names = {v: k for k, v in C.EVENT_PRIORITY.items()}
    per_day = events.groupBy("fecha").agg(
        F.max(X.literal_rank("impacto", C.EVENT_PRIORITY)).alias("_p"),
        F.count(F.lit(1)).cast("int").alias("num_eventos"),
    )
    # get() and not element_at(): with a NULL index the latter is not NULL under ANSI rules
    label = F.get(F.array(*[F.lit(names[i]) for i in range(4)]), F.col("_p"))
    return days.join(per_day, "fecha", "left").select(
        "fecha",
        F.coalesce(label, F.lit(C.NO_EVENT)).alias("evento_tipo"),
        F.coalesce("num_eventos", F.lit(0)).alias("num_eventos"),
    )
