"""Zone by hour demand and its features; zone by time-band levels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import contract as C
from ..functions import columns as X


def zone_hour_counts(trips: DataFrame) -> DataFrame:
    """Trips per zone and clock hour; counted on the map side before the shuffle."""
    return trips.groupBy("origen_id", X.floor_minutes("fecha_inicio").alias("timestamp_hora")).agg(
        F.count(F.lit(1)).alias("demanda")
    )


def zone_hour_demand(trips: DataFrame) -> DataFrame:
    """Zone by hour table: demand, mean conditions, flags, calendar of the hour."""
    grouped = trips.groupBy("origen_id", X.floor_minutes("fecha_inicio").alias("timestamp_hora")).agg(
        F.count("fecha_inicio").alias("demanda"),
        *[F.avg(c).alias(c) for c in ("temp_c", "precipitation", "viento_kmh", "velocidad_mph")],
        *[F.max(c).alias(c) for c in ("lluvia", "nieve", "es_festivo")],
        F.avg("num_eventos").alias("num_eventos"),
    )
    return grouped.withColumns(X.calendar("timestamp_hora"))


def dense_hours(zone_hours: DataFrame) -> DataFrame:
    """Fill the hours without trips between the first and last of each zone with zero."""
    span = zone_hours.groupBy("origen_id").agg(
        F.min("timestamp_hora").alias("a"), F.max("timestamp_hora").alias("b")
    )
    grid = span.select("origen_id", F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("timestamp_hora"))
    return grid.join(zone_hours, ["origen_id", "timestamp_hora"], "left").withColumn(
        "demanda", F.coalesce("demanda", F.lit(0))
    )


# Windows below run over zone by hour rows: one zone has at most one row per hour,
# however many trips it holds.

def with_lags(zone_hours: DataFrame, lags: Sequence[int] = C.LAGS) -> DataFrame:
    """Demand of earlier observed rows of the zone."""
    w = Window.partitionBy("origen_id").orderBy("timestamp_hora")
    return zone_hours.withColumns({f"lag_{n}h": F.lag("demanda", n).over(w) for n in lags})


def with_target(zone_hours: DataFrame) -> DataFrame:
    w = Window.partitionBy("origen_id").orderBy("timestamp_hora")
    return zone_hours.withColumn("target", F.lead("demanda", 1).over(w))


def with_rolling(zone_hours: DataFrame, sizes: Sequence[int] = C.ROLLING) -> DataFrame:
    """Trailing mean and deviation, the row itself excluded."""
    w = Window.partitionBy("origen_id").orderBy("timestamp_hora")
    out = {}
    for n in sizes:
        past = w.rowsBetween(-n, -1)
        out[f"roll_mean_{n}h"] = F.avg("demanda").over(past)
        out[f"roll_std_{n}h"] = F.coalesce(F.stddev("demanda").over(past), F.lit(0.0))
    return zone_hours.withColumns(out)


def group_mean(train: DataFrame, value: str, name: str, keys: Sequence[str] = ("origen_id", "hora", "dia_semana")) -> DataFrame:
    return train.groupBy(*keys).agg(F.avg(value).alias(name))


def with_group_mean(
    df: DataFrame, train: DataFrame, value: str, name: str,
    keys: Sequence[str] = ("origen_id", "hora", "dia_semana"),
) -> DataFrame:
    """Historical mean of the training rows per key, else their global mean."""
    overall = train.agg(F.avg(value).alias("m")).scalar()
    joined = df.join(group_mean(train, value, name, keys), list(keys), "left")
    return joined.withColumn(name, F.coalesce(F.col(name), overall))


def close_lag_gaps(df: DataFrame) -> DataFrame:
    """Drop rows without target or the three nearest lags; far lags take the mean."""
    kept = df.dropna(subset=["target", *[f"lag_{n}h" for n in C.LAGS_REQUIRED]])
    return kept.withColumns({
        f"lag_{n}h": F.coalesce(F.col(f"lag_{n}h").cast("double"), F.col("media_hist")) for n in C.LAGS_FILLED
    })


def demand_features(zone_hours: DataFrame, train_before) -> DataFrame:
    """Lags, rolling statistics, target and historical mean; ``train_before`` is the cut."""
    series = with_rolling(with_lags(with_target(zone_hours)))
    train = zone_hours.where(F.col("timestamp_hora") < train_before)
    return close_lag_gaps(with_group_mean(series, train, "demanda", "media_hist"))


# --- zone by time band ------------------------------------------------------

def band_summary(demand: DataFrame) -> DataFrame:
    """Mean, median, total and observed hours per zone and band."""
    banded = demand.withColumn("franja_horaria", X.time_band("hora", "plain"))
    return banded.groupBy("origen_id", "franja_horaria").agg(
        F.avg("demanda").alias("demanda_media"),
        F.median("demanda").alias("demanda_mediana"),
        F.sum("demanda").alias("demanda_total"),
        F.count(F.lit(1)).alias("horas_observadas"),
    )


def peak_hours(demand: DataFrame) -> DataFrame:
    """Hour with the highest mean per zone and band; the later hour wins a tie."""
    hourly = (
        demand.withColumn("franja_horaria", X.time_band("hora", "plain"))
        .groupBy("origen_id", "franja_horaria", "hora")
        .agg(F.avg("demanda").alias("m"))
    )
    best = hourly.groupBy("origen_id", "franja_horaria").agg(F.max(F.struct("m", "hora")).alias("p"))
    return best.select(
        "origen_id", "franja_horaria",
        F.col("p.hora").alias("hora_pico"), F.col("p.m").alias("demanda_hora_pico"),
    )


def level_cuts(summary: DataFrame, value: str = "demanda_media") -> DataFrame:
    """The two level cuts; one row over zones x bands."""
    lo, hi = C.LEVEL_QUANTILES
    return summary.agg(
        F.percentile(value, F.lit(lo)).alias("q_baja"), F.percentile(value, F.lit(hi)).alias("q_alta")
    )


def with_level(summary: DataFrame, value: str = "demanda_media") -> DataFrame:
    cuts = level_cuts(summary, value).select(F.struct("q_baja", "q_alta").alias("q"))
    lo, hi = cuts.scalar()["q_baja"], cuts.scalar()["q_alta"]
    # equal within the usual float tolerance: everything is "media"
    same = F.abs(lo - hi) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(hi)
    v = F.col(value)
    return summary.withColumn(
        "nivel_demanda",
        F.when(same, "media").when(v <= lo, "baja").when(v <= hi, "media").otherwise("alta"),
    )


def with_score(summary: DataFrame, value: str = "demanda_media") -> DataFrame:
    """Percentile score 0-100 from the average rank, over zones x bands rows."""
    rank = F.rank().over(Window.orderBy(value))
    ties = F.count(F.lit(1)).over(Window.partitionBy(value))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return summary.withColumn("score_demanda_0_100", F.round((rank + (ties - 1) / 2.0) / n * 100.0, 2))


def demand_levels(demand: DataFrame) -> DataFrame:
    """Zone by band summary with peak hour, level and score.

    The level cuts are taken before the peak hours join, so their subquery stays short.
    """
    levelled = with_score(with_level(band_summary(demand)))
    return levelled.join(peak_hours(demand), ["origen_id", "franja_horaria"], "left")


def name_zones(summary: DataFrame, zones: DataFrame) -> DataFrame:
    named = zones.select(
        F.col("LocationID").alias("origen_id"),
        F.col("Borough").alias("origen_barrio"),
        F.col("Zone").alias("origen_zona"),
        F.col("service_zone").alias("origen_service_zone"),
    )
    return summary.join(named, "origen_id", "left")


def query_demand(
    summary: DataFrame,
    zona: str | int | None = None,
    franja: str | None = None,
    nivel: str | None = None,
    demanda_min: float | None = None,
    demanda_max: float | None = None,
    top: int | None = None,
    require_filter: bool = True,
) -> DataFrame:
    """Rows of the zone by band table that meet all filters, highest mean demand first; with ``top`` only the first.

    ``zona`` is an id or a text found in zone, borough or service zone, ignoring
    case and accents. With ``require_filter=False`` empty texts mean no filter. Zone
    and band settle ties.
    """
    asked = {"zona": zona, "franja": franja, "nivel": nivel, "demanda_min": demanda_min, "demanda_max": demanda_max}
    asked = {k: v for k, v in asked.items() if v is not None and (require_filter or str(v).strip())}
    if require_filter and not asked:
        raise ValueError("a demand query needs at least one filter")
    mean = F.col("demanda_media")
    tests = {
        "zona": lambda v: _names_zone(summary, str(v).strip()),
        "franja": lambda v: X.plain_band("franja_horaria") == X.plain_band(F.lit(v)),
        "nivel": lambda v: X.plain_text("nivel_demanda") == X.plain_text(F.lit(v)),
        "demanda_min": lambda v: mean >= float(v),
        "demanda_max": lambda v: mean <= float(v),
    }
    kept = summary.where(reduce(and_, [tests[k](v) for k, v in asked.items()], F.lit(True)))
    ordered = kept.orderBy(mean.desc(), "origen_id", "franja_horaria")
    return ordered if top is None else ordered.limit(int(top))


def _names_zone(summary: DataFrame, text: str) -> Column:
    if text.isdigit():
        return F.col("origen_id").cast("string") == text
    named = [c for c in ("origen_zona", "origen_barrio", "origen_service_zone") if c in summary.columns]
    return reduce(or_, [X.contains_text(c, text) for c in named], F.lit(False))


def top_demand(summary: DataFrame, top: int) -> DataFrame:
    """Highest mean demand first; zone and band settle ties."""
    return summary.orderBy(F.desc("demanda_media"), "origen_id", "franja_horaria").limit(int(top))
