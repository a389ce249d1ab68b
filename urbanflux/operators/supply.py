"""Zone by ten minutes: success, inferred supply, good-zone label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import contract as C
from ..functions import columns as X
from ..session import closed_domain
from .demand import with_group_mean


def zone_windows(trips: DataFrame, minutes: int = 10) -> DataFrame:
    """Trips, success rate, mean wait and conditions per zone and window."""
    grouped = (
        trips.withColumn("_exito", X.success("espera_min"))
        .groupBy("origen_id", X.floor_minutes("fecha_inicio", minutes).alias("ventana_inicio"))
        .agg(
            F.count("espera_min").alias("n_viajes"),
            F.avg("_exito").alias("tasa_exito"),
            F.avg("espera_min").alias("espera_media"),
            *[F.avg(c).alias(c) for c in ("temp_c", "precipitation", "viento_kmh")],
            *[F.max(c).alias(c) for c in ("lluvia", "nieve", "es_festivo")],
            F.avg("num_eventos").alias("num_eventos"),
        )
    )
    fields = X.calendar("ventana_inicio")
    sin, cos = X.cyclic(fields["hora"])
    return grouped.withColumns({
        "hora": fields["hora"], "dia_semana": fields["dia_semana"], "es_finde": fields["es_finde"],
        "hora_sen": sin, "hora_cos": cos, "mes_num": fields["mes_num"],
    })


def inferred_supply(trips: DataFrame, minutes: int = 10) -> DataFrame:
    """Trips that ended in a zone per window."""
    return trips.groupBy(
        F.col("destino_id").alias("origen_id"),
        X.floor_minutes("fecha_fin", minutes).alias("ventana_inicio"),
    ).agg(F.count(F.lit(1)).alias("oferta_inferida"))


def with_supply(windows: DataFrame, supply: DataFrame) -> DataFrame:
    """Supply of the same zone and window, 0 where none ended.

    Both sides are already aggregated, so one row per key meets one row per key.
    """
    joined = windows.join(supply, ["origen_id", "ventana_inicio"], "left")
    return joined.withColumn("oferta_inferida", F.coalesce("oferta_inferida", F.lit(0)).cast("double"))


def with_good_label(windows: DataFrame, prob: float = C.GOOD_ZONE_QUANTILE) -> DataFrame:
    """1 when the zone's rate reaches the quantile of all zones in its window.

    A window holds at most one row per zone.
    """
    cut = F.percentile("tasa_exito", F.lit(prob)).over(Window.partitionBy("ventana_inicio"))
    return windows.withColumn("target", (F.col("tasa_exito") >= cut).cast("int"))


def with_historic_rate(windows: DataFrame, train: DataFrame) -> DataFrame:
    return with_group_mean(windows, train, "target", "tasa_historica")


def demand_model_proxies(windows: DataFrame, by_split: str | None = None, mean_supply=None) -> DataFrame:
    """Inputs of the demand model where lags are unknown: supply stands in for them.

    The mean supply is that of the whole table, or of each split when named.
    """
    if mean_supply is not None:
        rows, mean = windows, mean_supply
    elif by_split is None:
        rows, mean = windows, windows.agg(F.avg("oferta_inferida").alias("m")).scalar()
    else:
        means = windows.groupBy(by_split).agg(F.avg("oferta_inferida").alias("_media_oferta"))
        rows, mean = windows.join(closed_domain(means), by_split), F.col("_media_oferta")
    supply, rate = F.col("oferta_inferida"), F.col("tasa_historica")
    spread = supply * C.STD_PROXY
    return rows.withColumns({
        "dia_mes": F.dayofmonth("ventana_inicio") if "ventana_inicio" in windows.columns else F.col("dia_mes"),
        "demanda": supply,
        **{f"lag_{n}h": supply for n in (1, 2, 3, 6, 12)},
        "lag_24h": rate * mean,
        "roll_mean_3h": supply, "roll_std_3h": spread,
        "roll_mean_24h": supply, "roll_std_24h": spread,
        "media_hist": rate * mean,
        "velocidad_mph": F.col("viento_kmh") * C.KMH_TO_MPH,
    }).drop("_media_oferta")
