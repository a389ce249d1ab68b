"""Days whose volume or price leaves mean +- 2 deviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _limits(value: str, z: float) -> tuple[Column, Column]:
    """Lower and upper limit over all days; one row per day passes the window."""
    days = Window.partitionBy()
    mean, deviation = F.avg(value).over(days), F.stddev(value).over(days)
    return mean - z * deviation, mean + z * deviation


def daily_volume(trips: DataFrame) -> DataFrame:
    per_day = trips.groupBy(F.to_date("fecha_inicio").alias("fecha")).agg(
        F.count(F.lit(1)).alias("total_viajes"),
        *[F.max(c).alias(c) for c in ("lluvia", "nieve", "es_festivo", "num_eventos")],
    )
    return per_day.withColumn("hay_evento", (F.col("num_eventos") > 0).cast("int"))


def volume_anomalies(trips: DataFrame, z: float = 2.0, only: bool = False) -> DataFrame:
    """State of every day and the likely causes of the unusual ones."""
    daily = daily_volume(trips)
    low, high = _limits("total_viajes", z)
    state = (
        F.when(F.col("total_viajes") > high, "Anomalía Alta")
        .when(F.col("total_viajes") < low, "Anomalía Baja")
        .otherwise("Normal")
    )
    flags = (("hay_evento", "evento"), ("lluvia", "lluvia"), ("nieve", "nieve"), ("es_festivo", "festivo"))
    causes = F.concat_ws(", ", *[F.when(F.col(c) == 1, word) for c, word in flags])
    causes = F.when(causes == "", "sin causa obvia").otherwise(causes)
    out = daily.withColumn("estado", state)
    out = out.withColumn(
        "estado_detalle",
        F.when(F.col("estado") == "Normal", "Normal").otherwise(
            F.concat("estado", F.lit(" ("), causes, F.lit(")"))
        ),
    )
    return out.where(F.col("estado") != "Normal") if only else out


def price_anomalies(daily: DataFrame, z: float = 2.0) -> DataFrame:
    """Flag days whose mean price is above the upper limit."""
    _, high = _limits("precio_promedio", z)
    return daily.withColumn("anomalia_precio", F.col("precio_promedio") > high)
