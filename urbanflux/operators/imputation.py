"""Final trip table: calendar fields, tip and passenger imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import contract as C
from ..functions import columns as X
from ..functions.order_statistics import exact_quantile


def with_calendar(trips: DataFrame, start: str = "fecha_inicio") -> DataFrame:
    fields = X.calendar(start)
    sin, cos = X.cyclic(fields["hora"])
    return trips.withColumns({
        "hora": fields["hora"],
        "dia_semana": fields["dia_semana"],
        "es_fin_semana": fields["es_finde"],
        "franja_horaria": X.time_band(fields["hora"]),
        "hora_sen": sin,
        "hora_cos": cos,
    })


def positive_tip_median(trips: DataFrame) -> Column:
    return exact_quantile(trips.where(F.col("propina") > 0), "propina", 0.5)


def fill_tips(
    trips: DataFrame, median: Column | None = None, price: str = "precio_total_est", false_zeros: bool = True
) -> DataFrame:
    """Unknown tips, and zero tips on trips above $10, take the median positive tip."""
    median = positive_tip_median(trips) if median is None else median
    tip = F.col("propina")
    if false_zeros and price in trips.columns:
        tip = F.when((tip == 0) & (F.col(price) > C.FALSE_ZERO_PRICE), F.lit(None)).otherwise(tip)
    return trips.withColumn("propina", F.coalesce(tip, median))


def passenger_distribution(trips: DataFrame) -> DataFrame:
    """Known passenger counts with their cumulative share [desde, hasta)."""
    counts = (
        trips.where(F.col("num_pasajeros").isNotNull())
        .groupBy("num_pasajeros").agg(F.count(F.lit(1)).alias("c"))
    )
    upto = Window.partitionBy().orderBy("num_pasajeros")
    total = F.sum("c").over(Window.partitionBy())
    return counts.select(
        "num_pasajeros",
        F.try_divide(F.sum("c").over(upto) - F.col("c"), total).alias("desde"),
        F.try_divide(F.sum("c").over(upto), total).alias("hasta"),
    )


def fill_passengers(trips: DataFrame, key: str | list[str], distribution: DataFrame | None = None) -> DataFrame:
    """Unknown counts drawn from the known distribution by a hash of the trip key.

    The distribution is one short array (a passenger count is at most 8), read as a
    scalar subquery; the draw itself is a filter over that array.
    """
    keys = [key] if isinstance(key, str) else list(key)
    distribution = passenger_distribution(trips) if distribution is None else distribution
    steps = distribution.agg(
        F.array_sort(F.collect_list(F.struct("hasta", "num_pasajeros"))).alias("a")
    ).scalar()
    draw = X.hash32(*keys) / F.lit(4294967296.0)
    hit = F.get(F.filter(F.col("_steps"), lambda s: s["hasta"] > F.col("_u")), F.lit(0))["num_pasajeros"]
    return (
        trips.withColumns({"_u": draw, "_steps": steps})
        .withColumn("num_pasajeros", F.coalesce(F.col("num_pasajeros"), hit))
        .drop("_u", "_steps")
    )


def final_trips(trips: DataFrame, key: str | list[str]) -> DataFrame:
    out = with_calendar(trips).drop("tipo_pago")
    out = fill_tips(out)
    return fill_passengers(out, key) if "num_pasajeros" in out.columns else out
