"""Row sequences of zone by hour tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def feature_sequences(
    df: DataFrame, features: Sequence[str], lookback: int = 24, target: str = "target",
    zone: str = "origen_id", ts: str = "timestamp_hora",
) -> DataFrame:
    """For each row the ``lookback`` feature rows before it; short histories drop out."""
    past = Window.partitionBy(zone).orderBy(ts).rowsBetween(-lookback, -1)
    row = F.struct(*[F.col(c).cast("double").alias(c) for c in features])
    return (
        df.withColumn("secuencia", F.collect_list(row).over(past))
        .where(F.size("secuencia") == lookback)
        .select(zone, ts, "secuencia", F.col(target).cast("double").alias("y"))
    )


def first_run(df: DataFrame, size: int = 24, zone: str = "origen_id", ts: str = "timestamp_hora") -> DataFrame:
    """First ``size`` rows of the first run of consecutive hours that long, per zone.

    A zone without such a run gives its first ``size`` rows.
    """
    order = Window.partitionBy(zone).orderBy(ts)
    follows = F.col(ts) == F.lag(ts).over(order) + F.expr("interval 1 hour")
    runs = df.withColumn("_new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumns({"_run": F.sum("_new").over(order), "_pos": F.row_number().over(order)})
    in_run = Window.partitionBy(zone, "_run")
    runs = runs.withColumns({
        "_len": F.count(F.lit(1)).over(in_run), "_at": F.row_number().over(in_run.orderBy(ts)),
    })
    chosen = F.min(F.when(F.col("_len") >= size, F.col("_run"))).over(Window.partitionBy(zone))
    runs = runs.withColumn("_chosen", chosen)
    keep = F.when(
        F.col("_chosen").isNotNull(), (F.col("_run") == F.col("_chosen")) & (F.col("_at") <= size)
    ).otherwise(F.col("_pos") <= size)
    return runs.where(keep).drop("_new", "_run", "_pos", "_len", "_at", "_chosen")


def _hour_number(ts: str) -> Column:
    return F.unix_date(F.to_date(ts)) * 24 + F.hour(ts)


def around_cases(
    df: DataFrame, cases: DataFrame, before: int = 12, after: int = 11,
    zone: str = "origen_id", ts: str = "timestamp_hora",
) -> DataFrame:
    """Rows of the same zone from ``before`` hours before to ``after`` hours after each case.

    A case is spread over its hours, so rows meet cases by zone and hour, not by zone alone.
    """
    here = _hour_number(ts)
    picked = cases.select(F.col(zone), F.col(ts).alias("caso"), F.explode(F.sequence(here - before, here + after)).alias("_hora"))
    near = F.col(ts).between(
        F.col("caso") - F.expr(f"interval {int(before)} hours"), F.col("caso") + F.expr(f"interval {int(after)} hours")
    )
    return df.withColumn("_hora", here).join(picked, [zone, "_hora"]).where(near).drop("_hora")
