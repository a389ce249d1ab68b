"""Demand tables in any of the accepted shapes, reduced to (zone, hour, demand)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X


def _direct(df: DataFrame) -> DataFrame:
    return df.select("origen_id", "hora", "demanda")


def _timed(df: DataFrame) -> DataFrame:
    return df.select("origen_id", F.hour(X.lenient_timestamp("timestamp_hora")).alias("hora"), "demanda")


def _trips(df: DataFrame) -> DataFrame:
    from ..operators.demand import zone_hour_counts

    return zone_hour_counts(df).select("origen_id", F.hour("timestamp_hora").alias("hora"), "demanda")


def _context(df: DataFrame) -> DataFrame:
    return df.select("origen_id", "hora", F.col("n_viajes").alias("demanda"))


# first match wins
_SHAPES = (
    ({"origen_id", "hora", "demanda"}, _direct),
    ({"origen_id", "timestamp_hora", "demanda"}, _timed),
    ({"origen_id", "fecha_inicio"}, _trips),
    ({"origen_id", "hora", "n_viajes"}, _context),
)


def demand_rows(inputs: Sequence[DataFrame]) -> DataFrame:
    """Concatenate inputs of any accepted shape; unreadable demand counts as zero."""
    parts = []
    for df in inputs:
        match = next((f for need, f in _SHAPES if need <= set(df.columns)), None)
        if match is None:
            shapes = " or ".join(str(tuple(sorted(need))) for need, _ in _SHAPES)
            raise ValueError(f"demand input needs columns {shapes}; got {df.columns}")
        parts.append(
            match(df).select(
                F.col("origen_id").cast("int").alias("origen_id"),
                F.col("hora").cast("int").alias("hora"),
                F.coalesce(X.lenient_double("demanda"), F.lit(0.0)).alias("demanda"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
