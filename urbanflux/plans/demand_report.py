"""Which zones are in high demand in each time band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.demand import demand_levels, name_zones
from ..sources.demand_inputs import demand_rows


def demand_report(inputs: list[DataFrame], zones: DataFrame | None = None) -> DataFrame:
    """Zone by band table with levels, scores and names from any accepted input."""
    levels = demand_levels(demand_rows(inputs))
    return name_zones(levels, zones) if zones is not None else levels


def report_metadata(report: DataFrame) -> DataFrame:
    """Cut values and row count of a report, one row."""
    from ..operators.demand import level_cuts

    return level_cuts(report).withColumn("filas_resultado", report.agg(F.count(F.lit(1)).alias("n")).scalar())
