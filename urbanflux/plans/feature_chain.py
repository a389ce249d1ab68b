"""Final trips to model tables. Each stage is written once, as its consumers are many."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..operators import demand, models, splits, supply
from ..operators.cleaning import speed_band
from ..operators.context import context_table
from ..session import written_table


def demand_table(trips: DataFrame, span: DataFrame | None = None) -> DataFrame:
    """Zone by hour features with a chronological split.

    The trips are read once: lags, means and split all start from the written zone by
    hour table. ``span`` gives the time range when a narrower table than ``trips`` can.
    """
    hours = written_table(demand.zone_hour_demand(trips), "zone-hours")
    cuts = splits.cut_columns(splits.time_cuts(trips if span is None else span, "fecha_inicio", 60))
    return splits.split_by_time(demand.demand_features(hours, cuts[0]), "timestamp_hora", cuts)


def labelled_windows(trips: DataFrame, minutes: int = 10, arrivals: DataFrame | None = None) -> DataFrame:
    """Zone by window table with supply, good-zone label and split.

    ``arrivals`` are the trips that make the supply and the time range, where a
    narrower table than ``trips`` has them.
    """
    arrivals = trips if arrivals is None else arrivals
    cuts = splits.cut_columns(splits.time_cuts(arrivals, "fecha_inicio", minutes))
    windows = supply.with_supply(supply.zone_windows(trips, minutes), supply.inferred_supply(arrivals, minutes))
    return splits.split_by_time(supply.with_good_label(windows), "ventana_inicio", cuts)


def supply_table(trips: DataFrame, minutes: int = 10, arrivals: DataFrame | None = None) -> DataFrame:
    """The labelled windows, written once, with the historical rate of the training rows."""
    rows = written_table(labelled_windows(trips, minutes, arrivals), "zone-windows")
    return supply.with_historic_rate(rows, rows.where("split = 'train'"))


def speed_table(trips: DataFrame) -> DataFrame:
    """Trips in the plausible speed band with weather flags and a month split."""
    cols = [
        "fecha_inicio", "origen_id", "destino_id", "velocidad_mph", "temp_c", "precipitation", "viento_kmh",
        "lluvia", "nieve", "es_festivo", "num_eventos", "mes_num", "dia_semana", "es_fin_semana", "hora_sen",
        "hora_cos", "tipo_vehiculo", "franja_horaria",
    ]
    kept = trips.select(*cols).where(speed_band())
    weather = ["temp_c", "precipitation", "viento_kmh", "lluvia", "nieve"]
    filled = kept.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in weather})
    flagged = filled.withColumns({"hay_lluvia": X.has_rain("lluvia"), "hay_nieve": X.has_rain("nieve")})
    return splits.split_by_month(flagged)


def tip_table(trips: DataFrame, key: list[str]) -> DataFrame:
    """Trips with profitability columns and a positional split, dates removed."""
    out = trips.withColumns({
        "rentabilidad_base_min": X.income_per_minute(), "trafico_denso": X.dense_traffic(),
    })
    return splits.split_by_position(out, "fecha_inicio", key).drop("fecha_inicio", "fecha_fin")


@dataclass
class Contexts:
    taxi: DataFrame
    ride_hail: DataFrame


def contexts(supply_rows: DataFrame, tip_rows: DataFrame) -> Contexts:
    """Context tables of the training rows."""
    return Contexts(
        context_table(supply_rows.where("split = 'train'"), C.CONTEXT_P2_MEANS),
        context_table(tip_rows.where("split = 'train'"), C.CONTEXT_P5_MEANS, C.CONTEXT_P5_MODES),
    )


def with_cascade(supply_rows: DataFrame, demand_model) -> DataFrame:
    """Demand predicted from supply proxies as a feature of the good-zone model."""
    proxied = supply.demand_model_proxies(supply_rows, by_split="split")
    scored = models.predict(demand_model, proxied, C.P1_FEATURES, "demanda_p1")
    return scored.select(*supply_rows.columns, "demanda_p1")
