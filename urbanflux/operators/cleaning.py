"""Raw trip files to clean trips: names, types, limits, service rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..functions.order_statistics import exact_quantile


def rename_raw(df: DataFrame, service: str) -> DataFrame:
    """Keep the known raw columns of a service under their contract names."""
    names = C.SERVICE_COLUMNS.get(service.lower())
    if names is None:
        raise ValueError(f"unknown service: {service}")
    here = [c for c in names if c in df.columns]
    if not here:
        raise ValueError(f"no expected column for {service} in {df.columns}")
    return df.select(*[F.col(c).alias(names[c]) for c in here])


def coerce_types(df: DataFrame) -> DataFrame:
    """Lenient dates, floats and integers; whatever cannot be read becomes NULL."""
    kinds = (
        (C.TIMESTAMP_COLUMNS, X.lenient_timestamp),
        (C.FLOAT_COLUMNS, X.lenient_double),
        (C.INT_COLUMNS, X.lenient_int),
    )
    changes = {c: cast(c) for cols, cast in kinds for c in cols if c in df.columns}
    return df.withColumns(changes) if changes else df


def narrow_types(df: DataFrame) -> DataFrame:
    """32-bit floats and integers, for storage only."""
    narrow = {"double": "float", "bigint": "int"}
    return df.select(*[
        F.col(name).cast(narrow[kind]).alias(name) if kind in narrow else F.col(name)
        for name, kind in df.dtypes
    ])


def in_month(df: DataFrame, month: Column | int | None, year: Column | int | None = None) -> DataFrame:
    """Rows whose pickup month is the month of the file; the year only on request."""
    if month is not None:
        df = df.where(F.month("fecha_inicio") == month)
    if year is not None:
        df = df.where(F.year("fecha_inicio") == year)
    return df


def ends_after_start(start: str = "fecha_inicio", end: str = "fecha_fin") -> Column:
    return F.col(end) > F.col(start)


def physical_limits(distance: str = "distancia", minutes: str = "duracion_min") -> Column:
    d, m = F.col(distance), F.col(minutes)
    return (
        (d > C.DISTANCE_LIMITS[0]) & (d < C.DISTANCE_LIMITS[1])
        & (m > C.DURATION_LIMITS[0]) & (m < C.DURATION_LIMITS[1])
    )


def known_zones(*cols: str) -> Column:
    keep = F.lit(True)
    for c in cols or ("origen_id", "destino_id"):
        keep = keep & (F.col(c).isNull() | ~F.col(c).isin(*C.UNKNOWN_ZONES))
    return keep


def limits_on_raw(df: DataFrame) -> DataFrame:
    """Distance and zone limits on columns that already have a number type.

    They repeat what is checked after coercion, in a form the Parquet scan can use.
    """
    numbers = {c for c, kind in df.dtypes if kind in ("double", "float", "int", "bigint", "smallint")}
    if "distancia" in numbers:
        df = df.where((F.col("distancia") > C.DISTANCE_LIMITS[0]) & (F.col("distancia") < C.DISTANCE_LIMITS[1]))
    for c in ("origen_id", "destino_id"):
        if c in numbers:
            df = df.where(~F.col(c).isin(*C.UNKNOWN_ZONES))
    return df


def speed_band(speed: str = "velocidad_mph") -> Column:
    return F.col(speed).between(*C.SPEED_BAND)


def common_rules(df: DataFrame, service: str, strict_nulls: bool = True) -> DataFrame:
    """Rules of every service. ``strict_nulls`` also drops a NULL in any mapped column."""
    df = coerce_types(limits_on_raw(df))
    df = df.where(ends_after_start())
    df = df.withColumn("duracion_min", X.minutes_between("fecha_inicio", "fecha_fin"))
    df = df.where(physical_limits() & known_zones())
    df = df.withColumn("velocidad_mph", X.speed_mph("distancia", "duracion_min"))
    critical = [c for c in C.CORE_COLUMNS if c in df.columns] + ["duracion_min"]
    df = df.dropna(subset=critical).withColumn("tipo_vehiculo", F.lit(service.lower()))
    return df.dropna() if strict_nulls else df


def yellow_rules(df: DataFrame) -> DataFrame:
    """Passenger and fare ranges; a tip not paid by card is unknown."""
    if not {"tarifa_base", "precio_total"} <= set(df.columns):
        return df.where(F.lit(False))
    if "num_pasajeros" in df.columns:
        df = df.where(F.col("num_pasajeros").between(0, C.PASSENGER_MAX))
    base, total = F.col("tarifa_base"), F.col("precio_total")
    df = df.where((base >= 0) & (base < C.FARE_MAX) & (total > 0) & (total < C.FARE_MAX))
    if {"tipo_pago", "propina"} <= set(df.columns):
        df = df.withColumn("propina", F.when(F.col("tipo_pago") == 1, F.col("propina")))
    df = df.withColumns({"precio_base": base, "precio_total_est": total})
    return df.drop(*C.YELLOW_DROPPED)


def fhvhv_rules(df: DataFrame) -> DataFrame:
    """Fare, trip-time and wait ranges; the total is rebuilt from its parts."""
    if "tarifa_base" not in df.columns:
        return df.where(F.lit(False))
    base = F.col("tarifa_base")
    df = df.where((base > 0) & (base < C.FARE_MAX))
    if "duracion_seg" in df.columns:
        lo, hi = C.TRIP_SECONDS_LIMITS
        df = df.where((F.col("duracion_seg") > lo) & (F.col("duracion_seg") < hi))
    if "fecha_solicitud" in df.columns:
        df = df.withColumn("espera_min", X.minutes_between("fecha_solicitud", "fecha_inicio"))
        df = df.where(F.col("espera_min").between(0, C.WAIT_MAX))
    if {"tipo_pago", "propina"} <= set(df.columns):
        df = df.withColumn("propina", F.when(F.col("propina") != 0, F.col("propina")))
    parts = [c for c in C.PRICE_COMPONENTS if c in df.columns]
    for part in parts:
        df = df.where(F.coalesce(F.col(part), F.lit(0.0)) >= 0)
    df = df.withColumns({
        "precio_base": base,
        "precio_total_est": X.rebuilt_total(base, [F.col(p) for p in parts]),
    })
    total = F.col("precio_total_est")
    df = df.where((total > 0) & (total < C.FARE_MAX))
    return df.select(*[c for c in C.FHVHV_KEPT if c in df.columns])


def service_defaults(df: DataFrame, service: str) -> DataFrame:
    """Street hails have no wait; their unknown passenger count is one."""
    wait = F.col("espera_min") if "espera_min" in df.columns else F.lit(None).cast("double")
    if service.lower() == "yellow":
        wait = F.coalesce(wait, F.lit(0.0))
        if "num_pasajeros" in df.columns:
            df = df.withColumn("num_pasajeros", F.coalesce("num_pasajeros", F.lit(1)))
    return df.withColumn("espera_min", wait)


def clean_trips(
    raw: DataFrame,
    service: str,
    month: Column | int | None = None,
    year: Column | int | None = None,
    strict_nulls: bool = True,
) -> DataFrame:
    """All cleaning rules of one service, as one narrow pass over the file."""
    df = rename_raw(raw, service)
    df = df.withColumn("fecha_inicio", X.lenient_timestamp("fecha_inicio"))
    df = common_rules(in_month(df, month, year), service, strict_nulls)
    df = yellow_rules(df) if service.lower() == "yellow" else fhvhv_rules(df)
    return service_defaults(df, service)


def trim_above(df: DataFrame, column: str, prob: float = 0.99) -> DataFrame:
    """Drop rows above an exact quantile of a positive column."""
    positive = df.where(F.col(column) > 0)
    return positive.where(F.col(column) <= exact_quantile(positive, column, prob))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("c")).agg(
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicadas")
    )
