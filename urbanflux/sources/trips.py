"""Trip files: monthly scans, tolerant column reads, file profiles."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_MONTH_IN_PATH = r"(\d{4})-(\d{2})\.parquet"


def monthly_scans(
    spark: SparkSession, root: str, service: str, months: Iterable[tuple[int, int]]
) -> list[DataFrame]:
    """One scan per distinct file schema of the wanted (year, month) pairs of a service.

    Files are ``root/service/year/*YYYY-MM.parquet``; folders may also be written as
    ``name=value``. The year folder and the month suffix select files by path, so other
    months are never listed into a scan. Months may differ in their columns and types;
    each scan reads the columns that its files have. Adds ``anio_archivo``,
    ``mes_archivo`` and ``servicio``. No file at all raises with the months that do exist.
    """
    wanted = sorted(set(months))
    years = sorted({y for y, _ in wanted})
    names = "{" + ",".join(f"*{y:04d}-{m:02d}.parquet" for y, m in wanted) + "}"
    folders = "{" + ",".join(f"{p}{y:04d}" for y in years for p in ("", "*=")) + "}"
    files = _listed(spark, f"{root}/{_service_folders(service)}/{folders}/{names}")
    if not files:
        have = ", ".join(f"{y}-{m:02d}" for y, m in available_months(spark, root, service)) or "none"
        raise FileNotFoundError(f"no {service} file for {wanted}; available months: {have}")
    by_schema: dict[str, tuple] = {}
    for file in files:
        schema = spark.read.parquet(file).schema
        by_schema.setdefault(schema.json(), (schema, []))[1].append(file)
    path = F.col("_metadata.file_path")
    return [
        spark.read.schema(schema).parquet(*same).select(
            "*",
            F.regexp_extract(path, _MONTH_IN_PATH, 1).cast("int").alias("anio_archivo"),
            F.regexp_extract(path, _MONTH_IN_PATH, 2).cast("int").alias("mes_archivo"),
            F.lit(service).alias("servicio"),
        )
        for schema, same in by_schema.values()
    ]


def monthly_trips(
    spark: SparkSession, root: str, service: str, months: Iterable[tuple[int, int]]
) -> DataFrame:
    """The scans of ``monthly_scans`` as one table; a column that a month lacks is NULL there.

    For raw tables of like types. Cleaning takes the scans one by one, because its
    rules depend on the columns that a file has.
    """
    scans = monthly_scans(spark, root, service, months)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _service_folders(service: str) -> str:
    return "{" + f"{service},*={service}" + "}"


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob) or []
    return sorted(f.getPath().toString() for f in found)


def available_months(spark: SparkSession, root: str, service: str) -> list[tuple[int, int]]:
    """(year, month) pairs of a service, from the file listing alone."""
    files = _listed(spark, f"{root}/{_service_folders(service)}/*/*.parquet")
    hits = (re.search(_MONTH_IN_PATH, f) for f in files)
    return sorted((int(h.group(1)), int(h.group(2))) for h in hits if h)


def rolling_year_months(year: int) -> list[tuple[int, int]]:
    """December of the year before plus January to November of ``year``."""
    return [(year - 1, 12), *((year, m) for m in range(1, 12))]


def present_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project the wanted columns that exist; error when none does."""
    here = [c for c in wanted if c in df.columns]
    if not here:
        raise ValueError(f"none of these columns is present: {list(wanted)}")
    return df.select(*here)


def file_profile(df: DataFrame, time_column: str) -> DataFrame:
    """Rows, columns, and first and last time, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("filas"),
        F.lit(len(df.columns)).alias("columnas"),
        F.min(time_column).alias("primera"),
        F.max(time_column).alias("ultima"),
    )


def edge_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First and last ``n`` rows in a stated order."""
    head = df.orderBy(*order).limit(n).withColumn("extremo", F.lit("inicio"))
    tail = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("extremo", F.lit("fin"))
    return head.unionByName(tail)


def out_of_order(df: DataFrame, sequence: str, time_column: str, step: int = 1_000_000) -> DataFrame:
    """Count the rows whose time is earlier than that of the row before.

    ``sequence`` numbers the rows. They are cut into runs of ``step`` numbers that
    are checked side by side; the last time of each run is then compared with the
    first of the next one.
    """
    run = F.floor(F.col(sequence) / step)
    rows = df.select(run.alias("_run"), sequence, time_column)
    inside = Window.partitionBy("_run").orderBy(sequence)
    checked = rows.withColumn("_back", F.col(time_column) < F.lag(time_column).over(inside))
    runs = checked.groupBy("_run").agg(
        F.count_if(F.col("_back")).alias("bad"),
        F.min_by(time_column, sequence).alias("first"),
        F.max_by(time_column, sequence).alias("last"),
    )
    seam = F.col("first") < F.lag("last").over(Window.orderBy("_run"))
    return runs.select("bad", F.coalesce(seam.cast("int"), F.lit(0)).alias("seam")).agg(
        F.sum(F.col("bad") + F.col("seam")).alias("desordenadas")
    ).withColumn("ordenado", F.col("desordenadas") == 0)
