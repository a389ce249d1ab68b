"""Output tables: layout for trips, report files, and reuse by recorded inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_trips(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Trips by service, year and month, in time order inside each file.

    Rows are rebalanced by service and month: Spark splits what is large and joins what
    is small by the sizes it has measured, so a busy month spreads over many tasks, and
    no sampling pass runs the input a second time.
    """
    (
        df.withColumn("anio", F.year("fecha_inicio"))
        .withColumn("mes", F.month("fecha_inicio"))
        .hint("rebalance", "tipo_vehiculo", "anio", "mes")
        .sortWithinPartitions("tipo_vehiculo", "anio", "mes", "fecha_inicio")
        .write.mode(mode)
        .partitionBy("tipo_vehiculo", "anio", "mes")
        .option("compression", "snappy")
        .parquet(path)
    )


def write_report(df: DataFrame, path: str, formats: Sequence[str] = ("parquet", "csv"), mode: str = "overwrite") -> None:
    for fmt in formats:
        writer = df.write.mode(mode)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{path}/{fmt}")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def write_if_absent(df: DataFrame, path: str) -> bool:
    """Write unless a finished table is already there; tells whether it wrote."""
    if exists(df.sparkSession, f"{path}/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def reused_table(
    spark: SparkSession, path: str, inputs: Sequence[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """The table at ``path`` if it was built from the same inputs, else build and keep it."""
    manifest = f"{path}/manifest"
    table = f"{path}/table"
    wanted = sorted(inputs)
    if exists(spark, f"{manifest}/_SUCCESS") and exists(spark, f"{table}/_SUCCESS"):
        recorded = spark.read.schema("input_paths array<string>").json(manifest).first()
        if recorded is not None and list(recorded["input_paths"]) == wanted:
            return spark.read.parquet(table)
    build().write.mode("overwrite").parquet(table)
    spark.createDataFrame([(wanted,)], "input_paths array<string>").write.mode("overwrite").json(manifest)
    return spark.read.parquet(table)
