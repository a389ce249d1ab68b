"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanflux.session import scratch_path, written_table

#: Words of every operator: runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class StageTables:
    """Stage tables of one job, removed once what is made of them is written.

    Within ``with``, ``write`` works as ``written_table``; at the end the tables go, so
    nothing that still reads them may leave the block unwritten. A result that was written before
    doesn't read them any more, whatever executors are lost. An error leaves them in place.
    """

    def __init__(self):
        self._spark, self._paths = None, []

    def __enter__(self) -> StageTables:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.remove()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._spark = df.sparkSession
        path = scratch_path(self._spark, name)
        df.write.parquet(path)
        self._paths.append(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        while self._paths:
            path = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._paths.pop())
            path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str) -> DataFrame:
    """Number the rows of each group from 1 in the given order, whatever a group's size.

    Rows are dealt by range over (group, order), so that a group with a third of all
    rows spreads over as many ranges as its share. A range's rows are numbered on
    their own; what lies before them in the group is a running sum over one count per
    range and group. The dealt rows are written once: a replayed task then reads the
    same ranges. ``order`` should tell rows apart; rows equal in it follow in any order.
    """
    spread = df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id())
    spread = written_table(spread, "ranked")
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = spread.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    ahead = ahead.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ahead = ahead.select(F.col("_range").alias("_r"), "_ahead", *[F.col(c).alias(f"_g_{c}") for c in group])
    within = Window.partitionBy("_range", *group).orderBy(*order)
    numbered = spread.withColumn("_in_range", F.row_number().over(within))
    match = F.col("_range") == F.col("_r")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    numbered = numbered.join(ahead, match).withColumn(rank, F.col("_ahead") + F.col("_in_range"))
    return numbered.drop("_range", "_r", "_ahead", "_in_range", *[f"_g_{c}" for c in group])


__all__ = ["WORD", "StageTables", "id_remainder", "ranked", "scratch_path", "table", "written_table"]
