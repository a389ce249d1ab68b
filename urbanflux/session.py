"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "urbanflux", **conf: str) -> SparkSession:
    """Session with adaptive execution, skew-join splitting and UTC wall-clock times.

    The number of shuffle partitions is left to the cluster: adaptive execution
    coalesces small ones and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting (a test on one machine) gets a folder of its own; on a cluster a local
    folder would lose what other machines write, so a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="urbanflux-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/urbanflux/{spark.sparkContext.applicationId}"


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that lost executors never replay the upstream job, and gives
    Catalyst the real size of the table, which is what its broadcast decision uses.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_written_tables(spark: SparkSession) -> None:
    """Remove the stage tables that this application wrote to the shared folder; none may be in use."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Several small stage tables, their jobs submitted side by side."""
    with ThreadPoolExecutor(max_workers=max(len(tables), 1)) as pool:
        return dict(zip(tables, pool.map(lambda item: written_table(item[1], item[0]), tables.items())))


def closed_domain(df: DataFrame) -> DataFrame:
    """Broadcast hint for a table whose keys come from a closed, tiny domain.

    Only for keys like service, month, weekday, hour, time band, zone class or a
    handful of cut points, where the row count cannot grow with the trips. Tables
    keyed by zone or by time stay unhinted: Catalyst then checks their size.
    """
    return F.broadcast(df)
