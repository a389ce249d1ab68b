"""Raw monthly files to the final trip table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..operators.cleaning import clean_trips
from ..operators.enrichment import enrich_trips
from ..operators.imputation import final_trips
from ..operators.splits import fraction_sample
from ..session import written_table
from ..sources.sinks import write_trips
from ..sources.trips import monthly_scans


def clean_months(
    spark: SparkSession, root: str, services: Sequence[str], months: Sequence[tuple[int, int]]
) -> DataFrame:
    """Clean trips of all services and months as one table; columns a file lacks are NULL.

    Files of one schema are cleaned together and the results put together by name
    afterwards: a fee that only some months have counts there and nowhere else, and no
    trip is dropped for a column that its own file never had.
    """
    parts = [_clean_one(raw, service) for service in services for raw in monthly_scans(spark, root, service, months)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _clean_one(raw: DataFrame, service: str) -> DataFrame:
    start = next(k for k, v in C.SERVICE_COLUMNS[service].items() if v == "fecha_inicio")
    in_month = raw.where(F.month(X.lenient_timestamp(start)) == F.col("mes_archivo"))
    label = C.SERVICE_LABELS[service]
    return clean_trips(in_month, service).withColumn("tipo_vehiculo", F.lit(label))


def build_final_table(
    clean: DataFrame, dims: Mapping[str, DataFrame], key: Sequence[str], percent: int = 100
) -> DataFrame:
    """Enriched and imputed trips, of a sample if ``percent`` asks for one.

    The enriched trips are written once: imputation reads them several times, and none
    of its passes replays scan, cleaning and joins.
    """
    sampled = fraction_sample(clean, percent, *key) if percent < 100 else clean
    rich = enrich_trips(sampled, dims["zones"], dims["weather"], dims["holidays"], dims["events"])
    return final_trips(written_table(rich, "enriched_trips"), list(key))


def run(
    spark: SparkSession, root: str, out: str, services: Sequence[str], months: Sequence[tuple[int, int]],
    dims: Mapping[str, DataFrame], key: Sequence[str], percent: int = 100,
) -> None:
    clean = clean_months(spark, root, services, months)
    write_trips(build_final_table(clean, dims, key, percent), out)
