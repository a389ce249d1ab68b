"""Fit a factorization machine on a bounded sample of labelled documents; score all documents."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.common import StageTables, id_remainder, written_table
from urbanflux.llm.fm import Machine

#: Most labelled rows that a machine is fitted on.
TRAINING_ROWS = 16_384


def labelled_sample(labels: DataFrame, label: str, folds: int, held_fold: int, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, label) of at most ``rows`` documents outside the held-out fold, the first by hash of the id.

    A label other than 0 or 1 and a null id are ignored; of several labels of an id the larger counts.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), folds) != held_fold))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return written_table(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "labelled")


def training_rows(docs: DataFrame, sample: DataFrame, features: Column) -> DataFrame:
    """(doc_id, label, features) of the sample's documents; of several texts of an id the one with the least hash counts.

    The sample has at most TRAINING_ROWS rows of two numbers, so it is sent to every task.
    """
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    joined = joined.select("doc_id", "label", F.xxhash64("text").alias("order"), features.alias("features"))
    least = F.min_by(F.struct("label", "features"), "order").alias("row")
    return joined.groupBy("doc_id").agg(least).select("doc_id", "row.label", "row.features")


def fitted(rows: DataFrame, fit_rows: Callable[[pd.DataFrame], Machine]) -> Machine:
    """Fit in one task on the bounded sample; only the machine comes to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        held = pd.concat(parts) if parts else pd.DataFrame({"doc_id": [], "label": [], "features": []})
        held = held.sort_values("doc_id", kind="stable").reset_index(drop=True)
        yield pd.DataFrame({"machine": [pickle.dumps(fit_rows(held))]})

    # Written first: the fit then never replays the extraction of features.
    with StageTables() as tables:
        one = tables.write(rows, "training").repartition(1).mapInPandas(run, "machine binary")
        return pickle.loads(bytes(one.first()[0]))


def scoring(machine: Machine, row_features: Callable[[Machine, str | None], object]) -> Callable[[Column], Column]:
    """Column function: probability of label 1 for a text."""
    shared = pickle.dumps(machine)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = pickle.loads(shared)
        for batch in texts:
            yield pd.Series(m.scores([row_features(m, t) for t in batch]), index=batch.index)

    return score.asNondeterministic()  # else a filter on the score runs it a second time
