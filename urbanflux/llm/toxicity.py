"""Toxicity score by a factorization machine over hashed terms.

A machine of second order weighs single words and, through the factors, pairs of
words in the same document, such as an insult next to a group's name, which a sum of
linear weights can't tell from the two apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from urbanflux.llm import fm
from urbanflux.llm.common import id_remainder
from urbanflux.llm.labelled import TRAINING_ROWS, fitted, labelled_sample, scoring, training_rows

FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.5
#: A term must be in so many sampled documents to become a feature.
LEAST_DOCUMENTS = 3
#: Beginnings of words count as terms too: an insult keeps its stem under many endings.
STEMS = (4, 5, 6)
#: Every ASCII character but letters and digits separates terms.
_BLANKED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def term_hashes(text: str | None) -> np.ndarray:
    """Distinct 64-bit hashes of a text's lower-case words and stems; none for a null or empty text."""
    words = set((text or "").lower().encode("utf-8", "replace").translate(_BLANKED).split())
    for n in STEMS:
        words |= {b"%d %b" % (n, w[:n]) for w in words if len(w) > n and b" " not in w}
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@F.pandas_udf(ArrayType(LongType()))
def _hash_column(texts: pd.Series) -> pd.Series:
    return pd.Series([term_hashes(t).view(np.int64) for t in texts], index=texts.index)


def _fit(held: pd.DataFrame) -> fm.Machine:
    rows = [np.asarray(r, np.int64).view(np.uint64) for r in held["features"]]
    labels = held["label"].to_numpy(np.float64)
    terms = fm.frequent_terms(rows, LEAST_DOCUMENTS) if len(labels) else np.empty(0, np.uint64)
    blank = fm.Machine(terms, 0.0, np.empty(0), np.empty((0, 0)), {})
    return fm.fit([blank.numbers(r) for r in rows], labels, len(terms), terms=terms, extra={})


def _features(machine: fm.Machine, text: str | None) -> np.ndarray:
    return machine.numbers(term_hashes(text))


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> fm.Machine:
    """Machine from at most ``rows`` labelled documents outside the held-out fold. Only texts are read as features."""
    sample = labelled_sample(labels, "toxic", FOLDS, HELD_FOLD, rows)
    return fitted(training_rows(docs, sample, _hash_column("text")), _fit)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with held_out, score and predicted.

    A null or empty text has no terms and scores the machine's bias; a text of any length is
    scored whole. A null id is not
    held out. Repeated rows are scored alike. Without usable labels every text scores
    0.5. Input columns named as the three added ones are replaced. An empty table
    gives an empty result.
    """
    machine = fit_toxicity(docs, labels)
    scored = docs.withColumn("score", scoring(machine, _features)("text"))
    return scored.withColumns({
        "held_out": F.coalesce(id_remainder(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(False)),
        "predicted": (F.col("score") >= threshold).cast("int"),
    })
