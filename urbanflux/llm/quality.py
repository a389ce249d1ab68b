"""Quality score by a factorization machine over words, structure statistics and metadata.

Each statistic is cut into quantile bins of the training sample and enters as one
feature, so that the factors weigh pairs such as "few distinct words" with "long
text". Scores use the sum-of-squares form and are linear in a text's features.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from urbanflux.llm import fm
from urbanflux.llm.common import id_remainder
from urbanflux.llm.labelled import TRAINING_ROWS, fitted, labelled_sample, scoring, training_rows

FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.7
LEAST_DOCUMENTS = 5
BINS = 16
STATISTICS = (
    "characters", "words", "lines", "word_length", "upper", "digits", "stops", "bangs", "symbols", "other_marks",
    "not_ascii", "distinct_words", "commonest_word", "repeated_lines", "line_words", "ending_lines",
)
_BYTE = np.arange(256)
_CLASSES = np.stack([
    (_BYTE >= 65) & (_BYTE <= 90), (_BYTE >= 48) & (_BYTE <= 57), np.isin(_BYTE, list(b".,;:")), np.isin(_BYTE, list(b"!?")),
    np.isin(_BYTE, list(b"#*$%&|<>")), np.isin(_BYTE, list(b"'\"()[]{}+-=/\\^_`~@")), _BYTE >= 128,
], 1).astype(np.float64)
_BLANKED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def described(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word hashes, and the statistics in the order of STATISTICS, of a text (null: empty)."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    size = max(len(data), 1)
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / size
    words = data.lower().split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    n, n_lines = max(len(words), 1), max(len(lines), 1)
    statistics = np.array([
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), len(text) / n, *shares, len(counts) / n,
        max(counts.values(), default=0) / n, 1 - len(set(lines)) / n_lines, np.log1p(n / n_lines),
        sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / n_lines,
    ])
    terms = set(data.lower().translate(_BLANKED).split())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms)), statistics


@F.pandas_udf(StructType().add("terms", ArrayType(LongType())).add("statistics", ArrayType(DoubleType())))
def _described_column(texts: pd.Series) -> pd.DataFrame:
    found = [described(t) for t in texts]
    return pd.DataFrame({"terms": [a.view(np.int64) for a, _ in found], "statistics": [list(b) for _, b in found]}, index=texts.index)


def _binned(cuts: np.ndarray, statistics: np.ndarray) -> np.ndarray:
    """Number of each statistic's bin: how many of its cuts lie below it."""
    return (cuts < statistics[:, None]).sum(1) + np.arange(len(cuts)) * (cuts.shape[1] + 1)


def _fit(held: pd.DataFrame) -> fm.Machine:
    rows = [np.asarray(r["terms"], np.int64).view(np.uint64) for r in held["features"]]
    labels = held["label"].to_numpy(np.float64)
    statistics = np.array([r["statistics"] for r in held["features"]], np.float64).reshape(-1, len(STATISTICS))
    share = np.arange(1, BINS) / BINS
    cuts = np.quantile(statistics, share, axis=0).T if len(labels) else np.zeros((len(STATISTICS), BINS - 1))
    terms = fm.frequent_terms(rows, LEAST_DOCUMENTS) if len(labels) else np.empty(0, np.uint64)
    blank = fm.Machine(terms, 0.0, np.empty(0), np.empty((0, 0)), {})
    numbered = [np.concatenate([blank.numbers(r), len(terms) + _binned(cuts, s)]) for r, s in zip(rows, statistics)]
    return fm.fit(numbered, labels, len(terms) + cuts.size + len(cuts), terms=terms, extra={"cuts": cuts})


def _features(machine: fm.Machine, text: str | None) -> np.ndarray:
    hashes, statistics = described(text)
    return np.concatenate([machine.numbers(hashes), len(machine.terms) + _binned(machine.extra["cuts"], statistics)])


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> fm.Machine:
    """Machine from at most ``rows`` labelled documents outside the held-out fold."""
    sample = labelled_sample(labels, "quality", FOLDS, HELD_FOLD, rows)
    return fitted(training_rows(docs, sample, _described_column("text")), _fit)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with held_out, score and predicted (score >= threshold).

    The metadata are the text's own length and line counts; a null text counts as
    empty and is scored by its (zero) statistics; a text of any length is scored
    whole. A null id is not held out. Repeated
    rows are scored alike. Without usable labels every text scores 0.5. Input columns
    named as the three added ones are replaced. An empty table gives an empty result.
    """
    machine = fit_quality(docs, labels)
    scored = docs.withColumn("score", scoring(machine, _features)("text"))
    return scored.withColumns({
        "held_out": F.coalesce(id_remainder(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(False)),
        "predicted": (F.col("score") >= threshold).cast("int"),
    })
