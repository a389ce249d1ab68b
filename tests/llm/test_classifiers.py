"""Toxicity and quality: held-out accuracy, odd rows, and the factorization machine itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.llm import fm
from urbanflux.llm.quality import described, score_quality
from urbanflux.llm.toxicity import score_toxicity, term_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def corpus(spark):
    """An insult is toxic only beside a group's name; poor texts shout or repeat."""
    rng = np.random.default_rng(2)
    words = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        body = list(rng.choice(words, 60))
        insult, group, poor = i % 3 > 0, i % 3 < 2 and i % 2 == 0, i % 7 == 0
        body += ["fool"] * insult + ["martians"] * group
        rng.shuffle(body)
        text = " ".join(body)
        if poor:
            text = text.upper().replace(" ", "!! ")
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not poor), int(insult and group)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def accuracy(scored, labels, label):
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    return len(rows), np.mean([r.predicted == r[label] for r in rows])


def test_interactions_are_learned(spark):
    docs, labels = corpus(spark)
    n, right = accuracy(score_toxicity(docs, labels), labels, "toxic")
    assert n > 100 and right > 0.97


def test_quality_is_learned(spark):
    docs, labels = corpus(spark)
    n, right = accuracy(score_quality(docs, labels), labels, "quality")
    assert n > 100 and right > 0.97


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = fm.Machine(np.empty(0, np.uint64), 0.3, rng.normal(size=20), rng.normal(size=(20, 4)), {})
    rows = [np.array([1, 5, 7]), np.array([], int), np.array([0, 19, 3, 2, 11])]
    want = []
    for r in rows:
        pairs = sum(m.factors[a] @ m.factors[b] for i, a in enumerate(r) for b in r[i + 1 :])
        want.append(1 / (1 + np.exp(-(0.3 + m.weights[r].sum() + pairs))))
    np.testing.assert_allclose(m.scores(rows), want)


def test_terms_that_tell_nothing_alone(spark):
    """Each of two terms has exactly the base rate of label 1 on its own; only the pair tells."""
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(1500):
        first, second = i % 2, i // 2 % 2
        body = [f"word{j}" for j in rng.integers(0, 400, 40)] + ["fool"] * first + ["martians"] * second
        docs.append((i, " ".join(body), "en", "s", 0))
        labels.append((i, 1, int(first == second)))
    toxic = np.array([t for _, _, t in labels])
    assert {toxic[k::2].mean() for k in (0, 1)} == {toxic.mean()} == {0.5}
    labels = spark.createDataFrame(labels, LABELS)
    n, right = accuracy(score_toxicity(spark.createDataFrame(docs, DOCS), labels), labels, "toxic")
    assert n > 200 and right > 0.95


def test_zero_terms_are_left_out_and_change_no_score():
    rng = np.random.default_rng(5)
    rows = [np.unique(np.concatenate([rng.integers(2, 400, 20), [i % 2]])) for i in range(600)]
    labels = np.arange(600) % 2.0
    terms = np.arange(400, dtype=np.uint64)
    m = fm.fit(rows, labels, 400, terms=terms, extra={})
    assert {0, 1} <= set(m.terms.tolist()) and len(m.terms) == len(m.weights) == len(m.factors) < 400
    assert ((m.weights != 0) | m.factors.any(1)).all()
    assert ((m.scores([m.numbers(r.astype(np.uint64)) for r in rows]) > 0.5) == labels).all()


@pytest.mark.parametrize("n", [500, 20_000])
def test_one_rule_ends_fits_of_any_size(monkeypatch, n):
    rng = np.random.default_rng(8)
    rows = [np.unique(rng.integers(0, 50, 6)) for _ in range(n)]
    labels = np.array([float(0 in r and 1 in r or 2 in r) for r in rows])
    judged, log_loss = [], fm._log_loss
    monkeypatch.setattr(fm, "_log_loss", lambda *a: judged.append(log_loss(*a)) or judged[-1])
    fit = lambda: fm.fit(rows, labels, 50, terms=np.arange(50, dtype=np.uint64), extra={})
    m = fit()
    least = judged[0]
    since = 0
    for loss in judged:
        least, since = (loss, 0) if loss < least - fm.LEAST_FALL else (least, since + 1)
    assert since in (fm.PATIENCE, fm.PATIENCE + 1) and least < 0.05
    again = fit()
    assert m.bias == again.bias and (m.weights == again.weights).all() and (m.factors == again.factors).all()


def test_dropped_features_leave_the_same_rows():
    rows = [np.array([0, 3, 4]), np.array([], np.int64), np.array([1, 2]), np.array([4])]
    flat, starts = fm._renumbered(*fm._ragged(rows), np.array([True, False, False, True, True]))
    assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == [[0, 1, 2], [], [], [2]]
    flat, starts = fm._taken(*fm._ragged(rows), np.array([2, 1, 0]))
    assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == [[1, 2], [], [0, 3, 4]]


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_odd_rows(spark, score):
    docs, labels = corpus(spark)
    odd = spark.createDataFrame(
        [(None, "fool martians", None, None, None), (5000, None, None, None, None), (5001, "", "en", "s", 0),
         (5002, "fool " * 200_000, "en", "s", None), (5003, "same", "en", "s", 4), (5003, "same", "en", "s", 4)], DOCS,
    )
    wide = docs.union(odd).withColumns({"score": F.lit("mine"), "label": F.lit(1), "features": F.lit(2)})
    odd_labels = spark.createDataFrame([(1, None, None), (2, 7, 7), (None, 1, 1), (3, 1, 1), (3, 0, 0)], LABELS)
    out = score(wide, labels.union(odd_labels)).where("doc_id is null or doc_id >= 5000").collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    same = [r.score for r in out if r.doc_id == 5003]
    assert same[0] == same[1]
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    assert "features" in out[0].asDict()


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_without_labels_or_documents(spark, score):
    docs, labels = corpus(spark)
    assert {r.score for r in score(docs.limit(5), labels.limit(0)).collect()} == {0.5}
    assert score(docs.limit(0), labels).count() == 0


def test_features():
    assert len(term_hashes(None)) == 0 and len(term_hashes("Idiot, idiot!")) == 2  # the word and a stem
    assert len(described(None)[1]) == len(described("a b")[1])
