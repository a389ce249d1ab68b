"""Hard negatives against all pairs; the bounds hold and leave rows out where vectors are alike in shape."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.llm import hard_negatives as H

KIND = "vec_id long, embedding array<float>, label int"


def by_hand(rows):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in vector], label))
    out = []
    first = lambda scored: sorted(scored, key=lambda s: (-s[0], s[1] is not None, s[1] or 0))
    for i, (a, x, la) in enumerate(kept):
        if a is None or a % 100:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), b, lb) for j, (b, y, lb) in enumerate(kept) if j != i]
        for p, positive, _ in first(s for s in scored if s[2] == la)[: H.POSITIVES]:
            good = first(s for s in scored if s[2] != la and 30 * p <= 100 * s[0] <= 90 * p)[: H.NEGATIVES]
            out += [(a, positive, rank, b, p, s) for rank, (s, b, _) in enumerate(good, 1)]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def odd_rows(n=700):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 16))
    rows = []
    for i in range(n):
        x = centers[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.1, 1.0])
        rows.append((i, [float(np.float32(c)) for c in x], int(rng.integers(10)) if i % 3 else 4))
    rows += [(100, rows[100][1], 3), (100, rows[100][1], 3), (5, rows[5][1], 2), (None, rows[0][1], 4), (None, rows[0][1], 1)]
    rows += [(800, None, 1), (900, rows[0][1], None), (901, [None] * 16, 2), (902, [float("nan")] * 16, 2), (903, [float("inf")] + [0.0] * 15, 2)]
    return rows + [(1000, [], 4), (1001, [1.0, 2.0], 4), (1100, [1.0] * 20, 4), (1102, [0.0] * 16, 5), (-100, rows[7][1], 6)]


@pytest.mark.parametrize("sizes", [(4096, 4096, 512), (60, 3, 2)])
def test_all_pairs(spark, monkeypatch, sizes):
    for name, size in zip(("CHUNK", "GROUP", "SLICE"), sizes):
        monkeypatch.setattr(H, name, size)
    rows = odd_rows()
    vectors = spark.createDataFrame(rows, KIND).repartition(4).withColumns({"row": F.lit(0), "x": F.lit("a"), "rank": F.lit(9)})
    got = found(H.hard_negatives(vectors))
    assert got == by_hand(rows) and len(got) > 100


def test_nothing_to_mine(spark):
    some = spark.createDataFrame(odd_rows(), KIND)
    assert H.hard_negatives(some.limit(0)).count() == 0
    assert H.hard_negatives(some.filter("vec_id % 100 <> 0")).count() == 0
    assert H.hard_negatives(some.filter("vec_id = 100").limit(1)).count() == 0


def test_bounds():
    """Summaries bound every product at each level; with one component a segment they are the product."""
    rng = np.random.default_rng(1)
    for width in (1, 3, 16, 50):
        a, b = (rng.integers(-300, 300, (20, width)) for _ in range(2))
        exact = a @ b.T
        for segments in (1, 4, 16, 50):
            p, q = H.summaries(a, segments), H.summaries(b, segments)
            s = p.shape[1] // 2
            middle, reach = p[:, :s] @ q[:, :s].T, p[:, s:] @ q[:, s:].T
            assert (np.abs(exact - middle) <= reach + 1e-6).all()
            if s == width:
                assert np.allclose(exact, middle) and np.allclose(reach, 0)


def test_rows_are_left_out(spark, monkeypatch):
    """Vectors whose segments are level: their bounds are tight, so few pairs need the exact product."""
    monkeypatch.setattr(H, "CHUNK", 100)
    rng = np.random.default_rng(2)
    shape = np.repeat(rng.normal(size=(900, 4)), 4, axis=1) + rng.normal(size=(900, 16)) * 0.05
    rows = [(i, [float(np.float32(c)) for c in x], i % 10) for i, x in enumerate(shape)]
    result, totals = H.mine(H.labelled_vectors(spark.createDataFrame(rows, KIND)))
    got = found(result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    assert got == by_hand(rows)
    share = {r.search: r.scored / r.pairs for r in totals.collect()}
    assert share["negatives"] < 0.5
