"""Whitening against numpy; odd rows, one row, no variance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.llm import whitening as W

KIND = "vec_id long, embedding array<float>"


def by_hand(rows, width):
    kept = [(i, v) for i, v in rows if v is not None and not any(c is None or not math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in list(v) + [0.0] * (width - len(v))] for _, v in kept], object)
    n, sums = len(x), x.sum(0)
    deviation = ((n * x - sums) ** 2).sum(1)
    centred = np.array((n * x - sums) / n, float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[: W.COMPONENTS]
    return kept, n, deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def rows_of(n, width, seed=3):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(width, width)) * np.linspace(0.2, 3, width)
    return [(i, [float(np.float32(c)) for c in mix @ rng.normal(size=width)]) for i in range(n)]


@pytest.mark.parametrize("block_rows, block_columns", [(4096, 1024), (64, 1024), (50, 4)])
def test_against_numpy(spark, monkeypatch, block_rows, block_columns):
    for name, size in (("BLOCK_ROWS", block_rows), ("BLOCK_COLUMNS", block_columns), ("MIDDLE_BLOCKS", 2)):
        monkeypatch.setattr(W, name, size)
    rows = rows_of(500, 12)
    rows += [(600 + i, rows[0][1]) for i in range(250)] + [(3, rows[9][1]), (None, rows[8][1]), (990, [0.5, -0.25])]
    bad = [(800, None), (801, [None] * 12), (802, [float("nan")] * 12), (803, [float("-inf")] + [0.0] * 11)]
    vectors = spark.createDataFrame(rows + bad, KIND).repartition(5).withColumns({"index": F.lit(1), "x": F.lit("y"), "place": F.lit(0)})
    got = W.whiten(vectors).collect()
    kept, n, deviation, white, explained = by_hand(rows + bad, 12)
    assert len(got) == 8 * n and n == len(rows) and {r.n for r in got} == {n}
    sign = {}
    for c in range(8):
        of = {r.vec_id: r for r in got if r.component == c + 1 and r.vec_id not in (3, None)}
        first = kept[0][0]
        sign[c] = np.sign(of[first].whitened * white[0, c])
        for at, (vec_id, _) in enumerate(kept):
            if vec_id in of:
                assert of[vec_id].whitened * sign[c] == pytest.approx(white[at, c], abs=1e-8)
                assert int(of[vec_id].deviation) == deviation[at]
                assert of[vec_id].explained == pytest.approx(explained[c], rel=1e-9)
    assert sum(r.vec_id == 3 for r in got) == 16 and sum(r.vec_id is None for r in got) == 8
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_little_variance(spark):
    frame = lambda rows: spark.createDataFrame(rows, KIND)
    assert W.whiten(frame([]).limit(0)).count() == 0
    assert W.whiten(frame([(1, []), (2, None)])).count() == 0
    one = W.whiten(frame([(1, [0.5, 0.25, 1e30])])).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in one] == [(i, None, None, None, 0) for i in (1, 2, 3)]
    line = W.whiten(frame([(i, [i / 4, i / 4]) for i in range(5)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and len(line) == 10
    assert line[0].identity_error < 1e-9
