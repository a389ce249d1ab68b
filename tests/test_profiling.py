"""Rank correlation against pandas; the profiled columns are all numeric ones."""

import math

import numpy as np
import pandas as pd
import pytest

from urbanflux.catalog import aggregates
from urbanflux.catalog import base as B
from urbanflux.operators import flows, profiling


def test_profile_covers_every_numeric_column(spark, sf):
    assert tuple(profiling.numeric_columns(B.trips(spark, sf))) == aggregates.PROFILE


def test_spearman(spark):
    rng = np.random.default_rng(6)
    n = 600
    rows = pd.DataFrame({
        "a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float), "c": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)),
        "same": 3.0, "d": rng.normal(size=n), "e": rng.integers(0, 50, n).astype(float),
    })
    rows["a"] += rows["b"] + rows["e"] / 20
    rows.loc[rng.random(n) < 0.3, "c"] = None
    rows.loc[rng.random(n) < 0.2, "e"] = None
    rows["empty"] = np.nan
    want = rows.corr(method="spearman")
    frame = spark.createDataFrame([tuple(None if math.isnan(x) and at % 2 else x for x in r) for at, r in enumerate(rows.itertuples(index=False))],
                                  ", ".join(f"{c} double" for c in rows.columns)).repartition(5)
    got = {(r.variable_a, r.variable_b): r.rho for r in profiling.spearman(frame, list(rows.columns)).collect()}
    assert len(got) == 49
    for (a, b), rho in got.items():
        if math.isnan(want.loc[a, b]):
            assert rho is None
        else:
            assert rho == pytest.approx(want.loc[a, b], abs=1e-12)
    assert all(r.rho is None for r in profiling.spearman(frame.limit(0), ["a", "b"]).collect())


def test_matrix_cells(spark):
    pairs = spark.createDataFrame([("x", "y", 3), ("x", "z.1", 2), ("w", "y", 1)], "o string, d string, viajes long")
    cells = flows.matrix_cells(flows.od_matrix(pairs, "o", "d"), "o", "d")
    assert sorted(map(tuple, cells.collect())) == [("w", "y", 1), ("w", "z.1", 0), ("x", "y", 3), ("x", "z.1", 2)]
