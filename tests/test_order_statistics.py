import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.functions import order_statistics
from urbanflux.functions.order_statistics import exact_quantile, exact_quantiles, score_curve
from urbanflux.operators import splits
from urbanflux.operators.evaluation import ranking_metrics

PROBS = (0.0, 0.01, 0.25, 0.5, 0.66, 0.99, 1.0)


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = exact_quantiles(df, ["v"], PROBS).first()
    want = np.quantile(np.array(values, dtype=float), PROBS)
    assert row.n == len(values)
    np.testing.assert_allclose([row[f"q{i}"] for i in range(len(PROBS))], want, rtol=1e-12)


@pytest.mark.parametrize("kind", ["uniform", "heavy", "ties", "negative", "small", "two", "one", "hot"])
def test_quantiles_match_numpy(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.random(30011),
        "heavy": np.exp(rng.normal(0, 6, 20000)),
        "ties": rng.integers(0, 5, 29999),
        "negative": rng.normal(-5, 100, 25000),
        "small": rng.random(967), "two": np.array([2.0, 1.0]),
        "one": np.array([7.5]),
        "hot": np.concatenate([np.full(17000, 3.25), rng.random(13000) * 10]),
    }[kind]
    check(spark, values.tolist())


def test_quantiles_by_group_and_column_skip_nulls(spark):
    rows = [("a", 1.0, None), ("a", 3.0, 5.0), ("b", 10.0, 1.0), ("b", None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r.g, r.variable): (r.n, r.q0) for r in exact_quantiles(df, ["x", "y"], [0.5], by=["g"]).collect()}
    assert got == {("a", "x"): (2, 2.0), ("a", "y"): (1, 5.0), ("b", "x"): (1, 10.0), ("b", "y"): (2, 1.5)}


def test_quantiles_of_many_rows(spark):
    """Over a million rows, three fifths of them one value, in groups with a NULL key."""
    df = spark.range(1_200_000).selectExpr(
        "case when id % 3 < 2 then id % 3 end as g",
        "case when id % 5 < 3 then 2.5D else cast((xxhash64(id) % 1000003) / 7 as double) end as v",
    )
    got = {r.g: [r.q0, r.q1, r.q2] for r in exact_quantiles(df, ["v"], (0.1, 0.5, 0.9), by=["g"]).collect()}
    data = df.toPandas()
    for g, part in data.groupby("g", dropna=False):
        np.testing.assert_allclose(got[None if np.isnan(g) else g], np.quantile(part.v, (0.1, 0.5, 0.9)), rtol=1e-12)


def test_quantiles_of_extreme_values(spark):
    values = [float("-inf"), -1e308, -1e-308, -5e-324, 0.0, 5e-324, 1.0, float(np.nextafter(1.0, 2.0)), 2.0, 1e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, ["v"], [i / 10 for i in range(11)]).first()
    assert [row[f"q{i}"] for i in range(1, 10)] == values[1:10]


def test_scalar_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1.0,)], "v double").where("v > 5")
    assert spark.range(1).select(exact_quantile(df, "v", 0.5)).first()[0] is None


@pytest.mark.parametrize("n, cap", [(1000, 100), (50, 100), (100, 100), (1, 1)])
def test_capped_sample_size(spark, n, cap):
    out = splits.capped_sample(spark.range(n), cap, "id")
    assert out.count() == min(n, cap) and out.distinct().count() == min(n, cap)


def test_capped_sample_is_stable(spark):
    a = {r.id for r in splits.capped_sample(spark.range(500), 37, "id").collect()}
    b = {r.id for r in splits.capped_sample(spark.range(500).repartition(7), 37, "id").collect()}
    assert a == b


@pytest.mark.parametrize("n, days", [(100, 10), (97, 1), (1000, 3), (3, 3), (1, 1)])
def test_positional_split(spark, n, days):
    """Also when every row has the same time."""
    df = spark.range(n).selectExpr("id", f"timestamp_ntz'2025-01-01' + make_dt_interval(cast(id % {days} as int)) as t")
    rows = splits.split_by_position(df, "t", ["id"]).collect()
    sizes = {s: sum(r.split == s for r in rows) for s in ("train", "val", "test")}
    assert sizes["train"] == int(n * 0.7) and sizes["train"] + sizes["val"] == int(n * (0.7 + 0.15))
    last = {s: [r.t for r in rows if r.split == s] for s in sizes}
    for early, late in (("train", "val"), ("val", "test")):
        if last[early] and last[late]:
            assert max(last[early]) <= min(last[late])


def test_two_counting_scans(spark, monkeypatch):
    """A third of all rows at one instant: the rows are counted twice, whatever the levels."""
    df = spark.range(3000).selectExpr(
        "id", "timestamp_ntz'2025-01-01' + make_dt_interval(0, 0, 0, if(id % 3 = 0, 500.25, id / 3)) as t")
    counted = []
    stored = order_statistics.written_table
    monkeypatch.setattr(order_statistics, "written_table", lambda d, name: counted.append(name) or stored(d, name))
    rows = splits.split_by_position(df, "t", ["id"], (0.4, 0.2)).collect()
    assert counted.count("rank_counts") == 2
    ordered = sorted(rows, key=lambda r: r.t)
    assert [sum(r.split == s for r in rows) for s in ("train", "val", "test")] == [1200, 600, 1200]
    assert max(r.t for r in rows if r.split == "train") == ordered[1199].t
    assert max(r.t for r in rows if r.split == "val") == ordered[1799].t


def test_auc_and_average_precision(spark):
    rng = np.random.default_rng(5)
    score = np.round(rng.random(600), 2)
    label = (rng.random(600) < score).astype(int)
    df = spark.createDataFrame(list(zip(score.tolist(), label.tolist())), "s double, y int")
    got = ranking_metrics(df, "y", "s").first()
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert got.auc == pytest.approx(wins / (len(pos) * len(neg)))
    ap, before = 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        hit, all_ = (label[score >= t] == 1).sum(), (score >= t).sum()
        ap += (hit / len(pos) - before) * hit / all_
        before = hit / len(pos)
    assert got.precision_media == pytest.approx(ap)


def test_score_curve_totals(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 0), (1.0, 1), (0.5, 0)], "s double, y int")
    rows = score_curve(df, "y", "s").orderBy(F.desc("score")).collect()
    assert [(r.score, r.cum_pos, r.cum_neg) for r in rows] == [(1.0, 1, 1), (0.5, 1, 2), (0.0, 2, 2)]


def test_score_curve_inside_one_thousandth(spark):
    df = spark.range(2000).selectExpr("0.5 + id / 4000000.0 as s", "cast(id % 3 = 0 as int) as y")
    rows = score_curve(df, "y", "s").orderBy(F.desc("score")).collect()
    pos = neg = 0
    for r in rows:
        pos, neg = pos + r.pos, neg + r.neg
        assert (r.cum_pos, r.cum_neg) == (pos, neg)
    assert (pos, neg) == (667, 1333) == (rows[0].total_pos, rows[0].total_neg)
