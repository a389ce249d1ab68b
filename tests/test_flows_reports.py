import pytest
from datetime import datetime, timedelta

from urbanflux.operators import anomalies, evaluation, flows, profiling, reports


def trips(spark, pairs):
    rows = [(o, d) for o, d, n in pairs for _ in range(n)]
    return spark.createDataFrame(rows, "origen_id int, destino_id int")


def test_graph_edges_are_symmetric_and_strict(spark):
    t = trips(spark, [(1, 2, 9), (2, 3, 4), (3, 3, 9), (4, 1, 1), (5, 1, 1)])
    edges = flows.flow_edges(t, 0.5)  # the threshold is 4: a pair with 4 trips is no edge
    pairs = {(r.src, r.dst) for r in edges.collect()}
    assert pairs == {(1, 2), (2, 1), (3, 3)}
    stats = flows.graph_stats(flows.zone_nodes(t), edges).first()
    assert (stats.nodos, stats.conexiones, stats.media_vecinos, stats.zona_max, stats.vecinos_max) == (5, 1, 0.4, 1, 1)


def test_neighbour_average(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "zona_id int")
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "src int, dst int")
    feats = spark.createDataFrame([(1, 10.0), (2, 2.0), (3, 4.0)], "zona_id int, x double")
    got = {r.zona_id: r.x for r in flows.neighbour_average(nodes, edges, feats, ["x"]).collect()}
    assert got == {1: 3.0, 2: 10.0, 3: 0.0}


def test_index_of_one_zone_is_zero(spark):
    df = spark.createDataFrame([(1, None, 2), (1, 3.0, 1)], "origen_id int, propina double, num_pasajeros int")
    row = reports.purchasing_power(df, "origen_id").first()
    assert row.Poder_Adquisitivo == 0.0 and row.propina_media == 1.5
    assert reports.purchasing_power(df, "origen_id", over_known=True).first().propina_media == 3.0


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, viajes int")
    rows = reports.shares(df, ["g"]).collect()
    assert sorted((r.g, r.pct) for r in rows) == [("a", 25.0), ("a", 75.0), ("b", 100.0)]


def test_histogram_counts_every_row(spark):
    df = spark.range(1000).selectExpr("'VTC' as tipo_vehiculo", "cast(id + 1 as double) as v")
    rows = reports.histogram(df, "v", bins=10, trim=None).collect()
    assert sum(r.casos for r in rows) == 1000 and len(rows) == 10
    assert sum(r.densidad for r in rows) * 99.9 == pytest.approx(1.0)


def test_volume_anomaly_text(spark):
    day = datetime(2025, 1, 1)
    rows = []
    for i in range(20):
        n = 60 if i == 3 else 10
        rows += [(day + timedelta(days=i), 1 if i == 3 else 0, 0, 0, 2 if i == 3 else 0)] * n
    df = spark.createDataFrame(rows, "fecha_inicio timestamp_ntz, lluvia int, nieve int, es_festivo int, num_eventos int")
    out = anomalies.volume_anomalies(df, only=True).collect()
    assert [r.estado_detalle for r in out] == ["Anomalía Alta (evento, lluvia)"]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "y double, p double")
    row = evaluation.regression_metrics(df, "y", "p").first()
    assert row.n == 3 and row.mae == pytest.approx(2 / 3) and row.bias == pytest.approx(0.0) and row.r2 == pytest.approx(1 - 2 / 8)
    assert row.mape == pytest.approx((1 + 0 + 0.25) / 3 * 100)
    assert evaluation.regression_metrics(df, "y", "p", "gt1").first().mape == pytest.approx(12.5)
    with pytest.raises(ValueError):
        evaluation.regression_metrics(df, "y", "p", "nope")


def test_classification_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = evaluation.classification_metrics(df, "y", "p").first()
    assert (row.precision, row.recall, row.f1, row.f1_ponderado, row.exactitud) == (0.0, 0.0, 0.0, 1.0, 1.0)


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (4.0, "b"), (8.0, "b"), (16.0, "b")], "v double, s string")
    shape = profiling.shape_profile(df, ["v"]).first()
    assert shape.skew == pytest.approx(1.3253, abs=1e-4) and shape.kurtosis == pytest.approx(1.3037, abs=1e-3)
    assert profiling.null_profile(df).first().porcentaje == 20.0
    top = profiling.category_profile(df, ["s"], top=1).first()
    assert (top.valor, top.n, top.cardinalidad) == ("b", 3, 2)
    out = profiling.iqr_outliers(df, ["v"]).first()
    assert (out.atipicos, out.pct) == (0, 0.0)
