from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from urbanflux.operators import demand, sequences, supply
from urbanflux.sources.demand_inputs import demand_rows

H = datetime(2025, 1, 6, 0)


def hours(spark, rows):
    return spark.createDataFrame(
        [(z, H + timedelta(hours=h), d) for z, h, d in rows], "origen_id int, timestamp_hora timestamp_ntz, demanda bigint"
    )


def test_lags_count_rows_not_hours(spark):
    z = hours(spark, [(1, 0, 10), (1, 1, 20), (1, 5, 30), (2, 0, 7)])
    out = demand.with_rolling(demand.with_lags(demand.with_target(z))).orderBy("origen_id", "timestamp_hora").collect()
    assert [r.lag_1h for r in out] == [None, 10, 20, None]
    assert [r.lag_2h for r in out] == [None, None, 10, None]
    assert [r.target for r in out] == [20, 30, None, None]
    assert [r.roll_mean_3h for r in out] == [None, 10.0, 15.0, None]
    assert [round(r.roll_std_3h, 6) for r in out] == [0.0, 0.0, 7.071068, 0.0]


def test_dense_hours_fill_gaps(spark):
    out = demand.dense_hours(hours(spark, [(1, 0, 10), (1, 3, 30)])).orderBy("timestamp_hora").collect()
    assert [r.demanda for r in out] == [10, 0, 0, 30]


def test_history_falls_back_to_the_global_mean(spark):
    z = hours(spark, [(1, 0, 10), (1, 1, 20), (2, 0, 90)]).withColumn("hora", F.hour("timestamp_hora"))
    out = demand.with_group_mean(z, z.where("origen_id = 1"), "demanda", "m", ["origen_id", "hora"])
    assert {(r.origen_id, r.hora): r.m for r in out.collect()} == {(1, 0): 10.0, (1, 1): 20.0, (2, 0): 15.0}


def test_far_lags_take_history_and_near_ones_drop(spark):
    rows = [(1, h, h + 1) for h in range(8)]
    z = hours(spark, rows).withColumns({"hora": F.lit(0), "dia_semana": F.lit(0)})
    out = demand.demand_features(z, F.lit(H + timedelta(hours=100))).orderBy("timestamp_hora").collect()
    assert [r.demanda for r in out] == [4, 5, 6, 7]
    assert [r.lag_6h for r in out] == [4.5, 4.5, 4.5, 1.0]


def test_label_uses_the_zones_of_the_window(spark):
    rows = [("w1", 1, 0.5), ("w2", 1, 0.4), ("w2", 2, 0.4), ("w3", 1, 0.1), ("w3", 2, 0.5), ("w3", 3, 0.9)]
    df = spark.createDataFrame(rows, "ventana_inicio string, origen_id int, tasa_exito double")
    got = {(r.ventana_inicio, r.origen_id): r.target for r in supply.with_good_label(df).collect()}
    assert got == {("w1", 1): 1, ("w2", 1): 1, ("w2", 2): 1, ("w3", 1): 0, ("w3", 2): 0, ("w3", 3): 1}


def summary(spark, means):
    rows = [(i, "manana", float(m), f"Zona {i}", "Manhattan") for i, m in enumerate(means)]
    return spark.createDataFrame(
        rows, "origen_id int, franja_horaria string, demanda_media double, origen_zona string, origen_barrio string"
    )


def test_equal_means_are_all_medium(spark):
    assert {r.nivel_demanda for r in demand.with_level(summary(spark, [5, 5, 5])).collect()} == {"media"}


def test_levels_and_scores(spark):
    out = demand.with_score(demand.with_level(summary(spark, [1, 2, 2, 9]))).orderBy("origen_id").collect()
    assert [r.nivel_demanda for r in out] == ["baja", "media", "media", "alta"]
    assert [r.score_demanda_0_100 for r in out] == [25.0, 62.5, 62.5, 100.0]


def test_demand_query(spark):
    s = demand.with_level(summary(spark, [1, 2, 3, 9]))
    assert [r.origen_id for r in demand.query_demand(s, zona="MANHÁTTAN", demanda_min=2).collect()] == [3, 2, 1]
    assert [r.origen_id for r in demand.query_demand(s, zona=" 2 ").collect()] == [2]
    assert [r.origen_id for r in demand.query_demand(s, franja="mañana", top=1).collect()] == [3]
    assert [r.origen_id for r in demand.query_demand(s, nivel="Alta").collect()] == [3, 2]
    assert demand.query_demand(s, zona="nowhere").count() == 0
    assert demand.query_demand(s, zona="", require_filter=False, top=2).count() == 2
    with pytest.raises(ValueError):
        demand.query_demand(s)


def test_peak_hour_tie_takes_the_later_hour(spark):
    df = spark.createDataFrame([(1, 6, 4.0), (1, 8, 4.0), (1, 9, 1.0)], "origen_id int, hora int, demanda double")
    row = demand.peak_hours(df).first()
    assert (row.hora_pico, row.demanda_hora_pico) == (8, 4.0)


def test_demand_inputs(spark):
    trips = spark.createDataFrame([(1, H), (1, H + timedelta(minutes=5)), (2, H)], "origen_id int, fecha_inicio timestamp_ntz")
    text = spark.createDataFrame([(3, 4, "x")], "origen_id int, hora int, demanda string")
    rows = sorted(tuple(r) for r in demand_rows([trips, text]).collect())
    assert rows == [(1, 0, 2.0), (2, 0, 1.0), (3, 4, 0.0)]
    with pytest.raises(ValueError):
        demand_rows([spark.range(1)])


def test_proxies_per_split(spark):
    rows = [(H, "train", 2.0, 0.5, 10.0), (H, "train", 4.0, 1.0, 10.0), (H, "test", 10.0, 0.5, 20.0)]
    df = spark.createDataFrame(rows, "ventana_inicio timestamp_ntz, split string, oferta_inferida double, tasa_historica double, viento_kmh double")
    got = {r.oferta_inferida: r.lag_24h for r in supply.demand_model_proxies(df, by_split="split").collect()}
    assert got == {2.0: 1.5, 4.0: 3.0, 10.0: 5.0}


def test_sequences_need_full_history(spark):
    z = demand.with_target(hours(spark, [(1, h, h) for h in range(6)] + [(2, 0, 1), (2, 1, 1)])).where("target is not null")
    out = sequences.feature_sequences(z, ["demanda"], 3).orderBy("timestamp_hora").collect()
    assert [[s.demanda for s in r.secuencia] for r in out] == [[0.0, 1.0, 2.0], [1.0, 2.0, 3.0]]
    assert [r.y for r in out] == [4.0, 5.0]


def test_first_long_run_or_first_rows(spark):
    rows = [(1, h, h) for h in (0, 1, 5, 6, 7, 9, 10, 11)] + [(2, h, h) for h in (0, 4, 8, 12)]
    out = sequences.first_run(hours(spark, rows), 3)
    got = sorted((r.origen_id, r.demanda) for r in out.collect())
    assert got == [(1, 5), (1, 6), (1, 7), (2, 0), (2, 4), (2, 8)]
