from datetime import datetime, timedelta

from urbanflux.plans import etl, feature_chain
from urbanflux.plans.demand_report import demand_report, report_metadata


def test_months_to_final_table_to_features(spark, sf, tmp_path):
    """Raw monthly files of both services through the whole chain."""
    from urbanflux.catalog import base as B

    root = str(tmp_path / "raw")
    for service, raw in (("yellow", B.raw_yellow(spark, sf)), ("fhvhv", B.raw_fhvhv(spark, sf))):
        raw.write.parquet(f"{root}/{service}/2024/{service}_tripdata_2024-01.parquet")
    zones = B.zones(spark, sf).withColumn("LocationID", B.F.col("LocationID") + 240)
    dims = {"zones": zones, "weather": B.weather(spark, sf), "holidays": B.holidays(spark, sf), "events": B.city_days(spark, sf)}
    out = str(tmp_path / "final")
    key = ["fecha_inicio", "origen_id", "destino_id", "distancia"]
    etl.run(spark, root, out, ["yellow", "fhvhv"], [(2024, 1)], dims, key, percent=100)
    final = spark.read.parquet(out)
    expected = etl.clean_months(spark, root, ["yellow", "fhvhv"], [(2024, 1)]).count()
    assert final.count() == expected > 300
    assert {r.tipo_vehiculo for r in final.select("tipo_vehiculo").distinct().collect()} == {"Yellow Taxi", "VTC"}
    assert final.where("propina is null or num_pasajeros is null or temp_c is null or franja_horaria is null").count() == 0
    assert "tipo_pago" not in final.columns

    features = feature_chain.demand_table(final)
    assert features.where("target is null or media_hist is null or lag_24h is null").count() == 0
    windows = feature_chain.supply_table(final)
    tips = feature_chain.tip_table(final, key)
    contexts = feature_chain.contexts(windows, tips)
    assert contexts.taxi.count() > 0 and contexts.ride_hail.where("franja_horaria is null").count() == 0
    assert "fecha_inicio" not in tips.columns

    report = demand_report([final], zones)
    assert report_metadata(report).first().filas_resultado == report.count()


def test_time_split_cuts(spark):
    from urbanflux.operators import splits

    start = datetime(2025, 1, 1, 0, 30)
    df = spark.createDataFrame([(start,), (start + timedelta(hours=100),)], "fecha_inicio timestamp_ntz")
    row = splits.time_cuts(df).first()
    assert (row.corte_train, row.corte_val) == (datetime(2025, 1, 3, 22), datetime(2025, 1, 4, 13))
