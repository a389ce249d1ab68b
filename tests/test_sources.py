import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from urbanflux.catalog import base as B
from urbanflux.operators import enrichment
from urbanflux.sources import dimensions as D
from urbanflux.sources import sinks
from urbanflux.sources import trips as T


def test_zone_lookup(spark, tmp_path):
    (tmp_path / "z.csv").write_text('LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n264,Unknown,N/A,N/A\n1,EWR,Zzz,EWR\n')
    rows = D.read_zone_lookup(spark, str(tmp_path / "z.csv")).orderBy("LocationID").collect()
    assert [(r.LocationID, r.Zone, r.service_zone) for r in rows] == [(1, "Newark", "EWR"), (264, None, None)]


def test_weather_payload_and_repeated_hour(spark):
    hourly = {
        "time": ["2025-11-02T01:00", "2025-11-02T01:00", "bad"], "temperature_2m": [1.0, 3.0, 9.0], "precipitation": [0.0, 0.2, 0.0],
        "rain": [0.1, 0.11, 0.0], "snowfall": [0.0, None, 0.0], "windspeed_10m": [5.0, 7.0, 0.0],
    }
    df = spark.createDataFrame([("Queens", json.dumps({"hourly": hourly})), ("Bronx", "{}")], "borough string, payload string")
    rows = D.parse_weather(df).collect()
    assert [r.lluvia for r in rows] == [0, 1, 0] and rows[2].fecha_hora is None and rows[1].nieve == 0
    once = D.one_per_hour(D.parse_weather(df).where("fecha_hora is not null")).collect()
    assert len(once) == 1 and once[0].temp_c == 2.0 and once[0].lluvia == 1


def test_holidays(spark):
    items = [
        {"date": "2025-01-01", "global": True, "counties": None}, {"date": "2025-02-12", "global": False, "counties": ["US-CT", "US-NY"]},
        {"date": "2025-04-01", "global": False, "counties": ["US-CA"]}, {"date": "2026-01-01", "global": True, "counties": None},
        {"date": "2025-01-01", "global": True, "counties": None},
    ]
    df = spark.createDataFrame([(json.dumps(items),)], "payload string")
    found = D.parse_holidays(df, "2025-01", "2025-03")
    assert sorted(r.fecha for r in found.collect()) == [date(2025, 1, 1), date(2025, 2, 12)]
    cal = D.holiday_calendar(found, D.calendar_days(spark, "2025-01", "2025-03"))
    assert cal.count() == 90 and cal.where("es_festivo = 1").count() == 2


def test_city_events_with_empty_days(spark, tmp_path):
    (tmp_path / "e.csv").write_text(
        "Event Type,Attendance,Date and Time\nBike Parade,1,2025-01-02 10:00:00\nSport,abc,2025-01-02 11:00:00\n"
        "Sport,1000,2025-01-03 11:00:00\nSport,1,someday\nSport,1,2024-01-03 11:00:00\n"
    )
    events = D.city_events(D.read_city_events(spark, str(tmp_path / "e.csv")), 2025)
    days = D.daily_events(events, D.calendar_days(spark, "2025-01-01", "2025-01-04")).orderBy("fecha").collect()
    assert [(r.evento_tipo, r.num_eventos) for r in days] == [("No hay", 0), ("Masivo", 2), ("Medio", 1), ("No hay", 0)]


def test_months(spark):
    assert [r.mes for r in D.calendar_months(spark, "2024-11", "2025-02").collect()] == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert T.rolling_year_months(2025)[0] == (2024, 12) and len(T.rolling_year_months(2025)) == 12


def test_monthly_scan(spark, tmp_path):
    for m, n in ((10, 3), (11, 5), (12, 7)):
        spark.range(n).write.parquet(str(tmp_path / "yellow" / "2025" / f"yellow_tripdata_2025-{m}.parquet"))
    rows = T.monthly_trips(spark, str(tmp_path), "yellow", [(2025, 10), (2025, 12)]).groupBy("mes_archivo").count().collect()
    assert {r.mes_archivo: r["count"] for r in rows} == {10: 3, 12: 7}
    with pytest.raises(FileNotFoundError, match="2025-10, 2025-11, 2025-12"):
        T.monthly_trips(spark, str(tmp_path), "yellow", [(2024, 1)])


@pytest.mark.parametrize("fee_first", [True, False])
def test_months_of_two_schemas_are_cleaned_apart(spark, sf, tmp_path, fee_first):
    """A fee that one month has is in its prices and costs the other month no trip."""
    from urbanflux.catalog import base as B
    from urbanflux.plans import etl

    raw = B.raw_fhvhv(spark, sf).where("month(pickup_datetime) = 1")
    other = raw.withColumns({c: B.F.expr(f"{c} + interval 60 days") for c, k in raw.dtypes if k == "timestamp_ntz"})
    with_fee = lambda df: df.withColumn("cbd_congestion_fee", B.F.lit(1.5)).withColumn("trip_time", B.F.col("trip_time").cast("int"))
    first, second = (with_fee(raw), other) if fee_first else (raw, with_fee(other))
    for month, rows in ((1, first), (3, second)):
        rows.write.parquet(str(tmp_path / "fhvhv" / "2024" / f"x-2024-{month:02d}.parquet"))
        rows.limit(1).write.parquet(str(tmp_path / "notfhvhv" / "2024" / f"x-2024-{month:02d}.parquet"))
    assert len(T.monthly_scans(spark, str(tmp_path), "fhvhv", [(2024, 1), (2024, 3)])) == 2
    clean = etl.clean_months(spark, str(tmp_path), ["fhvhv"], [(2024, 1), (2024, 3)])
    got = {r.m: r for r in clean.groupBy(B.F.month("fecha_inicio").alias("m")).agg(
        B.F.count("*").alias("n"), B.F.sum("precio_total_est").alias("s")).collect()}
    assert got[1].n == got[3].n > 0
    gap = got[1].s - got[3].s
    assert gap == pytest.approx(1.5 * got[1].n * (1 if fee_first else -1))


def test_shared_folder_is_named_on_a_cluster():
    from types import SimpleNamespace

    from urbanflux.session import is_local, shared_folder

    assert is_local("local") and is_local("local[*]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_present_columns(spark):
    assert T.present_columns(spark.range(1), ["x", "id"]).columns == ["id"]
    with pytest.raises(ValueError):
        T.present_columns(spark.range(1), ["x"])


def test_order_check_sees_seams(spark):
    good = spark.range(100).selectExpr("id", "id * 2 as t")
    assert T.out_of_order(good, "id", "t", step=7).first().ordenado
    bad = spark.range(100).selectExpr("id", "case when id = 14 then 0 when id = 50 then 1 else id * 2 end as t")
    assert T.out_of_order(bad, "id", "t", step=7).first().desordenadas == 2


def test_write_if_absent_and_reuse(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_if_absent(spark.range(3), path) and not sinks.write_if_absent(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    where = str(tmp_path / "r")
    assert sinks.reused_table(spark, where, ["a"], lambda: spark.range(2)).count() == 2
    assert sinks.reused_table(spark, where, ["a"], lambda: spark.range(5)).count() == 2
    assert sinks.reused_table(spark, where, ["b"], lambda: spark.range(5)).count() == 5


def test_weather_gaps_take_the_median_of_the_file(spark):
    rows = [("VTC", 1, 1.0, 0.1, None, 1, None), ("VTC", 1, 3.0, None, None, None, 1), ("VTC", 1, None, None, None, None, None),
            ("VTC", 1, 3.0, 0.0, None, 0, 0), ("VTC", 2, None, None, 4.0, 0, 0)]
    df = spark.createDataFrame(rows, "tipo_vehiculo string, mes_num int, temp_c double, precipitation double, viento_kmh double, lluvia int, nieve int")
    out = enrichment.fill_weather(df).collect()
    assert sorted((r.mes_num, r.temp_c, r.viento_kmh) for r in out) == [(1, 1.0, 0.0), (1, 3.0, 0.0), (1, 3.0, 0.0), (1, 3.0, 0.0), (2, 0.0, 4.0)]
    assert all(r.precipitation is not None and r.lluvia is not None and r.nieve is not None for r in out)


def test_weather_medians_without_joining_trips(spark, sf):
    """The medians of counted zone hours are those of the joined trips; unknown zones have no reading."""
    trips = B.trips(spark, sf).withColumn("origen_id", F.when(F.col("id") % 11 == 0, 999).otherwise(F.col("origen_id")))
    zones, weather = B.zones(spark, sf), B.weather(spark, sf)
    joined = enrichment.with_weather(enrichment.with_zones(trips, zones), weather)
    counts = joined.groupBy("tipo_vehiculo", "mes_num", "temp_c", "viento_kmh").agg(F.count(F.lit(1)).alias("c"))
    want = enrichment._weighted_medians(counts, ("tipo_vehiculo", "mes_num"))
    got = enrichment.weather_medians(trips, zones, weather)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 1
    empty = enrichment.weather_medians(trips.limit(0), zones, weather)
    assert empty.count() == 0
