from datetime import datetime, timedelta

import pytest

from urbanflux.operators import cleaning, imputation
from urbanflux.operators.models import model_matrix

START = datetime(2025, 11, 3, 10, 0)
YELLOW = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, "
    "passenger_count double, trip_distance double, fare_amount double, tip_amount double, total_amount double, payment_type int"
)


def yellow(spark, **changes):
    base = {"start": START, "minutes": 10.0, "o": 1, "d": 2, "pax": 1.0, "mi": 2.0, "fare": 10.0, "tip": 1.0, "total": 12.0, "pay": 1}
    base.update(changes)
    row = (
        base["start"], base["start"] + timedelta(minutes=base["minutes"]), base["o"], base["d"], base["pax"], base["mi"],
        base["fare"], base["tip"], base["total"], base["pay"],
    )
    return spark.createDataFrame([row], YELLOW)


def kept(df, service="yellow", **kw):
    return cleaning.clean_trips(df, service, **kw).count() == 1


@pytest.mark.parametrize("change, keep", [
    ({}, True),
    ({"minutes": 0}, False), ({"minutes": 1}, False), ({"minutes": 1.01}, True), ({"minutes": 179.9}, True), ({"minutes": 180}, False),
    ({"mi": 0.1}, False), ({"mi": 0.11}, True), ({"mi": 199.9}, True), ({"mi": 200.0}, False),
    ({"o": 264}, False), ({"d": 265}, False), ({"o": 263}, True), ({"o": None}, False),
    ({"fare": -0.01}, False), ({"fare": 0.0}, True), ({"fare": 499.99}, True), ({"fare": 500.0}, False),
    ({"total": 0.0}, False), ({"total": 0.01}, True), ({"total": 500.0}, False),
    ({"pax": -1.0}, False), ({"pax": 0.0}, True), ({"pax": 8.0}, True), ({"pax": 9.0}, False), ({"pax": None}, False),
    ({"tip": float("nan")}, False),
])
def test_yellow_limits(spark, change, keep):
    assert kept(yellow(spark, **change)) is keep


def test_yellow_values(spark):
    row = cleaning.clean_trips(yellow(spark, pay=2), "yellow").first()
    assert row.propina is None and row.espera_min == 0.0 and row.tipo_vehiculo == "yellow"
    assert row.duracion_min == 10.0 and row.velocidad_mph == pytest.approx(12.0)
    assert row.precio_base == 10.0 and row.precio_total_est == 12.0
    assert cleaning.clean_trips(yellow(spark, pay=1), "yellow").first().propina == 1.0


def test_month_of_file_ignores_year(spark):
    assert kept(yellow(spark), month=11) and not kept(yellow(spark), month=10)
    assert kept(yellow(spark, start=datetime(2024, 11, 3)), month=11)
    assert not kept(yellow(spark, start=datetime(2024, 11, 3)), month=11, year=2025)


def test_yellow_without_fares_is_empty(spark):
    assert cleaning.clean_trips(yellow(spark).drop("fare_amount"), "yellow").count() == 0


def test_relaxed_nulls_default_passengers(spark):
    df = cleaning.coerce_types(cleaning.rename_raw(yellow(spark, pax=None), "yellow"))
    assert cleaning.service_defaults(df, "yellow").first().num_pasajeros == 1


def test_unknown_service_and_columns(spark):
    with pytest.raises(ValueError):
        cleaning.rename_raw(yellow(spark), "green")
    with pytest.raises(ValueError):
        cleaning.rename_raw(spark.range(1), "yellow")


FHVHV = (
    "request_datetime timestamp_ntz, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int, "
    "DOLocationID int, trip_miles double, trip_time bigint, base_passenger_fare double, tolls double, bcf double, tips double"
)


def fhvhv(spark, **changes):
    base = {"wait": 5.0, "sec": 600, "fare": 20.0, "tolls": 1.0, "bcf": 0.5, "tips": 2.0}
    base.update(changes)
    row = (
        START - timedelta(minutes=base["wait"]), START, START + timedelta(minutes=10), 1, 2, 2.0, base["sec"], base["fare"],
        base["tolls"], base["bcf"], base["tips"],
    )
    return spark.createDataFrame([row], FHVHV)


@pytest.mark.parametrize("change, keep", [
    ({}, True), ({"fare": 0.0}, False), ({"fare": 0.01}, True), ({"fare": 500.0}, False), ({"fare": 499.0}, False),
    ({"sec": 30}, False), ({"sec": 31}, True), ({"sec": 21600}, False), ({"sec": 21599}, True),
    ({"wait": -1}, False), ({"wait": 0}, True), ({"wait": 120}, True), ({"wait": 121}, False), ({"tolls": -1.0}, False),
])
def test_fhvhv_limits(spark, change, keep):
    assert kept(fhvhv(spark, **change), "fhvhv") is keep


def test_fhvhv_price_and_tip_guard(spark):
    row = cleaning.clean_trips(fhvhv(spark, tips=0.0), "fhvhv").first()
    assert row.precio_total_est == pytest.approx(21.5) and row.espera_min == 5.0
    assert row.propina == 0.0  # no payment column: zero stays
    paid = fhvhv(spark, tips=0.0).selectExpr("*", "1 as payment_type")
    assert cleaning.clean_trips(paid, "fhvhv").first().propina is None


def test_speed_band_is_inclusive(spark):
    df = spark.createDataFrame([(1.99,), (2.0,), (85.0,), (85.1,)], "velocidad_mph double")
    assert [r[0] for r in df.where(cleaning.speed_band()).collect()] == [2.0, 85.0]


def test_tip_filling(spark):
    rows = [(0.0, 20.0), (0.0, 10.0), (None, 5.0), (2.0, 9.0), (4.0, 30.0), (9.0, 30.0)]
    df = spark.createDataFrame(rows, "propina double, precio_total_est double")
    assert sorted(r[0] for r in imputation.fill_tips(df).select("propina").collect()) == [0.0, 2.0, 4.0, 4.0, 4.0, 9.0]


def test_passenger_draw_follows_the_distribution(spark):
    df = spark.range(20000).selectExpr(
        "id", "case when id % 2 = 0 then null when id % 10 = 1 then 4 when id % 10 = 3 then 2 else 1 end as num_pasajeros"
    )
    out = imputation.fill_passengers(df, "id").where("id % 2 = 0")
    share = {r.num_pasajeros: r["count"] / 10000 for r in out.groupBy("num_pasajeros").count().collect()}
    assert set(share) == {1, 2, 4}
    assert share[1] == pytest.approx(0.6, abs=0.03) and share[4] == pytest.approx(0.2, abs=0.03)


def test_matrix_fills_zero(spark):
    df = spark.createDataFrame([(None, "a")], "x int, s string")
    assert tuple(model_matrix(df, ["x"]).first()) == (0.0, "a")


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "x int, s string")
    assert cleaning.duplicate_rows(df).first()[0] == 3
