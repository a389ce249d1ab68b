from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from urbanflux import contract as C
from urbanflux.functions import columns as X


def values(spark, rows, schema, *exprs):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_time_bands_at_their_edges(spark):
    hours = [0, 5, 6, 11, 12, 15, 16, 19, 20, 23, 24, -1]
    got = [r[0] for r in values(spark, [(h,) for h in hours], "h int", X.time_band("h", "plain"))]
    assert got == ["madrugada"] * 2 + ["manana"] * 2 + ["mediodia"] * 2 + ["tarde"] * 2 + ["noche"] * 2 + [None, None]


def test_minutes_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = [(datetime(2025, 3, 9, 1, 30), datetime(2025, 3, 9, 3, 30, 30))]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
        assert df.select(X.minutes_between("a", "b")).first()[0] == 120.5
        floor = df.select(X.floor_minutes("b", 10), X.floor_minutes("b")).first()
        assert floor == (datetime(2025, 3, 9, 3, 30), datetime(2025, 3, 9, 3, 0))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_floor_step_must_divide_the_hour(spark):
    with pytest.raises(ValueError):
        X.floor_minutes("a", 7)


def test_weekday_starts_on_monday(spark):
    rows = [(date(2025, 6, d),) for d in (2, 7, 8)]
    assert values(spark, rows, "d date", X.weekday("d"), X.weekend(X.weekday("d"))) == [(0, 0), (5, 1), (6, 1)]


def test_lenient_types(spark):
    rows = [("1.5",), ("x",), ("",), ("NaN",), (None,)]
    assert [r[0] for r in values(spark, rows, "v string", X.lenient_double("v"))] == [1.5, None, None, None, None]
    assert [r[0] for r in values(spark, [("3.0",), ("4",), ("z",)], "v string", X.lenient_int("v"))] == [3, 4, None]
    assert values(spark, [("2025-01-02 03:04:05",), ("nope",)], "v string", X.lenient_timestamp("v")) == [
        (datetime(2025, 1, 2, 3, 4, 5),), (None,),
    ]


def test_arrival_crosses_sunday_midnight(spark):
    out = X.arrival("h", "d", "m")
    rows = [(23 + 50 / 60, 6, 20.0), (10.0, 2, -5.0), (23.0, 6, 25 * 60.0)]
    got = values(spark, rows, "h double, d int, m double", out["hora"], out["dia_semana"], out["es_fin_semana"])
    assert got == [(0, 0, 0), (10, 2, 0), (0, 1, 0)]


def test_event_impact_limits(spark):
    rows = [("Sport", "999"), ("Sport", "1000"), ("Sport", "4999"), ("Sport", "5000"), ("Sport", "many"), ("Sport", None),
            ("Bike Parade", "1"), ("street fair", None), (None, None)]
    got = [r[0] for r in values(spark, rows, "event_type string, attendance string", X.event_impact())]
    assert got == ["Pequeño", "Medio", "Medio", "Masivo", "Pequeño", "Pequeño", "Masivo", "Medio", "Pequeño"]


def test_text_match_ignores_case_and_accents(spark):
    rows = [("Midtown Center",), ("MÍDTOWN East",), ("Harlem",), (None,)]
    assert [r[0] for r in values(spark, rows, "z string", X.contains_text("z", " midtown"))] == [True, True, False, False]
    assert values(spark, [("Mañana",), ("medio-dia",), ("Medio Dia",)], "b string", X.plain_band("b")) == [
        ("manana",), ("mediodia",), ("mediodia",),
    ]


def test_zone_class_needs_either_end(spark):
    rows = [("JFK Airport", "Harlem"), ("Harlem", "LaGuardia Airport"), (None, "Harlem"), ("jfk", None)]
    expr = X.zone_class(C.AIRPORT_KEYWORDS, "Aeropuerto", "Resto", "a", "b")
    assert [r[0] for r in values(spark, rows, "a string, b string", expr)] == ["Aeropuerto", "Aeropuerto", "Resto", "Aeropuerto"]


def test_vehicle_synonyms(spark):
    rows = [("1",), (" VTC ",), ("Taxi",), ("Limusina",)]
    assert [r[0] for r in values(spark, rows, "v string", X.vehicle_type("v"))] == ["Yellow Taxi", "VTC", "Yellow Taxi", "Limusina"]


def test_weather_flag_is_strict(spark):
    assert [r[0] for r in values(spark, [(0.1,), (0.11,), (None,)], "r double", X.weather_flag("r"))] == [0, 1, 0]
    got = values(spark, [(0, 0.5), (1, 0.0), (None, None)], "l int, p double", X.has_rain("l"), X.has_rain("l", "p"))
    assert got == [(0, 1), (1, 1), (0, 0)]


def test_ratios_survive_zero(spark):
    rows = [(1.0, 0.0), (3.0, 2.0), (None, 1.0)]
    assert [r[0] for r in values(spark, rows, "a double, b double", X.ratio("a", "b"))] == [None, 1.5, None]
    assert [r[0] for r in values(spark, rows, "precio_base double, duracion_min double", X.income_per_minute())] == [0.0, 1.5, None]


def test_month_edges(spark):
    rows = [("2024-02",), ("2025-12",), ("2025-06-09",), ("x",)]
    got = values(spark, rows, "m string", X.month_edge("m"), X.month_edge("m", last=True))
    assert got == [
        (date(2024, 2, 1), date(2024, 2, 29)), (date(2025, 12, 1), date(2025, 12, 31)),
        (date(2025, 6, 9), date(2025, 6, 9)), (None, None),
    ]


def test_requested_hour_is_clamped(spark):
    rows = [("actual",), ("25",), ("-3",), ("7.5",), ("",)]
    now = F.lit(datetime(2025, 1, 1, 6, 30))
    assert [r[0] for r in values(spark, rows, "h string", X.plan_hour("h", now))] == [6.5, 23.99, 0.0, 7.5, 6.5]


def test_log_target_round_trip(spark):
    got = values(spark, [(0,), (9,)], "d int", X.unlog_target(X.log_target("d")))
    assert [round(r[0], 9) for r in got] == [0.0, 9.0]
    assert values(spark, [(-1.0,)], "d double", X.unlog_target("d"))[0][0] == 0.0
