from datetime import datetime, timedelta

from urbanflux.operators import sequences


def test_hours_around_many_cases(spark):
    """A thousand cases against the rows of their zones, compared with a plain loop."""
    start = datetime(2025, 3, 1, 0, 20)
    rows = [(zone, start + timedelta(hours=h, minutes=zone or 0), h) for zone in (1, 2, None) for h in range(600)]
    cases = [(zone, start + timedelta(hours=h)) for zone in (1, 2) for h in range(0, 1000, 2)]
    df = spark.createDataFrame(rows, "origen_id int, timestamp_hora timestamp_ntz, demanda int")
    asked = spark.createDataFrame(cases, "origen_id int, timestamp_hora timestamp_ntz")
    got = sequences.around_cases(df, asked)
    assert got.columns == ["origen_id", "timestamp_hora", "demanda", "caso"]
    near = lambda t, c: c - timedelta(hours=12) <= t <= c + timedelta(hours=11)
    want = [(z, t, d, c) for zone, c in cases for z, t, d in rows if z == zone and near(t, c)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
