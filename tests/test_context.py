import pytest

from urbanflux import contract as C
from urbanflux.operators import context, scoring

KEYS = "origen_id int, mes_num int, dia_semana int, hora int"


def table(spark):
    rows = [
        (1, 1, 0, 8, 10.0, "a", None), (1, 1, 0, 8, 20.0, "b", None), (1, 1, 0, 8, None, "b", None),
        (1, 1, 1, 8, 40.0, "c", None), (1, 2, 2, 8, 60.0, "c", None), (1, 2, 2, 9, 100.0, "d", None),
        (2, 1, 0, 8, 7.0, None, None),
    ]
    df = spark.createDataFrame(rows, KEYS + ", v double, s string, w double")
    return context.context_table(df, ["v", "w", "absent"], ["s"])


def ask(spark, *keys, **kw):
    req = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "id int, " + KEYS)
    out = context.lookup_context(req, table(spark), ["v", "w"], ["s"], **kw).orderBy("id").collect()
    return [(r.nivel_contexto, r.v, r.s) for r in out]


def test_context_table(spark):
    rows = {(r.origen_id, r.mes_num, r.dia_semana, r.hora): r for r in table(spark).collect()}
    first = rows[(1, 1, 0, 8)]
    assert (first.v, first.w, first._n_contexto, first.s) == (15.0, None, 3, "b")
    assert rows[(2, 1, 0, 8)].s is None
    with pytest.raises(ValueError):
        context.context_table(spark.range(1), ["v"])


def test_every_level_is_reached(spark):
    names = [n for n, _ in C.CONTEXT_LEVELS]
    got = ask(
        spark, (1, 1, 0, 8), (1, 1, 6, 8), (1, 9, 2, 8), (1, 9, 6, 8), (1, 9, 6, 23), (99, 1, 0, 8), (None, 1, 0, 8), (1, None, 0, 8)
    )
    assert [g[0] for g in got] == [*names, C.NO_CONTEXT, C.NO_CONTEXT, C.NO_CONTEXT]
    # context rows count equally: 15, 40, 60 and 100
    assert [g[1] for g in got] == [15.0, 27.5, 60.0, 115 / 3, 53.75, None, None, None]
    # ties go to the smallest text
    assert [g[2] for g in got] == ["b", "b", "c", "c", "c", None, None, None]


def test_weighted_levels(spark):
    assert ask(spark, (1, 1, 6, 8), weighted=True)[0][1] == pytest.approx((15 * 3 + 40) / 4)


def test_repeated_requests_keep_their_rows(spark):
    assert len(ask(spark, *[(1, 1, 0, 8)] * 50)) == 50


def test_mode_of_a_wide_column(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (2, None)], "k int, s string")
    assert {(r.k, r.s) for r in context.mode_per_key(df, ["k"], "s").collect()} == {(1, "a")}


def test_defaults(spark):
    df = spark.createDataFrame([(None,)], "ctx_a double")
    assert tuple(context.with_defaults(df, {"a": 3.0, "b": "x"}, "ctx_").first()) == (3.0, "x")


def test_accept_limits(spark):
    # 0.45 * 1 + 0.25 * 0.4 = 0.55 exactly at the limit
    rows = [(4.0, 8.0, 0.0), (4.0, 7.9, 0.0), (100.0, 100.0, 1.0), (0.0, 0.0, 0.6), (0.0, 0.0, 0.61)]
    out = scoring.with_decision(spark.createDataFrame(rows, "p double, v double, r double"), "p", "v", "r").collect()
    assert [r.decision for r in out] == ["ACEPTAR", "RECHAZAR", "ACEPTAR", "RECHAZAR", "RECHAZAR"]
    assert out[2].rentabilidad_score == pytest.approx(1.0)
    assert [r.encadenado for r in out][3:] == ["MODERADA", "ALTA"]


def test_trip_inputs_add_historical_extras(spark):
    means = [c for c in C.CONTEXT_P5_MEANS]
    rows = [(1, 1, 0, 8, *[2.0] * len(means))]
    ctx = spark.createDataFrame(rows, KEYS + "".join(f", {c} double" for c in means)).selectExpr(
        "* except (precio_total_est)", "5.0D as precio_total_est", "1L as _n_contexto"
    )
    req = spark.createDataFrame(
        [(1, 1, 0, 8, 30.0, "2", 8.0), (9, 1, 0, 8, 30.0, "x", 8.0)], KEYS + ", precio_base double, tipo_vehiculo string, hora_float double"
    )
    out = scoring.trip_inputs(req, ctx).orderBy("origen_id").collect()
    assert (out[0].precio_total_est, out[0].tipo_vehiculo, out[0].distancia) == (33.0, "VTC", 2.0)
    assert (out[1].precio_total_est, out[1].tipo_vehiculo, out[1].distancia, out[1].origen_zona) == (32.0, "x", 3.0, "desconocido")


def test_modes_and_means_of_combinations(spark):
    """Modes are counted over all combinations; ties go to the smallest, unknown texts do not count."""
    rows = [(1, "a", "x", 1.0), (1, "a", "y", 2.0), (1, "b", "x", None), (1, None, "x", 4.0), (1, "b", None, 5.0), (2, None, None, None)]
    df = spark.createDataFrame(rows, "k int, s string, t string, v double")
    got = {r.k: r for r in context.context_table(df, ["v"], ["s", "t"], keys=["k"]).collect()}
    assert (got[1].v, got[1]._n_contexto, got[1].s, got[1].t) == (3.0, 5, "a", "x")
    assert (got[2].v, got[2]._n_contexto, got[2].s, got[2].t) == (None, 1, None, None)
