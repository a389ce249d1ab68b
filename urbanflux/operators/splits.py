"""Samples and train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import contract as C
from ..functions import columns as X
from ..functions.order_statistics import exact_quantiles, keys_at_ranks


def fraction_sample(df: DataFrame, percent: int, *key: str) -> DataFrame:
    """A reproducible share of the rows, chosen by a hash of their key."""
    return df.where(X.hash_percent(*key) < percent)


def hash_levels(key: Sequence[str]) -> list[tuple[str, Column]]:
    h = X.hash32(*key)
    return [
        ("_h16", F.shiftrightunsigned(h, 16)),
        ("_h32", h),
        *[(f"_k{i}", F.col(k)) for i, k in enumerate(key)],
    ]


def capped_sample(df: DataFrame, n: int, *key: str) -> DataFrame:
    """At most ``n`` rows, those with the lowest hash of a unique key.

    The cut is the key of row ``n`` in hash order, found by two counting scans; the rows
    are then filtered in place, so no task ever holds the sample.
    """
    levels = hash_levels(key)
    names = [name for name, _ in levels]
    last = F.least(F.lit(n), F.col("n")) - 1
    cut = keys_at_ranks(df, levels, [last]).select(F.struct(*names).alias("k"))
    here = F.struct(*[expr.alias(name) for name, expr in levels])
    return df.where(here <= cut.scalar())


# --- by time range ----------------------------------------------------------

def time_cuts(df: DataFrame, ts: str = "fecha_inicio", minutes: int = 60, shares: Sequence[float] = C.TIME_SPLIT) -> DataFrame:
    """One row with the cut times at given shares of the time range, floored."""
    span = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    seconds = X.minutes_between("a", "b") * 60.0
    cuts = [
        X.floor_minutes(
            F.col("a") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (seconds * F.lit(s)).cast("decimal(18,6)")),
            minutes,
        ).alias(name)
        for s, name in zip(shares, ("corte_train", "corte_val"))
    ]
    return span.select(*cuts)


def cut_columns(cuts: DataFrame) -> tuple[Column, Column]:
    both = cuts.select(F.struct("corte_train", "corte_val").alias("c"))
    return both.scalar()["corte_train"], both.scalar()["corte_val"]


def split_by_time(df: DataFrame, ts: str, cuts: tuple[Column, Column]) -> DataFrame:
    first, second = cuts
    t = F.col(ts)
    return df.withColumn("split", F.when(t < first, "train").when(t < second, "val").otherwise("test"))


def split_by_month(df: DataFrame, month: str = "mes_num") -> DataFrame:
    m = F.col(month)
    return df.withColumn(
        "split", F.when(m.isin(*C.TEST_MONTHS), "test").when(m.isin(*C.VAL_MONTHS), "val").otherwise("train")
    )


# --- by position ------------------------------------------------------------

def split_by_position(
    df: DataFrame, ts: str, key: Sequence[str], shares: Sequence[float] = (0.70, 0.15)
) -> DataFrame:
    """First 70 % of the rows in time order train, next 15 % val, the rest test.

    Equal times are ordered by a hash of the unique key. The two boundary rows are
    found by counting seconds, then times and hashes of the boundary seconds, and the
    split is then a comparison with their keys: the trips are neither sorted nor shuffled.
    """
    t = F.col(ts)
    (_, high), *low = hash_levels(key)
    levels = [
        ("_d", F.to_date(t)),
        ("_s", F.date_trunc("second", t).cast("timestamp_ntz")),
        ("_t", F.struct(t.alias("t"), high.alias("h"))),
        ("_k", F.struct(*[expr.alias(name) for name, expr in low])),
    ]
    names = [name for name, _ in levels]
    totals = [sum(shares[: i + 1]) for i in range(len(shares))]
    # the last row of each part; an empty part has rank -1 and no boundary row
    ranks = [F.floor(F.col("n") * F.lit(s)) - 1 for s in totals]
    cuts = keys_at_ranks(df, levels, ranks, coarse=2)
    rows = cuts.agg(*[
        F.max(F.when(F.col("corte") == i, F.struct(*names))).alias(f"c{i}") for i in range(len(ranks))
    ]).select(F.struct("c0", "c1").alias("c"))
    here = F.struct(*[expr.alias(name) for name, expr in levels])
    upto = [F.coalesce(here <= rows.scalar()[f"c{i}"], F.lit(False)) for i in range(len(ranks))]
    return df.withColumn("split", F.when(upto[0], "train").when(upto[1], "val").otherwise("test"))


# --- checks and summaries ---------------------------------------------------

def split_overlap(df: DataFrame, ts: str) -> DataFrame:
    """True per boundary when the earlier split ends before the later one starts."""
    edge = lambda name, f: f(F.when(F.col("split") == name, F.col(ts)))
    ends = df.agg(
        edge("train", F.max).alias("a1"), edge("val", F.min).alias("b0"),
        edge("val", F.max).alias("b1"), edge("test", F.min).alias("c0"),
    )
    return ends.select(
        (F.col("a1") < F.col("b0")).alias("train_antes_de_val"),
        (F.col("b1") < F.col("c0")).alias("val_antes_de_test"),
    )


def split_summary(df: DataFrame, ts: str, target: str) -> DataFrame:
    """Rows, share, time range and target statistics per split of a feature table."""
    per_split = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("filas"),
        F.min(ts).alias("fecha_inicio"),
        F.max(ts).alias("fecha_fin"),
        F.avg((F.col(target) > 0).cast("int")).alias("tasa_positiva"),
        F.avg(target).alias("media"),
        F.stddev(target).alias("std"),
        F.min(F.col(target).cast("double")).alias("min"),
        F.max(F.col(target).cast("double")).alias("max"),
    )
    quartiles = exact_quantiles(df, [target], [0.25, 0.5, 0.75], by=["split"]).drop("variable", "n")
    per_split = per_split.join(quartiles, "split", "left")
    total = F.sum("filas").over(Window.partitionBy())
    days = F.floor(X.minutes_between("fecha_inicio", "fecha_fin") / 1440.0).cast("int")
    return per_split.select(
        "split", "filas", (F.col("filas") / total * 100.0).alias("pct"),
        "fecha_inicio", "fecha_fin", days.alias("dias"), "tasa_positiva", "media", "std", "min", "max",
        F.col("q0").alias("p25"), F.col("q1").alias("mediana"), F.col("q2").alias("p75"),
    )
