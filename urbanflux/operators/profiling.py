"""Column profiles: nulls, moments, percentiles, outliers, categories, correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from ..functions import moments
from ..functions.order_statistics import exact_quantiles
from ..session import closed_domain, written_table

PERCENTILES = (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)


def _rows_per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """One aggregate pass for all columns, then one output row per column."""
    wide = df.agg(*[f(c).alias(f"{c}__{m}") for c in columns for m, f in measures.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in columns
    ])))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percentage of the columns that have any."""
    columns = list(columns or df.columns)
    rows = _rows_per_column(df, columns, {
        "nulos": lambda c: F.count_if(F.col(c).isNull()),
        "filas": lambda c: F.count(F.lit(1)),
    })
    return rows.where("nulos > 0").select(
        "variable", "nulos", (F.col("nulos") / F.col("filas") * 100.0).alias("porcentaje")
    )


def numeric_profile(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = PERCENTILES) -> DataFrame:
    """count, mean, std, min, max and exact percentiles per column."""
    base = _rows_per_column(df, columns, {
        "count": lambda c: F.count(c),
        "mean": lambda c: F.avg(F.col(c).cast("double")),
        "std": lambda c: F.stddev(F.col(c).cast("double")),
        "min": lambda c: F.min(F.col(c).cast("double")),
        "max": lambda c: F.max(F.col(c).cast("double")),
    })
    probs = sorted(probs)
    q = exact_quantiles(df, columns, probs).select(
        "variable", *[F.col(f"q{i}").alias(f"p{round(p * 100):02d}") for i, p in enumerate(probs)]
    )
    return base.join(q, "variable", "left")


def shape_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness and kurtosis."""
    return _rows_per_column(df, columns, {"skew": moments.sample_skewness, "kurtosis": moments.sample_kurtosis})


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values beyond 1.5 interquartile ranges; the percentage is of all rows."""
    q = exact_quantiles(df, columns, (0.25, 0.75)).select(
        "variable",
        (F.col("q0") - 1.5 * (F.col("q1") - F.col("q0"))).alias("inferior"),
        (F.col("q1") + 1.5 * (F.col("q1") - F.col("q0"))).alias("superior"),
    )
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("valor")) for c in columns
    ])))
    outside = (F.col("valor") < F.col("inferior")) | (F.col("valor") > F.col("superior"))
    return (
        values.join(F.broadcast(q), "variable")  # one row per named column
        .groupBy("variable", "inferior", "superior")
        .agg(F.count_if(outside).alias("atipicos"), F.count(F.lit(1)).alias("_n"))
        .select("variable", "inferior", "superior", "atipicos", (F.col("atipicos") / F.col("_n") * 100.0).alias("pct"))
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each categorical column; NULL is a value here."""
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("valor")) for c in columns
    ])))
    return values.groupBy("variable", "valor").agg(F.count(F.lit(1)).alias("n"))


def category_profile(df: DataFrame, columns: Sequence[str], top: int = 15) -> DataFrame:
    """Cardinality and the ``top`` most frequent values per column.

    The cut is a rank filter, which Spark applies per task before the shuffle.
    """
    counts = value_counts(df, columns)
    card = counts.groupBy("variable").agg(F.count("valor").alias("cardinalidad"))
    order = Window.partitionBy("variable").orderBy(F.desc("n"), F.asc_nulls_last("valor"))
    best = counts.withColumn("posicion", F.row_number().over(order)).where(F.col("posicion") <= top)
    return best.join(closed_domain(card), "variable")


def time_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _rows_per_column(df, columns, {"minimo": F.min, "maximo": F.max})


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _centred_ranks(rows: DataFrame, columns: Sequence[str], masks: Sequence[str | None]) -> DataFrame:
    """variable, value, n and centred: per mask the rows of a value and its average rank less the mean rank.

    Mask 0 takes all rows where the column is known, mask k those where ``masks[k]`` is
    known too. Distinct values are counted in one pass and dealt by range of (column,
    value); ranks are running sums within a range after a sum over the ranges before.
    """
    flags = [F.lit(True) if m is None else F.col(f"`{m}`").isNotNull() for m in masks]
    entries = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").alias("value"), *[f.alias(f"m{k}") for k, f in enumerate(flags)]) for c in columns])
    counts = rows.select(F.inline(entries)).where("value is not null").groupBy("variable", "value")
    counts = counts.agg(*[F.count_if(F.col(f"m{k}")).alias(f"n{k}") for k in range(len(masks))])
    spread = counts.repartitionByRange("variable", "value").withColumn("_range", F.spark_partition_id())
    spread = written_table(spread, "value-counts")
    own = [f"n{k}" for k in range(len(masks))]
    totals = spread.groupBy("variable", "_range").agg(*[F.sum(n).alias(f"{n}_all") for n in own])
    before = Window.partitionBy("variable").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("variable")
    ahead = totals.select("variable", "_range", *[F.coalesce(F.sum(f"{n}_all").over(before), F.lit(0)).alias(f"{n}_ahead") for n in own],
                          *[F.sum(f"{n}_all").over(every).alias(f"{n}_total") for n in own])
    within = Window.partitionBy("variable", "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    running = spread.withColumns({f"{n}_within": F.coalesce(F.sum(n).over(within), F.lit(0)) for n in own})
    joined = running.join(ahead, ["variable", "_range"])
    # average rank (before + (n + 1) / 2) less the mean rank ((total + 1) / 2)
    centred = [F.col(f"{n}_ahead") + F.col(f"{n}_within") + (F.col(n) - F.col(f"{n}_total")) / 2.0 for n in own]
    return joined.select("variable", "value", F.array(*own).alias("n"), F.array(*centred).alias("centred"))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every pair of columns over the rows that know both; NULL where one doesn't vary.

    Ranks of all columns come from one table of counted distinct values, so no column of
    the rows is sorted. A pair of columns ranks only rows that know both, which asks for
    one more set of ranks per column that has NULLs (or NaN). The rows meet the ranks of
    their values column by column, Catalyst choosing each join by the table's size, and
    one aggregate sums all products.
    """
    columns = list(columns)
    value = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) + F.lit(0.0)
    rows = written_table(df.select(*[value(c).alias(c) for c in columns]), "numbers")
    known = rows.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in columns]).first()
    masks = [None, *[c for c in columns if known[c] < known["_rows"]]]
    mask_of = {c: masks.index(c) if c in masks else 0 for c in columns}
    ranks = written_table(_centred_ranks(rows, columns, masks), "ranks")
    squares = ranks.select("variable", F.posexplode(F.zip_with("n", "centred", lambda n, r: n * r * r)).alias("mask", "square"))
    squares = written_table(squares.groupBy("variable", "mask").agg(F.sum("square").alias("squares")), "squares")
    ranked = rows
    for at, c in enumerate(columns):
        one = written_table(ranks.where(F.col("variable") == c).select(F.col("value").alias(f"_value{at}"), F.col("centred").alias(f"_rank{at}")), "column-ranks")
        ranked = ranked.join(one, F.col(f"`{c}`") == F.col(f"_value{at}"), "left").drop(f"_value{at}")
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    at = lambda i, j: F.get(F.col(f"_rank{i}"), F.lit(mask_of[columns[j]]))
    sums = ranked.agg(*[F.sum(at(i, j) * at(j, i)).alias(f"_{i}_{j}") for i, j in pairs])
    both = {(i, j) for i, j in pairs} | {(j, i) for i, j in pairs}
    long = sums.select(F.inline(F.array(*[
        F.struct(F.lit(columns[i]).alias("variable_a"), F.lit(columns[j]).alias("variable_b"), F.lit(mask_of[columns[j]]).alias("mask_a"),
                 F.lit(mask_of[columns[i]]).alias("mask_b"), F.col(f"_{min(i, j)}_{max(i, j)}").alias("product"))
        for i, j in sorted(both)
    ])))
    for side in "ab":
        one = squares.select(F.col("variable").alias(f"variable_{side}"), F.col("mask").alias(f"mask_{side}"), F.col("squares").alias(f"squares_{side}"))
        long = long.join(one, [f"variable_{side}", f"mask_{side}"], "left")
    spread = F.sqrt(F.col("squares_a")) * F.sqrt(F.col("squares_b"))
    return long.select("variable_a", "variable_b", F.when(spread > 0, F.col("product") / spread).alias("rho"))
