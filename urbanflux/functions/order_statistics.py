"""Exact order statistics without sorting or collecting the data in one place.

The built-in ``percentile`` keeps every distinct value of a group in one buffer,
which is fine for summaries (a few rows per group) and wrong for trips. Here values
are counted per cell of a fixed logarithmic grid, which gives the exact rank of every
cell's edges; only the values of the cells that hold a wanted rank are counted one by
one, and only those of one narrow bin are ranked. Every size takes the same two passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import closed_domain, written_table

# cells per doubling of a value; an offset above the cells of the smallest double
_CELLS = 256
_OFFSET = 300_000
_BINS = 1024


def _cell(value: Column) -> Column:
    """Number of the grid cell of a double; never falls as the value rises."""
    size = F.abs(value)
    step = F.floor(F.log2(size) * _CELLS) + _OFFSET
    cell = F.when(size == float("inf"), F.lit(2 * _OFFSET)).otherwise(step)
    cell = F.when(value < 0, -cell).when(value == 0, F.lit(0)).otherwise(cell)
    return F.when(F.isnan(value), F.lit(3 * _OFFSET)).otherwise(cell).cast("int")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolated quantiles, one row per group and column.

    Returns ``by..., variable, n, q0, q1, ...`` with one ``q`` per entry of
    ``probs``; NULLs are ignored and a group or column without values has no row. NaN
    counts as the largest value. ``by`` may be any columns. The cells that hold a wanted
    rank are a stored table, two at most per group, column and entry of ``probs``, so
    that Catalyst sends them to every task only if they are few. Cells that overlap,
    which a grid that is not monotone would have, raise an error instead of a wrong rank.
    """
    by = list(by)
    probs = sorted(float(p) for p in probs)
    keys = [*by, "variable"]

    entries = F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("valor")) for c in columns
    ])
    values = df.select(*by, F.inline(entries)).where(F.col("valor").isNotNull()).withColumn("_cell", _cell(F.col("valor")))

    groups = Window.partitionBy(*keys)
    upward = groups.orderBy("_cell")
    ranks = F.array(*[
        rank for p in probs for rank in (
            F.floor((F.col("n") - 1) * F.lit(p)), F.ceil((F.col("n") - 1) * F.lit(p))
        )
    ])
    cells = values.groupBy(*keys, "_cell").agg(
        F.count(F.lit(1)).alias("c"), F.min("valor").alias("_lo"), F.max("valor").alias("_hi")
    )
    below = F.sum("c").over(upward) - F.col("c")
    apart = F.coalesce(F.lag("_hi").over(upward) < F.col("_lo"), F.lit(True))
    checked = F.when(apart, below).otherwise(F.raise_error(F.lit("cells of the quantile grid overlap")).cast("bigint"))
    hits = (
        cells.withColumns({"n": F.sum("c").over(groups), "_below": checked})
        .withColumn("_ranks", F.filter(
            F.array_distinct(ranks), lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("c"))
        ))
        .where(F.size("_ranks") > 0)
        .drop("c")
    )
    hits = written_table(hits, "quantile_cells")

    # the values of the hit cells, counted one by one inside equal-width bins of the cell
    same = F.col("_c") == F.col("_cell")
    for k in keys:
        same = same & F.col(f"_k_{k}").eqNullSafe(F.col(k))
    found = hits.withColumnsRenamed({"_cell": "_c", **{k: f"_k_{k}" for k in keys}})
    bin_no = F.try_divide((F.col("valor") - F.col("_lo")) * _BINS, F.col("_hi") - F.col("_lo"))
    inside = values.join(found, same).withColumn("_bin", F.coalesce(F.nanvl(bin_no, F.lit(0.0)), F.lit(0.0)).cast("int"))
    counted = inside.groupBy(*keys, "_cell", "_bin", "valor", "n", "_below", "_ranks").agg(F.count(F.lit(1)).alias("c"))
    counted = written_table(counted, "quantile_values")
    bins = counted.groupBy(*keys, "_cell", "_bin").agg(F.sum("c").alias("_held"))
    ahead = F.sum("_held").over(Window.partitionBy(*keys, "_cell").orderBy("_bin")) - F.col("_held")
    bins = bins.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_cell").alias("_c"), F.col("_bin").alias("_b"), ahead.alias("_ahead")
    )
    placed = counted.join(bins, same & (F.col("_b") == F.col("_bin")))
    upto = F.sum("c").over(Window.partitionBy(*keys, "_cell", "_bin").orderBy("valor"))
    picked = (
        placed.withColumn("_upto", F.col("_below") + F.col("_ahead") + upto)
        .withColumn("_rank", F.explode("_ranks"))
        .where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("c") <= F.col("_rank")))
    )

    by_rank = F.map_from_entries(F.collect_list(F.struct("_rank", "valor")))
    rows = picked.groupBy(*keys, "n").agg(by_rank.alias("_values"))
    out = []
    for i, p in enumerate(probs):
        position = (F.col("n") - 1) * F.lit(p)
        low = F.element_at("_values", F.floor(position))
        high = F.element_at("_values", F.ceil(position))
        out.append((low + (high - low) * (position - F.floor(position))).alias(f"q{i}"))
    return rows.select(*keys, "n", *out)


def exact_quantile(df: DataFrame, column: str, prob: float) -> Column:
    """One exact quantile of a whole table as a scalar subquery."""
    return exact_quantiles(df, [column], [prob]).select("q0").scalar()


def keys_at_ranks(
    df: DataFrame, levels: Sequence[tuple[str, Column]], ranks: Sequence[Column], coarse: int = 1
) -> DataFrame:
    """The ordering key of the rows at given 0-based ranks, one row per rank.

    ``levels`` refine the order step by step (day, second, exact time, hash range,
    id, ...). Two scans count rows, however many levels there are: the first by the
    ``coarse`` first levels, whose values must be few beside the rows; the second by the
    whole key, only below the prefixes that hold a wanted rank, for all ranks at once.
    Both counts are stored, and each level is looked up in them under the prefix found
    so far, so no window holds more than one level's values below one prefix. ``ranks``
    are expressions of ``n``, the row count. Returns ``corte, n, rango, <levels...>``.
    """
    names = [name for name, _ in levels]
    keyed = df.select(*[expr.alias(name) for name, expr in levels])
    head = names[:coarse]
    counted = written_table(keyed.groupBy(*head).agg(F.count(F.lit(1)).alias("c")), "rank_counts")

    first = names[0]
    counts = counted.groupBy(first).agg(F.sum("c").alias("c"))
    everything = Window.partitionBy()
    wanted = F.posexplode(F.array(*[r.cast("bigint") for r in ranks]))
    found = (
        counts.withColumn("n", F.sum("c").over(everything))
        .withColumn("_below", F.sum("c").over(everything.orderBy(first)) - F.col("c"))
        .select("c", "n", "_below", first, wanted.alias("corte", "_rank"))
        .withColumn("rango", F.col("_rank"))
    )
    hit = (F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("c"))
    found = found.where(hit).select(
        "corte", "n", "rango", first, (F.col("_rank") - F.col("_below")).alias("_rank")
    )

    for depth in range(1, len(names)):
        prefix, name = names[:depth], names[depth]
        if depth == coarse:
            found = written_table(found, "rank_prefixes")
            inside = keyed.join(closed_domain(found.select(*prefix).distinct()), prefix)
            counted = written_table(inside.groupBy(*names).agg(F.count(F.lit(1)).alias("c")), "rank_counts")
        carried = ["corte", "n", "rango", *prefix, "_rank"]
        counts = (
            counted.join(closed_domain(found), prefix)
            .groupBy(*carried, name)
            .agg(F.sum("c").alias("c"))
        )
        order = Window.partitionBy("corte").orderBy(name)
        found = (
            counts.withColumn("_below", F.sum("c").over(order) - F.col("c"))
            .where(hit)
            .select("corte", "n", "rango", *prefix, name, (F.col("_rank") - F.col("_below")).alias("_rank"))
        )
    return written_table(found.drop("_rank"), "rank_keys")


def score_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score with totals of all higher scores.

    Rows are first counted per score. The distinct scores are then dealt by range, each
    range with about as many of them wherever the scores lie, and accumulated in two
    steps: over the ranges, then inside each.
    """
    per_score = (
        df.select(F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("y"))
        .where(F.col("score").isNotNull() & F.col("y").isNotNull())
        .groupBy("score")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )
    dealt = per_score.repartitionByRange(F.desc("score")).withColumn("_range", F.spark_partition_id())
    dealt = written_table(dealt, "scores")
    above = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_range").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("_on"),
        F.sum("bp").over(Window.partitionBy()).alias("total_pos"),
        F.sum("bn").over(Window.partitionBy()).alias("total_neg"),
    )
    higher = Window.partitionBy("_range").orderBy(F.desc("score"))
    return (
        dealt.join(offsets, "_range")
        .withColumn("cum_pos", F.col("_op") + F.sum("pos").over(higher))
        .withColumn("cum_neg", F.col("_on") + F.sum("neg").over(higher))
        .select("score", "pos", "neg", "cum_pos", "cum_neg", "total_pos", "total_neg")
    )
