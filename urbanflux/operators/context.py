"""Historical context tables and the lookup that falls back to coarser keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C

_ANY = -1  # stands for "not part of this level" in a level key


def context_table(
    df: DataFrame,
    means: Sequence[str],
    modes: Sequence[str] = (),
    keys: Sequence[str] = C.CONTEXT_KEYS,
) -> DataFrame:
    """Mean of each numeric column, most frequent text and row count per key.

    Ties between texts go to the smallest. Rows are first reduced to one per key and
    combination of texts, with sums and counts; these are then counted per text, and
    the last step only compares counts, so no buffer holds the texts of a hot key.
    Columns the table lacks are left out; a missing key is an error.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"context keys missing: {missing}")
    means, modes = [c for c in means if c in df.columns], [c for c in modes if c in df.columns]
    by_key = df.groupBy(*[F.col(k).cast("int").alias(k) for k in keys], *[F.col(c).alias(f"_t_{c}") for c in modes])
    if not modes:
        return by_key.agg(*[F.avg(c).alias(c) for c in means], F.count(F.lit(1)).alias("_n_contexto"))

    parts = by_key.agg(
        F.count(F.lit(1)).alias("_n"),
        *[x for c in means for x in (F.sum(F.col(c).cast("double")).alias(f"_s_{c}"), F.count(c).alias(f"_c_{c}"))],
    )
    # One row per text of a combination; the sums travel with the first of them only.
    sums = ["_n", *[f"_{x}_{c}" for c in means for x in "sc"]]
    texts = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"_t_{c}").cast("string").alias("_text")) for i, c in enumerate(modes)])
    spread = parts.select(*keys, *sums, F.inline(texts))
    counted = spread.groupBy(*keys, "_i", "_text").agg(*[F.sum(c).alias(c) for c in sums])
    only = lambda c: F.sum(F.when(F.col("_i") == 0, F.col(c)))
    order = F.struct(-F.col("_n"), F.col("_text"))
    kinds = dict(df.dtypes)
    return counted.groupBy(*keys).agg(
        *[F.try_divide(only(f"_s_{c}"), only(f"_c_{c}")).alias(c) for c in means],
        only("_n").alias("_n_contexto"),
        *[
            F.min_by("_text", F.when((F.col("_i") == i) & F.col("_text").isNotNull(), order)).cast(kinds[c]).alias(c)
            for i, c in enumerate(modes)
        ],
    )


def mode_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value per key for a column of any cardinality.

    Values are counted first, so a hot key spreads over its values and the second
    step only compares counts.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("c"), F.col(column))).alias(column))


def level_table(
    context: DataFrame, means: Sequence[str], modes: Sequence[str] = (), weighted: bool = False
) -> DataFrame:
    """All five fallback levels in one grouping-sets pass over the context table.

    Context rows count equally unless ``weighted``, which uses their trip counts.
    """
    keys = list(C.CONTEXT_KEYS)
    if weighted:
        n = F.col("_n_contexto")
        mean = lambda c: F.try_divide(F.sum(F.col(c) * n), F.sum(F.when(F.col(c).isNotNull(), n)))
    else:
        mean = F.avg
    sets = [[F.col(k) for k in level] for _, level in C.CONTEXT_LEVELS]
    grouped = context.groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).alias("_gid"),
        *[mean(c).alias(c) for c in means],
        F.avg("_n_contexto").alias("_n_contexto"),
        F.count(F.lit(1)).alias("_filas"),
        *[F.mode(c, True).alias(c) for c in modes],
    )
    number = None
    for i, (_, level) in enumerate(C.CONTEXT_LEVELS):
        gid = sum(1 << (len(keys) - 1 - j) for j, k in enumerate(keys) if k not in level)
        hit = F.col("_gid") == gid
        number = F.when(hit, i) if number is None else number.when(hit, i)
    return grouped.withColumns({
        "_nivel": number, **{k: F.coalesce(F.col(k), F.lit(_ANY)) for k in keys},
    }).drop("_gid")


def lookup_context(
    requests: DataFrame,
    context: DataFrame,
    means: Sequence[str],
    modes: Sequence[str] = (),
    on: Mapping[str, str] | None = None,
    prefix: str = "",
    weighted: bool = False,
) -> DataFrame:
    """Attach to each request the most specific context that is not empty.

    Only the distinct keys of the requests go through the five levels; the requests
    themselves are joined once, to their resolved key. ``nivel_contexto`` names the
    level used. ``on`` maps context keys to request columns.
    """
    keys = list(C.CONTEXT_KEYS)
    on = {k: (on or {}).get(k, k) for k in keys}
    levels = level_table(context, means, modes, weighted)
    values = [*means, "_n_contexto", "_filas", *modes]

    asked = requests.select(*[F.col(on[k]).cast("int").alias(k) for k in keys]).dropna().distinct()
    tries = asked.select(*[F.col(k).alias(f"_q_{k}") for k in keys], F.inline(F.array(*[
        F.struct(F.lit(i).alias("_nivel"), *[
            (F.col(k) if k in level else F.lit(_ANY)).alias(k) for k in keys
        ]) for i, (_, level) in enumerate(C.CONTEXT_LEVELS)
    ])))
    found = (
        tries.join(levels, ["_nivel", *keys])
        .groupBy(*[f"_q_{k}" for k in keys])
        .agg(
            F.min("_nivel").alias("_nivel"),
            F.min_by(F.struct(*values), F.col("_nivel")).alias("_v"),
        )
    )
    label = F.get(F.array(*[F.lit(n) for n, _ in C.CONTEXT_LEVELS]), F.col("_nivel"))
    resolved = found.select(
        *[F.col(f"_q_{k}") for k in keys],
        label.alias("nivel_contexto"),
        *[F.col(f"_v.{c}").alias(f"{prefix}{c}") for c in values],
    )
    match = [F.col(on[k]).cast("int") == F.col(f"_q_{k}") for k in keys]
    joined = requests.join(resolved, match, "left").drop(*[f"_q_{k}" for k in keys])
    return joined.withColumn("nivel_contexto", F.coalesce("nivel_contexto", F.lit(C.NO_CONTEXT)))


def default_value(column: str, defaults: Mapping[str, object]) -> Column:
    return F.coalesce(F.col(column), F.lit(defaults[column]))


def with_defaults(df: DataFrame, defaults: Mapping[str, object], prefix: str = "") -> DataFrame:
    """A safe value for every context column that is missing or NULL."""
    changes = {}
    for name, value in defaults.items():
        c = f"{prefix}{name}"
        changes[c] = F.coalesce(F.col(c), F.lit(value)) if c in df.columns else F.lit(value)
    return df.withColumns(changes)
