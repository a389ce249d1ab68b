"""Origin-destination flows as edge lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_counts(trips: DataFrame, origin: str, destination: str) -> DataFrame:
    """Trips per known pair."""
    known = trips.where(F.col(origin).isNotNull() & F.col(destination).isNotNull())
    return known.groupBy(origin, destination).agg(F.count(F.lit(1)).alias("viajes"))


def top_routes(trips: DataFrame, origin: str, destination: str, k: int) -> DataFrame:
    return pair_counts(trips, origin, destination).orderBy(F.desc("viajes"), origin, destination).limit(k)


def od_matrix(pairs: DataFrame, origin: str, destination: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Pair counts as a matrix, missing pairs 0. Naming the columns saves a job."""
    wide = pairs.groupBy(origin).pivot(destination, list(columns) if columns else None)
    return wide.agg(F.sum("viajes")).fillna(0)


def matrix_cells(matrix: DataFrame, origin: str, destination: str) -> DataFrame:
    """The cells of an origin-destination matrix, one row each."""
    return matrix.unpivot([origin], [F.col(f"`{c}`") for c in matrix.columns if c != origin], destination, "viajes")


def zone_nodes(trips: DataFrame) -> DataFrame:
    """Every zone that appears at either end."""
    ends = trips.select(F.explode(F.array("origen_id", "destino_id")).alias("zona_id"))
    return ends.where(F.col("zona_id").isNotNull()).distinct()


def flow_edges(trips: DataFrame, prob: float = 0.75) -> DataFrame:
    """Both directions of the pairs with more trips than the quantile of all pairs.

    There are at most zones x zones pairs.
    """
    pairs = pair_counts(trips, "origen_id", "destino_id")
    strong = pairs.where(F.col("viajes") > pairs.agg(F.percentile("viajes", F.lit(prob)).alias("q")).scalar())
    both = strong.select(F.inline(F.array(
        F.struct(F.col("origen_id").alias("src"), F.col("destino_id").alias("dst")),
        F.struct(F.col("destino_id").alias("src"), F.col("origen_id").alias("dst")),
    )))
    return both.distinct()


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Neighbours per zone, self-loops left out, isolated zones 0."""
    out = edges.where("src <> dst").groupBy(F.col("src").alias("zona_id")).agg(F.count(F.lit(1)).alias("vecinos"))
    return nodes.join(out, "zona_id", "left").withColumn("vecinos", F.coalesce("vecinos", F.lit(0)))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes, undirected edges, mean degree and the zone with most neighbours."""
    return degrees(nodes, edges).agg(
        F.count(F.lit(1)).alias("nodos"),
        (F.sum("vecinos") / 2).cast("bigint").alias("conexiones"),
        F.avg("vecinos").alias("media_vecinos"),
        F.min_by("zona_id", F.struct(-F.col("vecinos"), F.col("zona_id"))).alias("zona_max"),
        F.max("vecinos").alias("vecinos_max"),
    )


def neighbours(edges: DataFrame, zones: DataFrame, zone_id: int | None = None) -> DataFrame:
    """Neighbours with names, of one zone or of all."""
    pairs = edges.where("src <> dst")
    if zone_id is not None:
        pairs = pairs.where(F.col("src") == zone_id)
    names = zones.select(
        F.col("LocationID").alias("dst"),
        F.concat("Zone", F.lit(" ("), "Borough", F.lit(")")).alias("vecino"),
    )
    unknown = F.concat(F.lit("Zona ID "), F.col("dst").cast("string"))
    return pairs.join(names, "dst", "left").select("src", "dst", F.coalesce("vecino", unknown).alias("vecino"))


def neighbour_average(nodes: DataFrame, edges: DataFrame, features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean feature over the neighbours of each zone, 0 for isolated zones."""
    side = features.select(F.col("zona_id").alias("dst"), *columns)
    mixed = edges.join(side, "dst").groupBy(F.col("src").alias("zona_id")).agg(
        *[F.avg(c).alias(c) for c in columns]
    )
    return nodes.join(mixed, "zona_id", "left").fillna(0.0, subset=list(columns))
