"""A fitted tree ensemble as a table of nodes, scored and explained without the model.

The table is read from the model's own files in the shared folder, so any SQL engine can
score from it: start at node 0 of each tree, go left where the feature is at most the
threshold, and add weight times value of the leaf. Its size is bounded by the trees and
their depth, whatever the number of rows the model was fitted on.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """arbol, peso, nodo, variable, corte, izquierda, derecha, valor, filas, impureza and ganancia of every node.

    The last stage of ``model`` is a forest or boosted trees for regression. A forest's
    trees weigh one over their number, so that both kinds add up to the prediction. A
    leaf has -1 as its variable and children and no threshold. filas is the weighted
    number of training rows in a node, impureza the variance of their label. The features are numbers or 0/1 columns, which are
    split at 0.5; splits of more than two declared categories are an error.
    """
    ensemble = model.stages[-1]
    path = scratch_path(spark, "trees")
    ensemble.write().save(path)
    # a forest averages its trees, boosting adds them
    share = 1.0 / ensemble.getNumTrees if "Forest" in type(ensemble).__name__ else 1.0
    weights = spark.read.parquet(f"{path}/treesMetadata").select(
        F.col("_1").alias("arbol"), (F.col("_3") * F.lit(share)).alias("peso")
    )
    node, split = F.col("nodeData"), F.col("nodeData.split")
    sums = node["impurityStats"]  # rows, sum and sum of squares of the label
    sides, left = split["leftCategoriesOrThreshold"], node["leftChild"]
    binary = split["numCategories"] == 2
    turned = binary & (F.get(sides, 0) == 1)  # the ones go left: the children change places
    grouped = F.raise_error(F.lit("a split by categories has no threshold")).cast("double")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("arbol"),
        node["id"].alias("nodo"),
        split["featureIndex"].alias("variable"),
        F.when(binary, F.lit(0.5)).when(split["numCategories"] >= 0, grouped)
        .when(split["featureIndex"] >= 0, F.get(sides, 0)).alias("corte"),
        F.when(turned, node["rightChild"]).otherwise(left).alias("izquierda"),
        F.when(turned, left).otherwise(node["rightChild"]).alias("derecha"),
        node["prediction"].alias("valor"),
        sums[0].alias("filas"),
        # MLlib gives no impurity for a leaf that it never tried to split
        (sums[2] / sums[0] - F.pow(sums[1] / sums[0], 2)).alias("impureza"),
        node["gain"].alias("ganancia"),
    )
    return nodes.join(weights, "arbol")


def packed(nodes: DataFrame) -> DataFrame:
    """One row: the trees as an array, each with its weight and its nodes at the places of their numbers."""
    node = F.struct("nodo", "variable", "corte", "izquierda", "derecha", "valor")
    trees = nodes.groupBy("arbol", "peso").agg(F.array_sort(F.collect_list(node)).alias("nodos"))
    return trees.agg(F.array_sort(F.collect_list(F.struct("arbol", "peso", "nodos"))).alias("arboles"))


def ensemble_score(trees: Column, depth: int, features: Column) -> Column:
    """Prediction of packed ``trees`` for an array of features, as a native expression; ``depth`` is the greatest of a tree."""

    def leaf(nodes: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(nodes, at)
            goes_left = F.get(features, node["variable"]) <= node["corte"]
            return F.when(node["variable"] < 0, at).when(goes_left, node["izquierda"]).otherwise(node["derecha"])

        steps = F.sequence(F.lit(1), F.lit(depth)) if depth > 0 else F.array().cast("array<int>")
        return F.get(nodes, F.aggregate(steps, F.lit(0), step))["valor"]

    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + tree["peso"] * leaf(tree["nodos"]))


def score_by_nodes(df: DataFrame, model: PipelineModel, nodes: DataFrame, name: str) -> DataFrame:
    """``df`` with MLlib's prediction as ``_pred`` and the node table's as ``name``; ``df`` has the model's input columns.

    The packed trees are a scalar subquery: computed once and sent to the tasks with the plan.
    """
    depth = model.stages[-1].getOrDefault("maxDepth")
    ready = model.transform(df).withColumn("_array", vector_to_array("features"))
    ready = ready.withColumn("_arboles", packed(nodes).scalar())
    return ready.withColumn(name, ensemble_score(F.col("_arboles"), depth, F.col("_array"))).drop("_array", "_arboles")


def importance(nodes: DataFrame, per_tree: bool) -> DataFrame:
    """variable and its importance: the gains of its splits times their rows, as shares of 1.

    ``per_tree`` first brings each tree to a sum of 1, as for forests; boosted trees add
    their gains as they are. Variables without a split have no row.
    """
    gains = nodes.where("variable >= 0").groupBy("arbol", "variable").agg(F.sum(F.col("ganancia") * F.col("filas")).alias("g"))
    if per_tree:
        trees = gains.groupBy("arbol").agg(F.sum("g").alias("_t")).where("_t > 0")
        gains = gains.join(trees, "arbol").select("variable", (F.col("g") / F.col("_t")).alias("g"))
    each = gains.groupBy("variable").agg(F.sum("g").alias("g"))
    total = each.agg(F.sum("g").alias("t")).scalar()
    return each.select("variable", (F.col("g") / total).alias("importancia"))


def inconsistent_nodes(nodes: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Inner nodes whose rows are not the sum of their children's, or whose gain is not the fall of impurity."""
    child = nodes.select("arbol", "nodo", "filas", "impureza")
    left = child.select("arbol", F.col("nodo").alias("izquierda"), F.col("filas").alias("_fl"), F.col("impureza").alias("_il"))
    right = child.select("arbol", F.col("nodo").alias("derecha"), F.col("filas").alias("_fr"), F.col("impureza").alias("_ir"))
    joined = nodes.where("variable >= 0").join(left, ["arbol", "izquierda"], "left").join(right, ["arbol", "derecha"], "left")
    fall = F.col("impureza") - (F.col("_fl") * F.col("_il") + F.col("_fr") * F.col("_ir")) / F.col("filas")
    rows_off = F.abs(F.col("filas") - F.col("_fl") - F.col("_fr")) > tolerance
    gain_off = F.abs(fall - F.col("ganancia")) > tolerance * F.greatest(F.lit(1.0), F.col("impureza"))
    return joined.where(F.coalesce(rows_off | gain_off, F.lit(True))).select(*nodes.columns)
