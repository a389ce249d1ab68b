"""MLlib models for demand, good zones, speed and tips."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import contract as C
from ..session import closed_domain, shared_folder


# --- preparation -----------------------------------------------------------------

def model_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Numeric features as doubles with 0 for NULL."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})


def label_dictionary(train: DataFrame, column: str) -> DataFrame:
    """Distinct training values numbered in order; one row per zone or category."""
    values = train.where(F.col(column).isNotNull()).select(column).distinct()
    return values.withColumn("indice", F.row_number().over(Window.orderBy(column)) - 1)


def encode_labels(df: DataFrame, dictionary: DataFrame, column: str, name: str, unseen: int = -1) -> DataFrame:
    """Dictionary number of a value; unseen values are -1 (training) or 0, the first class (scoring)."""
    return (
        df.join(dictionary.withColumnRenamed("indice", name), column, "left")
        .withColumn(name, F.coalesce(F.col(name), F.lit(unseen)))
    )


def category_values(train: DataFrame, column: str) -> list[str]:
    """Sorted categories of a column, as a fitted indexer has them."""
    indexer = StringIndexer(inputCol=column, outputCol="_i", stringOrderType="alphabetAsc", handleInvalid="skip")
    return list(indexer.fit(train).labels)


def dummy_columns(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """0/1 columns per training category, the first dropped; unseen values are all 0."""
    made = {
        f"{c}_{value}": F.coalesce((F.col(c) == value).cast("int"), F.lit(0))
        for c, values in categories.items() for value in values[1:]
    }
    return df.withColumns(made).drop(*categories)


def feature_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Scaled numbers and one-hot categories in one vector; unseen categories are all 0."""
    stages = [
        VectorAssembler(inputCols=list(numeric), outputCol="_num"),
        StandardScaler(inputCol="_num", outputCol="_scaled", withMean=True, withStd=True),
    ]
    parts = ["_scaled"]
    if categorical:
        idx = [f"_idx_{c}" for c in categorical]
        hot = [f"_hot_{c}" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=idx, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=idx, outputCols=hot, handleInvalid="keep", dropLast=True),
        ]
        parts += hot
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight n / (2 * n_class) per row."""
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    k = per_class.agg(F.count(F.lit(1)).alias("k")).scalar()
    return df.join(closed_domain(per_class), label).withColumn("peso", n / (k * F.col("_c"))).drop("_c")


# --- fits --------------------------------------------------------------------------

def fit_demand_forest(
    train: DataFrame, features: Sequence[str] = C.P1_FEATURES, target: str = "target",
    trees: int = 200, depth: int = 12, min_rows: int = 10, seed: int = 42,
) -> PipelineModel:
    rows = model_matrix(train.where(F.col(target).isNotNull()), features)
    forest = RandomForestRegressor(
        labelCol=target, featuresCol="features", predictionCol="_pred", numTrees=trees, maxDepth=depth,
        featureSubsetStrategy="sqrt", minInstancesPerNode=min_rows, seed=seed,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), forest]).fit(rows)


def fit_good_zone_classifier(
    train: DataFrame, features: Sequence[str], target: str = "target", c: float = 1.0, max_iter: int = 500
) -> PipelineModel:
    """Balanced, L2-penalised logistic regression on scaled features."""
    rows = balanced_weights(model_matrix(train, features), target)
    n = rows.count()
    logistic = LogisticRegression(
        labelCol=target, featuresCol="features", weightCol="peso", maxIter=max_iter,
        regParam=1.0 / (c * max(n, 1)), standardization=False, rawPredictionCol="_raw",
        probabilityCol="_prob", predictionCol="_pred",
    )
    return Pipeline(stages=[*feature_stages(features, ()), logistic]).fit(rows)


def fit_ridge(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, alpha: float = 1.0
) -> PipelineModel:
    """Least squares with ``alpha`` times the squared weights.

    The solver divides the label by its deviation but not the penalty by its square, so
    the penalty is given in deviations of the label.
    """
    rows = model_matrix(train.where(F.col(target).isNotNull()), numeric)
    n, spread = rows.agg(F.count(F.lit(1)), F.stddev_pop(F.col(target).cast("double"))).first()
    ridge = LinearRegression(
        labelCol=target, featuresCol="features", predictionCol="_pred", elasticNetParam=0.0,
        regParam=alpha * (spread or 0.0) / max(n, 1), standardization=False,
    )
    return Pipeline(stages=[*feature_stages(numeric, categorical), ridge]).fit(rows)


def fit_boosted_tips(
    train: DataFrame, numeric: Sequence[str] = C.P5_NUMERIC, categorical: Sequence[str] = C.P5_CATEGORICAL,
    target: str = "propina", rounds: int = 200, depth: int = 7, rate: float = 0.1, subsample: float = 0.8,
    seed: int = 42,
) -> PipelineModel:
    """Boosted trees; long boosting chains are cut by checkpoints in the shared folder."""
    shared_folder(train.sparkSession)
    rows = model_matrix(train.where(F.col(target).isNotNull()), numeric)
    boosted = GBTRegressor(
        labelCol=target, featuresCol="features", predictionCol="_pred", maxIter=rounds, maxDepth=depth,
        stepSize=rate, subsamplingRate=subsample, featureSubsetStrategy=str(subsample),
        checkpointInterval=10, seed=seed,
    )
    return Pipeline(stages=[*feature_stages(numeric, categorical), boosted]).fit(rows)


def refit(fit, *parts: DataFrame, **options) -> PipelineModel:
    """Fit again on the union of train, validation and test rows."""
    return fit(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), **options)


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted model with its encoders, in place of what is at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- predictions ---------------------------------------------------------------------

_SCRATCH = (
    "features", "_num", "_scaled", "_raw", "_prob", "_pred",
)


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str], name: str, floor: float | None = 0.0) -> DataFrame:
    """Predicted value, clipped at ``floor``; NULL features count as 0 for the model only."""
    given = [c for c in features if c in df.columns]
    kept = df.withColumns({f"_in_{c}": F.col(c) for c in given})
    out = model.transform(model_matrix(kept, given))
    value = F.col("_pred")
    out = out.withColumn(name, value if floor is None else F.greatest(value, F.lit(floor)))
    return _restore(out, df, given, name)


def predict_probability(model: PipelineModel, df: DataFrame, features: Sequence[str], name: str) -> DataFrame:
    given = [c for c in features if c in df.columns]
    kept = df.withColumns({f"_in_{c}": F.col(c) for c in given})
    out = model.transform(model_matrix(kept, given)).withColumn(name, vector_to_array("_prob")[1])
    return _restore(out, df, given, name)


def _restore(out: DataFrame, df: DataFrame, given: Sequence[str], name: str) -> DataFrame:
    back = [F.col(f"_in_{c}").alias(c) if c in given else F.col(c) for c in df.columns if c != name]
    return out.select(*back, name)


# --- explanation ---------------------------------------------------------------------

def feature_ranking(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importance (trees) or coefficient (linear) per input feature, largest first.

    Names come from the metadata of the feature vector; the ranking itself has one
    row per feature.
    """
    last = model.stages[-1]
    vector = PipelineModel(stages=model.stages[:-1]).transform(df).schema["features"].metadata
    attrs = sorted(
        (a for group in vector["ml_attr"]["attrs"].values() for a in group), key=lambda a: a["idx"]
    )
    names = [a.get("name", str(a["idx"])) for a in attrs]
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(n, float(w), abs(float(w))) for n, w in zip(names, weights.toArray())]
    table = df.sparkSession.createDataFrame(rows, "feature string, peso double, impacto double")
    return table.orderBy(F.desc("impacto"), "feature")
