"""Classification, regression, clustering, tuning and persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class WithoutSummary:
    """Fits models that keep no training summary.

    A summary refers to the session, and scoring sends the model to every task: once
    the session has served an ``Observation`` it can no longer be serialised.
    """

    def _create_model(self, java_model):
        nothing = SparkContext._active_spark_context._jvm.scala.Option.empty()
        java_model.setSummary(nothing)
        return super()._create_model(java_model)


class Logistic(WithoutSummary, LogisticRegression):
    pass


class SupportVectors(WithoutSummary, LinearSVC):
    pass


class Forest(WithoutSummary, RandomForestClassifier):
    pass


class Linear(WithoutSummary, LinearRegression):
    pass


class Centres(WithoutSummary, KMeans):
    pass


# Settings of each model in the jobs these stand for.
CLASSIFIERS = {
    "naive_bayes": lambda: NaiveBayes(),
    "decision_tree": lambda: DecisionTreeClassifier(
        impurity="gini", maxDepth=5, maxBins=8, seed=42
    ),
    "random_forest": lambda: Forest(
        numTrees=20, maxDepth=30, maxBins=40, featureSubsetStrategy="sqrt", seed=42
    ),
    "gbt": lambda: GBTClassifier(maxIter=5, seed=42),
    "svm": lambda: SupportVectors(maxIter=100),
    "logistic": lambda: Logistic(maxIter=20, regParam=0.01),
}
REGRESSORS = {
    "decision_tree": lambda: DecisionTreeRegressor(maxDepth=10, maxBins=64, seed=42),
    "random_forest": lambda: RandomForestRegressor(
        numTrees=10, featureSubsetStrategy="onethird", seed=42
    ),
    "linear": lambda: Linear(maxIter=20),
    "lasso": lambda: Linear(maxIter=20, regParam=0.01, elasticNetParam=1.0),
    "ridge": lambda: Linear(maxIter=20, regParam=0.01, elasticNetParam=0.0),
}


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame, params=None) -> DataFrame:
    """Train on one part, predict the other; ``params`` overrides single settings."""
    model = estimator.fit(train, params) if params else estimator.fit(train)
    return model.transform(test)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of an assembled vector's places, from the metadata its column carries."""
    attrs = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    named = sorted((a["idx"], a.get("name", str(a["idx"]))) for kind in attrs.values() for a in kind)
    return [name for _, name in named]


def importances(model, df: DataFrame, column: str = "features") -> DataFrame:
    """(feature, importance) of a tree model; one row per place of the vector."""
    weights = model.featureImportances.toArray()
    names = feature_names(df, column) or [str(i) for i in range(len(weights))]
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def centres(model, df: DataFrame) -> DataFrame:
    """(cluster, size, centre) of a fitted clustering and the rows it was fitted on."""
    found = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    sizes = model.transform(df).groupBy(F.col("prediction").cast("bigint").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size")
    )
    named = df.sparkSession.createDataFrame(found, "cluster bigint, centre array<double>")
    return named.join(sizes, "cluster", "left").select(
        "cluster", F.coalesce("size", F.lit(0)).alias("size"), "centre"
    )


def kmeans(df: DataFrame, k: int = 10, iterations: int = 20, seed: int = 42):
    return Centres(k=k, maxIter=iterations, seed=seed).fit(df)


def nearest_centre(
    df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]], output: str
) -> DataFrame:
    """Number of the nearest of the given centres; ties go to the first."""
    distances = []
    for number, centre in enumerate(centres):
        squares = [(F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(columns, centre)]
        total = squares[0]
        for square in squares[1:]:
            total = total + square
        distances.append(F.struct(total.alias("d"), F.lit(number).alias("n")))
    return df.withColumn(output, F.array_min(F.array(*distances))["n"])


def cross_validated(
    estimator: Estimator, grid: list, evaluator: Evaluator, train: DataFrame, folds: int = 3
):
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
        parallelism=2, seed=42,
    ).fit(train)


def split_validated(
    estimator: Estimator, grid: list, evaluator: Evaluator, train: DataFrame, ratio: float = 0.9
):
    return TrainValidationSplit(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, trainRatio=ratio,
        parallelism=2, seed=42,
    ).fit(train)


def best_settings(validated, scores: Sequence[float], larger_is_better: bool) -> dict[str, str]:
    """Parameter names and values of the best grid point."""
    ranked = max if larger_is_better else min
    best = ranked(range(len(scores)), key=lambda i: scores[i])
    return {p.name: str(v) for p, v in validated.getEstimatorParamMaps()[best].items()}


def save_and_load(model, path: str):
    """Write a model and read it back with its own class."""
    model.write().overwrite().save(path)
    return type(model).load(path)
