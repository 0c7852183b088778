"""Model metrics as aggregates over a stored predictions table."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE, MSE, MAE, R squared and explained variance in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    n = F.count(F.lit(1))
    squared, total = F.sum((y - p) ** 2), F.var_pop(y) * n
    # Mean squared distance of predictions from the label mean, without a second pass.
    explained = F.var_pop(p) + (F.avg(p) - F.avg(y)) ** 2
    return df.agg(
        F.sqrt(squared / n).alias("rmse"),
        (squared / n).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - squared / total).alias("r2"),
        explained.alias("explained_variance"),
    )


def area_under_roc(df: DataFrame, label: str, score: str) -> float:
    """Exact area under the ROC curve (no binning of scores)."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(df)


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("bigint").alias("label"),
        F.col(prediction).cast("bigint").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("cnt"))


def multiclass_metrics(confused: DataFrame) -> DataFrame:
    """Accuracy and weighted F1 from confusion counts (one row per class pair)."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("cnt")).otherwise(0)
    actual = confused.groupBy(F.col("label").alias("class")).agg(
        F.sum("cnt").alias("actual"), F.sum(hit).alias("hits")
    )
    guessed = confused.groupBy(F.col("prediction").alias("class")).agg(
        F.sum("cnt").alias("guessed")
    )
    f1 = 2.0 * F.col("hits") / (F.col("actual") + F.coalesce("guessed", F.lit(0)))
    return actual.join(guessed, "class", "left").agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("weighted_f1"),
    )
