"""Frequent itemsets, association rules and sequential patterns."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.operators.topk import top_per_group


def baskets(df: DataFrame, key: str, item: str) -> DataFrame:
    """Distinct items per key; meant for items of few distinct values."""
    return df.groupBy(key).agg(F.collect_set(item).alias("items"))


def mine(df: DataFrame, support: float, confidence: float, partitions: int | None = None):
    growth = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence)
    if partitions:
        growth = growth.setNumPartitions(partitions)
    return growth.fit(df)


def itemsets(model, smallest: int = 1, largest: int | None = None) -> DataFrame:
    sets = model.freqItemsets.withColumn("size", F.size("items")).filter(
        F.col("size") >= smallest
    )
    if largest is not None:
        sets = sets.filter(F.col("size") <= largest)
    return sets.select(
        F.array_join(F.array_sort("items"), ",").alias("items"), F.col("size").cast("bigint"),
        "freq",
    )


def rules(model) -> DataFrame:
    return model.associationRules.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"),
        F.size("antecedent").cast("bigint").alias("size"),
        F.col("consequent")[0].alias("consequent"),
        "confidence",
    )


def also_bought(model, best: int = 5) -> DataFrame:
    """The best consequents of every single item."""
    single = rules(model).filter(F.col("size") == 1).drop("size")
    return top_per_group(single, ["antecedent"], "confidence", best, ["consequent"])


def sequences(
    df: DataFrame, keys: list[str], step: str, item: str
) -> DataFrame:
    """Sequence of item sets per key, ordered by ``step``.

    A key must span few steps (hours of a day, say); repeated items of a step
    are removed before the sequence is put together.
    """
    sets = df.groupBy(*keys, step).agg(F.array_sort(F.collect_set(item)).alias("_items"))
    ordered = F.array_sort(F.collect_list(F.struct(step, "_items")))
    return sets.groupBy(*keys).agg(
        F.transform(ordered, lambda s: s["_items"]).alias("sequence")
    )


def prefix_span(df: DataFrame, support: float, longest: int) -> DataFrame:
    return PrefixSpan(minSupport=support, maxPatternLength=longest).findFrequentSequentialPatterns(
        df.select("sequence")
    )


def recommended_sequences(patterns: DataFrame, least: int, elements: int = 2) -> DataFrame:
    return patterns.filter((F.col("freq") >= least) & (F.size("sequence") == elements))
