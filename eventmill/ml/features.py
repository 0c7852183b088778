"""Feature preparation on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Imputer,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
    Word2Vec,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.scalar import normalize_tokens


def index_categories(df: DataFrame, column: str, output: str) -> DataFrame:
    """Category numbers in alphabetical order, from zero."""
    indexer = StringIndexer(
        inputCol=column, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return indexer.fit(df).transform(df)


def one_hot(df: DataFrame, index: str, output: str) -> DataFrame:
    encoder = OneHotEncoder(inputCol=index, outputCol=output, dropLast=False)
    return encoder.fit(df).transform(df)


def from_one_hot(flags: Sequence[str]) -> Column:
    """The position of the set flag among one-hot columns."""
    return F.array_position(F.array(*flags), F.lit(1)) - 1


def mean_impute(df: DataFrame, column: str, output: str) -> DataFrame:
    return Imputer(strategy="mean", inputCol=column, outputCol=output).fit(df).transform(df)


def age_group(age: str) -> Column:
    """Fixed age limits: 61, 26 and 16 years."""
    years = F.col(age)
    return (
        F.when(years >= 61, "old").when(years >= 26, "middle").when(years >= 16, "young")
        .otherwise("child")
    )


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def index_vector(
    df: DataFrame, features: str, output: str, max_categories: int = 40
) -> DataFrame:
    """Treat vector slots with few distinct values as categories."""
    indexer = VectorIndexer(inputCol=features, outputCol=output, maxCategories=max_categories)
    return indexer.fit(df).transform(df)


def array_features(df: DataFrame, array: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(array).cast("array<double>")))


def tokenized(df: DataFrame, text: str, output: str = "tokens") -> DataFrame:
    return df.withColumn(output, normalize_tokens(text))


def hashed_idf(
    df: DataFrame, tokens: str, output: str = "features", size: int = 100_000
) -> DataFrame:
    """Hashed term frequencies weighted by inverse document frequency."""
    stages = [
        HashingTF(inputCol=tokens, outputCol="_tf", numFeatures=size),
        IDF(inputCol="_tf", outputCol=output),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop("_tf")


def summed_values(vector: str) -> Column:
    """Sum of a sparse or dense vector's stored values; it is not made dense."""
    return F.aggregate(F.unwrap_udt(vector)["values"], F.lit(0.0), lambda a, x: a + x)


def term_weights(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """Document frequency and weight ln((n + 1) / (df + 1)) of every term."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.select(key, F.explode(F.array_distinct(tokens)).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        .withColumn("idf", F.log((total + 1.0) / (F.col("df") + 1.0)))
    )


def word_counts(df: DataFrame, tokens: str) -> DataFrame:
    """Occurrences of every word, as ``w`` and ``count``.

    Each Arrow batch is counted by itself first, so that Spark groups the distinct words of
    batches instead of a row for every word.
    """
    def counted(batches):
        for batch in batches:
            words = batch.column(0).flatten().value_counts()
            yield pa.RecordBatch.from_arrays(
                [words.field("values"), words.field("counts")], ["w", "n"]
            )

    parts = df.select(tokens).mapInArrow(counted, "w string, n long")
    return parts.groupBy("w").agg(F.sum("n").alias("count"))


def word_vectors(
    df: DataFrame, tokens: str, size: int = 16, partitions: int | None = None, seed: int = 42,
    least: int = 5,
):
    """Word2Vec model, trained on as many partitions as the cluster has cores by default.

    Words seen fewer than ``least`` times get no vector. Longer texts are cut into
    sentences of 1,000 words, none of which is dropped.
    """
    partitions = partitions or df.sparkSession.sparkContext.defaultParallelism
    return Word2Vec(
        inputCol=tokens, outputCol="vector", vectorSize=size, minCount=least, seed=seed,
        numPartitions=partitions, maxSentenceLength=1000,
    ).fit(df)
