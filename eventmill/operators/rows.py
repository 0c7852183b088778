"""Row filters, projections, routing and sampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def of_type(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == value)


def starting_with(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(F.col(column).contains(part))


def with_pair(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows in which both values are present."""
    return df.dropna(subset=[first, second])


def split_by_threshold(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Tag rows high (above the threshold) or low."""
    return df.withColumn(
        "branch", F.when(F.col(value) > threshold, "high").otherwise("low")
    )


def with_side_output(df: DataFrame, alert: Column) -> DataFrame:
    """Tag rows for the alert output or the main output."""
    return df.withColumn("output", F.when(alert, "alert").otherwise("main"))


def key_range(
    df: DataFrame, key: str, start, stop, columns: Sequence[str]
) -> DataFrame:
    """Scan keys in [start, stop); range and columns reach the file scan."""
    return df.filter((F.col(key) >= start) & (F.col(key) < stop)).select(*columns)


def connect(
    left: DataFrame, left_map: dict[str, Column], right: DataFrame, right_map: dict[str, Column]
) -> DataFrame:
    """Map two differently shaped inputs and merge them; missing columns are null."""
    first = left.select(*[c.alias(n) for n, c in left_map.items()])
    second = right.select(*[c.alias(n) for n, c in right_map.items()])
    return first.unionByName(second, allowMissingColumns=True)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def per_partition(
    df: DataFrame, prepare: Callable[[], object], apply: Callable, schema: str
) -> DataFrame:
    """Arrow batches through ``apply(resource, batch)``; one resource per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = prepare()
        for batch in batches:
            yield apply(resource, batch)

    return df.mapInPandas(run, schema)


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int):
    """Disjoint parts by key hash: the same rows land in the same part on every run."""
    total, position = sum(weights), 0.0
    point = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    parts = []
    for weight in weights:
        upper = position + weight / total
        parts.append(df.filter((point >= position) & (point < upper)))
        position = upper
    return parts
