"""Table sinks that can be run again after a failure without duplicating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def save_text(df: DataFrame, line: Column, path: str) -> None:
    """Text lines, unless the path already exists."""
    df.select(line.cast("string").alias("value")).write.mode("ignore").text(path)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Replace the result table of the last run."""
    df.write.mode("overwrite").format(fmt).options(**options).save(path)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Last written values per key: what a hash store holds after all writes."""
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


def upserted(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Table after insert-or-update: untouched old rows plus one update per key.

    Of several updates of a key the one that is last by ``order`` counts; updates that
    are equal in ``order`` fall to the larger values.
    """
    values = [c for c in current.columns if c not in keys]
    newest = latest_per_key(updates, keys, [*order, *values], values)
    untouched = current.join(newest.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(newest.select(*current.columns))


def upsert_to_version(
    current: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    path: str,
    version: int,
) -> str:
    """Write the upserted table as a new version folder and return it.

    Readers keep the old version until the new one is complete; writing the same
    version again replaces it.
    """
    target = f"{path}/version={version}"
    upserted(current, updates, keys, order).write.mode("overwrite").parquet(target)
    return target


def save_by_day(df: DataFrame, day: str, path: str) -> None:
    """Load day partitions; a second run of a day replaces that day only.

    Rebalancing gathers the rows of a day into few files, while AQE splits a day
    that is too big for one task.
    """
    (
        df.hint("rebalance", F.col(day)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    )


def save_by_route(df: DataFrame, route: str, path: str) -> None:
    """One folder per route; AQE splits big routes over several files."""
    df.hint("rebalance", F.col(route)).write.mode("overwrite").partitionBy(route).parquet(path)


def cells(
    df: DataFrame, row_key: str, family: str, columns: Sequence[str]
) -> DataFrame:
    """Explode records to (row_key, family, qualifier, value); nulls make no cell."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(
            F.col(row_key).cast("string").alias("row_key"), F.lit(family).alias("family"),
            F.explode(pairs).alias("_cell"),
        )
        .select("row_key", "family", "_cell.*")
        .filter(F.col("value").isNotNull())
    )


def sort_for_key_store(
    df: DataFrame, keys: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Range-partitioned and sorted by key: files with disjoint, ordered key ranges.

    With all keys in the range bounds, even one hot leading key is split.
    """
    ranged = (
        df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    )
    return ranged.sortWithinPartitions(*keys)


def messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as queue messages: JSON in ``value``, optionally a ``key``."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def send(df: DataFrame, fmt: str, key: str | None = None, **options) -> None:
    """Write messages to a queue format such as kafka, or to files in tests."""
    messages(df, key).write.format(fmt).options(**options).mode("append").save()


def order_route(kind: str | Column, known: Sequence[str], other: str = "other") -> Column:
    """The route of a message type; unknown types go to ``other``."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    return F.when(kind.isin(*known), kind).otherwise(other)
