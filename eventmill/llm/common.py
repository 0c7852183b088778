"""Helpers shared by the operators: stored intermediates, words, stable samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.session import work_dir
from eventmill.sources.tables import table

# Words are runs of anything but space, tab, line feed, vertical tab, form feed
# and carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, keeps statistics."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def handed_back(rows: Iterator) -> Iterator:
    """``rows``; at their end the worker gives free memory back, as it lives on for later stages."""
    import ctypes
    import gc

    try:
        yield from rows
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers keep no memory of finished tasks."""
    return df.mapInArrow(lambda batches: handed_back(run(batches)), schema)


def words(text: Column) -> Column:
    """Array of words of a text; empty for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_CLASS + "+")
    )


def unit_interval(*columns: Column) -> Column:
    """Stable pseudo-random double in [0, 1) from column values."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
