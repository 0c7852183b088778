"""Batch and stream readers behind one format-and-options surface."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source(
    spark: SparkSession, fmt: str, path: str | None = None, schema: str | None = None, **options
) -> DataFrame:
    """Any installed format: parquet, orc, text, json, csv, jdbc, kafka, mongodb, avro."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def stream_source(
    spark: SparkSession, fmt: str, path: str | None = None, schema: str | None = None, **options
) -> DataFrame:
    """The streaming counterpart of :func:`source`."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def text_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    lines = spark.read.text(path)
    return lines.repartition(min_partitions) if min_partitions else lines


def csv_rows(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    separator: str = ",",
    header: bool = False,
    infer: bool = False,
    **options,
) -> DataFrame:
    """Delimited text with a declared or an inferred schema; ``\\t`` reads TSV."""
    reader = (
        spark.read.option("sep", separator).option("header", header)
        .option("inferSchema", infer).options(**options)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def json_rows(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return spark.read.json(path, schema=schema) if schema else spark.read.json(path)


def collection(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """In-memory rows, for small dimension lists."""
    return spark.createDataFrame(list(rows), schema)


def rows_with_schema(
    lines: DataFrame, value: str, schema: Sequence[tuple[str, str]], separator: str
) -> DataFrame:
    """Split text lines and give them a schema put together at run time."""
    parts = F.split(value, separator)
    return lines.select(
        *[
            F.get(parts, F.lit(i)).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(schema)
        ]
    )


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with bounds it is read by that many range queries."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=low, upperBound=high,
        numPartitions=partitions, properties=properties,
    )


def partition_slice(spark: SparkSession, path: str, schema: str | None = None, **values):
    """Only the partitions with the given values; the others are not listed or read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path)
    for name, value in values.items():
        rows = rows.filter(F.col(name) == value)
    return rows


def sql_on_files(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A document collection as a table: nested JSON under an enforced schema."""
    return spark.read.schema(schema).json(path)


def message_values(messages: DataFrame) -> DataFrame:
    """Key and value of queue messages as text."""
    columns = [F.col(c).cast("string").alias(c) for c in ("key", "value") if c in messages.columns]
    return messages.select(*columns)
