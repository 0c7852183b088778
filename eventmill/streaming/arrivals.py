"""Replay a table as files that arrive out of order, and close what is still open.

Rows are dealt to files by their event time plus a stable delay below ``delay``, so a
stream with a watermark of ``delay`` meets real disorder but no late row. A last file
holds one row without a key, far later than all others: a heartbeat, which lets the
watermark pass everything. It is never passed itself, so it appears in no result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from eventmill.session import use_rocksdb_state, work_dir
from eventmill.sources.readers import stream_source

MICROS = 1_000_000
FILE_ROWS = 2_000_000
LEAST_FILES = 8
FILES_PER_TRIGGER = 2
FAR_SECONDS = 900 * 86_400


def heartbeat(df: DataFrame, ts: str, later: int = FAR_SECONDS) -> DataFrame:
    """One row ``later`` s after the last of ``df``; all other columns are null."""
    last = df.agg(F.max(ts).alias(ts))
    kinds = {f.name: f.dataType for f in df.schema}
    return last.select(*(
        (F.col(ts) + F.make_dt_interval(secs=F.lit(float(later)))).cast(kind).alias(name)
        if name == ts else F.lit(None).cast(kind).alias(name)
        for name, kind in kinds.items()
    ))


def deliver(
    df: DataFrame, ts: str, delay: int, file_rows: int = FILE_ROWS, least_files: int = LEAST_FILES,
    close: bool = True,
) -> str:
    """Write ``df`` as files in order of arrival, then the heartbeat; the folder's path.

    Without ``close`` there is no heartbeat: what the rows leave open stays open.
    """
    spark = df.sparkSession
    path = work_dir(spark, "arrivals")
    found = df.agg(F.count("*").alias("n")).first()["n"]
    files = max(least_files, math.ceil(found / file_rows))
    at = F.unix_micros(ts)
    shares = [i / files for i in range(1, files)]
    bounds = df.agg(F.percentile_approx(at, shares, 10 * files)).first()[0] or []
    late = F.pmod(F.xxhash64(*df.columns), F.lit(delay * MICROS)) if delay else F.lit(0)
    arrival = at + late
    limits = F.array(*(F.lit(bound) for bound in sorted(set(bounds))))
    number = F.size(F.filter(limits, lambda bound: arrival >= bound)) if bounds else F.lit(0)
    # One pass deals the rows. A file source takes files by their time, so the parts are
    # then written one after the other, each from its own files.
    dealt, count = path + "-dealt", len(set(bounds)) + 1
    df.withColumn("_file", number).write.partitionBy("_file").parquet(dealt)
    parts = spark.read.schema(StructType([*df.schema.fields, StructField("_file", IntegerType())]))
    for i in range(count):
        part = parts.parquet(dealt).filter(F.col("_file") == i).drop("_file")
        part.coalesce(1).write.mode("append").parquet(path)
    if close:
        heartbeat(df, ts).coalesce(1).write.mode("append").parquet(path)
    return path


def replayed(df: DataFrame, ts: str, delay: int, per_trigger: int = FILES_PER_TRIGGER, **limits) -> DataFrame:
    """``df`` as a stream of several micro-batches, at most ``delay`` s out of order."""
    spark = use_rocksdb_state(df.sparkSession)
    path = deliver(df, ts, delay, **limits)
    return stream_source(spark, "parquet", path, df.schema, maxFilesPerTrigger=per_trigger)
