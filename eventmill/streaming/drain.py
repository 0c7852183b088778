"""Run a streaming query over what is available now and read its result table.

Results always land in files written by the executors. Appended rows use the
file sink (exactly once); updates go through ``foreachBatch`` into one folder
per micro-batch, so that a batch repeated after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.session import use_rocksdb_state, work_dir


@contextmanager
def state_partitions(spark):
    """Number of state partitions, which a query keeps for its whole life.

    On a cluster it is the session's shuffle partition number. With a local
    master more partitions than cores only add state stores, so it is capped.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    context = spark.sparkContext
    if context.master.startswith("local"):
        spark.conf.set(key, min(int(before), context.defaultParallelism))
    try:
        yield use_rocksdb_state(spark)
    finally:
        spark.conf.set(key, before)


def start_append(stream: DataFrame, path: str, checkpoint: str):
    """Append finished rows to ``path``, starting or resuming at ``checkpoint``."""
    with state_partitions(stream.sparkSession):
        return (
            stream.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def start_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str,
    per_batch: Callable[[DataFrame], DataFrame] = lambda batch: batch,
):
    """Write each micro-batch's rows to its own folder below ``path``."""
    def save(batch: DataFrame, batch_id: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with state_partitions(stream.sparkSession):
        return (
            stream.writeStream.outputMode(mode).foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def read_batches(stream_schema: str, spark, path: str) -> DataFrame:
    return spark.read.schema(stream_schema + ", batch_id bigint").parquet(path)


def drain_append(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    path = work_dir(spark, label)
    start_append(stream, path, path + "-checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def drain_batches(
    stream: DataFrame,
    label: str,
    mode: str,
    schema: str,
    per_batch: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataFrame:
    spark = stream.sparkSession
    path = work_dir(spark, label)
    start_batches(stream, path, path + "-checkpoint", mode, per_batch).awaitTermination()
    return read_batches(schema, spark, path)


def final_values(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after the last update of every key."""
    values = [c for c in batches.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*values), "batch_id").alias("_last")
    return batches.groupBy(*keys).agg(last).select(*keys, "_last.*")


def last_batch(batches: DataFrame) -> DataFrame:
    """The full table of the last micro-batch (complete mode)."""
    newest = batches.agg(F.max("batch_id"))
    return batches.filter(F.col("batch_id") == newest.scalar()).drop("batch_id")
