"""Micro-batch sinks for ``foreachBatch``: several outputs, keyed tables, rolling reports.

A batch may be repeated after a failure. Everything a batch writes lies in folders named
by its id, which a repetition replaces, and reads only what earlier batches wrote.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.sinks.tables import latest_per_key
from eventmill.streaming.drain import state_partitions

# -- several outputs ---------------------------------------------------------------


def start_outputs(
    stream: DataFrame,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    path: str,
    checkpoint: str,
):
    """Write each output of every batch below ``path/<name>``; the batch is computed once."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, part in outputs.items():
                part(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    with state_partitions(stream.sparkSession):
        return (
            stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def routes(kind: str, known: Sequence[str], other: str = "other") -> dict[str, Callable]:
    """One output per known value of ``kind``, and one for all else, nulls included."""
    made = {name: lambda b, n=name: b.filter(F.col(kind) == n) for name in known}
    rest = ~F.coalesce(F.col(kind).isin(*known), F.lit(False))
    return made | {other: lambda b: b.filter(rest)}


# -- keyed tables ------------------------------------------------------------------


class KeyedTable:
    """A table with one row per key, updated by batches.

    Keys fall into hash buckets. A batch writes a new version of the buckets it touches
    and leaves all others alone: ``path/batch_id=<id>/bucket=<b>``. The table is the
    newest version of each bucket. Of several rows of a key the one that is last by
    ``order`` stays (equal ones fall to the larger values), whatever batch brings it, so
    a repeated batch changes nothing. Null keys are keys like any other.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, keys: Sequence[str],
        order: Sequence[str], buckets: int,
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets

    def versions(self, before: int | None = None) -> dict[int, int]:
        """The newest batch of every bucket, from the names of the files."""
        try:
            files = self.spark.read.schema(self.schema).parquet(self.path).inputFiles()
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return {}
        newest: dict[int, int] = {}
        for batch, bucket in re.findall(r"batch_id=(-?\d+)/bucket=(\d+)/", "\n".join(files)):
            if before is None or int(batch) < before:
                newest[int(bucket)] = max(newest.get(int(bucket), -1), int(batch))
        return newest

    def read(self, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The table, as of the batches below ``before``; of some buckets ``only``."""
        folders = [
            f"{self.path}/batch_id={batch}/bucket={bucket}"
            for bucket, batch in sorted(self.versions(before).items())
            if only is None or bucket in only
        ]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        columns = self.spark.createDataFrame([], self.schema).columns
        values = [c for c in columns if c not in self.keys]
        rows = batch.select(*columns).persist()
        try:
            touched = [r[0] for r in rows.select(self.bucket()).distinct().collect()]  # <= buckets
            if not touched:
                return
            known = self.read(batch_id, touched).unionByName(rows)
            newest = latest_per_key(known, self.keys, [*self.order, *values], values)
            (
                newest.select(*columns, self.bucket().alias("bucket"))
                .hint("rebalance", F.col("bucket")).write.mode("overwrite")
                .partitionBy("bucket").parquet(f"{self.path}/batch_id={batch_id}")
            )
        finally:
            rows.unpersist()

    def start(self, stream: DataFrame, checkpoint: str):
        return (
            stream.writeStream.foreachBatch(self.upsert).outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


# -- rolling reports ---------------------------------------------------------------


class RollingReport:
    """The top of the last ``batches`` micro-batches, replaced with every batch.

    A batch stores its own sums per key; the report merges those of the last batches,
    so a row is read once. With a trigger of 5 s and three batches it covers 15 s.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, value: str, batches: int = 3, top: int = 10
    ):
        self.spark, self.path, self.key, self.value = spark, path, key, value
        self.batches, self.top = batches, top

    def save(self, batch: DataFrame, batch_id: int) -> None:
        amount = F.col(self.value).cast("decimal(18,2)")
        sums = batch.groupBy(self.key).agg(
            F.sum(amount).cast("decimal(28,2)").alias("total"), F.count(F.lit(1)).alias("cnt")
        )
        sums.write.mode("overwrite").parquet(f"{self.path}/panes/batch_id={batch_id}")
        first = max(0, batch_id - self.batches + 1)
        folders = [f"{self.path}/panes/batch_id={i}" for i in range(first, batch_id + 1)]
        merged = self.spark.read.schema(sums.schema).parquet(*folders).groupBy(self.key).agg(
            F.sum("total").cast("decimal(28,2)").alias("total"), F.sum("cnt").alias("cnt")
        )
        best = merged.orderBy(F.desc("total"), self.key).limit(self.top)
        best.write.mode("overwrite").parquet(f"{self.path}/report/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, every: str | None = None):
        """``every`` (such as ``5 seconds``) keeps it running; else what is there now."""
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return (
            stream.writeStream.foreachBatch(self.save).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start()
        )

    def reports(self) -> DataFrame:
        """Every report, with the batch that made it."""
        return self.spark.read.option("basePath", f"{self.path}/report").parquet(f"{self.path}/report")
