"""Session settings, shared working folders and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Of equally named URL parameters the last one counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}
# Texts are long: the usual 10,000 rows of a batch for Python may be far too many bytes.
MEMORY_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}
# Estimates count compressed files; in memory a table may take several times more.
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024


def build_session(app: str = "eventmill", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results, on a session made elsewhere.

    Batches for Python get a size bound, unless the session has one.
    """
    for key, value in RESULT_SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    for key, value in MEMORY_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keyed state with timers needs the RocksDB provider; it also spills."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # Upload what a batch changed instead of whole snapshots.
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, since there the
    driver and the executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="eventmill-")
    return _LOCAL_ROOTS[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that it is worked out once."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate; it errs on the large side, runs no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only below ``limit``; otherwise Spark shuffles the join."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
