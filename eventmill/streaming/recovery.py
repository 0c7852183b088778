"""Restart from a checkpoint, and retries for queries that fail."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame

from eventmill.session import work_dir
from eventmill.sources.readers import stream_source


def run_with_restarts(start: Callable, attempts: int = 3, wait_seconds: float = 5.0) -> int:
    """Start a query and wait for it; after a failure start it again from its checkpoint.

    Returns the number of starts. The last failure is raised.
    """
    for attempt in range(1, attempts + 1):
        try:
            start().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == attempts:
                raise
            time.sleep(wait_seconds)
    return attempts


def run_in_parts(
    parts: Sequence[DataFrame], input_schema: str, start: Callable[[DataFrame, str], object]
) -> str:
    """Deliver input in parts; after each, run what is there and stop.

    Every run resumes from the checkpoint of the one before. ``start`` gets the
    input stream and the result path; the path is returned.
    """
    spark = parts[0].sparkSession
    inbox, result = work_dir(spark, "inbox"), work_dir(spark, "resumed")
    for part in parts:
        part.write.mode("append").parquet(inbox)
        stream = stream_source(spark, "parquet", inbox, input_schema)
        run_with_restarts(lambda s=stream: start(s, result))
    return result
