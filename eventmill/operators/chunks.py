"""Ordered computations over keys that may be far too big for one task.

``lag`` and running flags need the rows of a key in time order, but a window
partitioned by the key alone would put a hot key on one task. Keys with many
rows are therefore cut into time chunks; all others stay whole. The hot keys are counted
once for each step and written down. Windows run per
(key, chunk); what crosses the chunk borders of a hot key is carried over by a
summary with one row per (hot key, chunk), whose size is bounded by the time
range and not by the number of events.

A null key is a key like any other: the steps run over ``_key``, a struct of the
keys, which is never null and equal where its fields are. Rows without an event
time have no place in a sequence and are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventmill.operators.windows import epoch, floor_div
from eventmill.session import stored

# Ten minutes: a key with a third of a month's 100 TB gives chunks of a few GB.
CHUNK_SECONDS = 600
# From this many rows on a key is hot. There can be at most (all rows / HOT_ROWS)
# hot keys: one million keys per 10^12 rows.
HOT_ROWS = 1_000_000
# So many hot keys may be broadcast; beyond that the join shuffles and AQE splits skew.
MOST_BROADCAST = 200_000


def with_chunk(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, hot_rows: int
) -> DataFrame:
    """Add ``_key``, ``_chunk`` (0 for the only chunk of a key that is not hot), ``_hot``."""
    complete = df.dropna(subset=[ts]).withColumn("_key", F.struct(*keys))
    hot = hot_keys(complete, hot_rows)
    flagged = complete.join(hot, "_key", "left")
    chunk = F.when(F.col("_hot"), floor_div(epoch(ts), seconds)).otherwise(F.lit(0))
    return flagged.withColumn("_chunk", chunk)


def hot_keys(
    complete: DataFrame, hot_rows: int, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """(_key, _hot) of the keys with ``hot_rows`` rows or more, counted once and written.

    Every branch of a step reads the written list. It is broadcast by the exact number of
    its rows.
    """
    seen = Observation()
    counted = (
        complete.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") >= hot_rows).select("_key", F.lit(True).alias("_hot"))
    )
    hot = stored(counted.observe(seen, F.count(F.lit(1)).alias("keys")), "hot-keys")
    return F.broadcast(hot) if seen.get["keys"] <= most_broadcast else hot


def _attach(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """Bring the carry of each hot chunk to its rows.

    ``rows`` comes from a window over (key, chunk), whose partitioning and order
    serve this join too.
    """
    return rows.join(carried.filter("_carry IS NOT NULL"), ["_key", "_chunk"], "left")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add struct ``prev`` holding ``columns`` of the preceding row of the key.

    ``order[0]`` is the event time; further columns break ties. ``prev`` is null
    on the first row of a key. ``_key``, ``_chunk`` and ``_hot`` stay for further steps.
    """
    chunked = with_chunk(df, keys, order[0], chunk_seconds, hot_rows)
    payload = F.struct(*columns)
    last_rows = chunked.filter("_hot").groupBy("_key", "_chunk").agg(
        F.max_by(payload, F.struct(*order)).alias("_last")
    )
    carried = last_rows.withColumn(
        "_carry", F.lag("_last").over(W.partitionBy("_key").orderBy("_chunk"))
    ).select("_key", "_chunk", "_carry")
    inside = F.lag(payload).over(W.partitionBy("_key", "_chunk").orderBy(*order))
    return (
        _attach(chunked.withColumn("_inside", inside), carried)
        .withColumn("prev", F.coalesce("_inside", "_carry"))
        .drop("_inside", "_carry")
    )


def with_run_start(df: DataFrame, order: Sequence[str], starts: Column) -> DataFrame:
    """Add ``run_start``: the ordering struct of the row that opened the run.

    ``starts`` marks rows that open a run; ``df`` must come from
    :func:`with_previous`. Runs may span any number of chunks.
    """
    marked = df.withColumn("_point", F.when(starts, F.struct(*order)))
    # Order structs grow along the key, so the latest start is the maximum.
    latest = marked.filter("_hot").groupBy("_key", "_chunk").agg(
        F.max("_point").alias("_latest")
    )
    before = W.partitionBy("_key").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = latest.withColumn("_carry", F.max("_latest").over(before)).select(
        "_key", "_chunk", "_carry"
    )
    upto = (
        W.partitionBy("_key", "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        _attach(marked.withColumn("_inside", F.max("_point").over(upto)), carried)
        .withColumn("run_start", F.coalesce("_inside", "_carry"))
        .drop("_point", "_inside", "_carry")
    )


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    wanted: Column,
    column: str,
    output: str,
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``output``: ``column`` of the next later row of the key that is ``wanted``."""
    hit = F.when(wanted, F.struct(*order, F.col(column).alias("_value")))
    marked = with_chunk(df, keys, order[0], chunk_seconds, hot_rows).withColumn("_hit", hit)
    first_hits = marked.filter("_hot").groupBy("_key", "_chunk").agg(
        F.min("_hit").alias("_first")
    )
    # Frames run backwards in time, so that they only ever grow.
    later = W.partitionBy("_key").orderBy(F.desc("_chunk")).rowsBetween(W.unboundedPreceding, -1)
    carried = first_hits.withColumn(
        "_carry", F.last("_first", ignorenulls=True).over(later)
    ).select("_key", "_chunk", "_carry")
    inside = F.last("_hit", ignorenulls=True).over(
        W.partitionBy("_key", "_chunk")
        .orderBy(*[F.desc(c) for c in order])
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        _attach(marked.withColumn("_inside", inside), carried)
        .withColumn(output, F.coalesce("_inside", "_carry")["_value"])
        .drop("_hit", "_inside", "_carry", "_key", "_chunk", "_hot")
    )
