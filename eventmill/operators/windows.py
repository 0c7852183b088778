"""Event-time windows on batch tables.

Sliding windows aggregate in two steps: first per *pane* (the largest step that
divides both size and slide), then every pane is expanded to the windows that
cover it and merged. The expansion factor ``size / slide`` therefore applies to
pane partials, not to raw rows, and a hot key is reduced by partial aggregation
before the first shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# How each supported aggregate is taken over rows and merged over panes.
_PARTIAL = {"count": lambda c: F.count(F.lit(1)), "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def epoch(ts: str | Column) -> Column:
    """Event time in whole seconds."""
    return F.unix_timestamp(ts)


def floor_div(value: Column, step: int) -> Column:
    """Integer division rounding down, also for times before 1970."""
    return F.floor(value / F.lit(step)).cast("bigint")


def window_end(ts: str | Column, size: int, offset: int = 0) -> Column:
    """End (epoch seconds) of the tumbling window an event falls in."""
    return (floor_div(epoch(ts) - offset, size) + 1) * size + offset


def sliding_aggregate(
    df: DataFrame,
    ts: str,
    size: int,
    slide: int,
    keys: Sequence[str] = (),
    aggs: dict[str, tuple[str, str | None]] | None = None,
    offset: int = 0,
) -> DataFrame:
    """Aggregates per (keys, window); windows end at ``offset + k * slide``.

    ``aggs`` maps an output name to (count | sum | min | max, column). The result
    carries ``window_end`` in epoch seconds; a window covers [end - size, end).
    """
    aggs = aggs or {"cnt": ("count", None)}
    pane = math.gcd(size, slide)
    panes = df.groupBy(*keys, floor_div(epoch(ts) - offset, pane).alias("_pane")).agg(
        *[_PARTIAL[how](column).alias(name) for name, (how, column) in aggs.items()]
    )
    return merge_panes(panes, size, slide, keys, {n: how for n, (how, _) in aggs.items()}, offset)


def merge_panes(
    panes: DataFrame,
    size: int,
    slide: int,
    keys: Sequence[str],
    aggs: dict[str, str],
    offset: int = 0,
) -> DataFrame:
    """Windows from pane partials; ``_pane`` counts panes of gcd(size, slide) seconds."""
    pane = math.gcd(size, slide)
    if pane == size == slide:
        ends = panes.withColumn("window_end", (F.col("_pane") + 1) * size + offset)
        return ends.drop("_pane")
    first = -floor_div(-(F.col("_pane") + 1) * pane, slide)
    last = floor_div(F.col("_pane") * pane + size, slide)
    # A slide above the size leaves gaps: such panes belong to no window.
    expanded = (
        panes.filter(first <= last)
        .withColumn("_end", F.explode(F.sequence(first, last)))
        .withColumn("window_end", F.col("_end") * slide + offset)
    )
    return expanded.groupBy(*keys, "window_end").agg(
        *[_MERGE[how](name).alias(name) for name, how in aggs.items()]
    )


def top_n_per_window(
    counts: DataFrame, n: int, by: str, tie_break: Sequence[str], window: str = "window_end"
) -> DataFrame:
    """Rank rows inside each window; ties fall to the smaller key.

    ``row_number() <= n`` lets Spark cut every map task's output to n rows per
    window before the shuffle.
    """
    order = W.partitionBy(window).orderBy(F.desc(by), *tie_break)
    return counts.withColumn("rank_no", F.row_number().over(order)).filter(
        F.col("rank_no") <= n
    )


def top_n_of_panes(
    panes: DataFrame,
    size: int,
    slide: int,
    n: int,
    by: str,
    key: str,
    aggs: dict[str, str],
    until: int | None = None,
    block: int = 64,
) -> DataFrame:
    """The n largest keys of every window, straight from pane partials.

    Panes are sent to the blocks of ``block`` windows that they reach into, a few at
    most; there they are expanded, merged and ranked. So panes are shuffled and not
    their many windows. ``until`` leaves out windows that end later (epoch seconds).
    """
    pane = math.gcd(size, slide)
    first = -floor_div(-(F.col("_pane") + 1) * pane, slide)
    last = floor_div(F.col("_pane") * pane + size, slide)
    reached = panes.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    blocks = F.sequence(floor_div(F.col("_first"), block), floor_div(F.col("_last"), block))
    parts = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = F.sequence(
        F.greatest("_first", F.col("_block") * block),
        F.least("_last", (F.col("_block") + 1) * block - 1),
    )
    ends = (
        reached.withColumn("_block", F.explode(blocks))
        .repartition(parts, "_block")
        .withColumn("_end", F.explode(inside))
        .withColumn("window_end", F.col("_end") * slide)
    )
    if until is not None:
        ends = ends.filter(F.col("window_end") <= until)
    counts = ends.groupBy("_block", "window_end", key).agg(
        *[_MERGE[how](name).alias(name) for name, how in aggs.items()]
    )
    order = W.partitionBy("_block", "window_end").orderBy(F.desc(by), key)
    return (
        counts.withColumn("rank_no", F.row_number().over(order)).filter(F.col("rank_no") <= n)
        .drop("_block")
    )


def unique_visitors(df: DataFrame, ts: str, user: str, size: int) -> DataFrame:
    """Exact distinct users per tumbling window."""
    return df.groupBy(window_end(ts, size).alias("window_end")).agg(
        F.countDistinct(user).alias("uv")
    )


def unique_visitors_bitmap(df: DataFrame, ts: str, user: str, size: int) -> DataFrame:
    """The same count from bitmaps: one fixed-size bitmap per window and id range."""
    bitmaps = df.groupBy(
        window_end(ts, size).alias("window_end"),
        F.bitmap_bucket_number(user).alias("_bucket"),
    ).agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(user))).alias("_bits"))
    return bitmaps.groupBy("window_end").agg(F.sum("_bits").alias("uv"))


def closed_windows(df: DataFrame, source: DataFrame, ts: str, delay: int) -> DataFrame:
    """Only the windows a watermark of ``max(ts) - delay`` has passed."""
    limit = source.agg(F.max(F.unix_micros(ts)) - delay * 1_000_000)
    return df.filter(F.col("window_end") * 1_000_000 <= limit.scalar())
