"""Streaming twins of the windowed, joined and running aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.operators.aggregates import words
from eventmill.operators.windows import epoch, floor_div


def seconds(n: int) -> str:
    return f"{n} seconds"


def ascending(stream: DataFrame, ts: str) -> DataFrame:
    """Watermark for rows that arrive in time order."""
    return stream.withWatermark(ts, "0 seconds")


def bounded(stream: DataFrame, ts: str, delay: int, lateness: int = 0) -> DataFrame:
    """Watermark for rows at most ``delay`` s out of order.

    ``lateness`` keeps windows open longer, so later rows still update them.
    """
    return stream.withWatermark(ts, seconds(delay + lateness))


def punctuated(stream: DataFrame, ts: str, advances: Column, delay: int) -> DataFrame:
    """Watermark moved only by rows that satisfy ``advances``.

    It is taken on ``mark_ts``, which is null on all other rows: a null event
    time does not move a watermark.
    """
    marked = stream.withColumn("mark_ts", F.when(advances, F.col(ts)))
    return marked.withWatermark("mark_ts", seconds(delay))


def window_counts(
    stream: DataFrame,
    ts: str,
    size: int,
    slide: int | None = None,
    keys: Sequence[str] = (),
    aggs: Sequence[Column] | None = None,
) -> DataFrame:
    """Incremental window aggregates with ``window_end`` in epoch seconds."""
    window = F.window(ts, seconds(size), seconds(slide) if slide else None)
    columns = aggs or [F.count(F.lit(1)).alias("cnt")]
    return (
        stream.groupBy(window, *keys).agg(*columns)
        .withColumn("window_end", F.unix_timestamp("window.end")).drop("window")
    )


def unique_visitors(stream: DataFrame, ts: str, user: str, size: int) -> DataFrame:
    """Distinct users per closed tumbling window, from a deduplicated stream."""
    seen = stream.select(F.window(ts, seconds(size)).alias("window"), user).dropDuplicates(
        ["window", user]
    )
    counted = seen.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))
    return counted.select(F.unix_timestamp("window.end").alias("window_end"), "uv")


def unique_visitor_bits(stream: DataFrame, ts: str, user: str, size: int) -> DataFrame:
    """Running bit counts per (window, id range); their sum is the running UV."""
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(user))).alias("bits")
    grouped = stream.groupBy(
        F.window(ts, seconds(size)).alias("window"), F.bitmap_bucket_number(user).alias("bucket")
    ).agg(bits)
    return grouped.select(F.unix_timestamp("window.end").alias("window_end"), "bucket", "bits")


def interval_pairs(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
    how: str = "inner",
) -> DataFrame:
    """Stream-stream interval join; both inputs carry watermarks.

    Keyed by (key, time bucket) like the batch form, so state for a hot key is
    spread; the range condition lets Spark drop state that can no longer match.
    """
    width = max(upper - lower, 1)
    bucketed = left.withColumn("_bucket", floor_div(epoch(left_ts), width))
    first = floor_div(epoch(right_ts) - upper - 1, width)
    last = floor_div(epoch(right_ts) - lower + 1, width)
    spread = right.withColumn("_right_bucket", F.explode(F.sequence(first, last)))
    spread = spread.withColumnRenamed(key, "_right_key")
    condition = F.expr(
        f"{key} = _right_key AND _bucket = _right_bucket "
        f"AND {right_ts} >= {left_ts} + INTERVAL '{lower}' SECOND "
        f"AND {right_ts} <= {left_ts} + INTERVAL '{upper}' SECOND"
    )
    return bucketed.join(spread, condition, how).drop("_bucket", "_right_bucket", "_right_key")


def full_outer_pairs(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
) -> DataFrame:
    """Interval join that also returns the unmatched rows of both sides, once each.

    One state per side: a row is kept until the watermarks say that it can match no
    more. Keyed by ``key`` alone, since a row spread over time buckets would be unmatched
    in some of them; a hot key costs its own rows of the last ``upper - lower`` seconds.
    """
    other = right.withColumnRenamed(key, "_right_key")
    condition = F.expr(
        f"{key} = _right_key "
        f"AND {right_ts} >= {left_ts} + INTERVAL '{lower}' SECOND "
        f"AND {right_ts} <= {left_ts} + INTERVAL '{upper}' SECOND"
    )
    joined = left.join(other, condition, "full_outer")
    return joined.withColumn(key, F.coalesce(key, "_right_key")).drop("_right_key")


def running_totals(stream: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Totals per key over the whole stream; the output mode picks changed or all keys."""
    return stream.groupBy(*keys).agg(
        F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("total"),
        F.count(F.lit(1)).alias("cnt"),
    )


def word_counts(lines: DataFrame, text: str) -> DataFrame:
    return (
        lines.select(F.explode(words(text)).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    )
