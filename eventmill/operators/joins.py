"""Joins: key lookups, interval joins, two-stream matching, range lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.operators.windows import epoch, floor_div
from eventmill.session import broadcast_if_small

MICROS = 1_000_000
# Pieces of intervals that may be broadcast; at some 100 bytes each about 50 MB.
BROADCAST_PIECES = 500_000


def lookup_with_default(
    df: DataFrame, key: str, mapping: DataFrame, source: str, target: str, output: str
) -> DataFrame:
    """Replace ``key`` by its mapped value, by itself where there is none.

    ``mapping`` must hold each source once. It is broadcast while small; beyond
    that the join shuffles and AQE splits skewed keys.
    """
    small = broadcast_if_small(mapping.select(F.col(source).alias(key), F.col(target)))
    return (
        df.join(small, key, "left")
        .withColumn(output, F.coalesce(F.col(target), F.col(key)))
        .drop(target)
    )


def _spread(right: DataFrame, ts: str, lower: int, upper: int, width: int) -> DataFrame:
    """Copy right rows to every left bucket whose rows they can match."""
    first = floor_div(epoch(ts) - upper - 1, width)
    last = floor_div(epoch(ts) - lower + 1, width)
    return right.withColumn("_bucket", F.explode(F.sequence(first, last)))


def _within(left_ts: Column, right_ts: Column, lower: int, upper: int) -> Column:
    gap = F.unix_micros(right_ts) - F.unix_micros(left_ts)
    return gap.between(lower * MICROS, upper * MICROS)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
    how: str = "inner",
    width: int | None = None,
) -> DataFrame:
    """Right rows with equal key and time in [left + lower, left + upper] seconds.

    Both sides are keyed by (key, time bucket): a left row has one bucket, right
    rows are copied to those they can match (two or three at the default width,
    the span of the interval), so each pair is found once and a hot key spreads
    over its buckets; narrower buckets spread it further for more copies.
    ``how``: inner, left, left_anti or left_semi.
    """
    width = width or max(upper - lower, 1)
    bucketed = left.withColumn("_bucket", floor_div(epoch(left_ts), width))
    spread = _spread(right, right_ts, lower, upper, width).withColumnRenamed(key, "_key")
    condition = (
        (F.col(key) == F.col("_key"))
        & (bucketed["_bucket"] == spread["_bucket"])
        & _within(F.col(left_ts), F.col(right_ts), lower, upper)
    )
    joined = bucketed.join(spread, condition, how)
    if how in ("left_anti", "left_semi"):
        return joined.drop("_bucket")
    return joined.drop(bucketed["_bucket"]).drop(spread["_bucket"]).drop("_key")


def match_streams(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
) -> DataFrame:
    """Full outer interval match: ``matched``, ``left_only`` or ``right_only`` rows."""
    left_part = interval_join(left, right, key, left_ts, right_ts, lower, upper, "left")
    left_part = left_part.withColumn(
        "status", F.when(F.col(right_ts).isNotNull(), "matched").otherwise("left_only")
    )
    # Seen from the right side the interval is mirrored.
    right_part = interval_join(
        right, left, key, right_ts, left_ts, -upper, -lower, "left_anti"
    ).withColumn("status", F.lit("right_only"))
    return left_part.unionByName(right_part, allowMissingColumns=True)


def range_lookup(
    points: DataFrame,
    ranges: DataFrame,
    point: str,
    lo: str,
    hi: str,
    width: int,
) -> DataFrame:
    """Left-join each point with the interval [lo, hi] it lies in.

    Intervals are split at multiples of ``width`` so that the join has an equi
    key. The number of pieces is counted first (a job over the interval table
    alone): few enough are broadcast, otherwise the join shuffles by bucket and
    AQE splits skewed buckets.
    """
    bucketed = points.withColumn("_bucket", floor_div(F.col(point), width))
    first, last = floor_div(F.col(lo), width), floor_div(F.col(hi), width)
    pieces = ranges.withColumn("_bucket", F.explode(F.sequence(first, last)))
    count = ranges.agg(F.sum(last - first + 1)).first()[0] or 0
    if count <= BROADCAST_PIECES:
        pieces = F.broadcast(pieces)
    condition = (bucketed["_bucket"] == pieces["_bucket"]) & F.col(point).between(
        F.col(lo), F.col(hi)
    )
    return bucketed.join(pieces, condition, "left").drop("_bucket")
