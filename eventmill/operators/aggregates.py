"""Grouped aggregates. Spark combines map-side, so hot groups shrink before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def exact_sum(column: str | Column) -> Column:
    """Sum of two-decimal amounts, independent of the order of addition."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.cast(MONEY)).cast("double")


def words(text: str | Column, separator: str = r"\s+") -> Column:
    """Non-blank tokens of a text; a separator pattern should take in blanks around it."""
    return F.array_remove(F.split(text, separator), "")


def word_counts(df: DataFrame, text: str, separator: str = r"\s+") -> DataFrame:
    return (
        df.select(F.explode(words(text, separator)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def token_total(df: DataFrame, text: str, separator: str = r"\s+") -> DataFrame:
    return df.agg(F.sum(F.size(words(text, separator))).cast("bigint").alias("tokens"))


def content_stats(df: DataFrame, size: str) -> DataFrame:
    """Average (rounded down, as the log report prints it), minimum and maximum."""
    value = F.col(size).cast("bigint")
    return df.agg(
        F.expr(f"sum(CAST({size} AS BIGINT)) div count(1)").alias("avg_floor"),
        F.min(value).alias("min_size"),
        F.max(value).alias("max_size"),
        F.count(F.lit(1)).alias("cnt"),
    )


def counts_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def frequent_values(df: DataFrame, key: str, more_than: int) -> DataFrame:
    return counts_by(df, key).filter(F.col("cnt") > more_than)


def page_views_by_day(df: DataFrame, ts: str) -> DataFrame:
    day = F.date_format(ts, "yyyy-MM-dd").alias("day")
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("pv"))


def visitors_by_day(df: DataFrame, ts: str, user: str) -> DataFrame:
    day = F.date_format(ts, "yyyy-MM-dd").alias("day")
    return df.groupBy(day).agg(F.countDistinct(user).alias("uv"))


def new_users_by_dims(
    df: DataFrame, day: str, platform: str, browser: str
) -> DataFrame:
    """Launches per (day, platform), (day, browser), (day, platform, browser), one pass.

    A dimension left out of a grouping set reads ``all``.
    """
    sets = [[day, platform], [day, browser], [day, platform, browser]]
    grouped = df.groupingSets(
        [[F.col(c) for c in s] for s in sets], F.col(day), F.col(platform), F.col(browser)
    ).agg(
        F.count(F.lit(1)).alias("new_users"),
        F.grouping(platform).alias("_no_platform"),
        F.grouping(browser).alias("_no_browser"),
    )
    return grouped.select(
        day,
        F.when(F.col("_no_platform") == 1, "all").otherwise(F.col(platform)).alias("platform"),
        F.when(F.col("_no_browser") == 1, "all").otherwise(F.col(browser)).alias("browser"),
        "new_users",
    )


def bitmap_distinct(df: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """Exact distinct count of integer ids through one bitmap per id range."""
    per_range = df.groupBy(*keys, F.bitmap_bucket_number(user).alias("_bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(user))).alias("_bits")
    )
    return per_range.groupBy(*keys).agg(F.sum("_bits").alias("uv"))


def group_average(df: DataFrame, key: str, value: str) -> DataFrame:
    """True average from an exact (sum, count) accumulator."""
    return df.groupBy(key).agg(
        (exact_sum(value) / F.count(value)).alias("avg_value"),
        F.count(value).alias("cnt"),
    )
