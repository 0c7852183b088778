"""Global and per-group top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def top(df: DataFrame, by: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    """The n largest rows; every task keeps n rows, no global sort."""
    return df.orderBy(F.desc(by), *tie_break).limit(n)


def top_per_group(
    df: DataFrame, keys: Sequence[str], by: str, n: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The n largest rows of each group with ``rank_no``; duplicates are kept.

    The rank bound is pushed into the map tasks, which pass on at most n rows
    per group, so a hot group does not overload the task that ranks it.
    """
    order = W.partitionBy(*keys).orderBy(F.desc(by), *tie_break)
    ranked = df.withColumn("rank_no", F.row_number().over(order)).filter(F.col("rank_no") <= n)
    return ranked.withColumn("rank_no", F.col("rank_no").cast("bigint"))


def top_per_group_salted(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    n: int,
    tie_break: Sequence[str],
    salts: int = 16,
) -> DataFrame:
    """Two stages: top n per (group, salt), then top n of those per group."""
    salt = F.pmod(F.xxhash64(by, *tie_break), F.lit(salts))
    local = top_per_group(df.withColumn("_salt", salt), [*keys, "_salt"], by, n, tie_break)
    return top_per_group(local.drop("_salt", "rank_no"), keys, by, n, tie_break)
