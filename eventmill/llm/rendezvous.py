"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number from (key, shard); the smallest ``-ln(u) / weight``
wins. A further shard only competes with the winner, so rows move into it alone,
in proportion to its weight. All of it is column expressions over a row; the only
shuffle numbers the rows inside a shard.

Nulls: a null key is the key ''; a null text has no bytes. Rows that repeat a key
land in one shard and get slots of their own. An empty table gives no rows. Other
columns of the input are ignored by the query and kept by ``with_shard``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import documents

DRAW_DIGITS = 12  # hexadecimal digits of the draw: 48 bits
SLOT_DIGITS = 3  # 4,096 numbering buckets per shard


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(""))


def draw(key: Column, shard: int) -> Column:
    """Uniform number in (0, 1) that depends on the key and the shard only."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{shard}"))), 1, DRAW_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DRAW_DIGITS)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the winning shard; equal scores fall to the smaller number."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [
        F.struct((-F.ln(draw(key, i)) / F.lit(float(w))).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.array_min(F.array(*scores))["shard"]


def with_shard(df: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    return df.withColumn(name, shard_of(key_text(F.col(key)), weights))


def with_slots(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Number the rows of every shard from 0 without gaps.

    Rows are numbered inside (shard, hash bucket), so no task holds a shard; the
    offsets come from counts, 4,096 rows per shard at most, which bounds the running
    sum. They meet the rows by the partitioning of the numbering; whether they are
    broadcast instead is left to their size.
    """
    text = key_text(F.col(key))
    df = df.withColumn("_bucket", F.substring(F.md5(text), 1, SLOT_DIGITS))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        df.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
        .select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy(key, *order)
    return (
        df.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, ["shard", "_bucket"])
        .withColumn("slot", F.col("_first") + F.col("_rank") - 1)
        .drop("_bucket", "_rank", "_first")
    )


SHARDS = 16


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    rows = with_shard(rows, "doc_id", [1.0] * SHARDS)
    rows = with_shard(rows, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    return with_slots(rows, "doc_id", ["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


# The checksum is the usual bitwise one: a table of 256 steps, folded over the bytes.
OP10_SQL = f"""
WITH steps AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, z:
      CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
docs AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, encode(coalesce(text, '')) AS b
  FROM documents),
sized AS (
  SELECT doc_id, k, octet_length(b) + 1 AS size, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(b), '..'),
      lambda x: ('0x' || x)::BIGINT)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM docs, steps),
drawn AS (
  SELECT *, list_transform(range({SHARDS + 1}), lambda s:
    -ln((('0x' || substr(md5(k || '/' || s), 1, {DRAW_DIGITS}))::BIGINT + 0.5)
        / {16**DRAW_DIGITS}::DOUBLE)) AS scores
  FROM sized),
placed AS (
  SELECT *, list_position(scores, list_min(scores)) - 1 AS grown_shard,
    list_position(scores, list_min(scores[1:{SHARDS}])) - 1 AS shard
  FROM drawn)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law,
  shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard
    ORDER BY substr(md5(k), 1, {SLOT_DIGITS}), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM placed
"""
