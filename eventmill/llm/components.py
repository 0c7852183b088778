"""Connected components of an undirected graph, by alternating stars.

Each round links all larger neighbours of a node to its smallest neighbour (large
star), then all smaller ones (small star), until every node hangs on the smallest of
its component. Rounds grow with the logarithm of the longest path. Edges are written
to the shared folder after each round, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventmill.llm.common import stored


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written, and a mark of their set, taken while they are written."""
    seen = Observation()
    found = edges.observe(
        seen, F.count("*").alias("rows"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hashes"),
    )
    kept = stored(found, "edges")
    return kept, (seen.get["rows"], seen.get["hashes"])


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) to (u, v): every node but the smallest, with that smallest."""
    now, mark = _stored(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = None
    while mark != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # Never more rows than edges, so repeated ones may wait for the next step.
        large = (
            both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter("u <> v").unionByName(low.withColumnRenamed("m", "v")).distinct()
        before = mark
        now, mark = _stored(small)
    return now
