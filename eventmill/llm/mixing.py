"""Mixing sources to target weights by temperature.

The weight of a source is its share of tokens to the power of an exponent between 0
(all sources alike) and 1 (as they are), normalised. The exponent is the largest whose
weights reach a target entropy, raised as far as a repetition limit asks. It is found
by bisection in sections: one aggregation over the sources evaluates 64 exponents,
four rounds leave 2^-24. Sources are never collected.

A budget of tokens is then dealt out: by default the least with which every source is
used at least once, so no document is lost. Documents fall into 1,024 blocks per
source by a hash; each epoch of a source takes its blocks in a permutation of its own,
and the last epoch ends inside a block, where the budget is spent. ``mix_order`` (0 to
1) interleaves all sources, so the weights hold in every prefix of that order.

Tokens are words plus one end mark, so an empty or null text has one. A null source is
a source of its own. Rows that repeat an id and source stay together in a block. An
empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import documents, stored, unit_interval, words
from eventmill.session import broadcast_if_small

BLOCKS = 1_024
SECTIONS = 64
ROUNDS = 4
ENTROPY = 0.95  # of the entropy of equal weights
REPETITIONS = 4.0


@dataclass(frozen=True)
class Temperature:
    exponent: float
    normaliser: float  # sum of the powered shares
    tokens: int
    budget: float


def find_temperature(
    sources: DataFrame, entropy: float, repetitions: float, budget: float | None = None
) -> Temperature | None:
    """``sources``: one row for each, with ``tokens``. None if there are none."""
    whole = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return None
    log_share = F.log(F.col("tokens") / F.lit(float(whole["t"])))

    def evaluate(exponents: list[float]) -> list[tuple[float, float, float]]:
        """Entropy over its maximum, most repetitions and normaliser for each exponent."""
        parts = []
        for i, e in enumerate(exponents):
            powered = F.exp(e * log_share)
            parts += [F.sum(powered).alias(f"z{i}"), F.sum(powered * log_share).alias(f"s{i}")]
        row = sources.agg(
            F.min(log_share).alias("low"), F.max(log_share).alias("high"), *parts
        ).first()
        out = []
        for i, e in enumerate(exponents):
            z, s = row[f"z{i}"], row[f"s{i}"]
            ratio = 1.0 if whole["n"] == 1 else (math.log(z) - e * s / z) / math.log(whole["n"])
            factor = (
                z * math.exp((1 - e) * row["high"]) if budget is None else budget / whole["t"]
            )
            out.append((ratio, factor * math.exp((e - 1) * row["low"]) / z, z))
        return out

    def search(holds) -> float:
        """Where ``holds`` turns from true to false as the exponent rises."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
            found = [holds(v) for v in evaluate(grid)]
            if all(found):
                return high
            if not found[0]:
                return low
            last = found.index(False) - 1
            low, high = grid[last], grid[last + 1]
        return low

    slack = 1e-9
    flat = search(lambda v: v[0] >= entropy - slack)
    steep = search(lambda v: v[1] > repetitions + slack)
    exponent = max(flat, steep)
    _, _, z = evaluate([exponent])[0]
    if budget is None:
        high = sources.agg(F.max(log_share)).first()[0]
        budget = whole["t"] * z * math.exp((1 - exponent) * high)
    return Temperature(exponent, z, whole["t"], budget)


def mix(
    df: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    entropy: float = ENTROPY,
    repetitions: float = REPETITIONS,
    budget: float | None = None,
    blocks: int = BLOCKS,
    tokens: Column | None = None,
) -> DataFrame:
    """``df`` with ``mix_tokens``, ``epoch``, ``weight`` and ``mix_order``; a row for each use."""
    made = ("mix_tokens", "epoch", "weight", "mix_order")
    kept = [c for c in df.columns if c not in made]
    key = F.when(F.col(source_col).isNull(), F.lit("")).otherwise(
        F.concat(F.lit("="), F.col(source_col).cast("string"))
    )
    identity = F.col(id_col).cast("string")
    size = F.size(words(F.col(text_col))) + 1 if tokens is None else tokens
    sized = df.select(
        *kept,
        size.cast("long").alias("mix_tokens"),
        key.alias("_key"),
        F.pmod(F.xxhash64(F.lit("block"), identity, key), F.lit(blocks)).cast("int").alias("_block"),
        unit_interval(F.lit("place"), identity, key).alias("_place"),
    )
    # Words are counted once for all sums; the texts are not carried along.
    sizes = stored(sized.select("_key", "_block", "_place", "mix_tokens"), "mix-sizes")
    held = stored(
        sizes.groupBy("_key", "_block").agg(F.sum("mix_tokens").alias("tokens")), "mix-blocks"
    )
    sources = held.groupBy("_key").agg(F.sum("tokens").alias("tokens"))
    found = find_temperature(sources, entropy, repetitions, budget)
    if found is None:
        return sized.select(
            *kept, "mix_tokens", F.lit(0).alias("epoch"), F.lit(0.0).alias("weight"),
            F.lit(0.0).alias("mix_order"),
        ).limit(0)

    weight = F.pow(F.col("tokens") / F.lit(float(found.tokens)), F.lit(found.exponent)) / F.lit(
        found.normaliser
    )
    # Round away the last digits, so a whole number of epochs is not one epoch more.
    turns = F.round(weight * F.lit(float(found.budget)) / F.col("tokens"), 6)
    plans = (
        sources.withColumn("weight", weight).withColumn("_turns", turns)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil("_turns").cast("int") - 1)))
        .select(
            "_key", "weight", "epoch", F.col("tokens").alias("_whole"), "_turns",
            (F.least(F.lit(1.0), F.col("_turns") - F.col("epoch")) * F.col("tokens")).alias("_due"),
        )
        .filter("_due > 0")
    )
    permuted = Window.partitionBy("_key", "epoch").orderBy(
        F.xxhash64(F.lit("turn"), "_key", "_block", "epoch"), "_block"
    ).rowsBetween(Window.unboundedPreceding, -1)
    # At most ``blocks`` rows for each source and epoch.
    schedule = stored(
        plans.join(held, "_key")
        .withColumn("_before", F.coalesce(F.sum("tokens").over(permuted), F.lit(0)))
        .filter(F.col("_before") < F.col("_due") - 1e-6 * F.col("_whole") / F.lit(blocks))
        .withColumn("_left", F.col("_due") - F.col("_before")),
        "mix-schedule",
    )
    # The block in which the budget runs out is cut at a place, found from its rows alone.
    inside = Window.partitionBy("_key", "epoch", "_block").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    partial = F.col("_left") < F.col("tokens") - 0.5
    last = stored(schedule.filter(partial).select("_key", "_block", "epoch", "_left"), "mix-last")
    cut = stored(
        sizes.join(broadcast_if_small(last), ["_key", "_block"])
        .groupBy("_key", "_block", "epoch", "_left", "_place").agg(F.sum("mix_tokens").alias("_n"))
        .withColumn("_sum", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .filter(F.col("_sum") < F.col("_left"))
        .groupBy("_key", "_block", "epoch").agg(F.max("_place").alias("_last")),
        "mix-cut",
    )
    turn = stored(
        schedule.join(cut, ["_key", "_block", "epoch"], "left").select(
            "_key", "_block", "epoch", "weight", "_turns", "_whole", "_before",
            F.least("tokens", "_left").alias("_spent"),
            F.coalesce("_last", F.lit(1.0)).alias("_last"),
        ),
        "mix-turns",
    )
    # A place is a share of what its block spends, so the order ends at 1 in a cut block too.
    within = F.col("_place") / F.greatest("_last", F.lit(1e-300)) * F.col("_spent")
    order = (F.col("epoch") + (F.col("_before") + within) / F.col("_whole")) / F.col("_turns")
    return (
        sized.join(turn, ["_key", "_block"]).filter(F.col("_place") <= F.col("_last"))
        .withColumn("mix_order", order)
        .select(*kept, *made)
    )


def op8_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", *("mix_tokens", "epoch", "weight", "mix_order"))
