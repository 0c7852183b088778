"""Patterns over keyed event sequences, batch forms.

All of them survive a key that holds a large share of the rows: ordered steps
run per (key, time chunk), see :mod:`eventmill.operators.chunks`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventmill.operators.chunks import (
    CHUNK_SECONDS,
    HOT_ROWS,
    with_next,
    with_previous,
    with_run_start,
)
from eventmill.operators.windows import epoch, floor_div
from eventmill.session import stored

DAY = 86400
MICROS = 1_000_000


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


# -- state per key ---------------------------------------------------------------


def rate_limit(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    limit: int,
    tie_break: Sequence[str] = (),
    period: int = DAY,
) -> DataFrame:
    """Pass the first ``limit`` rows per key and period, warn once on the next.

    Column ``outcome`` is ``pass`` or ``warn``; further rows of the period are
    blacklisted and leave the stream, as the rule asks. The rank bound is
    applied by every map task before the shuffle, so a hot key stays small.
    """
    order = W.partitionBy(*keys, "_period").orderBy(ts, *tie_break)
    return (
        df.withColumn("_period", floor_div(epoch(ts), period))
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= limit + 1)
        .withColumn("outcome", F.when(F.col("nth") <= limit, "pass").otherwise("warn"))
        .drop("_period")
    )


def change_alerts(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    threshold: float,
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose value moved more than ``threshold`` since the key's last row."""
    compared = with_previous(df, [key], order, [value], chunk_seconds, hot_rows)
    return (
        compared.filter(F.abs(F.col(value) - F.col(f"prev.{value}")) > threshold)
        .withColumn("prev_value", F.col(f"prev.{value}"))
        .drop("prev", "_key", "_chunk", "_hot")
    )


def rising_runs(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    min_seconds: int,
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Maximal runs without a drop in value that last at least ``min_seconds``."""
    compared = with_previous(df, [key], order, [value], chunk_seconds, hot_rows)
    breaks = F.col("prev").isNull() | (F.col(value) < F.col(f"prev.{value}"))
    runs = with_run_start(compared, order, breaks)
    ts = order[0]
    return (
        runs.groupBy(key, "run_start")
        .agg(F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("readings"))
        .withColumn("first_ts", F.col(f"run_start.{ts}"))
        .filter(micros_between(F.col("last_ts"), F.col("first_ts")) >= min_seconds * MICROS)
        .select(key, "first_ts", "last_ts", "readings")
    )


# -- failed-login patterns -----------------------------------------------------------


def strict_next(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    kind: str,
    wanted: str,
    within: int,
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Two directly adjacent rows of kind ``wanted`` less than ``within`` s apart."""
    ts = order[0]
    linked = with_previous(df, [key], order, [kind, ts], chunk_seconds, hot_rows)
    return linked.filter(
        (F.col(kind) == wanted)
        & (F.col(f"prev.{kind}") == wanted)
        & (micros_between(F.col(ts), F.col(f"prev.{ts}")) < within * MICROS)
    ).select(key, F.col(f"prev.{ts}").alias("first_ts"), F.col(ts).alias("last_ts"))


def fail_pairs(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    kind: str,
    fail: str,
    success: str,
    within: int,
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """A fail soon after the last fail, with no success between them."""
    logins = df.filter(F.col(kind).isin(fail, success))
    return strict_next(logins, key, order, kind, fail, within, chunk_seconds, hot_rows)


def fail_bursts(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    kind: str,
    fail: str,
    success: str,
    times: int,
    within: int,
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """At least ``times`` fails in the ``within`` seconds from a first fail.

    The first fail opens a period [first, first + within]; a success closes it;
    the first fail after a period opens the next. Runs of fails with no success
    and no gap above ``within`` are independent of each other. Nearly all of them
    fit one period and are settled by the aggregate alone; the periods of longer runs
    are chained by :func:`_periods`.
    """
    ts = order[0]
    logins = df.filter(F.col(kind).isin(fail, success))
    linked = with_previous(logins, [key], order, [kind, ts], chunk_seconds, hot_rows)
    fails = linked.filter(F.col(kind) == fail)
    opens = (
        F.col("prev").isNull()
        | (F.col(f"prev.{kind}") != fail)
        | (micros_between(F.col(ts), F.col(f"prev.{ts}")) > within * MICROS)
    )
    runs = with_run_start(fails, order, opens).select(
        key, ts, F.struct(key, "run_start").alias("_run")
    )
    per_run = (
        runs.groupBy(key, "_run")
        .agg(
            F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
            F.count(F.lit(1)).alias("fails"),
        )
        .filter(F.col("fails") >= times)
    )
    fits = micros_between(F.col("last_ts"), F.col("first_ts")) <= within * MICROS
    long_runs = per_run.filter(~fits).select("_run", F.unix_micros("first_ts").alias("begin"))
    steps = (
        runs.join(long_runs, "_run")
        .groupBy("_run", "begin", F.unix_micros(ts).alias("at"))
        .agg(F.count(F.lit(1)).alias("fails"))
    )
    chained = _periods(steps, within * MICROS).filter(F.col("fails") >= times).select(
        F.col(f"_run.{key}").alias(key), F.timestamp_micros("first").alias("first_ts"),
        F.timestamp_micros("last").alias("last_ts"), "fails",
    )
    return per_run.filter(fits).select(key, "first_ts", "last_ts", "fails").unionByName(chained)


def _periods(steps: DataFrame, within: int) -> DataFrame:
    """Periods (_run, first, last, fails) of long runs, by pointer doubling.

    ``steps``: (_run, begin, at, fails) in microseconds, distinct in (_run, at), with no
    gap above ``within``. The period after the one that begins at t begins with the
    first row later than t + within, which is at most another ``within`` away: it is
    found in the time slot of t + within or the next one. Which rows begin a period is
    then spread from the run's beginning along pointers of 1, 2, 4, ... periods, so a run
    of n periods takes log2 n rounds. Every step is keyed by run and time: no task holds
    a run.
    """
    seen = Observation()
    steps = stored(
        steps.observe(seen, F.max(F.col("at") - F.col("begin")).alias("longest")), "burst-steps"
    )
    longest = seen.get["longest"]
    if longest is None:
        return steps.select("_run", F.col("at").alias("first"), F.col("at").alias("last"), "fails")
    slot = lambda c: floor_div(F.col(c), within)
    heads = steps.groupBy("_run", (slot("at") - 1).alias("_slot")).agg(F.min("at").alias("_head"))
    # Rows and the ends of their reach in one slot: after an end, the first row there.
    ends = steps.select("_run", (F.col("at") + within).alias("_at"), F.col("at").alias("_from"))
    both = steps.select("_run", F.col("at").alias("_at"), F.lit(None).cast("bigint").alias("_from"))
    later = (
        W.partitionBy("_run", "_slot").orderBy(F.desc("_at"), F.col("_from").asc_nulls_last())
        .rowsBetween(W.unboundedPreceding, -1)
    )
    row_at = F.when(F.col("_from").isNull(), F.col("_at"))
    to = (
        both.unionByName(ends).withColumn("_slot", slot("_at"))
        .withColumn("_here", F.min(row_at).over(later))
        .filter("_from IS NOT NULL")
        .join(heads, ["_run", "_slot"], "left")
        .select("_run", F.col("_from").alias("at"), F.coalesce("_here", "_head").alias("to"))
    )
    rows = to.join(steps.select("_run", "at", (F.col("at") == F.col("begin")).alias("opens")), ["_run", "at"])
    # Periods begin more than ``within`` apart: a run has at most longest // within + 1.
    for _ in range((longest // within).bit_length()):
        rows = stored(rows, "burst-pointers")
        onward = rows.select("_run", F.col("at").alias("to"), F.col("to").alias("_to"))
        doubled = rows.join(onward, ["_run", "to"], "left").select(
            "_run", "at", F.col("_to").alias("to"), "opens"
        )
        opened = rows.filter("opens AND to IS NOT NULL").select(
            "_run", F.col("to").alias("at"), F.lit(None).cast("bigint").alias("to"), "opens"
        )
        rows = doubled.unionByName(opened).groupBy("_run", "at").agg(
            F.max("to").alias("to"), F.max("opens").alias("opens")
        )
    begins = rows.filter("opens").select("_run", "at")
    # A period lies in the slot of its beginning and the next; a slot holds one beginning.
    spans = begins.withColumnRenamed("at", "first").withColumn(
        "_slot", F.explode(F.array(slot("first"), slot("first") + 1))
    )
    return (
        steps.withColumn("_slot", slot("at")).join(spans, ["_run", "_slot"])
        .filter((F.col("at") >= F.col("first")) & (F.col("at") <= F.col("first") + within))
        .groupBy("_run", "first").agg(F.max("at").alias("last"), F.sum("fails").alias("fails"))
    )


# -- order patterns ----------------------------------------------------------------


def followed_by(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    kind: str,
    first: str,
    then: str,
    within: int,
    chunk_seconds: int = CHUNK_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For every ``first`` row: was it followed by a ``then`` row within the time?

    Rows between them are allowed. The nearest follower is found per (key, chunk)
    and carried over chunk borders; no pairs are formed.
    """
    ts = order[0]
    relevant = df.filter(F.col(kind).isin(first, then))
    linked = with_next(
        relevant, [key], order, F.col(kind) == then, ts, "_next", chunk_seconds, hot_rows
    ).filter(F.col(kind) == first)
    in_time = micros_between(F.col("_next"), F.col(ts)) < within * MICROS
    return (
        linked.withColumn("then_ts", F.when(in_time, F.col("_next")))
        .withColumn("status", F.when(F.col("then_ts").isNotNull(), "paid").otherwise("timeout"))
        .drop("_next")
    )


def _first_times(df: DataFrame, key: str, ts: str, kind: str, create: str, pay: str) -> DataFrame:
    return (
        df.filter(F.col(kind).isin(create, pay))
        .groupBy(key)
        .agg(
            F.min(F.when(F.col(kind) == create, F.col(ts))).alias("create_ts"),
            F.min(F.when(F.col(kind) == pay, F.col(ts))).alias("pay_ts"),
        )
    )


def timeout_at_deadline(
    df: DataFrame, key: str, ts: str, kind: str, create: str, pay: str, within: int
) -> DataFrame:
    """One row per created key, judged at create + ``within``: paid or timeout."""
    times = _first_times(df, key, ts, kind, create, pay).filter("create_ts IS NOT NULL")
    in_time = micros_between(F.col("pay_ts"), F.col("create_ts")) <= within * MICROS
    return times.withColumn(
        "result", F.when(F.coalesce(in_time, F.lit(False)), "paid").otherwise("timeout")
    )


def order_outcomes(
    df: DataFrame, key: str, ts: str, kind: str, create: str, pay: str, within: int
) -> DataFrame:
    """paid, paid_late, timeout or paid_without_create for every key."""
    times = _first_times(df, key, ts, kind, create, pay)
    waited = micros_between(F.col("pay_ts"), F.col("create_ts"))
    return times.withColumn(
        "outcome",
        F.when(F.col("create_ts").isNull(), "paid_without_create")
        .when(F.col("pay_ts").isNull(), "timeout")
        .when(waited < within * MICROS, "paid")
        .otherwise("paid_late"),
    )
