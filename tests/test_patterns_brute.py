"""Pattern operators against plain loops on random, skewed event logs.

User 0 holds a third of the rows. Tiny chunks force most links over chunk
borders, for all users (from 0 rows on), for the hot user only (60), or for none.
"""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from eventmill.operators import joins, windows
from eventmill.operators import patterns as pat
from eventmill.streaming import ordered

SECOND = 1_000_000


def make_log(seed, n=300, span=400):
    rnd = random.Random(seed)
    log = []
    for i in range(n):
        user = 0 if rnd.random() < 0.35 else rnd.randrange(1, 6)
        kind = rnd.choice(["fail", "fail", "fail", "success", "create", "pay"])
        log.append((i, user, rnd.randrange(span), kind, float(rnd.randrange(40))))
    return log


def frame(spark, log):
    df = spark.createDataFrame(log, "id bigint, user bigint, t bigint, kind string, value double")
    return df.withColumn("ts", F.timestamp_seconds("t")).repartition(5)


def by_user(log):
    users = {}
    for row in sorted(log, key=lambda r: (r[2], r[0])):
        users.setdefault(row[1], []).append(row)
    return users


def play(rule, log, until):
    """Feed a rule in time order, then let the time pass: the loop form of a pattern."""
    out = []
    for user, events in by_user(log).items():
        state = None
        for i, _, t, kind, value in events:
            due = rule.deadline(state)
            if due is not None and due < t * SECOND:
                state, found = rule.until(state, due)
                out += [(user, *f) for f in found]
            state, found = rule.step(state, t * SECOND, i, kind, value)
            out += [(user, *f) for f in found]
        state, found = rule.until(state, until * SECOND)
        out += [(user, *f) for f in found]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk, hot", [(7, 0), (7, 60), (1000, 10_000)])
def test_ordered_patterns_equal_loops(spark, seed, chunk, hot):
    log = make_log(seed)
    df = frame(spark, log).cache()
    order = ["ts", "id"]
    us = F.unix_micros

    changes = pat.change_alerts(df, "user", order, "value", 10.0, chunk, hot)
    assert rows(changes.select("user", "id", "prev_value", "value")) == play(
        ordered.ChangeRule(10.0), log, 10_000
    )
    pairs = pat.strict_next(df, "user", order, "kind", "fail", 5, chunk, hot)
    assert rows(pairs.select("user", us("first_ts"), us("last_ts"))) == play(
        ordered.StrictNextRule("fail", 5), log, 10_000
    )
    followed = pat.followed_by(df, "user", order, "kind", "create", "pay", 20, chunk, hot)
    got = followed.select(
        "user", "id", us("ts"), F.coalesce(us("then_ts"), F.lit(-1)), "status"
    )
    assert rows(got) == play(ordered.FollowedByRule("create", "pay", 20), log, 10_000)
    for within, times in ((3, 2), (15, 3), (60, 4)):
        bursts = pat.fail_bursts(
            df, "user", order, "kind", "fail", "success", times, within, chunk, hot
        )
        got = bursts.select("user", us("first_ts"), us("last_ts"), "fails")
        assert rows(got) == play(
            ordered.FailBurstRule("fail", "success", times, within), log, 10_000
        )
    df.unpersist()


def test_long_bursts_walk_several_periods(spark):
    """One endless run of fails: periods follow each other from first fail to first fail."""
    log = [(i, 0, i * 2, "fail", 0.0) for i in range(100)]
    bursts = pat.fail_bursts(
        frame(spark, log), "user", ["ts", "id"], "kind", "fail", "success", 3, 9, 13, 0
    )
    got = bursts.select(F.unix_timestamp("first_ts"), F.unix_timestamp("last_ts"), "fails")
    assert rows(got) == [(t, t + 8, 5) for t in range(0, 200, 10)]


@pytest.mark.parametrize("hot", [0, 60, 10_000])
def test_a_null_key_is_a_key(spark, hot):
    """Same answers as under a key of its own, hot or not, in every ordered pattern."""
    log = make_log(4)
    named = frame(spark, log)
    nameless = named.withColumn("user", F.nullif("user", F.lit(0)))
    order = ["ts", "id"]
    forms = (
        lambda df: pat.change_alerts(df, "user", order, "value", 10.0, 7, hot),
        lambda df: pat.rising_runs(df, "user", order, "value", 3, 7, hot),
        lambda df: pat.strict_next(df, "user", order, "kind", "fail", 5, 7, hot),
        lambda df: pat.followed_by(df, "user", order, "kind", "create", "pay", 20, 7, hot),
        lambda df: pat.fail_bursts(df, "user", order, "kind", "fail", "success", 2, 3, 7, hot),
    )
    for form in forms:
        want, got = form(named), form(nameless)
        assert got.columns == want.columns
        got = got.withColumn("user", F.coalesce("user", F.lit(0)))
        assert rows(got.fillna(0)) == rows(want.fillna(0))


@pytest.mark.parametrize("chunk, hot", [(7, 0), (7, 60), (1000, 10_000)])
def test_rising_runs_equal_loop(spark, chunk, hot):
    log = make_log(3)
    want = []
    for user, events in by_user(log).items():
        run = []
        for event in [*events, None]:
            if run and (event is None or event[4] < run[-1][4]):
                if run[-1][2] - run[0][2] >= 3:
                    want.append((user, run[0][2], run[-1][2], len(run)))
                run = []
            if event is not None:
                run.append(event)
    runs = pat.rising_runs(frame(spark, log), "user", ["ts", "id"], "value", 3, chunk, hot)
    got = runs.select(
        "user", F.unix_timestamp("first_ts"), F.unix_timestamp("last_ts"), "readings"
    )
    assert rows(got) == sorted(want)


def test_rate_limit_equals_loop(spark):
    log = make_log(4)
    kept = pat.rate_limit(frame(spark, log), ["user"], "ts", 7, ["id"], period=100)
    got = kept.select("user", "id", F.col("nth").cast("bigint"), "outcome")
    assert rows(got) == play(ordered.RateLimitRule(7, 100), log, 10_000)


@pytest.mark.parametrize("lower, upper", [(-5, 5), (0, 30), (-40, -3), (2, 2)])
def test_interval_join_equals_pairs(spark, lower, upper):
    log = make_log(5)
    df = frame(spark, log)
    left = df.filter("kind = 'create'").select("user", "id", F.col("ts").alias("lt"))
    right = df.filter("kind = 'pay'").select("user", F.col("id").alias("rid"), F.col("ts").alias("rt"))
    want = sorted(
        (a[1], a[0], b[0])
        for a in log if a[3] == "create"
        for b in log if b[3] == "pay" and a[1] == b[1] and lower <= b[2] - a[2] <= upper
    )
    pairs = joins.interval_join(left, right, "user", "lt", "rt", lower, upper)
    assert rows(pairs.select("user", "id", "rid")) == want
    narrow = joins.interval_join(left, right, "user", "lt", "rt", lower, upper, width=3)
    assert rows(narrow.select("user", "id", "rid")) == want
    matched = joins.match_streams(left, right, "user", "lt", "rt", lower, upper)
    counts = dict(rows(matched.groupBy("status").count()))
    creates = {a[0] for a in log if a[3] == "create"}
    pays = {b[0] for b in log if b[3] == "pay"}
    assert counts.get("matched", 0) == len(want)
    assert counts.get("left_only", 0) == len(creates - {p[1] for p in want})
    assert counts.get("right_only", 0) == len(pays - {p[2] for p in want})


@pytest.mark.parametrize("size, slide, offset", [(60, 20, 0), (60, 25, 0), (30, 30, 7), (20, 50, 0)])
def test_sliding_windows_equal_loop(spark, size, slide, offset):
    log = make_log(6)
    want = {}
    for _, user, t, _, value in log:
        for k in range(-5, 60):
            end = offset + k * slide
            if end - size <= t < end:
                n, low = want.get((user, end), (0, value))
                want[user, end] = (n + 1, min(low, value))
    got = windows.sliding_aggregate(
        frame(spark, log), "ts", size, slide, ["user"],
        {"cnt": ("count", None), "low": ("min", "value")}, offset,
    )
    assert rows(got.select("user", "window_end", "cnt", "low")) == sorted(
        (u, e, n, low) for (u, e), (n, low) in want.items()
    )


@pytest.mark.parametrize("limit", [0, 500_000])
def test_range_lookup_equals_scan(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_PIECES", limit)
    rnd = random.Random(7)
    edges = sorted(rnd.sample(range(5000), 40))
    bands = [(a, b - 1, i) for i, (a, b) in enumerate(zip(edges[::2], edges[1::2]))]
    points = [(i, rnd.randrange(5200)) for i in range(400)]
    got = joins.range_lookup(
        spark.createDataFrame(points, "id bigint, p bigint"),
        spark.createDataFrame(bands, "lo bigint, hi bigint, band bigint"), "p", "lo", "hi", 64,
    ).select("id", F.coalesce("band", F.lit(-1)).alias("band"))
    want = [(i, next((b for lo, hi, b in bands if lo <= p <= hi), -1)) for i, p in points]
    assert rows(got) == want


def test_chained_periods_equal_a_walk(spark):
    """Long irregular runs over many slots, several keys (one null), equal times and exact borders."""
    rng = random.Random(8)
    log, n = [], 0
    for user in (0, 1, None):
        t = 0
        for _ in range(400):
            t += rng.choice([0, 1, 1, 2, 3, 9, 10, 11, 25])
            log.append((n, user, t, "fail" if rng.random() < 0.98 else "success", 0.0))
            n += 1
    bursts = pat.fail_bursts(frame(spark, log), "user", ["ts", "id"], "kind", "fail", "success", 2, 10, 50, 100)
    want = []
    for user in (0, 1, None):
        state = None
        closed = lambda s: [(user, *s)] if s and s[2] >= 2 else []  # noqa: E731,B023
        for _, who, t, kind, _ in log:
            if who != user:
                continue
            if kind == "success":
                want, state = want + closed(state), None
            elif state and t <= state[0] + 10:
                state = (state[0], t, state[2] + 1)
            else:
                want, state = want + closed(state), (t, t, 1)
        want += closed(state)
    got = bursts.select("user", F.unix_timestamp("first_ts"), F.unix_timestamp("last_ts"), "fails")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    plan = bursts._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
