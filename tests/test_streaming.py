"""Streams fed in several micro-batches, out of order, late, and restarted."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_patterns_brute import SECOND, make_log, play

import __spark_entry__ as entry_module
from eventmill.operators import windows
from eventmill.session import use_rocksdb_state, work_dir
from eventmill.sources.readers import stream_source
from eventmill.streaming import arrivals, drain, firing, ordered, recovery, windowed

QUERIES = entry_module.queries()
SCHEMA = "id bigint, user bigint, t bigint, kind string, value double"
DELAY = 30


def feed(spark, batches):
    """One file per micro-batch, read in the order written."""
    use_rocksdb_state(spark)
    inbox = work_dir(spark, "feed")
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").json(inbox)
    stream = stream_source(spark, "json", inbox, SCHEMA, maxFilesPerTrigger=1)
    return stream.withColumn("ts", F.timestamp_seconds("t"))


def shuffled(log, seed, parts=4):
    """Time-ordered micro-batches with rows up to DELAY seconds out of order."""
    rnd = random.Random(seed)
    mixed = sorted(log, key=lambda r: r[2] + rnd.randrange(DELAY - 5))
    step = len(mixed) // parts + 1
    return [mixed[i:i + step] for i in range(0, len(mixed), step)]


RULES = {
    "change": (ordered.ChangeRule(10.0), 0),
    "rising": (ordered.RisingRule(4), 0),
    "limit": (ordered.RateLimitRule(3, 100), 0),
    "strict": (ordered.StrictNextRule("fail", 5), 0),
    "burst": (ordered.FailBurstRule("fail", "success", 2, 15), 15),
    "followed": (ordered.FollowedByRule("create", "pay", 20), 20),
}


@pytest.mark.parametrize("name", sorted(RULES))
def test_rules_do_not_depend_on_arrival(spark, name):
    rule, _ = RULES[name]
    log = make_log(11, n=240)
    batches = shuffled(log, 12)
    stream = ordered.apply_rule(
        feed(spark, batches), ("user",), "ts", rule, DELAY,
        row_id="id", kind="kind", value="value",
    )
    got = rows(drain.drain_append(stream, "rule-" + name))
    limit = max(r[2] for r in log) - DELAY
    want = play(rule, [r for r in log if r[2] <= limit], limit)
    assert got == want and got


@pytest.mark.parametrize("rule", [ordered.RateLimitRule(3, 100), ordered.FailBurstRule("fail", "success", 2, 15)])
def test_state_falls_to_the_open_keys(spark, rule):
    log = [(i, i % 7, i, "fail", 0.0) for i in range(40)]
    late = [(99, 50, 5_000, "fail", 0.0)], [(100, 51, 9_000, "fail", 0.0)]
    stream = ordered.apply_rule(
        feed(spark, [log[:20], log[20:], *late]), ("user",), "ts", rule, DELAY,
        row_id="id", kind="kind", value="value",
    )
    path = work_dir(spark, "closed")
    drain.start_append(stream, path, path + "-checkpoint").awaitTermination()
    state = spark.read.format("statestore").option("stateVarName", "memory").load(path + "-checkpoint")
    users = {r["key"]["user"] for r in state.collect()}
    assert 51 in users and users <= {50, 51}


def test_order_outcomes_are_corrected(spark):
    log = [
        (1, 1, 1, "create", 0.0), (2, 1, 10, "pay", 0.0),
        (3, 2, 1, "create", 0.0), (4, 2, 300, "pay", 0.0),
        (5, 3, 5, "create", 0.0), (6, 4, 5, "pay", 0.0),
        (7, 9, 500, "create", 0.0),
    ]
    stream = ordered.apply_rule(
        feed(spark, [log[:2] + log[2:3] + log[4:6], log[3:4], log[6:]]), ("user",), "ts",
        ordered.OrderOutcomeRule("create", "pay", 100), DELAY, row_id="id", kind="kind",
        mode="update",
    )
    batches = drain.drain_batches(
        stream, "outcomes-test", "update", "user bigint, outcome string, judged_us bigint",
    )
    last = batches.groupBy("user").agg(F.max_by("outcome", "judged_us"))
    assert rows(last) == [
        (1, "paid"), (2, "paid_late"), (3, "timeout"), (4, "paid_without_create")
    ]
    # Order 2 was a timeout first and was corrected by its late payment.
    assert [r[0] for r in batches.filter("user = 2").select("outcome").distinct().orderBy(
        "outcome").collect()] == ["paid_late", "timeout"]


def test_windows_equal_batch_on_closed_windows(spark):
    log = make_log(13)
    stream = windowed.bounded(feed(spark, shuffled(log, 14)), "ts", DELAY)
    got = drain.drain_append(
        windowed.window_counts(stream, "ts", 60, 20, ["user"]), "closed-windows"
    )
    df = spark.createDataFrame(log, SCHEMA).withColumn("ts", F.timestamp_seconds("t"))
    batch = windows.sliding_aggregate(df, "ts", 60, 20, ["user"])
    closed = windows.closed_windows(batch, df, "ts", DELAY)
    cols = ["user", "window_end", "cnt"]
    assert rows(got.select(cols)) == rows(closed.select(cols))


def late_feed(spark):
    """Second batch: one row for a window long closed, one within the lateness."""
    return feed(spark, [
        [(1, 1, 10, "pv", 0.0), (2, 1, 200, "pv", 0.0)],
        [(3, 1, 300, "pv", 0.0)],
        [(4, 1, 20, "pv", 0.0), (5, 1, 290, "pv", 0.0), (6, 1, 400, "pv", 0.0)],
        [(7, 1, 900, "pv", 0.0)],
    ])


def test_late_rows_are_dropped_and_counted(spark):
    stream = windowed.bounded(late_feed(spark), "ts", 10)
    path = work_dir(spark, "late")
    query = drain.start_append(
        windowed.window_counts(stream, "ts", 60), path, path + "-checkpoint"
    )
    query.awaitTermination()
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    counts = {r["window_end"]: r["cnt"] for r in spark.read.parquet(path).collect()}
    assert dropped >= 1
    assert counts[60] == 1  # the late row is not in it


def test_lateness_keeps_windows_open(spark):
    def count_of(lateness):
        stream = windowed.bounded(late_feed(spark), "ts", 10, lateness)
        batches = drain.drain_batches(
            windowed.window_counts(stream, "ts", 60), "lateness", "update",
            "cnt bigint, window_end bigint",
        )
        return dict((r["window_end"], r["cnt"]) for r in drain.final_values(
            batches, ["window_end"]).collect())

    assert count_of(0)[60] == 1
    assert count_of(400)[60] == 2


def test_punctuated_watermark_ignores_other_rows(spark):
    """Rows of other users, however late in time, do not close user 1's windows."""
    stream = feed(spark, [
        [(1, 1, 10, "pv", 0.0)], [(2, 2, 5000, "pv", 0.0)], [(3, 1, 20, "pv", 0.0)],
        [(4, 1, 300, "pv", 0.0)],
    ])
    marks = windowed.punctuated(stream, "ts", F.col("user") == 1, 0)
    counted = windowed.window_counts(marks.filter("mark_ts IS NOT NULL"), "mark_ts", 60)
    got = drain.drain_append(counted, "punctuated")
    assert rows(got.select("window_end", "cnt")) == [(60, 2)]


def test_unique_visitors_forms_agree(spark):
    log = make_log(15)
    stream = lambda: windowed.bounded(feed(spark, shuffled(log, 16)), "ts", DELAY)
    exact = dict(rows(drain.drain_append(
        windowed.unique_visitors(stream(), "ts", "user", 60), "uv-exact")))
    bits = drain.final_values(
        drain.drain_batches(
            windowed.unique_visitor_bits(stream(), "ts", "user", 60), "uv-bits", "update",
            "window_end bigint, bucket bigint, bits bigint",
        ), ["window_end", "bucket"],
    )
    running = dict(rows(bits.groupBy("window_end").agg(F.sum("bits"))))
    assert exact and exact.items() <= running.items()
    want = {}
    for _, user, t, _, _ in log:
        want.setdefault((t // 60 + 1) * 60, set()).add(user)
    assert running == {end: len(users) for end, users in want.items()}


def test_restart_after_failure_counts_once(spark):
    """A batch that fails after writing is repeated from the checkpoint, not doubled."""
    log = make_log(17)
    stream = feed(spark, shuffled(log, 18))
    path = work_dir(spark, "restarted")
    failures = []

    def failing(batch):
        if not failures and batch.sparkSession.catalog is not None:
            failures.append(1)
            raise RuntimeError("lost once")
        return batch

    totals = windowed.running_totals(stream, ["user"], "value")
    starts = recovery.run_with_restarts(
        lambda: drain.start_batches(totals, path, path + "-checkpoint", "update", failing),
        wait_seconds=0.1,
    )
    assert starts == 2
    batches = drain.read_batches("user bigint, total double, cnt bigint", spark, path)
    got = drain.final_values(batches, ["user"]).select("user", "cnt")
    want = {}
    for row in log:
        want[row[1]] = want.get(row[1], 0) + 1
    assert dict(rows(got)) == want


def test_complete_mode_returns_all_keys(spark):
    log = make_log(19)
    totals = windowed.running_totals(feed(spark, shuffled(log, 20)), ["user"], "value")
    schema = "user bigint, total double, cnt bigint"
    full = drain.last_batch(drain.drain_batches(totals, "complete", "complete", schema))
    assert full.agg(F.sum("cnt")).first()[0] == len(log)


def test_rate_cap_makes_several_batches(spark):
    stream = feed(spark, shuffled(make_log(21), 22, parts=4)).select("id")
    batches = drain.drain_batches(stream, "capped", "append", "id bigint")
    assert batches.select("batch_id").distinct().count() == 4
    assert batches.count() == 300


def test_timer_is_in_event_time():
    rule = ordered.FailBurstRule("fail", "success", 2, 10)
    state, _ = rule.step(None, 0, 1, "fail", 0.0)
    state, _ = rule.step(state, 5 * SECOND, 2, "fail", 0.0)
    assert rule.until(state, 10 * SECOND)[1] == []
    assert rule.until(state, rule.deadline(state))[1] == [(0, 5 * SECOND, 2)]


class Handle:
    """State of one key in memory, which records the slices that are read."""

    def __init__(self):
        self.read, self.maps, self.value, self.timers = [], {}, None, set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getMapState(self, *_):
        handle = self

        class Rows:
            def updateValue(self, key, value):
                handle.maps[key] = value

            def getValue(self, key):
                handle.read.append(key[0])
                return handle.maps[key]

            def removeKey(self, key):
                del handle.maps[key]

        return Rows()

    def getValueState(self, *_):
        handle = self

        class Memory:
            def exists(self):
                return handle.value is not None

            def get(self):
                return handle.value

            def update(self, value):
                handle.value = value

            def clear(self):
                handle.value = None

        return Memory()


class Times:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms


def test_only_due_slices_are_read(monkeypatch):
    monkeypatch.setattr(ordered, "SLICE_ROWS", 3)
    processor = ordered.OrderedProcessor(ordered.ChangeRule(0.5), ("user",), 10)
    handle = Handle()
    processor.init(handle)
    times = [95, 3, 41, 17, 8, 62, 12, 5, 73, 44, 19, 1]
    rows_in = [{"us": t * SECOND, "row_id": t, "kind": "v", "value": float(t)} for t in times]
    processor.handleInputRows((1,), iter(rows_in), None)
    assert sorted({k[0] for k in handle.maps}) == [0, 1, 4, 6, 7, 9] and handle.timers == {1000}

    def wake(at):
        handle.read.clear()
        fired = min(handle.timers)
        out = list(processor.handleExpiredTimer((1,), Times(at * 1000), Times(fired)))
        handle.timers.discard(fired)
        return [r.event_id for r in out]

    assert wake(18) == [3, 5, 8, 12, 17]  # 1 is the first reading
    assert set(handle.read) == {0, 1} and handle.timers == {19_000}
    assert wake(43) == [19, 41]
    assert set(handle.read) == {1, 4} and handle.timers == {44_000}
    assert wake(200) == [44, 62, 73, 95]
    assert not handle.maps and not handle.timers


def test_orders_are_forgotten_after_their_time():
    rule = ordered.OrderOutcomeRule("create", "pay", 100, keep=50)
    state, out = rule.step(None, 0, 1, "create", 0.0)
    assert rule.deadline(state) == 100 * SECOND and out == []
    state, out = rule.until(state, 120 * SECOND)
    assert out == [("timeout", 100 * SECOND)] and rule.deadline(state) == 150 * SECOND
    corrected, out = rule.step(state, 130 * SECOND, 2, "pay", 0.0)
    assert out == [("paid_late", 130 * SECOND)]
    assert rule.until(corrected, 150 * SECOND) == (None, [])
    # Later still the key begins anew.
    state, out = rule.step(state, 160 * SECOND, 3, "pay", 0.0)
    assert out == [] and state == (None, 160 * SECOND, None)


def test_matching_uses_each_row_once():
    rng = random.Random(4)
    for _ in range(50):
        log = sorted((rng.randrange(60) * SECOND, i, rng.choice("abx")) for i in range(30))
        rule, state, got = ordered.MatchOnceRule("a", "b", 5), None, []
        for us, i, kind in log:
            state, out = rule.step(state, us, i, kind, 0.0)
            got += out
        got += rule.until(state, 10**12)[1]
        free, want = [], []
        for us, i, kind in log:
            near = [x for x in free if x[2] != kind and us - x[0] <= 5 * SECOND]
            if kind == "x":
                continue
            if near:
                other = max(near)
                free.remove(other)
                want.append((i, other[1], "matched") if kind == "a" else (other[1], i, "matched"))
            else:
                free.append((us, i, kind))
        want += [(i, None, "left_only") if k == "a" else (None, i, "right_only") for _, i, k in free]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_windows_fire_again_for_late_rows_until_they_expire(spark):
    base = 10_000_000
    parts = [[(1, 10), (2, 15), (3, 200)], [(4, 20), (5, 30), (6, 260)], [(7, 40), (8, 250)],
             [(9, 2_000)]]
    stream = feed(spark, [[(i, 1, base + t, "pv", 0.0) for i, t in p] for p in parts])
    dropped = firing.DroppedRows()
    spark.streams.addListener(dropped)
    try:
        found = drain.drain_append(
            firing.firing_windows(stream, "ts", "id", 60, 10, 150, horizon=1_000_000), "firing")
        got = rows(found.select(F.col("window_end") - base, "outcome", "firing", "cnt", "row_id"))
    finally:
        spark.streams.removeListener(dropped)
    end = -(-(base + 10) // 60) * 60 - base  # windows begin at whole minutes
    first = [r for r in got if r[0] == end and r[1] == "fired"]
    assert [r[2] for r in sorted(first)] == list(range(1, len(first) + 1))
    counted = sum(max(r[3] for r in got if r[0] == e and r[1] == "fired")
                  for e in {r[0] for r in got if r[1] == "fired"})
    late = [r for r in got if r[1] == "late"]
    # The window of the last row is still open.
    assert counted + len(late) == 8 and [r[4] for r in late] == [7]
    assert sum(dropped.rows.values()) == 0


def test_words_of_a_table_in_several_files(spark, tmp_path):
    """A table may be a folder of files as well as one file."""
    rows = spark.createDataFrame(
        [(i, 0, "user", "one two" if i % 2 else "two") for i in range(10)],
        "conv_id long, turn long, role string, text string",
    )
    rows.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["state_word_count"](spark, str(tmp_path)).collect()
    assert sorted((r.word, r.cnt) for r in got) == [("one", 5), ("two", 10)]


def test_ranks_of_blocks_are_ranks_of_windows(spark):
    """Panes, not their windows, are shuffled; the result is that of merging first."""
    rnd = random.Random(3)
    log = [(f"u{rnd.randrange(9)}", rnd.randrange(-40, 400)) for _ in range(600)]
    panes = spark.createDataFrame(log, "url string, _pane bigint").groupBy("url", "_pane").count()
    panes = panes.withColumnRenamed("count", "cnt")
    merged = windows.merge_panes(panes, 60, 5, ["url"], {"cnt": "count"}).filter("window_end <= 1500")
    expected = windows.top_n_per_window(merged, 3, "cnt", ["url"])
    got = windows.top_n_of_panes(panes, 60, 5, 3, "cnt", "url", {"cnt": "count"}, 1500, block=7)
    columns = ["window_end", "url", "cnt", "rank_no"]
    assert rows(got.select(columns)) == rows(expected.select(columns))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange" in x and "window_end" in x]


def test_replay_deals_rows_in_one_pass(spark):
    day = spark.range(900).selectExpr("id", "timestamp_seconds(id * 60) AS ts")
    day = day.unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS TIMESTAMP) AS ts"))
    path = arrivals.deliver(day, "ts", 3600, least_files=5)
    dealt = spark.read.parquet(path + "-dealt")
    assert dealt.count() == 901 and dealt.select("_file").distinct().count() == 5
    got = spark.read.schema(day.schema).parquet(path).withColumn("name", F.col("_metadata.file_name"))
    assert sorted(r.id for r in got.filter("id IS NOT NULL").collect()) == list(range(-1, 900))
    assert got.select("name").distinct().count() == 6  # the last is the heartbeat


@pytest.mark.parametrize("name", sorted(RULES))
def test_keys_of_a_group_keep_their_own_state(spark, name):
    """Groups change nothing but the number of calls; a null key is a key as any other."""
    rule, _ = RULES[name]
    log = make_log(31, n=240)
    some = {r[1] for r in log[:1]}
    batches = [
        [(i, None if u in some else u, t, k, v) for i, u, t, k, v in batch]
        for batch in shuffled(log, 32)
    ]
    stream = ordered.apply_rule(
        feed(spark, batches), ("user",), "ts", rule, DELAY, row_id="id", kind="kind",
        value="value", slice_seconds=50, groups=2,
    )
    path = work_dir(spark, "grouped-" + name)
    drain.start_append(stream, path, path + "-checkpoint").awaitTermination()
    got = spark.read.schema(stream.schema).parquet(path)
    limit = max(r[2] for r in log) - DELAY
    want = play(rule, [r for r in log if r[2] <= limit], limit)
    if got.filter("user IS NULL").count():
        got = got.fillna(some.pop(), ["user"])
    assert rows(got) == want and want
    state = spark.read.format("statestore").option("stateVarName", "memory").load(path + "-checkpoint")
    assert state.count() <= 2


def test_closed_keys_leave_their_group():
    processor = ordered.GroupedProcessor(ordered.RateLimitRule(3, 100), ("user", "kind"), 1000)
    handle = Handle()
    processor.init(handle)
    rows_in = [
        {"us": t * SECOND, "row_id": t, "kind": "a", "value": None, "user": user}
        for t, user in ((10, 1), (20, None), (30, 1), (150, 2))
    ]
    processor.handleInputRows((0,), iter(rows_in), None)
    assert handle.timers == {10_000}

    def wake(at):
        fired = min(handle.timers)
        out = list(processor.handleExpiredTimer((0,), Times(at * 1000), Times(fired)))
        handle.timers.discard(fired)
        return [(r.user, r.kind, r.event_id, r.nth) for r in out]

    assert wake(40) == [(1, "a", 10, 1), (None, "a", 20, 1), (1, "a", 30, 2)]
    assert "[1, " in handle.value[0] and handle.timers == {100_000}
    assert wake(120) == [] and handle.value[0] == "null" and handle.timers == {150_000}


def test_registered_rules_run_in_groups(spark, sf_dir, monkeypatch):
    seen = []
    plain = ordered.apply_rule

    def noted(*args, **settings):
        seen.append(settings.get("groups"))
        return plain(*args, **settings)

    monkeypatch.setattr(ordered, "apply_rule", noted)
    assert QUERIES["state_rate_limit_blacklist_stream"](spark, sf_dir).count()
    assert seen and all(seen)
