"""Keyed stream state in event-time order.

Rows of a key wait in slices of time until the watermark passes them and are then
handled in time order, so results do not depend on arrival order. Each rule below says what
one row does to the small state of its key and what time alone does to it.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

MICROS = 1_000_000
SLICE_ROWS = 10_000
SLICE_SECONDS = 3600
KEEP_SECONDS = 90 * 86_400
# Keys of these types are kept exactly by JSON, so many of them can share one group.
JSON_KEYS = {"tinyint", "smallint", "int", "bigint", "string"}


class Rule:
    """State is a JSON-able value, ``None`` at first; times are microseconds."""

    output = ""

    def step(self, state, us: int, row_id: int, kind: str, value: float):
        """(new state, output tuples) after one row."""
        raise NotImplementedError

    def until(self, state, now: int):
        """(new state, output tuples) once the watermark has reached ``now``."""
        return state, []

    def deadline(self, state) -> int | None:
        """The next time at which ``until`` could have an effect."""
        return None


class ChangeRule(Rule):
    output = "event_id bigint, prev_value double, value double"

    def __init__(self, threshold: float):
        self.threshold = threshold

    def step(self, state, us, row_id, kind, value):
        moved = state is not None and abs(value - state) > self.threshold
        return value, [(row_id, state, value)] if moved else []


class RisingRule(Rule):
    """One alert per run without a drop, when it has lasted ``seconds``."""

    output = "first_us bigint, alert_us bigint"

    def __init__(self, seconds: int):
        self.span = seconds * MICROS

    def step(self, state, us, row_id, kind, value):
        first, last, alerted = state or (us, value, False)
        if value < last:
            first, alerted = us, False
        fire = not alerted and us - first >= self.span
        return (first, value, alerted or fire), [(first, us)] if fire else []


class RateLimitRule(Rule):
    output = "event_id bigint, nth bigint, outcome string"

    def __init__(self, limit: int, period_seconds: int = 86400):
        self.limit, self.period = limit, period_seconds * MICROS

    def step(self, state, us, row_id, kind, value):
        period, count = state or (None, 0)
        count = count + 1 if us // self.period == period else 1
        found = []
        if count <= self.limit + 1:
            found = [(row_id, count, "pass" if count <= self.limit else "warn")]
        return (us // self.period, count), found

    def until(self, state, now):
        # A period that is over counts no more rows.
        return (None if state and now >= self.deadline(state) else state), []

    def deadline(self, state):
        return (state[0] + 1) * self.period if state else None


class StrictNextRule(Rule):
    output = "first_us bigint, last_us bigint"

    def __init__(self, wanted: str, within: int):
        self.wanted, self.within = wanted, within * MICROS

    def step(self, state, us, row_id, kind, value):
        hit = (
            state is not None and kind == self.wanted == state[0]
            and us - state[1] < self.within
        )
        return (kind, us), [(state[1], us)] if hit else []


class FailBurstRule(Rule):
    output = "first_us bigint, last_us bigint, fails bigint"

    def __init__(self, fail: str, success: str, times: int, within: int):
        self.fail, self.success = fail, success
        self.times, self.within = times, within * MICROS

    def _closed(self, state):
        return [tuple(state)] if state and state[2] >= self.times else []

    def step(self, state, us, row_id, kind, value):
        if kind == self.success:
            return None, self._closed(state)
        if kind != self.fail:
            return state, []
        if state and us <= state[0] + self.within:
            return (state[0], us, state[2] + 1), []
        return (us, us, 1), self._closed(state)

    def until(self, state, now):
        if state and now > state[0] + self.within:
            return None, self._closed(state)
        return state, []

    def deadline(self, state):
        return state[0] + self.within + 1 if state else None


class FollowedByRule(Rule):
    output = "event_id bigint, create_us bigint, pay_us bigint, status string"

    def __init__(self, first: str, then: str, within: int):
        self.first, self.then, self.within = first, then, within * MICROS

    def step(self, state, us, row_id, kind, value):
        waiting = state or []
        if kind == self.first:
            waiting.append((row_id, us))
            return waiting, []
        if kind != self.then:
            return state, []
        return None, [
            (i, t, us, "paid") if us - t < self.within else (i, t, -1, "timeout")
            for i, t in waiting
        ]

    def until(self, state, now):
        waiting = state or []
        over = [(i, t, -1, "timeout") for i, t in waiting if now >= t + self.within]
        return [(i, t) for i, t in waiting if now < t + self.within] or None, over

    def deadline(self, state):
        return state[0][1] + self.within if state else None


class OrderOutcomeRule(Rule):
    """Verdict per order; a later row may correct it, so the one with the last time counts.

    An order is forgotten ``keep`` s after its deadline; a row that comes later still
    begins a new order of that key.
    """

    output = "outcome string, judged_us bigint"

    def __init__(self, create: str, pay: str, within: int, keep: int = KEEP_SECONDS):
        self.create, self.pay, self.within = create, pay, within * MICROS
        self.keep = keep * MICROS

    def step(self, state, us, row_id, kind, value):
        state, out = self.until(state, us)
        if kind not in (self.create, self.pay):
            return state, out
        created, paid, said = state or (None, None, None)
        if kind == self.create and created is None:
            created = us
        if kind == self.pay and paid is None:
            paid = us
        verdict = None
        if created is not None and paid is not None:
            verdict = "paid" if paid - created < self.within else "paid_late"
        if verdict and verdict != said:
            out = [*out, (verdict, us)]
        return (created, paid, verdict or said), out

    def _due(self, state) -> int:
        return min(t for t in state[:2] if t is not None) + self.within

    def until(self, state, now):
        if not state or now < self._due(state):
            return state, []
        (created, paid, said), due = state, self._due(state)
        out = []
        if said is None:
            said = "timeout" if created is not None else "paid_without_create"
            out = [(said, due)]
        return None if now >= due + self.keep else (created, paid, said), out

    def deadline(self, state):
        if not state:
            return None
        return self._due(state) + (self.keep if state[2] is not None else 0)


class MatchOnceRule(Rule):
    """Greedy one-to-one matching of two kinds of rows.

    A row takes the nearest waiting row of the other kind, which is the latest, if it is
    at most ``within`` s old; else it waits itself, for as long. Each row is used once.
    """

    output = "left_id bigint, right_id bigint, status string"

    def __init__(self, left: str, right: str, within: int):
        self.left, self.right, self.within = left, right, within * MICROS

    def _alone(self, waiting):
        return [
            (i, None, "left_only") if kind == self.left else (None, i, "right_only")
            for _, i, kind in waiting
        ]

    def step(self, state, us, row_id, kind, value):
        if kind not in (self.left, self.right):
            return state, []
        state, out = self.until(state, us)
        waiting = state or []
        for at in range(len(waiting) - 1, -1, -1):
            if waiting[at][2] != kind:
                other = waiting.pop(at)[1]
                pair = (row_id, other) if kind == self.left else (other, row_id)
                return waiting or None, [*out, (*pair, "matched")]
        waiting.append((us, row_id, kind))
        return waiting, out

    def until(self, state, now):
        waiting = state or []
        over = sum(now > t + self.within for t, _, _ in waiting)
        return waiting[over:] or None, self._alone(waiting[:over])

    def deadline(self, state):
        return state[0][0] + self.within + 1 if state else None


class OrderedProcessor(StatefulProcessor):
    """Rows wait in slices of time; the watermark wakes a key, which reads what is due.

    A slice is a number of pieces of a map state, each of at most ``SLICE_ROWS`` rows.
    A timer reads the slices that have begun, one after the other, and applies the rule
    to their rows in time order; later slices are not touched. Only the slice that the
    watermark stands in is written again.
    """

    def __init__(self, rule: Rule, keys: tuple[str, ...], slice_seconds: int):
        self.rule, self.width = rule, slice_seconds * MICROS
        self.columns = [*keys, *(field.split()[0] for field in rule.output.split(","))]

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "slice bigint, piece int", "rows string")
        # One value holds the rule's state, (pieces, first time) of every open slice and
        # the time of the pending timer.
        self.memory = handle.getValueState("memory", "state string, open string, timer_ms bigint")

    def _recall(self):
        kept = self.memory.get() if self.memory.exists() else None
        if not kept:
            return None, {}, None
        return json.loads(kept[0]), {int(k): v for k, v in json.loads(kept[1]).items()}, kept[2]

    def _remember(self, state, slices, timer_ms) -> None:
        if state is None and not slices and timer_ms is None:
            self.memory.clear()  # nothing open: the key leaves no row behind
        else:
            self.memory.update((json.dumps(state), json.dumps(slices), timer_ms))

    def _wake(self, at_us, timer_ms):
        """Keep one timer per key, at the earliest time of interest."""
        wanted = None if at_us is None else -(-at_us // 1000)
        if wanted != timer_ms:
            if timer_ms is not None:
                self.handle.deleteTimer(timer_ms)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        return wanted

    def _kept(self, r) -> tuple:
        """What is kept of a row while it waits."""
        return r["us"], r["row_id"], r["kind"], r["value"]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows, state, slices, timer_ms, first_us = iter(rows), None, None, None, None
        # In pieces: a hot key may bring more rows than fit in memory.
        while piece := list(islice(rows, SLICE_ROWS)):
            if slices is None:
                state, slices, timer_ms = self._recall()
            found: dict[int, list] = {}
            for r in piece:
                found.setdefault(r["us"] // self.width, []).append(self._kept(r))
            for number, new in found.items():
                first = min(r[0] for r in new)
                pieces, before = slices.get(number, (0, first))
                self.rows.updateValue((number, pieces), (json.dumps(new),))
                slices[number] = (pieces + 1, min(first, before))
                first_us = first if first_us is None else min(first_us, first)
        if first_us is not None:
            if timer_ms is None or -(-first_us // 1000) < timer_ms:
                timer_ms = self._wake(first_us, timer_ms)
            self._remember(state, slices, timer_ms)
        return iter(())

    def _taken(self, number: int, pieces: int) -> list:
        """The rows of a slice in order; they leave the state."""
        found = []
        for piece in range(pieces):
            found += json.loads(self.rows.getValue((number, piece))[0])
            self.rows.removeKey((number, piece))
        found.sort(key=lambda r: (r[0], r[1] is not None, r[1]))
        return found

    def _due(self, slices: dict, now: int) -> Iterator[list]:
        """The rows up to ``now``, in order; the rest of their slice goes back to the state."""
        for number in sorted(slices):
            if slices[number][1] > now:
                break
            waiting = self._taken(number, slices.pop(number)[0])
            due = bisect_right(waiting, now, key=lambda r: r[0])
            yield from waiting[:due]
            if later := waiting[due:]:
                self.rows.updateValue((number, 0), (json.dumps(later),))
                slices[number] = (1, later[0][0])

    def _rest(self, state, deadline, slices, timer_ms, fired) -> None:
        """Set the next timer and remember what is open."""
        times = [t for t in (deadline, *(f for _, f in slices.values())) if t is not None]
        # The timer that has just fired is gone already.
        pending = None if timer_ms == fired else timer_ms
        timer_ms = self._wake(min(times) if times else None, pending)
        self._remember(state, slices, timer_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        state, slices, timer_ms = self._recall()
        make = Row(*self.columns)
        for us, row_id, kind, value in self._due(slices, now):
            state, out = self.rule.step(state, us, row_id, kind, value)
            for found in out:
                yield make(*key, *found)
        state, out = self.rule.until(state, now)
        for found in out:
            yield make(*key, *found)
        fired = expiredTimerInfo.getExpiryTimeInMs()
        self._rest(state, self.rule.deadline(state), slices, timer_ms, fired)

    def close(self) -> None:
        pass


class GroupedProcessor(OrderedProcessor):
    """The same for a group of keys, which share slices, timer and one value of state.

    A call for a key costs some milliseconds whatever it does, so millions of keys with few
    rows each are dear one by one. Here a call serves all keys of a group. A row waits
    with its key; the state is a list of (key, state of the key), without the closed keys.
    """

    def __init__(self, rule: Rule, keys: tuple[str, ...], slice_seconds: int):
        super().__init__(rule, keys, slice_seconds)
        self.keys = keys

    def _kept(self, r) -> tuple:
        return (*super()._kept(r), *(r[k] for k in self.keys))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        kept, slices, timer_ms = self._recall()
        states = {tuple(owner): state for owner, state in kept or ()}
        make = Row(*self.columns)
        for us, row_id, kind, value, *owner in self._due(slices, now):
            owner = tuple(owner)
            states[owner], out = self.rule.step(states.get(owner), us, row_id, kind, value)
            for found in out:
                yield make(*owner, *found)
        kept, nearest = [], None
        for owner, state in states.items():
            deadline = self.rule.deadline(state)
            if deadline is not None and deadline <= now:
                state, out = self.rule.until(state, now)
                for found in out:
                    yield make(*owner, *found)
                deadline = self.rule.deadline(state)
            if state is not None:
                kept.append((owner, state))
            if deadline is not None:
                nearest = deadline if nearest is None else min(nearest, deadline)
        fired = expiredTimerInfo.getExpiryTimeInMs()
        self._rest(kept or None, nearest, slices, timer_ms, fired)


def apply_rule(
    stream: DataFrame,
    keys: tuple[str, ...],
    ts: str,
    rule: Rule,
    delay: int,
    row_id: str | None = None,
    kind: str | None = None,
    value: str | None = None,
    mode: str = "append",
    slice_seconds: int = SLICE_SECONDS,
    groups: int | None = None,
) -> DataFrame:
    """Run ``rule`` per key over a stream that is at most ``delay`` s out of order.

    With ``groups`` the state lies in that many groups of keys instead of one entry for each
    key: the same results, far fewer calls. The number belongs to the checkpoint, as that
    of the state partitions does. Keys of other types than whole numbers and texts have
    entries of their own all the same.
    """
    # Send the rule with the query, so executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    empty = F.lit(None)
    rows = stream.select(
        *keys, ts, F.unix_micros(ts).alias("us"),
        (F.col(row_id) if row_id else F.lit(0)).cast("bigint").alias("row_id"),
        (F.col(kind) if kind else empty).cast("string").alias("kind"),
        (F.col(value) if value else empty).cast("double").alias("value"),
    ).withWatermark(ts, f"{delay} seconds")
    kinds = {k: stream.schema[k].dataType.simpleString() for k in keys}
    output = ", ".join(f"{k} {kind}" for k, kind in kinds.items()) + f", {rule.output}"
    if groups and JSON_KEYS.issuperset(kinds.values()):
        group = F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("_group")
        grouped, make = rows.select(group, "*").groupBy("_group"), GroupedProcessor
    else:
        grouped, make = rows.groupBy(*keys), OrderedProcessor
    return grouped.transformWithState(
        statefulProcessor=make(rule, keys, slice_seconds),
        outputStructType=output,
        outputMode=mode,
        timeMode="EventTime",
    )
