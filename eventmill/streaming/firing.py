"""Windows that fire when the watermark passes them, and again for every late row.

A window [end - size, end) fires once the largest time seen, less ``delay``, has reached
its end. Until ``lateness`` s later each further row makes it fire again, with its whole
count; then the window expires and its state goes. Rows that come after that are not
lost: they are a second output. Each window holds two timers, one to fire and one to
expire.

Spark drops rows older than its own watermark before any operator sees them. That
watermark therefore lags by ``delay + horizon``: only rows more than ``horizon`` s behind
are dropped, and :class:`DroppedRows` counts them. The rules above are kept by the
processor, whose timers are shifted by the same horizon, so state goes in time. Event
times must lie at least ``horizon`` s after 1970.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQueryListener

from eventmill.operators.windows import epoch, floor_div

HORIZON = 400 * 86_400
OUTPUT = "window_end bigint, outcome string, firing bigint, cnt bigint, row_id bigint"


class FiringWindows(StatefulProcessor):
    """Outcomes: ``fired`` (firing number, whole count) and ``late`` (row id)."""

    def __init__(self, lateness: int, horizon: int):
        self.lateness, self.horizon = lateness, horizon

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "cnt bigint, firings bigint")

    def _reached(self, timerValues) -> float:
        """The largest time seen less the delay, in seconds."""
        mark = timerValues.getCurrentWatermarkInMs()
        return mark / 1000 + self.horizon if mark > 0 else float("-inf")

    def _timer(self, seconds: int) -> int:
        return (seconds - self.horizon) * 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (end,), reached, found = key, self._reached(timerValues), []
        make = Row("window_end", "outcome", "firing", "cnt", "row_id")
        if reached >= end + self.lateness:
            return iter([make(end, "late", None, None, r["row_id"]) for r in rows])
        held = self.count.exists()
        cnt, firings = self.count.get() if held else (0, 0)
        for _ in rows:
            cnt += 1
            if reached >= end:
                firings += 1
                found.append(make(end, "fired", firings, cnt, None))
        self.count.update((cnt, firings))
        if not held:
            if reached < end:
                self.handle.registerTimer(self._timer(end))
            self.handle.registerTimer(self._timer(end + self.lateness))
        return iter(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (end,), out = key, []
        cnt, firings = self.count.get()
        if not firings:  # also if the watermark passes both timers at once
            out = [Row("window_end", "outcome", "firing", "cnt", "row_id")(end, "fired", 1, cnt, None)]
            firings = 1
        if expiredTimerInfo.getExpiryTimeInMs() == self._timer(end + self.lateness):
            self.count.clear()
        else:
            self.count.update((cnt, firings))
        return iter(out)

    def close(self) -> None:
        pass


def firing_windows(
    stream: DataFrame,
    ts: str,
    row_id: str,
    size: int,
    delay: int,
    lateness: int,
    horizon: int = HORIZON,
) -> DataFrame:
    """(window_end, outcome, firing, cnt, row_id): firings and rows that came too late."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = stream.select(
        F.col(ts), F.col(row_id).cast("bigint").alias("row_id"),
        ((floor_div(epoch(ts), size) + 1) * size).cast("bigint").alias("window_end"),
    ).withWatermark(ts, f"{delay + horizon} seconds")
    return rows.groupBy("window_end").transformWithState(
        statefulProcessor=FiringWindows(lateness, horizon), outputStructType=OUTPUT,
        outputMode="append", timeMode="EventTime",
    )


class DroppedRows(StreamingQueryListener):
    """Counts the rows that watermarks have dropped, per query run."""

    def __init__(self):
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.rows[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.rows[run] = self.rows.get(run, 0) + dropped

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass
