"""Named queries over the tables, each with its SQL check where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The behaviour view of the events table as the SQL checks see it: item id out
# of the JSON properties, event time in whole seconds.
EV = (
    "(SELECT event_id, ts, user_id, event_type, value, props, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, "
    "epoch_us(ts) // 1000000 AS t FROM events)"
)


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.replace("{EV}", EV)
        return fn

    return register
