"""Streaming forms over the file stream of a table.

Each drains what is available and returns the closed part of its result, which
must equal the batch form. The watermark follows the rows that reach it, so row
filters come first in both forms.
"""

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmill.functions.parse import parse_json_order
from eventmill.operators.rows import hash_split
from eventmill.operators.windows import (
    closed_windows,
    merge_panes,
    top_n_of_panes,
    top_n_per_window,
)
from eventmill.plans.registry import query
from eventmill.plans.windows import sliding_sql
from eventmill.session import use_rocksdb_state, work_dir
from eventmill.sinks.batches import KeyedTable, RollingReport, routes, start_outputs
from eventmill.sinks.tables import messages
from eventmill.sources.readers import message_values, stream_source
from eventmill.sources.tables import table, table_stream, with_item
from eventmill.streaming import drain, ordered, windowed
from eventmill.streaming.arrivals import heartbeat, replayed
from eventmill.streaming.firing import OUTPUT as FIRED
from eventmill.streaming.firing import firing_windows
from eventmill.streaming.recovery import run_in_parts

HOUR, DAY = 3600, 86400


def closed_sql(sql, delay, where="true", column="window_end * 1000000"):
    return (
        f"SELECT * FROM ({sql}) WHERE {column} <= (SELECT max(epoch_us(ts)) FROM events "
        f"WHERE {where}) - {delay * 1000000}"
    )


def events(spark, sf_dir, disorder=0):
    """All events in several micro-batches, less than ``disorder`` s out of order."""
    return replayed(table(spark, sf_dir, "events"), "ts", disorder, per_trigger=4, close=False)


def views(spark, sf_dir, disorder=0):
    return with_item(events(spark, sf_dir, disorder)).filter(F.col("event_type") == "view")


VIEWS = "event_type = 'view'"
HOURLY_VIEWS = (
    "SELECT (t // 3600 + 1) * 3600 AS window_end, count(*) AS cnt FROM {EV} "
    "WHERE event_type = 'view' GROUP BY 1"
)


@query("wm_ascending", closed_sql(HOURLY_VIEWS, 0, VIEWS))
def wm_ascending(spark, sf_dir):
    stream = windowed.ascending(views(spark, sf_dir), "ts")
    return drain.drain_append(windowed.window_counts(stream, "ts", HOUR), "wm-ascending")


@query("wm_bounded", closed_sql(HOURLY_VIEWS, 10, VIEWS))
def wm_bounded(spark, sf_dir):
    stream = windowed.bounded(views(spark, sf_dir, 10), "ts", 10)
    return drain.drain_append(windowed.window_counts(stream, "ts", HOUR), "wm-bounded")


@query("wm_periodic_punctuated", closed_sql(HOURLY_VIEWS, 60, VIEWS))
def wm_periodic_punctuated(spark, sf_dir):
    """Only views move the watermark, by their time less a minute; counts of these marks."""
    marked = windowed.punctuated(
        events(spark, sf_dir), "ts", F.col("event_type") == "view", 60
    )
    marks = marked.filter(F.col("mark_ts").isNotNull())
    return drain.drain_append(windowed.window_counts(marks, "mark_ts", HOUR), "wm-punctuated")


@query("late_allowed_update", HOURLY_VIEWS)
def late_allowed_update(spark, sf_dir):
    """Update mode: a window's count is refreshed by late rows while it is open."""
    stream = windowed.bounded(views(spark, sf_dir, 70), "ts", 10, lateness=60)
    batches = drain.drain_batches(
        windowed.window_counts(stream, "ts", HOUR), "late-allowed", "update",
        "cnt bigint, window_end bigint",
    )
    return drain.final_values(batches, ["window_end"])


LATENESS = 2 * DAY
# Of the views in the first half of the time, three of ten come late: after the others
# of that half, and before the second half. What the stream has reached by then:
LATE_INPUT = """
WITH views AS (SELECT *, epoch_us(ts) // 1000000 AS t, (epoch_us(ts) // 3600000000 + 1) * 3600
    AS window_end FROM events WHERE event_type = 'view'),
half AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS us FROM views),
parts AS (SELECT views.*, CASE WHEN epoch_us(ts) >= us THEN 3 WHEN event_id % 10 < 3 THEN 2
    ELSE 1 END AS part FROM views, half),
reached AS (SELECT max(epoch_us(ts)) / 1000000 - 10 AS mark FROM parts WHERE part = 1),
judged AS (SELECT parts.*, part = 2 AND window_end + {lateness} <= mark AS late,
    part = 2 AND window_end <= mark AND window_end + {lateness} > mark AS again FROM parts, reached)
""".replace("{lateness}", str(LATENESS))


def late_views(spark, sf_dir):
    """Three parts of the views and a heartbeat, each its own run of the query."""
    views = table(spark, sf_dir, "events").filter("event_type = 'view'").select("event_id", "ts")
    us = F.unix_micros("ts")
    half = views.agg(F.floor((F.min(us) + F.max(us)) / 2).cast("bigint")).scalar()
    second, late = us >= half, F.col("event_id") % 10 < 3
    parts = [views.filter(~second & ~late), views.filter(~second & late), views.filter(second)]
    return run_in_parts(
        [*parts, heartbeat(views, "ts")], "event_id bigint, ts timestamp",
        lambda stream, out: drain.start_append(
            firing_windows(stream, "ts", "event_id", HOUR, 10, LATENESS), out, out + "-checkpoint"
        ),
    )


@query(
    "late_allowed",
    LATE_INPUT + """,
base AS (SELECT window_end, count(*) AS cnt FROM judged WHERE NOT late AND NOT again
    GROUP BY window_end),
late_rows AS (SELECT window_end, row_number() OVER (PARTITION BY window_end) AS k
    FROM judged WHERE again)
SELECT window_end, 1 AS firing, cnt FROM base
UNION ALL SELECT window_end, k + CASE WHEN cnt IS NULL THEN 0 ELSE 1 END, k + coalesce(cnt, 0)
FROM late_rows LEFT JOIN base USING (window_end)""",
)
def late_allowed(spark, sf_dir):
    """Hourly counts that fire at the watermark and again, whole, for each late row."""
    found = spark.read.schema(FIRED).parquet(late_views(spark, sf_dir))
    return found.filter("outcome = 'fired'").select("window_end", "firing", "cnt")


@query(
    "late_dropped_rows",
    LATE_INPUT + """SELECT window_end, count(*) FILTER (NOT late) AS kept,
    count(*) FILTER (late) AS dropped FROM judged GROUP BY window_end""",
)
def late_dropped_rows(spark, sf_dir):
    """Rows counted and rows too late for their window; together all rows."""
    found = spark.read.schema(FIRED).parquet(late_views(spark, sf_dir))
    return found.groupBy("window_end").agg(
        F.coalesce(F.max("cnt"), F.lit(0)).alias("kept"),
        F.count("row_id").alias("dropped"),
    )



UV = (
    "SELECT (t // 3600 + 1) * 3600 AS window_end, count(DISTINCT user_id) AS uv FROM {EV} "
    "WHERE event_type = 'view' GROUP BY 1"
)


@query("win_tumbling_uv_stream", closed_sql(UV, 60, VIEWS))
def win_tumbling_uv_stream(spark, sf_dir):
    stream = windowed.bounded(views(spark, sf_dir, 60), "ts", 60)
    return drain.drain_append(
        windowed.unique_visitors(stream, "ts", "user_id", HOUR), "uv-stream"
    )


@query("win_tumbling_uv_bitmap_stream", UV)
def win_tumbling_uv_bitmap_stream(spark, sf_dir):
    stream = windowed.bounded(views(spark, sf_dir, 60), "ts", 60)
    batches = drain.drain_batches(
        windowed.unique_visitor_bits(stream, "ts", "user_id", HOUR), "uv-bits", "update",
        "window_end bigint, bucket bigint, bits bigint",
    )
    bits = drain.final_values(batches, ["window_end", "bucket"])
    return bits.groupBy("window_end").agg(F.sum("bits").alias("uv"))


@query(
    "win_sliding_pv_stream",
    closed_sql(
        sliding_sql(HOUR, 300, "window_end, count(*) AS cnt", "window_end", VIEWS), 60, VIEWS
    ),
)
def win_sliding_pv_stream(spark, sf_dir):
    stream = windowed.bounded(views(spark, sf_dir, 60), "ts", 60)
    return drain.drain_append(windowed.window_counts(stream, "ts", HOUR, 300), "pv-stream")


@query(
    "win_sliding_by_province_stream",
    closed_sql(
        sliding_sql(HOUR, 300, "window_end, event_type AS province, count(*) AS cnt",
                    "window_end, event_type"), 60,
    ),
)
def win_sliding_by_province_stream(spark, sf_dir):
    stream = windowed.bounded(
        events(spark, sf_dir, 60).withColumnRenamed("event_type", "province"), "ts", 60
    )
    return drain.drain_append(
        windowed.window_counts(stream, "ts", HOUR, 300, ["province"]), "province-stream"
    )


@query(
    "win_recent_by_region_stream",
    closed_sql(
        sliding_sql(1200, 600, "window_end, event_type AS region, count(*) AS cnt, "
                    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total",
                    "window_end, event_type"), 60,
    ),
)
def win_recent_by_region_stream(spark, sf_dir):
    stream = windowed.bounded(
        events(spark, sf_dir, 60).withColumnRenamed("event_type", "region"), "ts", 60
    )
    aggs = [
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    ]
    return drain.drain_append(
        windowed.window_counts(stream, "ts", 1200, 600, ["region"], aggs), "region-stream"
    )


def wide_windows(spark, sf_dir, kept, delay, size, slide, keys, label):
    """Windows of many slides: the stream keeps panes only, windows merge from their table.

    State is one row per key and open pane, not one per window a row falls in.
    """
    pane = math.gcd(size, slide)
    panes = drain.drain_append(
        windowed.window_counts(windowed.bounded(kept, "ts", delay), "ts", pane, keys=keys), label
    ).withColumn("_pane", (F.col("window_end") / pane).cast("bigint") - 1)
    merged = merge_panes(panes.drop("window_end"), size, slide, keys, {"cnt": "count"})
    seen = table(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    return closed_windows(merged, seen, "ts", delay)


@query(
    "win_sliding_total_stream",
    closed_sql(
        sliding_sql(HOUR, 10, "window_end, count(*) AS cnt", "window_end",
                    "event_type <> 'error'"), 60, "event_type <> 'error'",
    ),
)
def win_sliding_total_stream(spark, sf_dir):
    kept = events(spark, sf_dir, 60).filter(F.col("event_type") != "error")
    return wide_windows(spark, sf_dir, kept, 60, HOUR, 10, [], "total-stream")


@query(
    "win_sliding_by_channel_behavior_stream",
    closed_sql(
        sliding_sql(HOUR, 10, "window_end, concat('channel-', item_id % 4) AS channel, "
                    "event_type AS behavior, count(*) AS cnt",
                    "window_end, item_id % 4, event_type", "event_type <> 'error'"),
        60, "event_type <> 'error'",
    ),
)
def win_sliding_by_channel_behavior_stream(spark, sf_dir):
    kept = with_item(events(spark, sf_dir, 60)).filter(F.col("event_type") != "error").select(
        "ts", F.concat(F.lit("channel-"), (F.col("item_id") % 4).cast("string")).alias("channel"),
        F.col("event_type").alias("behavior"),
    )
    return wide_windows(
        spark, sf_dir, kept, 60, HOUR, 10, ["channel", "behavior"], "channel-stream"
    )


@query(
    "win_sliding_min_stream",
    closed_sql(
        sliding_sql(15, 5, "window_end, user_id AS sensor_id, min(value) AS min_value",
                    "window_end, user_id"), 1,
    ),
)
def win_sliding_min_stream(spark, sf_dir):
    stream = windowed.bounded(
        events(spark, sf_dir, 1).withColumnRenamed("user_id", "sensor_id"), "ts", 1
    )
    lowest = [F.min("value").alias("min_value")]
    return drain.drain_append(
        windowed.window_counts(stream, "ts", 15, 5, ["sensor_id"], lowest), "min-stream"
    )


def ranked(counts, label, key):
    """Rank each closed window; all its counts arrive in the batch that closes it."""
    schema = f"{key} {counts.schema[key].dataType.simpleString()}, cnt bigint, " \
        "window_end bigint, rank_no int"
    batches = drain.drain_batches(
        counts, label, "append", schema,
        lambda batch: top_n_per_window(batch, 20, "cnt", [key]),
    )
    return batches.select("window_end", key, "cnt", F.col("rank_no").cast("bigint"))


def top_sql(counts, key):
    return (
        f"SELECT window_end, {key}, cnt, rank_no FROM (SELECT *, row_number() OVER (PARTITION BY "
        f"window_end ORDER BY cnt DESC, {key}) AS rank_no FROM ({counts})) WHERE rank_no <= 20"
    )


@query(
    "topn_items_per_window_stream",
    closed_sql(
        top_sql(sliding_sql(HOUR, 300, "window_end, item_id, count(*) AS cnt",
                            "window_end, item_id", VIEWS), "item_id"), 0, VIEWS,
    ),
)
def topn_items_per_window_stream(spark, sf_dir):
    stream = windowed.ascending(views(spark, sf_dir), "ts")
    counts = windowed.window_counts(stream, "ts", HOUR, 300, ["item_id"])
    return ranked(counts, "top-items", "item_id")


@query(
    "topn_urls_per_window_stream",
    closed_sql(
        top_sql(sliding_sql(600, 5, "window_end, url, count(*) AS cnt", "window_end, url",
                            source="(SELECT *, concat('/', event_type, '/', item_id) AS url "
                            "FROM {EV})"), "url"), 70,
    ),
)
def topn_urls_per_window_stream(spark, sf_dir):
    hits = with_item(events(spark, sf_dir, 70)).select(
        "ts", F.concat(F.lit("/"), "event_type", F.lit("/"), F.col("item_id").cast("string"))
        .alias("url"),
    )
    stream = windowed.bounded(hits, "ts", 10, lateness=60)
    panes = drain.drain_append(windowed.window_counts(stream, "ts", 5, keys=["url"]), "url-panes")
    panes = panes.withColumn("_pane", (F.col("window_end") / 5).cast("bigint") - 1)
    closed = table(spark, sf_dir, "events").agg(
        F.floor((F.max(F.unix_micros("ts")) - 70 * 1_000_000) / 1_000_000).cast("bigint")
    ).first()[0]
    top = top_n_of_panes(
        panes.drop("window_end"), 600, 5, 20, "cnt", "url", {"cnt": "count"}, until=closed
    )
    return top.select("window_end", "url", "cnt", F.col("rank_no").cast("bigint"))


@query(
    "win_processing_batch_stream",
    "SELECT event_type, count(*) AS cnt, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "
    "total FROM events GROUP BY 1",
)
def win_processing_batch_stream(spark, sf_dir):
    """Per-batch SQL and sink; the per-batch reports add up to the table."""

    def report(batch):
        return batch.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("cnt"),
            F.sum(F.col("value").cast("decimal(18,2)")).alias("total"),
        )

    batches = drain.drain_batches(
        events(spark, sf_dir).select("event_type", "value"), "per-batch", "append",
        "event_type string, cnt bigint, total decimal(28,2)", report,
    )
    return batches.groupBy("event_type").agg(
        F.sum("cnt").alias("cnt"), F.sum("total").cast("double").alias("total")
    )


TOTALS = (
    "SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS cnt "
    "FROM events GROUP BY 1"
)
TOTAL_SCHEMA = "user_id bigint, total double, cnt bigint"


@query("state_running_total_changed", TOTALS)
def state_running_total_changed(spark, sf_dir):
    totals = windowed.running_totals(events(spark, sf_dir, HOUR), ["user_id"], "value")
    batches = drain.drain_batches(totals, "changed-totals", "update", TOTAL_SCHEMA)
    return drain.final_values(batches, ["user_id"])


@query("state_running_total_all", TOTALS)
def state_running_total_all(spark, sf_dir):
    totals = windowed.running_totals(events(spark, sf_dir, HOUR), ["user_id"], "value")
    batches = drain.drain_batches(totals, "all-totals", "complete", TOTAL_SCHEMA)
    return drain.last_batch(batches)


@query(
    "state_word_count",
    "SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS "
    "word FROM conversations) WHERE trim(word) <> '' GROUP BY word",
)
def state_word_count(spark, sf_dir):
    use_rocksdb_state(spark)
    counts = windowed.word_counts(table_stream(spark, sf_dir, "conversations"), "text")
    batches = drain.drain_batches(counts, "words", "update", "word string, cnt bigint")
    return drain.final_values(batches, ["word"])


# -- joins of two streams --------------------------------------------------------------

SIX_HOURS = 6 * HOUR


def two_streams(spark, sf_dir, delay=60):
    pays = events(spark, sf_dir, delay).filter(F.col("event_type") == "signup").select(
        "user_id", F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts")
    )
    receipts = events(spark, sf_dir, delay).filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts")
    )
    return (
        pays.withWatermark("pay_ts", f"{delay} seconds"),
        receipts.withWatermark("receipt_ts", f"{delay} seconds"),
    )


def arriving_kind(spark, sf_dir, kind, name):
    """One kind of event under its own names; the heartbeat, which has no kind, stays."""
    rows = arriving(spark, sf_dir).filter((F.col("event_type") == kind) | F.col("event_type").isNull())
    return rows.select(
        "user_id", F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts")
    ).withWatermark(f"{name}_ts", f"{DISORDER} seconds")


JOINED = (
    "(SELECT * FROM events WHERE event_type = 'signup') p {how} JOIN (SELECT * FROM events WHERE "
    "event_type = 'purchase') r ON p.user_id = r.user_id AND epoch_us(r.ts) - epoch_us(p.ts) "
    "BETWEEN -21600000000 AND 21600000000"
)


@query(
    "join_interval_stream",
    "SELECT p.user_id, p.event_id AS pay_id, r.event_id AS receipt_id FROM " + JOINED.format(how=""),
)
def join_interval_stream(spark, sf_dir):
    pays, receipts = two_streams(spark, sf_dir)
    pairs = windowed.interval_pairs(
        pays, receipts, "user_id", "pay_ts", "receipt_ts", -SIX_HOURS, SIX_HOURS
    )
    return drain.drain_append(pairs.select("user_id", "pay_id", "receipt_id"), "pairs")


@query(
    "match_two_streams_stream",
    "SELECT coalesce(p.user_id, r.user_id) AS user_id, coalesce(p.event_id, -1) AS pay_id, "
    "coalesce(r.event_id, -1) AS receipt_id, CASE WHEN r.event_id IS NULL THEN 'left_only' WHEN "
    "p.event_id IS NULL THEN 'right_only' ELSE 'matched' END AS status FROM "
    + JOINED.format(how="FULL"),
)
def match_two_streams_stream(spark, sf_dir):
    """Matches and both kinds of unmatched rows, from one full outer join of two streams."""
    found = windowed.full_outer_pairs(
        *(arriving_kind(spark, sf_dir, kind, name)
          for kind, name in (("signup", "pay"), ("purchase", "receipt"))),
        "user_id", "pay_ts", "receipt_ts", -SIX_HOURS, SIX_HOURS,
    )
    pairs = drain.drain_append(found.select("user_id", "pay_id", "receipt_id"), "full-matches")
    # The heartbeats are rows without an id.
    pairs = pairs.filter("pay_id IS NOT NULL OR receipt_id IS NOT NULL")
    missing = F.lit(-1).cast("bigint")
    return pairs.select(
        "user_id", F.coalesce("pay_id", missing).alias("pay_id"),
        F.coalesce("receipt_id", missing).alias("receipt_id"),
        F.when(F.col("receipt_id").isNull(), "left_only")
        .when(F.col("pay_id").isNull(), "right_only").otherwise("matched").alias("status"),
    )


@query(
    "match_two_streams_once",
    """
WITH RECURSIVE numbered AS (
  SELECT user_id, event_id AS id, event_type AS kind, epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events WHERE event_type IN ('signup', 'purchase')),
walk AS (
  SELECT DISTINCT user_id, 0::BIGINT AS n, NULL::BIGINT AS id, NULL::VARCHAR AS kind,
         NULL::BIGINT AS other, []::STRUCT(id BIGINT, us BIGINT, kind VARCHAR)[] AS waiting
  FROM numbered
  UNION ALL
  SELECT user_id, n, id, kind, c[-1].id, CASE WHEN len(c) > 0
         THEN list_filter(live, lambda x: x.id <> c[-1].id)
         ELSE list_append(live, {'id': id, 'us': us, 'kind': kind}) END
  FROM (SELECT *, list_filter(live, lambda x: x.kind <> s.kind) AS c
        FROM (SELECT w.user_id, r.n, r.id, r.us, r.kind,
                     list_filter(w.waiting, lambda x: x.us >= r.us - 21600000000) AS live
              FROM walk w JOIN numbered r ON r.user_id = w.user_id AND r.n = w.n + 1) s)),
pairs AS (SELECT user_id, CASE kind WHEN 'signup' THEN id ELSE other END AS pay_id,
    CASE kind WHEN 'signup' THEN other ELSE id END AS receipt_id FROM walk WHERE other IS NOT NULL)
SELECT user_id, pay_id, receipt_id, 'matched' AS status FROM pairs
UNION ALL SELECT user_id, id, -1, 'left_only' FROM numbered
  WHERE kind = 'signup' AND id NOT IN (SELECT pay_id FROM pairs)
UNION ALL SELECT user_id, -1, id, 'right_only' FROM numbered
  WHERE kind = 'purchase' AND id NOT IN (SELECT receipt_id FROM pairs)
""",
)
def match_two_streams_once(spark, sf_dir):
    """Greedy matching to the nearest earlier row of the other stream, each row used once."""
    rule = ordered.MatchOnceRule("signup", "purchase", SIX_HOURS)
    missing = F.lit(-1).cast("bigint")
    return ruled(spark, sf_dir, "matched-once", rule).select(
        "user_id", F.coalesce("left_id", missing).alias("pay_id"),
        F.coalesce("right_id", missing).alias("receipt_id"), "status",
    )


# -- keyed state and patterns --------------------------------------------------------

# Rows arrive up to six hours out of order, in eight files and more; a heartbeat ends the
# stream, so every rule gives its whole result.
DISORDER = 6 * HOUR
# Groups of keys that share state: many more than cores, far fewer than keys. A group has
# the rows of many keys in a slice of time, which may so be wide.
GROUPS = {"groups": 256, "slice_seconds": DISORDER}


def arriving(spark, sf_dir):
    return replayed(table(spark, sf_dir, "events"), "ts", DISORDER)


def ruled(spark, sf_dir, label, rule, keys=("user_id",), mode="append"):
    stream = ordered.apply_rule(
        arriving(spark, sf_dir), keys, "ts", rule, DISORDER,
        row_id="event_id", kind="event_type", value="value", mode=mode, **GROUPS,
    )
    return drain.drain_append(stream, label)


@query(
    "state_change_alert_stream",
    "SELECT user_id, event_id, prev_value, value FROM (SELECT *, lag(value) OVER "
    "(PARTITION BY user_id ORDER BY ts, event_id) AS prev_value FROM events) "
    f"WHERE abs(value - prev_value) > 10.0",
)
def state_change_alert_stream(spark, sf_dir):
    return ruled(spark, sf_dir, "changes", ordered.ChangeRule(10.0))


@query(
    "state_rising_alert_stream",
    "WITH d AS (SELECT *, epoch_us(ts) AS us, CASE WHEN value < lag(value) OVER w THEN 1 ELSE 0 "
    "END AS dropped FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), "
    "r AS (SELECT *, sum(dropped) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM d), "
    "f AS (SELECT *, min(us) OVER (PARTITION BY user_id, run) AS first_us FROM r) "
    "SELECT user_id, first_us, min(us) AS alert_us FROM f WHERE us - first_us >= 86400000000 "
    "GROUP BY user_id, run, first_us",
)
def state_rising_alert_stream(spark, sf_dir):
    return ruled(spark, sf_dir, "rising", ordered.RisingRule(DAY))


@query(
    "state_rate_limit_blacklist_stream",
    "SELECT event_id, user_id, event_type, nth, CASE WHEN nth <= 2 THEN 'pass' ELSE 'warn' END "
    "AS outcome FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, t // 86400 "
    "ORDER BY ts, event_id) AS nth FROM {EV}) WHERE nth <= 3",
)
def state_rate_limit_blacklist_stream(spark, sf_dir):
    return ruled(
        spark, sf_dir, "limited", ordered.RateLimitRule(2), ("user_id", "event_type")
    )


@query(
    "pat_strict_next_stream",
    "SELECT user_id, epoch_us(prev_ts) AS first_us, epoch_us(ts) AS last_us FROM (SELECT *, "
    "lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type FROM events "
    "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'error' "
    "AND prev_type = 'error' AND epoch_us(ts) - epoch_us(prev_ts) < 86400000000",
)
def pat_strict_next_stream(spark, sf_dir):
    return ruled(spark, sf_dir, "strict", ordered.StrictNextRule("error", DAY))


@query(
    "pat_followed_by_stream",
    "SELECT user_id, event_id, epoch_us(ts) AS create_us, CASE WHEN pay_us - epoch_us(ts) < "
    "86400000000 THEN pay_us ELSE -1 END AS pay_us, CASE WHEN pay_us - epoch_us(ts) < 86400000000 "
    "THEN 'paid' ELSE 'timeout' END AS status FROM (SELECT *, min(CASE WHEN event_type = "
    "'purchase' THEN epoch_us(ts) END) OVER (PARTITION BY user_id ORDER BY ts, event_id "
    "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_us FROM events) "
    "WHERE event_type = 'signup'",
)
def pat_followed_by_stream(spark, sf_dir):
    return ruled(spark, sf_dir, "followed", ordered.FollowedByRule("signup", "purchase", DAY))


@query(
    "pat_fail_burst_stream",
    """
WITH RECURSIVE logins AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS us,
         sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
           OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seg
  FROM events WHERE event_type IN ('error', 'signup')),
fails AS (SELECT user_id, seg, us FROM logins WHERE event_type = 'error'),
periods AS (
  SELECT user_id, seg, min(us) AS first_us FROM fails GROUP BY user_id, seg
  UNION ALL
  SELECT p.user_id, p.seg, (SELECT min(f.us) FROM fails f WHERE f.user_id = p.user_id
         AND f.seg = p.seg AND f.us > p.first_us + 172800000000) AS first_us
  FROM periods p WHERE EXISTS (SELECT 1 FROM fails f WHERE f.user_id = p.user_id
         AND f.seg = p.seg AND f.us > p.first_us + 172800000000))
SELECT p.user_id, p.first_us, max(f.us) AS last_us, count(*) AS fails
FROM periods p JOIN fails f ON f.user_id = p.user_id AND f.seg = p.seg
 AND f.us BETWEEN p.first_us AND p.first_us + 172800000000
GROUP BY p.user_id, p.seg, p.first_us HAVING count(*) >= 2
""",
)
def pat_fail_burst_stream(spark, sf_dir):
    """Periods that the watermark or a success has closed."""
    return ruled(
        spark, sf_dir, "bursts", ordered.FailBurstRule("error", "signup", 2, 2 * DAY)
    )


@query(
    "pat_order_outcome_stream",
    "WITH f AS (SELECT user_id, min(CASE WHEN event_type = 'signup' THEN epoch_us(ts) END) AS c, "
    "min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS p FROM events "
    "GROUP BY user_id) SELECT user_id, CASE WHEN c IS NULL THEN 'paid_without_create' "
    "WHEN p IS NULL THEN 'timeout' WHEN p - c < 86400000000 THEN 'paid' ELSE "
    "'paid_late' END AS outcome FROM f WHERE c IS NOT NULL OR p IS NOT NULL",
)
def pat_order_outcome_stream(spark, sf_dir):
    stream = ordered.apply_rule(
        arriving(spark, sf_dir), ("user_id",), "ts",
        ordered.OrderOutcomeRule("signup", "purchase", DAY), DISORDER,
        row_id="event_id", kind="event_type", mode="update", **GROUPS,
    )
    batches = drain.drain_batches(
        stream, "outcomes", "update", "user_id bigint, outcome string, judged_us bigint",
    )
    last = F.max_by("outcome", "judged_us").alias("outcome")
    return batches.groupBy("user_id").agg(last)


# -- sinks of micro-batches ------------------------------------------------------------


def order_parts(spark, sf_dir, parts):
    """The orders as a stream of ``parts`` batches, each the rest of a division of the key."""
    use_rocksdb_state(spark)
    path = work_dir(spark, "order-parts")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("amount"),
        (F.col("o_custkey") % 34).alias("province_id"),
    )
    for i in range(parts):
        rows.filter(F.col("o_orderkey") % parts == i).coalesce(1).write.mode("append").parquet(path)
    return stream_source(spark, "parquet", path, rows.schema, maxFilesPerTrigger=1)


@query(
    "side_output_stream",
    "SELECT o_orderkey, CASE WHEN amount >= 200000 THEN 'alert' ELSE 'main' END AS output, "
    "CASE WHEN amount >= 200000 THEN concat('large order ', o_orderkey) END AS note "
    "FROM (SELECT *, o_totalprice AS amount FROM orders)",
)
def side_output_stream(spark, sf_dir):
    """Two sinks of one pass: rows of the main output, texts of the side output."""
    large = F.col("amount") >= 200_000
    outputs = {
        "main": lambda b: b.filter(~large).select("o_orderkey"),
        "alert": lambda b: b.filter(large).select(
            "o_orderkey", F.concat(F.lit("large order "), "o_orderkey").alias("note")
        ),
    }
    path = work_dir(spark, "side-output")
    start_outputs(order_parts(spark, sf_dir, 3), outputs, path, path + "-checkpoint").awaitTermination()
    main = spark.read.schema("o_orderkey bigint").parquet(f"{path}/main")
    alerts = spark.read.schema("o_orderkey bigint, note string").parquet(f"{path}/alert")
    return main.select(
        "o_orderkey", F.lit("main").alias("output"), F.lit(None).cast("string").alias("note")
    ).unionByName(alerts.select("o_orderkey", F.lit("alert").alias("output"), "note"))


@query(
    "route_by_type_stream",
    "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'other' END "
    "AS route FROM orders",
)
def route_by_type_stream(spark, sf_dir):
    """Each order in the folder of its type; unknown types have one of their own."""
    path = work_dir(spark, "routes")
    outputs = routes("o_orderstatus", ["F", "O"])
    start_outputs(order_parts(spark, sf_dir, 3), outputs, path, path + "-checkpoint").awaitTermination()
    found = [
        spark.read.schema("o_orderkey bigint").parquet(f"{path}/{name}")
        .select("o_orderkey", F.lit(name).alias("route"))
        for name in outputs
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "snk_upsert_stream",
    "SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS o_orderkey, "
    "max(o_totalprice) AS amount FROM orders GROUP BY 1",
)
def snk_upsert_stream(spark, sf_dir):
    """The largest order of every customer, kept by batches of orders."""
    path = work_dir(spark, "keyed")
    kept = KeyedTable(
        spark, path, "o_custkey bigint, o_orderkey bigint, amount double", ["o_custkey"],
        ["amount", "o_orderkey"], 16,
    )
    kept.start(order_parts(spark, sf_dir, 4), path + "-checkpoint").awaitTermination()
    return kept.read()


@query(
    "snk_kv_latest_stream",
    "SELECT user_id, event_type, epoch_us(max(ts)) AS us, arg_max(event_id, (ts, event_id)) AS event_id, "
    "arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2",
)
def snk_kv_latest_stream(spark, sf_dir):
    """The last value per user and event type, though rows arrive out of order."""
    path = work_dir(spark, "latest")
    schema = "user_id bigint, event_type string, ts timestamp, event_id bigint, value double"
    kept = KeyedTable(spark, path, schema, ["user_id", "event_type"], ["ts", "event_id"], 16)
    stream = arriving(spark, sf_dir).filter("event_id IS NOT NULL")
    kept.start(stream, path + "-checkpoint").awaitTermination()
    return kept.read().select("user_id", "event_type", F.unix_micros("ts").alias("us"), "event_id", "value")


REPORT_PARTS = 5


@query(
    "win_processing_report_stream",
    f"""
WITH parts AS (SELECT o_orderkey % {REPORT_PARTS} AS part, o_custkey % 34 AS province_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
sums AS (SELECT b AS batch_id, province_id, sum(amount) AS total, count(*) AS cnt
  FROM parts JOIN range({REPORT_PARTS}) r(b) ON part BETWEEN b - 2 AND b GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY total DESC, province_id)
  AS rank_no FROM sums)
SELECT batch_id, province_id, CAST(total AS DOUBLE) AS total, cnt, rank_no FROM ranked
WHERE rank_no <= 10
""",
)
def win_processing_report_stream(spark, sf_dir):
    """After every batch the ten provinces of largest sums over the last three batches."""
    path = work_dir(spark, "report")
    report = RollingReport(spark, path, "province_id", "amount")
    stream = order_parts(spark, sf_dir, REPORT_PARTS)
    report.start(stream, path + "-checkpoint").awaitTermination()
    order = W.partitionBy("batch_id").orderBy(F.desc("total"), "province_id")
    return report.reports().select(
        F.col("batch_id").cast("bigint").alias("batch_id"), "province_id",
        F.col("total").cast("double").alias("total"), "cnt",
        F.row_number().over(order).cast("bigint").alias("rank_no"),
    )


# -- operation -----------------------------------------------------------------------


@query("stream_recovery", TOTALS)
def stream_recovery(spark, sf_dir):
    """Stop after half of the rows, restart from the checkpoint, end with full totals."""
    halves = hash_split(
        table(spark, sf_dir, "events").select("event_id", "user_id", "value"),
        ["event_id"], [0.5, 0.5], 7,
    )
    path = run_in_parts(
        halves, "event_id bigint, user_id bigint, value double",
        lambda stream, out: drain.start_batches(
            windowed.running_totals(stream, ["user_id"], "value"), out, out + "-checkpoint",
            "update",
        ),
    )
    return drain.final_values(drain.read_batches(TOTAL_SCHEMA, spark, path), ["user_id"])


@query(
    "late_dropped",
    closed_sql(
        "SELECT (t // 3600 + 1) * 3600 AS window_end, count(*) AS cnt FROM {EV} WHERE NOT "
        "(event_type = 'signup' AND epoch_us(ts) < (SELECT max(epoch_us(ts)) - 86400000000 "
        "FROM events)) GROUP BY 1", 60,
    ),
)
def late_dropped(spark, sf_dir):
    """Signups older than a day arrive after the rest, when their windows are closed."""
    rows = table(spark, sf_dir, "events").select("ts", "event_type")
    old = F.unix_micros("ts") < rows.agg(F.max(F.unix_micros("ts")) - DAY * 1_000_000).scalar()
    is_late = (F.col("event_type") == "signup") & old
    path = run_in_parts(
        [rows.filter(~is_late), rows.filter(is_late)], "ts timestamp, event_type string",
        lambda stream, out: drain.start_append(
            windowed.window_counts(windowed.bounded(stream, "ts", 60), "ts", HOUR), out,
            out + "-checkpoint",
        ),
    )
    return spark.read.schema("cnt bigint, window_end bigint").parquet(path)


@query(
    "stream_rate_cap",
    "SELECT count(*) AS cnt, 4 AS batches FROM events",
)
def stream_rate_cap(spark, sf_dir):
    """One file per micro-batch: several capped batches, the same rows in the end."""
    use_rocksdb_state(spark)
    path = work_dir(spark, "capped")
    table(spark, sf_dir, "events").select("event_id", "value").repartition(4).write.parquet(path)
    stream = stream_source(
        spark, "parquet", path, "event_id bigint, value double", maxFilesPerTrigger=1
    )
    batches = drain.drain_batches(stream, "capped-out", "append", "event_id bigint, value double")
    return batches.agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count_distinct("batch_id").cast("int").alias("batches"),
    )


@query(
    "src_kafka_json",
    "SELECT o_orderkey AS order_id, o_custkey % 34 AS province_id, o_totalprice AS order_price "
    "FROM orders",
)
def src_kafka_json(spark, sf_dir):
    """Queue messages to typed rows; files stand in for the topic, the columns are its."""
    path = work_dir(spark, "topic")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderId"), (F.col("o_custkey") % 34).alias("provinceId"),
        F.col("o_totalprice").alias("orderPrice"),
    )
    messages(orders, "orderId").write.parquet(path)
    topic = stream_source(spark, "parquet", path, "key string, value string")
    parsed = parse_json_order(
        message_values(topic), "value", "orderId bigint, provinceId bigint, orderPrice double"
    )
    return drain.drain_append(
        parsed.select(
            F.col("orderId").alias("order_id"), F.col("provinceId").alias("province_id"),
            F.col("orderPrice").alias("order_price"),
        ),
        "orders-stream",
    )
