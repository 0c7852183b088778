"""Tumbling and sliding event-time windows, batch forms."""

from pyspark.sql import functions as F

from eventmill.operators import windows as win
from eventmill.operators.patterns import rate_limit
from eventmill.plans.registry import query
from eventmill.sources.tables import table, with_item

HOUR, MINUTES5, MINUTES10, MINUTES20, SECONDS10 = 3600, 300, 600, 1200, 10


def sliding_sql(size, slide, select, group, where="true", offset=0, source="{EV}"):
    """SQL check: unnest every window end that covers a row, then aggregate."""
    first = f"((t - {offset} - {size}) // {slide} + 1) * {slide} + {size} + {offset}"
    if size % slide:
        raise ValueError("the SQL check needs a size that is a multiple of the slide")
    last = f"((t - {offset}) // {slide} + 1) * {slide} + {size} + {offset}"
    return (
        f"SELECT {select} FROM (SELECT *, unnest(range({first}, {last}, {slide})) AS window_end "
        f"FROM {source} WHERE {where}) GROUP BY {group}"
    )


def behaviour(spark, sf_dir):
    return with_item(table(spark, sf_dir, "events"))


def views(spark, sf_dir):
    return behaviour(spark, sf_dir).filter(F.col("event_type") == "view")


@query(
    "topn_items_per_window",
    "SELECT window_end, item_id, cnt, rank_no FROM (SELECT *, row_number() OVER "
    "(PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank_no FROM ("
    + sliding_sql(HOUR, MINUTES5, "window_end, item_id, count(*) AS cnt",
                  "window_end, item_id", "event_type = 'view'")
    + ")) WHERE rank_no <= 20",
)
def topn_items_per_window(spark, sf_dir):
    counts = win.sliding_aggregate(views(spark, sf_dir), "ts", HOUR, MINUTES5, ["item_id"])
    top = win.top_n_per_window(counts, 20, "cnt", ["item_id"])
    return top.select("window_end", "item_id", "cnt", F.col("rank_no").cast("bigint"))


@query(
    "topn_urls_per_window",
    "SELECT window_end, url, cnt, rank_no FROM (SELECT *, row_number() OVER "
    "(PARTITION BY window_end ORDER BY cnt DESC, url) AS rank_no FROM ("
    + sliding_sql(MINUTES10, 5, "window_end, url, count(*) AS cnt", "window_end, url",
                  source="(SELECT *, concat('/', event_type, '/', item_id) AS url FROM {EV})")
    + ")) WHERE rank_no <= 20",
)
def topn_urls_per_window(spark, sf_dir):
    hits = behaviour(spark, sf_dir).withColumn(
        "url", F.concat(F.lit("/"), "event_type", F.lit("/"), F.col("item_id").cast("string"))
    )
    pane = win.floor_div(win.epoch("ts"), 5).alias("_pane")
    panes = hits.groupBy("url", pane).agg(F.count(F.lit(1)).alias("cnt"))
    top = win.top_n_of_panes(panes, MINUTES10, 5, 20, "cnt", "url", {"cnt": "count"})
    return top.select("window_end", "url", "cnt", F.col("rank_no").cast("bigint"))


UV_SQL = (
    "SELECT (t // 3600 + 1) * 3600 AS window_end, count(DISTINCT user_id) AS uv FROM {EV} "
    "WHERE event_type = 'view' GROUP BY 1"
)


@query("win_tumbling_uv", UV_SQL)
def win_tumbling_uv(spark, sf_dir):
    return win.unique_visitors(views(spark, sf_dir), "ts", "user_id", HOUR)


@query("win_tumbling_uv_bitmap", UV_SQL)
def win_tumbling_uv_bitmap(spark, sf_dir):
    return win.unique_visitors_bitmap(views(spark, sf_dir), "ts", "user_id", HOUR)


@query(
    "win_sliding_pv",
    sliding_sql(HOUR, MINUTES5, "window_end, count(*) AS pv", "window_end", "event_type = 'view'"),
)
def win_sliding_pv(spark, sf_dir):
    return win.sliding_aggregate(
        views(spark, sf_dir), "ts", HOUR, MINUTES5, aggs={"pv": ("count", None)}
    )


@query(
    "win_sliding_by_province",
    sliding_sql(HOUR, MINUTES5, "window_end, event_type AS province, count(*) AS cnt",
                "window_end, event_type"),
)
def win_sliding_by_province(spark, sf_dir):
    clicks = table(spark, sf_dir, "events").withColumnRenamed("event_type", "province")
    return win.sliding_aggregate(clicks, "ts", HOUR, MINUTES5, ["province"])


@query(
    "win_recent_by_region",
    sliding_sql(
        MINUTES20, MINUTES10,
        "window_end, event_type AS region, count(*) AS cnt, "
        "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total",
        "window_end, event_type",
    ),
)
def win_recent_by_region(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "ts", F.col("event_type").alias("region"), F.col("value").cast("decimal(18,2)")
    )
    recent = win.sliding_aggregate(
        events, "ts", MINUTES20, MINUTES10, ["region"],
        {"cnt": ("count", None), "total": ("sum", "value")},
    )
    return recent.withColumn("total", F.col("total").cast("double"))


@query(
    "win_sliding_total",
    sliding_sql(HOUR, SECONDS10,
                "window_end - 3600 AS window_start, window_end, 'app marketing' AS channel, "
                "'total' AS behavior, count(*) AS cnt",
                "window_end", "event_type <> 'error'"),
)
def win_sliding_total(spark, sf_dir):
    kept = table(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    total = win.sliding_aggregate(kept, "ts", HOUR, SECONDS10)
    return total.select(
        (F.col("window_end") - HOUR).alias("window_start"), "window_end",
        F.lit("app marketing").alias("channel"), F.lit("total").alias("behavior"), "cnt",
    )


@query(
    "win_sliding_by_channel_behavior",
    sliding_sql(HOUR, SECONDS10,
                "window_end - 3600 AS window_start, window_end, "
                "concat('channel-', item_id % 4) AS channel, event_type AS behavior, "
                "count(*) AS cnt",
                "window_end, item_id % 4, event_type", "event_type <> 'error'"),
)
def win_sliding_by_channel_behavior(spark, sf_dir):
    kept = (
        behaviour(spark, sf_dir)
        .filter(F.col("event_type") != "error")
        .select(
            "ts",
            F.concat(F.lit("channel-"), (F.col("item_id") % 4).cast("string")).alias("channel"),
            F.col("event_type").alias("behavior"),
        )
    )
    counts = win.sliding_aggregate(kept, "ts", HOUR, SECONDS10, ["channel", "behavior"])
    return counts.select(
        (F.col("window_end") - HOUR).alias("window_start"), "window_end", "channel",
        "behavior", "cnt",
    )


@query(
    "win_sliding_min",
    sliding_sql(15, 5, "window_end, user_id AS sensor_id, min(value) AS min_value",
                "window_end, user_id"),
)
def win_sliding_min(spark, sf_dir):
    readings = table(spark, sf_dir, "events").withColumnRenamed("user_id", "sensor_id")
    return win.sliding_aggregate(
        readings, "ts", 15, 5, ["sensor_id"], {"min_value": ("min", "value")}
    )


@query(
    "win_offset",
    sliding_sql(86400, 43200, "window_end, user_id, count(*) AS cnt", "window_end, user_id",
                offset=-8 * 3600),
)
def win_offset(spark, sf_dir):
    # Day windows that start at midnight in a zone eight hours ahead of UTC.
    return win.sliding_aggregate(
        table(spark, sf_dir, "events"), "ts", 86400, 43200, ["user_id"], offset=-8 * 3600
    )


@query(
    "win_processing_batch",
    "SELECT t // 15 AS batch_id, event_type, count(*) AS cnt, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {EV} GROUP BY 1, 2",
)
def win_processing_batch(spark, sf_dir):
    """Report per 15-second batch: the per-batch SQL of the streaming job, whole table."""
    table(spark, sf_dir, "events").createOrReplaceTempView("eventmill_batch_events")
    return spark.sql(
        "SELECT CAST(floor(unix_timestamp(ts) / 15) AS BIGINT) AS batch_id, event_type, "
        "count(*) AS cnt, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total "
        "FROM eventmill_batch_events GROUP BY 1, 2"
    )


@query(
    "win_after_blacklist",
    sliding_sql(HOUR, MINUTES5, "window_end, event_type AS province, count(*) AS cnt",
                "window_end, event_type",
                source="(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, "
                "event_type, t // 86400 ORDER BY ts, event_id) AS n FROM {EV}) WHERE n <= 2)"),
)
def win_after_blacklist(spark, sf_dir):
    passed = rate_limit(
        table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", 2, ["event_id"]
    ).filter(F.col("outcome") == "pass")
    return win.sliding_aggregate(
        passed.withColumnRenamed("event_type", "province"), "ts", HOUR, MINUTES5, ["province"]
    )
