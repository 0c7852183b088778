"""Scalar functions."""

from pyspark.sql import functions as F

from eventmill.functions import scalar
from eventmill.plans.registry import query
from eventmill.sources.tables import table, with_item


def behaviour(spark, sf_dir):
    return with_item(table(spark, sf_dir, "events"))


@query(
    "fn_get_json_object",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def fn_get_json_object(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k")
    )


def packed(spark, sf_dir):
    """Lists as text: three ids, then two or three prices, then three quantities."""
    k, uid = F.col("item_id").cast("string"), F.col("user_id").cast("string")
    eid = F.col("event_id").cast("string")
    prices = F.when(F.col("item_id") % 3 == 0, F.concat_ws(",", k, uid)).otherwise(
        F.concat_ws(",", k, uid, eid)
    )
    return behaviour(spark, sf_dir).select(
        "event_id", "user_id", "item_id",
        F.concat_ws(",", eid, uid, k).alias("ids"), prices.alias("prices"),
        F.concat_ws("-", F.concat_ws(",", eid, uid, k), prices).alias("packed2"),
        F.concat_ws("-", F.concat_ws(",", eid, uid, k), prices, F.concat_ws(",", uid, uid, uid))
        .alias("packed3"),
    )


@query(
    "fn_split_index",
    "SELECT event_id, CAST(item_id AS VARCHAR) AS first, CAST(user_id AS VARCHAR) AS second, "
    "CASE WHEN item_id % 3 = 0 THEN 'missing' ELSE CAST(event_id AS VARCHAR) END AS third "
    "FROM {EV}",
)
def fn_split_index(spark, sf_dir):
    return packed(spark, sf_dir).select(
        "event_id",
        scalar.split_index("prices", 0).alias("first"),
        scalar.split_index("prices", 1).alias("second"),
        F.coalesce(scalar.split_index("prices", 2), F.lit("missing")).alias("third"),
    )


@query(
    "fn_lateral_explode",
    "SELECT event_id, unnest(string_split(concat(event_id, ',', user_id, ',', item_id), ',')) "
    "AS item FROM {EV}",
)
def fn_lateral_explode(spark, sf_dir):
    packed(spark, sf_dir).createOrReplaceTempView("eventmill_lists")
    return spark.sql(
        "SELECT event_id, item FROM eventmill_lists "
        "LATERAL VIEW EXPLODE(SPLIT(ids, ',')) v AS item"
    )


@query(
    "fn_zip_lists",
    "SELECT event_id, CASE WHEN item_id % 3 = 0 THEN concat(event_id, ',', item_id, '->', "
    "user_id, ',', user_id) ELSE concat(event_id, ',', item_id, '->', user_id, ',', user_id, "
    "'->', item_id, ',', event_id) END AS zip2, CASE WHEN item_id % 3 = 0 THEN concat(event_id, "
    "',', item_id, ',', user_id, '->', user_id, ',', user_id, ',', user_id) ELSE concat(event_id, "
    "',', item_id, ',', user_id, '->', user_id, ',', user_id, ',', user_id, '->', item_id, ',', "
    "event_id, ',', user_id) END AS zip3 FROM {EV}",
)
def fn_zip_lists(spark, sf_dir):
    return packed(spark, sf_dir).select(
        "event_id",
        scalar.zip_packed("packed2", 2).alias("zip2"),
        scalar.zip_packed("packed3", 3).alias("zip3"),
    )


@query(
    "fn_regexp",
    "SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)', 2) AS host, "
    "regexp_replace(url, '[?#].*$', '') AS bare FROM pages",
)
def fn_regexp(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("url", "^(https?)://([^/]+)", 2).alias("host"),
        F.regexp_replace("url", "[?#].*$", "").alias("bare"),
    )


@query(
    "fn_lower_nullsafe",
    "SELECT o_orderkey, coalesce(lower(nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE "
    "o_orderpriority END, '')), 'none') AS priority FROM orders",
)
def fn_lower_nullsafe(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(scalar.lower_null_safe(text), F.lit("none")).alias("priority")
    )


@query(
    "fn_normalize_tokens",
    "SELECT item_id, array_to_string(list_filter(regexp_split_to_array(translate(lower(text), "
    "',.', ''), '\\s+'), lambda x: x <> ''), ' ') AS tokens FROM benchmark",
)
def fn_normalize_tokens(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        "item_id", F.array_join(scalar.normalize_tokens("text"), " ").alias("tokens")
    )


@query(
    "fn_url_decode",
    "SELECT page_id, 'a b/' || page_id || '=é & x' AS decoded, url FROM pages",
)
def fn_url_decode(spark, sf_dir):
    """A text with every kind of escape, and the URL after encoding and decoding it."""
    escaped = F.concat(
        F.lit("a+b%2F"), F.col("page_id").cast("string"), F.lit("%3d%C3%A9%20%26 x")
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", scalar.url_decode(escaped).alias("decoded"),
        scalar.url_decode(F.url_encode("url")).alias("url"),
    )


WEEK_SQL = (
    "CASE WHEN year(CAST(d AS DATE) + CAST(6 - dayofweek(d) AS INTEGER)) > year(d) THEN 1 "
    "ELSE (dayofyear(d) - 1 + dayofweek(date_trunc('year', d))) // 7 + 1 END"
)


@query(
    "fn_date_parts",
    "SELECT o_orderkey, CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS season, "
    f"CAST(month(d) AS BIGINT) AS month, CAST({WEEK_SQL} AS BIGINT) AS week, "
    "CAST(day(d) AS BIGINT) AS day, CAST(hour(d) AS BIGINT) AS hour FROM "
    "(SELECT o_orderkey, o_orderdate AS d FROM orders)",
)
def fn_date_parts(spark, sf_dir):
    parts = scalar.date_parts("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[c.cast("bigint").alias(n) for n, c in parts.items()]
    )


@query(
    "fn_period_starts",
    "SELECT o_orderkey, CAST(w AS VARCHAR) AS this_week, CAST(w - 7 AS VARCHAR) AS previous_week, "
    "CAST(w + 7 AS VARCHAR) AS next_week, CAST(m AS VARCHAR) AS this_month, "
    "CAST(CAST(m - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS previous_month, "
    "CAST(CAST(m + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month, "
    "CAST(d AS VARCHAR) AS today, CAST(d - 3 AS VARCHAR) AS shifted FROM (SELECT o_orderkey, d, "
    "d - CAST(dayofweek(d) AS INTEGER) AS w, CAST(date_trunc('month', d) AS DATE) AS m FROM "
    "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders))",
)
def fn_period_starts(spark, sf_dir):
    starts = scalar.period_starts("o_orderdate", shift_days=-3)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[c.cast("string").alias(n) for n, c in starts.items()]
    )


@query(
    "fn_date_format_validate",
    "SELECT event_id, item_id % 4 <> 0 AS valid, CASE WHEN item_id % 4 <> 0 THEN "
    "strftime(ts, '%Y%m%d') ELSE 'none' END AS compact, CASE WHEN item_id % 4 <> 0 THEN "
    "strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') ELSE 'none' END AS yesterday FROM {EV}",
)
def fn_date_format_validate(spark, sf_dir):
    text = F.when(F.col("item_id") % 4 == 0, F.date_format("ts", "yyyy/MM/dd")).otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    dated = behaviour(spark, sf_dir).select("event_id", text.alias("run_date"))
    day = scalar.parse_running_date("run_date")
    return dated.select(
        "event_id",
        scalar.is_running_date("run_date").alias("valid"),
        F.coalesce(F.date_format(day, "yyyyMMdd"), F.lit("none")).alias("compact"),
        F.coalesce(F.date_format(F.date_sub(day, 1), "yyyy-MM-dd"), F.lit("none")).alias(
            "yesterday"
        ),
    )


@query(
    "fn_epoch_seconds",
    "SELECT event_id, CASE WHEN item_id % 10 = 0 THEN -1 ELSE CAST(trunc(CAST(concat(t, '.', "
    "lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0')) AS DOUBLE) * 1000) AS BIGINT) "
    "END AS millis FROM {EV}",
)
def fn_epoch_seconds(spark, sf_dir):
    millis = F.unix_millis("ts")
    text = F.concat_ws(
        ".", F.unix_timestamp("ts").cast("string"),
        F.lpad((millis % 1000).cast("string"), 3, "0"),
    )
    server = F.when(F.col("item_id") % 10 == 0, "n/a").otherwise(text)
    return behaviour(spark, sf_dir).select(
        "event_id", scalar.epoch_millis(server).alias("millis")
    )
