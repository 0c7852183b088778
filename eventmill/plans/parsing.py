"""Parsing, filtering and enrichment.

Text lines are put together from table columns and parsed back, so the SQL
checks can compare every field with its source column.
"""

from pyspark.sql import functions as F

from eventmill.functions import enrich, parse
from eventmill.functions.scalar import row_key, version_dim
from eventmill.operators import rows
from eventmill.plans.registry import query
from eventmill.session import work_dir
from eventmill.sources.tables import table, with_item


def behaviour(spark, sf_dir):
    return with_item(table(spark, sf_dir, "events"))


def text(column):
    return F.col(column).cast("string")


@query(
    "parse_csv_events",
    "SELECT user_id, event_type, CASE WHEN item_id % 9 = 0 THEN -1 ELSE item_id END AS item_id, "
    "t AS event_time FROM {EV}",
)
def parse_csv_events(spark, sf_dir):
    item = F.when(F.col("item_id") % 9 == 0, "n/a").otherwise(text("item_id"))
    lines = behaviour(spark, sf_dir).select(
        F.concat_ws(" , ", text("user_id"), item, F.col("event_type"),
                    F.unix_timestamp("ts").cast("string")).alias("value")
    )
    fields = {
        "user_id": "bigint", "item_id": "bigint", "event_type": "string", "event_time": "bigint"
    }
    return parse.parse_delimited(lines, "value", fields).fillna({"item_id": -1})


@query(
    "parse_access_log",
    "SELECT concat('10.', user_id % 256, '.', item_id, '.1') AS ip, '-' AS client_ident, "
    "concat('u', user_id) AS user_id, strftime(ts, '%d/%b/%Y:%H:%M:%S +0000') AS date_time, "
    "'GET' AS method, concat('/', event_type, '/', item_id) AS endpoint, 'HTTP/1.1' AS protocol, "
    "CAST(200 + item_id AS INTEGER) AS response_code, event_id * 7 AS content_size FROM {EV} "
    "WHERE item_id % 13 <> 0",
)
def parse_access_log(spark, sf_dir):
    return parse.parse_access_log(access_lines(spark, sf_dir), "value")


def access_lines(spark, sf_dir):
    """Access-log lines of all events; those of every 13th item are malformed."""
    size = F.when(F.col("item_id") % 13 == 0, "-").otherwise(
        (F.col("event_id") * 7).cast("string")
    )
    stamp = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    return behaviour(spark, sf_dir).select(
        F.concat(
            F.lit("10."), (F.col("user_id") % 256).cast("string"), F.lit("."), text("item_id"),
            F.lit(".1 - u"), text("user_id"), F.lit(" ["), stamp, F.lit(' +0000] "GET /'),
            F.col("event_type"), F.lit("/"), text("item_id"), F.lit(' HTTP/1.1" '),
            (F.col("item_id") + 200).cast("string"), F.lit(" "), size,
        ).alias("value")
    )


@query(
    "parse_space_log",
    "SELECT concat('10.0.', item_id, '.1') AS ip, CAST(user_id AS VARCHAR) AS user_id, "
    "t AS event_time, 'GET' AS method, concat('/', event_type) AS url FROM {EV}",
)
def parse_space_log(spark, sf_dir):
    lines = behaviour(spark, sf_dir).select(
        F.concat(
            F.lit("10.0."), text("item_id"), F.lit(".1 "), text("user_id"), F.lit(" - "),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit(" +0000 GET /"),
            F.col("event_type"),
        ).alias("value")
    )
    parsed = parse.parse_space_log(lines, "value")
    return parsed.withColumn("event_time", F.unix_timestamp("event_time"))


ALIAS_SQL = (
    "CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' WHEN 'purchase' THEN 'e_cs' "
    "WHEN 'click' THEN 'e_e' ELSE 'e_x' END"
)


def tracking_lines(spark, sf_dir):
    """Tracking-log lines of all events; every 17th item lacks a separator."""
    alias = (
        F.when(F.col("event_type") == "signup", "e_l")
        .when(F.col("event_type") == "view", "e_pv")
        .when(F.col("event_type") == "purchase", "e_cs")
        .when(F.col("event_type") == "click", "e_e")
        .otherwise("e_x")
    )
    seconds = F.concat(F.unix_timestamp("ts").cast("string"), F.lit(".000"))
    last = F.when(F.col("item_id") % 17 == 0, "").otherwise("^A")
    title = F.url_encode(F.concat(F.lit("title & more = "), text("item_id")))
    return behaviour(spark, sf_dir).select(
        F.concat(
            F.lit("10.0.0."), text("item_id"), F.lit("^A"), seconds, F.lit("^Ahost"), last,
            F.lit("/log.gif?en="), alias, F.lit("&ver=1&pl=website&u_ud=u"), text("user_id"),
            F.lit("&u_mid=&tt="), title, F.lit("&ver=2"),
        ).alias("value")
    )


@query(
    "parse_tracking_log",
    "SELECT concat('10.0.0.', item_id) AS ip, concat(t, '.000') AS s_time, 'host' AS http_host, "
    f"{ALIAS_SQL} AS en, '2' AS ver, 'website' AS pl, concat('u', user_id) AS u_ud, "
    "'none' AS u_mid, concat('title & more = ', item_id) AS tt, 6 AS params "
    "FROM {EV} WHERE item_id % 17 <> 0",
)
def parse_tracking_log(spark, sf_dir):
    parsed = parse.parse_tracking_log(tracking_lines(spark, sf_dir), "value")
    return parsed.select(
        "ip", "s_time", "http_host",
        *[F.col("params")[k].alias(k) for k in ("en", "ver", "pl", "u_ud", "tt")],
        F.coalesce(F.col("params")["u_mid"], F.lit("none")).alias("u_mid"),
        F.size("params").alias("params"),
    )


@query(
    "enrich_user_agent",
    "SELECT event_id, CASE item_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN "
    "'Safari' ELSE 'IE' END AS browser, concat(item_id, '.0') AS browser_v, CASE item_id % 4 "
    "WHEN 0 THEN 'Windows' WHEN 1 THEN 'Android' WHEN 2 THEN 'iOS' ELSE 'Windows' END AS os, "
    "CASE item_id % 4 WHEN 0 THEN 'Windows 10' WHEN 1 THEN 'Android 4.4' WHEN 2 THEN 'iOS 12.1' "
    "ELSE 'Windows 7' END AS os_v FROM {EV}",
)
def enrich_user_agent(spark, sf_dir):
    k, version = F.col("item_id") % 4, F.concat(text("item_id"), F.lit(".0"))
    agent = (
        F.when(k == 0, F.concat(
            F.lit("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like "
                  "Gecko) Chrome/"), version, F.lit(" Safari/537.36")))
        .when(k == 1, F.concat(
            F.lit("Mozilla/5.0 (Android 4.4; Mobile; rv:1.0) Gecko/1.0 Firefox/"), version))
        .when(k == 2, F.concat(
            F.lit("Mozilla/5.0 (iPhone; CPU iPhone OS 12_1 like Mac OS X) AppleWebKit/605.1 "
                  "(KHTML, like Gecko) Version/"), version, F.lit(" Mobile Safari/604.1")))
        .otherwise(F.concat(
            F.lit("Mozilla/4.0 (compatible; MSIE "), version, F.lit("; Windows NT 6.1)")))
    )
    agents = behaviour(spark, sf_dir).select("event_id", agent.alias("b_iev"))
    return enrich.with_user_agent(agents, "b_iev").drop("b_iev")


# Location text per nation number (modulo ten) with the region it must resolve to.
PLACES = (
    ("浙江省杭州市", "中国", "浙江省", "杭州市"),
    ("内蒙古包头市", "中国", "内蒙古自治区", "包头市"),
    ("广西南宁市", "中国", "广西", "南宁市"),
    ("上海市浦东新区", "中国", "上海市", "浦东新区"),
    ("重庆市云阳县", "中国", "重庆市", "云阳县"),
    ("香港", "中国", "香港特别行政区", "unknown"),
    ("局域网", "中国", "上海市", "unknown"),
    ("美国", "美国", "unknown", "unknown"),
    ("北京市", "中国", "北京市", "unknown"),
    ("江苏省", "中国", "江苏省", "unknown"),
)


@query(
    "enrich_ip_region",
    "SELECT event_id, coalesce(p.country, '中国') AS country, coalesce(p.province, '上海市') AS "
    "province, coalesce(p.city, 'unknown') AS city FROM {EV} e LEFT JOIN nation ON item_id "
    "BETWEEN n_nationkey * 3 AND n_nationkey * 3 + 2 LEFT JOIN (VALUES "
    + ", ".join(f"({i}, '{c}', '{p}', '{t}')" for i, (_, c, p, t) in enumerate(PLACES))
    + ") p(n, country, province, city) ON n_nationkey % 10 = p.n",
)
def enrich_ip_region(spark, sf_dir):
    place = F.col("n_nationkey") % len(PLACES)
    where = F.when(place == 0, PLACES[0][0])
    for i, known in enumerate(PLACES[1:], 1):
        where = where.when(place == i, known[0])
    first = (F.lit(10 * 256) + F.col("n_nationkey") * 3).cast("bigint") * 65536
    ranges = table(spark, sf_dir, "nation").select(
        first.alias("lo"), (first + 3 * 65536 - 1).alias("hi"), where.alias("place")
    )
    visits = behaviour(spark, sf_dir).select(
        "event_id",
        F.concat_ws(".", F.lit("10"), text("item_id"), (F.col("user_id") % 256).cast("string"),
                    F.lit("7")).alias("ip"),
    )
    located = enrich.ip_region(visits, "ip", ranges, "lo", "hi", "place")
    return located.select("event_id", "country", "province", "city")


@query(
    "parse_json_order",
    "SELECT o_orderkey AS order_id, CAST(o_custkey % 34 AS INTEGER) AS province_id, "
    "o_totalprice AS order_price FROM orders WHERE o_orderstatus <> 'P'",
)
def parse_json_order(spark, sf_dir):
    good = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("orderId"), (F.col("o_custkey") % 34).alias("provinceId"),
            F.col("o_totalprice").alias("orderPrice"),
        )
    )
    value = F.when(F.col("o_orderstatus") == "P", F.lit('{"orderId": broken')).otherwise(good)
    parsed = parse.parse_json_order(
        table(spark, sf_dir, "orders").select(value.alias("value")), "value",
        "orderId bigint, provinceId int, orderPrice double",
    )
    return parsed.select(
        F.col("orderId").alias("order_id"), F.col("provinceId").alias("province_id"),
        F.col("orderPrice").alias("order_price"),
    ).dropna(subset=["order_id"])


@query(
    "parse_order_csv_tolerant",
    "SELECT CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_custkey % 34 AS INTEGER) END AS "
    "province_id, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE CAST(o_orderkey * 2 AS DOUBLE) END "
    "AS order_price FROM orders WHERE o_orderstatus <> 'O'",
)
def parse_order_csv_tolerant(spark, sf_dir):
    line = F.concat_ws(
        ",", text("o_orderkey"), (F.col("o_custkey") % 34).cast("string"),
        (F.col("o_orderkey") * 2).cast("string"),
    )
    value = (
        F.when(F.col("o_orderstatus") == "O", F.lit("  "))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("bad line "), line))
        .otherwise(line)
    )
    return parse.parse_order_line(
        table(spark, sf_dir, "orders").select(value.alias("value")), "value"
    )


@query(
    "filter_event_type",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'view'",
)
def filter_event_type(spark, sf_dir):
    views = rows.of_type(table(spark, sf_dir, "events"), "event_type", "view")
    return views.select("event_id", "user_id", "value")


@query(
    "filter_string_match",
    "SELECT page_id, url FROM pages WHERE url LIKE 'https%' AND url LIKE '%example.com%'",
)
def filter_string_match(spark, sf_dir):
    pages = rows.starting_with(table(spark, sf_dir, "pages"), "url", "https")
    return rows.containing(pages, "url", "example.com").select("page_id", "url")


@query(
    "filter_allowed_events",
    f"SELECT en, count(*) AS cnt FROM (SELECT {ALIAS_SQL} AS en, item_id FROM {{EV}}) "
    "WHERE item_id % 17 <> 0 AND en <> 'e_x' GROUP BY en",
)
def filter_allowed_events(spark, sf_dir):
    parsed = parse.parse_tracking_log(tracking_lines(spark, sf_dir), "value")
    known = parse.keep_known_events(parsed, F.col("params")["en"])
    return known.groupBy(F.col("params")["en"].alias("en")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


@query(
    "quarantine_bad_rows",
    "SELECT event_id, item_id % 6 = 0 AS is_bad, CASE WHEN item_id % 6 = 0 THEN -1 ELSE item_id "
    "END AS amount FROM {EV}",
)
def quarantine_bad_rows(spark, sf_dir):
    amount = F.when(F.col("item_id") % 6 == 0, "12x").otherwise(text("item_id"))
    raw = behaviour(spark, sf_dir).select("event_id", amount.alias("amount"))
    return parse.quarantine(raw, {"amount": "bigint"}).fillna({"amount": -1})


@query(
    "filter_not_null_pair",
    "SELECT event_id, user_id AS uuid, t AS s_time FROM {EV} WHERE item_id % 5 <> 0 "
    "AND item_id % 7 <> 0",
)
def filter_not_null_pair(spark, sf_dir):
    k = F.col("item_id")
    pairs = behaviour(spark, sf_dir).select(
        "event_id",
        F.when(k % 5 != 0, F.col("user_id")).alias("uuid"),
        F.when(k % 7 != 0, F.unix_timestamp("ts")).alias("s_time"),
    )
    return rows.with_pair(pairs, "uuid", "s_time")


@query(
    "dim_platform_browser",
    "SELECT event_id, CASE WHEN item_id % 5 = 0 THEN 'unknown:unknown' WHEN item_id % 3 = 0 THEN "
    "concat(event_type, ':unknow') ELSE concat(event_type, ':', item_id) END AS platform FROM {EV}",
)
def dim_platform_browser(spark, sf_dir):
    k = F.col("item_id")
    name = F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("event_type"))
    version = F.when(k % 3 == 0, F.lit(None)).otherwise(text("item_id"))
    return behaviour(spark, sf_dir).select(
        "event_id", version_dim(name, version).alias("platform")
    )


# The usual reflected checksum, folded over the bytes with a table of its 256 steps.
ROW_KEY_SQL = """
WITH steps AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, z:
      CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
fed AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ms, encode(coalesce(user_id::VARCHAR, '') ||
    coalesce(item_id::VARCHAR, '') || coalesce(user_id::VARCHAR, '') || event_type) AS b FROM {EV})
SELECT event_id, ms || '_' || xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(b), '..'),
      lambda x: ('0x' || x)::BIGINT)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS row_key
FROM fed, steps
"""


@query("make_row_key", ROW_KEY_SQL)
def make_row_key(spark, sf_dir):
    key = row_key(F.unix_millis("ts"), text("user_id"), text("item_id"), F.col("event_type"))
    return behaviour(spark, sf_dir).select("event_id", key.alias("row_key"))


@query(
    "split_stream",
    "SELECT event_id, value, CASE WHEN value > 30 THEN 'high' ELSE 'low' END AS branch FROM events",
)
def split_stream(spark, sf_dir):
    tagged = rows.split_by_threshold(table(spark, sf_dir, "events"), "value", 30.0)
    return tagged.select("event_id", "value", "branch")


@query(
    "side_output",
    "SELECT event_id, value, CASE WHEN value < 32.0 THEN 'alert' ELSE 'main' END AS output "
    "FROM events",
)
def side_output(spark, sf_dir):
    tagged = rows.with_side_output(table(spark, sf_dir, "events"), F.col("value") < 32.0)
    return tagged.select("event_id", "value", "output")


@query(
    "project_cells",
    "SELECT event_id, user_id, t AS s_time FROM {EV} WHERE event_type = 'signup'",
)
def project_cells(spark, sf_dir):
    signups = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    return signups.select("event_id", "user_id", F.unix_timestamp("ts").alias("s_time"))


@query(
    "rowkey_range_scan",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey >= 1000 AND "
    "o_orderkey < 9000",
)
def rowkey_range_scan(spark, sf_dir):
    return rows.key_range(
        table(spark, sf_dir, "orders"), "o_orderkey", 1000, 9000,
        ["o_orderkey", "o_custkey", "o_totalprice"],
    )


@query("rowkey_point_get", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 1234")
def rowkey_point_get(spark, sf_dir):
    return rows.of_type(table(spark, sf_dir, "orders"), "o_orderkey", 1234).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "log_content_stats",
    "SELECT CAST(sum(event_id * 7) AS BIGINT) // count(*) AS avg_floor, min(event_id * 7) AS "
    "min_size, max(event_id * 7) AS max_size, count(*) AS cnt FROM {EV} WHERE item_id % 13 <> 0",
)
def log_content_stats(spark, sf_dir):
    """The log report end to end: parse the stored lines, then aggregate."""
    from eventmill.operators.aggregates import content_stats

    path = work_dir(spark, "access-log")
    access_lines(spark, sf_dir).write.text(path)
    return content_stats(parse.parse_access_log(spark.read.text(path), "value"), "content_size")
