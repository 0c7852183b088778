"""Aggregations: word counts, log statistics, PV / UV, dimension reports."""

import pandas as pd
from pyspark.sql import functions as F

from eventmill.functions.scalar import version_dim
from eventmill.operators import aggregates as agg
from eventmill.operators import topk
from eventmill.plans.registry import query
from eventmill.sources.tables import table, with_item

# DuckDB splits on RE2's \s, the JVM on the same six ASCII characters.
WORDS_SQL = (
    "(SELECT w AS word FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS w "
    "FROM documents) WHERE trim(w) <> '')"
)


@query("agg_word_count", f"SELECT word, count(*) AS cnt FROM {WORDS_SQL} GROUP BY word")
def agg_word_count(spark, sf_dir):
    return agg.word_counts(table(spark, sf_dir, "documents"), "text")


@query("agg_token_total", f"SELECT count(*) AS tokens FROM {WORDS_SQL}")
def agg_token_total(spark, sf_dir):
    return agg.token_total(table(spark, sf_dir, "documents"), "text")


KEYED_SQL = (
    "SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total "
    "FROM events GROUP BY user_id"
)


@query("agg_keyed_reduce", KEYED_SQL)
def agg_keyed_reduce(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(agg.exact_sum("value").alias("total"))


@query(
    "agg_content_stats",
    "SELECT CAST(sum(n_chars) AS BIGINT) // count(*) AS avg_floor, min(n_chars) AS min_size, "
    "max(n_chars) AS max_size, count(*) AS cnt FROM documents",
)
def agg_content_stats(spark, sf_dir):
    return agg.content_stats(table(spark, sf_dir, "documents"), "n_chars")


@query("agg_count_all", "SELECT count(*) AS cnt FROM events")
def agg_count_all(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("eventmill_access_log")
    return spark.sql("SELECT count(*) AS cnt FROM eventmill_access_log")


@query("agg_by_code", "SELECT event_type AS code, count(*) AS cnt FROM events GROUP BY 1")
def agg_by_code(spark, sf_dir):
    return agg.counts_by(table(spark, sf_dir, "events"), F.col("event_type").alias("code"))


@query(
    "agg_having_limit",
    "SELECT user_id, count(*) AS cnt FROM events GROUP BY 1 HAVING count(*) > 30 "
    "ORDER BY cnt DESC, user_id LIMIT 10",
)
def agg_having_limit(spark, sf_dir):
    busy = agg.frequent_values(table(spark, sf_dir, "events"), "user_id", 30)
    return busy.orderBy(F.desc("cnt"), "user_id").limit(10)


@query(
    "agg_count_by_value",
    "SELECT l_suppkey, count(*) AS cnt FROM lineitem GROUP BY 1 HAVING count(*) > 600 "
    "ORDER BY cnt DESC, l_suppkey",
)
def agg_count_by_value(spark, sf_dir):
    frequent = agg.frequent_values(table(spark, sf_dir, "lineitem"), "l_suppkey", 600)
    return frequent.orderBy(F.desc("cnt"), "l_suppkey")


@query(
    "agg_pv_by_day",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS pv FROM events "
    "WHERE event_type = 'view' GROUP BY 1",
)
def agg_pv_by_day(spark, sf_dir):
    views = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return agg.page_views_by_day(views, "ts")


@query(
    "agg_uv_by_day",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS uv FROM events GROUP BY 1",
)
def agg_uv_by_day(spark, sf_dir):
    return agg.visitors_by_day(table(spark, sf_dir, "events"), "ts", "user_id")


def launches(spark, sf_dir):
    """New-user rows: signups with day of month and platform / browser dimensions."""
    signups = with_item(table(spark, sf_dir, "events")).filter(F.col("event_type") == "signup")
    k = F.col("item_id")
    platform = F.when(k % 5 == 0, None).otherwise(F.concat(F.lit("p"), (k % 3).cast("string")))
    version = F.when(k % 7 == 0, "").otherwise((k % 2).cast("string"))
    browser = F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("b"), (k % 4).cast("string")))
    return signups.select(
        "user_id",
        F.dayofmonth("ts").cast("bigint").alias("day"),
        version_dim(platform, version).alias("platform"),
        version_dim(browser, (k % 6).cast("string")).alias("browser"),
    )


LAUNCH_SQL = """
(SELECT user_id, CAST(day(ts) AS BIGINT) AS day,
  CASE WHEN item_id % 5 = 0 THEN 'unknown:unknown'
       WHEN item_id % 7 = 0 THEN concat('p', item_id % 3, ':unknow')
       ELSE concat('p', item_id % 3, ':', item_id % 2) END AS platform,
  CASE WHEN item_id % 11 = 0 THEN 'unknown:unknown'
       ELSE concat('b', item_id % 4, ':', item_id % 6) END AS browser
 FROM {EV} WHERE event_type = 'signup')
"""


@query(
    "agg_new_users_dims",
    "SELECT day, CASE WHEN grouping(platform) = 1 THEN 'all' ELSE platform END AS platform, "
    "CASE WHEN grouping(browser) = 1 THEN 'all' ELSE browser END AS browser, "
    f"count(*) AS new_users FROM {LAUNCH_SQL} GROUP BY GROUPING SETS "
    "((day, platform), (day, browser), (day, platform, browser))",
)
def agg_new_users_dims(spark, sf_dir):
    return agg.new_users_by_dims(launches(spark, sf_dir), "day", "platform", "browser")


NEW_USERS_SQL = (
    f"SELECT day, platform, count(*) AS new_users FROM {LAUNCH_SQL} GROUP BY day, platform"
)


@query("agg_new_users_df", NEW_USERS_SQL)
def agg_new_users_df(spark, sf_dir):
    return launches(spark, sf_dir).groupBy("day", "platform").agg(
        F.count(F.lit(1)).alias("new_users")
    )


@query("agg_new_users_sql", NEW_USERS_SQL)
def agg_new_users_sql(spark, sf_dir):
    launches(spark, sf_dir).createOrReplaceGlobalTempView("eventmill_launches")
    return spark.sql(
        "SELECT day, platform, count(*) AS new_users FROM global_temp.eventmill_launches "
        "GROUP BY day, platform"
    )


@query(
    "agg_avg_round",
    "SELECT c_mktsegment, "
    "CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_balance, "
    "round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*), 0) AS avg_0, "
    "round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_2 "
    "FROM customer GROUP BY 1",
)
def agg_avg_round(spark, sf_dir):
    average = agg.exact_sum("c_acctbal") / F.count("c_acctbal")
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        average.alias("avg_balance"),
        F.round(average, 0).alias("avg_0"),
        F.round(average, 2).alias("avg_2"),
    )


@query(
    "agg_avg_accumulator",
    "SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value, "
    "count(*) AS cnt FROM events GROUP BY 1",
)
def agg_avg_accumulator(spark, sf_dir):
    return agg.group_average(table(spark, sf_dir, "events"), "event_type", "value")


GROUP_MAX_SQL = "SELECT l_suppkey, max(l_extendedprice) AS max_price FROM lineitem GROUP BY 1"


@query("agg_group_max", GROUP_MAX_SQL)
def agg_group_max(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_suppkey").agg(F.max("l_extendedprice").alias("max_price"))


@query("agg_group_max_udaf", GROUP_MAX_SQL)
def agg_group_max_udaf(spark, sf_dir):
    """The user-defined-aggregate form.

    A grouped pandas UDF needs a whole group in memory, so it only merges partial
    maxima that built-in aggregation has already reduced to 16 rows per group.
    """

    @F.pandas_udf("double")
    def largest(values: pd.Series) -> float:
        return float(values.max())

    lines = table(spark, sf_dir, "lineitem")
    salt = F.pmod(F.xxhash64("l_orderkey", "l_partkey"), F.lit(16)).alias("_salt")
    partial = lines.groupBy("l_suppkey", salt).agg(F.max("l_extendedprice").alias("_part"))
    return partial.groupBy("l_suppkey").agg(largest("_part").alias("max_price"))


@query(
    "agg_running_bounded_topk",
    "SELECT l_suppkey, l_partkey, cnt, rank_no FROM (SELECT *, row_number() OVER (PARTITION BY "
    "l_suppkey ORDER BY cnt DESC, l_partkey) AS rank_no FROM (SELECT l_suppkey, l_partkey, "
    "count(*) AS cnt FROM lineitem GROUP BY 1, 2)) WHERE rank_no <= 5",
)
def agg_running_bounded_topk(spark, sf_dir):
    pairs = agg.counts_by(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")
    return topk.top_per_group(pairs, ["l_suppkey"], "cnt", 5, ["l_partkey"])


@query(
    "agg_fold_by_key",
    "SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS "
    "DOUBLE) AS total, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1",
)
def agg_fold_by_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        agg.exact_sum("o_totalprice").alias("total"),
        F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"),
    )


def sale_orders(spark, sf_dir):
    """Orders with the province (nation) of their customer.

    Orders are summed per customer before the join wherever the report allows.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_totalprice").alias("order_price"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("order_type"),
    )


def customer_totals(spark, sf_dir):
    """Order count and value per province, pre-aggregated per customer."""
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast(agg.MONEY)).alias("value"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        per_customer.join(customers, per_customer.o_custkey == customers.c_custkey)
        .groupBy(F.col("c_nationkey").cast("bigint").alias("province_id"))
        .agg(F.sum("orders").alias("orders"), F.sum("value").cast("double").alias("total"))
    )


@query(
    "agg_province_sum_top5",
    "SELECT CAST(c_nationkey AS BIGINT) AS province_id, CAST(sum(CAST(o_totalprice AS "
    "DECIMAL(18,2))) AS DOUBLE) AS total FROM orders JOIN customer ON o_custkey = c_custkey "
    "GROUP BY 1 ORDER BY total DESC, province_id LIMIT 5",
)
def agg_province_sum_top5(spark, sf_dir):
    totals = customer_totals(spark, sf_dir).select("province_id", "total")
    return totals.orderBy(F.desc("total"), "province_id").limit(5)


@query(
    "agg_category_distribution",
    "SELECT lang AS category, count(*) AS cnt FROM documents GROUP BY 1",
)
def agg_category_distribution(spark, sf_dir):
    return agg.counts_by(table(spark, sf_dir, "documents"), F.col("lang").alias("category"))


@query(
    "agg_bitmap_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS uv FROM events GROUP BY 1",
)
def agg_bitmap_distinct(spark, sf_dir):
    return agg.bitmap_distinct(table(spark, sf_dir, "events"), ["event_type"], "user_id")


@query("agg_approx_distinct", "SELECT event_type, true AS near FROM events GROUP BY 1")
def agg_approx_distinct(spark, sf_dir):
    """The sketch of every type, judged by the exact number: within three deviations."""
    # Beside an exact distinct count a sketch would be kept for every user: distinct
    # pairs come first, and leave the sketch as it is.
    users = table(spark, sf_dir, "events").select("event_type", "user_id").distinct()
    counted = users.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.02).alias("uv"),
        F.count("user_id").alias("exact"),
    )
    near = F.abs(F.col("uv") - F.col("exact")) <= 3 * 0.02 * F.col("exact")
    return counted.select("event_type", near.alias("near"))
