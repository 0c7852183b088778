"""Joins."""

from pyspark.sql import functions as F

from eventmill.operators import aggregates as agg
from eventmill.operators import joins
from eventmill.plans.registry import query
from eventmill.sources.tables import table

SIX_HOURS = 6 * 3600


@query(
    "join_inner_key",
    "SELECT day, pv, uv FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS pv FROM events "
    "WHERE event_type = 'view' GROUP BY 1) JOIN (SELECT strftime(ts, '%Y-%m-%d') AS day, "
    "count(DISTINCT user_id) AS uv FROM events GROUP BY 1) USING (day)",
)
def join_inner_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    pv = agg.page_views_by_day(events.filter(F.col("event_type") == "view"), "ts")
    return pv.join(agg.visitors_by_day(events, "ts", "user_id"), "day", "inner")


@query(
    "join_pred_actual",
    "SELECT l_suppkey, l_partkey, actual, predicted FROM (SELECT l_suppkey, l_partkey, "
    "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS actual FROM lineitem WHERE "
    "l_returnflag = 'R' GROUP BY 1, 2) JOIN (SELECT l_suppkey, l_partkey, CAST(sum(CAST(l_quantity "
    "AS DECIMAL(18,2))) AS DOUBLE) AS predicted FROM lineitem WHERE l_returnflag = 'N' "
    "GROUP BY 1, 2) USING (l_suppkey, l_partkey)",
)
def join_pred_actual(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_suppkey", "l_partkey"]

    def totals(flag, name):
        rows = lines.filter(F.col("l_returnflag") == flag)
        return rows.groupBy(*keys).agg(agg.exact_sum("l_quantity").alias(name))

    return totals("R", "actual").join(totals("N", "predicted"), keys)


@query(
    "join_broadcast_map",
    "SELECT coalesce(good_id, l_partkey) AS item_id, count(*) AS plays FROM lineitem LEFT JOIN "
    "(SELECT p_partkey AS bad_id, p_partkey // 10 AS good_id FROM part WHERE p_size < 10) "
    "ON l_partkey = bad_id GROUP BY 1",
)
def join_broadcast_map(spark, sf_dir):
    aliases = table(spark, sf_dir, "part").filter(F.col("p_size") < 10).select(
        F.col("p_partkey").alias("bad_id"),
        F.floor(F.col("p_partkey") / 10).cast("bigint").alias("good_id"),
    )
    # Plays are counted per raw id first: the lookup then sees one row per id.
    plays = agg.counts_by(table(spark, sf_dir, "lineitem"), "l_partkey")
    named = joins.lookup_with_default(
        plays, "l_partkey", aliases, "bad_id", "good_id", "item_id"
    )
    return named.groupBy("item_id").agg(F.sum("cnt").alias("plays"))


@query(
    "join_emp_dept",
    "SELECT c_custkey, c_name, c_acctbal, n_nationkey, n_name FROM customer JOIN nation "
    "ON c_nationkey = n_nationkey",
)
def join_emp_dept(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("eventmill_emp")
    table(spark, sf_dir, "nation").createOrReplaceTempView("eventmill_dept")
    return spark.sql(
        "SELECT e.c_custkey, e.c_name, e.c_acctbal, d.n_nationkey, d.n_name "
        "FROM eventmill_emp e JOIN eventmill_dept d ON e.c_nationkey = d.n_nationkey"
    )


@query(
    "join_theta_pushdown",
    "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS order_day, l_linenumber, l_partkey, "
    "l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity > 45 "
    "AND o_orderkey > 100",
)
def join_theta_pushdown(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("eventmill_orders")
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("eventmill_lines")
    return spark.sql(
        "SELECT o_orderkey, date_format(o_orderdate, 'yyyy-MM-dd') AS order_day, l_linenumber, "
        "l_partkey, l_quantity FROM eventmill_orders JOIN eventmill_lines "
        "ON o_orderkey = l_orderkey WHERE l_quantity > 45 AND o_orderkey > 100"
    )


def pay_and_receipt(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    pays = events.filter(F.col("event_type") == "signup").select(
        "user_id", F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts")
    )
    receipts = events.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts")
    )
    return pays, receipts


PAIRS_SQL = (
    "FROM (SELECT * FROM events WHERE event_type = 'signup') p {how} JOIN "
    "(SELECT * FROM events WHERE event_type = 'purchase') r ON p.user_id = r.user_id AND "
    "epoch_us(r.ts) - epoch_us(p.ts) BETWEEN -21600000000 AND 21600000000"
)


@query(
    "join_interval",
    "SELECT p.user_id, p.event_id AS pay_id, r.event_id AS receipt_id "
    + PAIRS_SQL.format(how=""),
)
def join_interval(spark, sf_dir):
    pays, receipts = pay_and_receipt(spark, sf_dir)
    pairs = joins.interval_join(
        pays, receipts, "user_id", "pay_ts", "receipt_ts", -SIX_HOURS, SIX_HOURS
    )
    return pairs.select("user_id", "pay_id", "receipt_id")


@query(
    "match_two_streams",
    "SELECT coalesce(p.user_id, r.user_id) AS user_id, coalesce(p.event_id, -1) AS pay_id, "
    "coalesce(r.event_id, -1) AS receipt_id, CASE WHEN r.event_id IS NULL THEN 'left_only' "
    "WHEN p.event_id IS NULL THEN 'right_only' ELSE 'matched' END AS status "
    + PAIRS_SQL.format(how="FULL"),
)
def match_two_streams(spark, sf_dir):
    pays, receipts = pay_and_receipt(spark, sf_dir)
    matched = joins.match_streams(
        pays, receipts, "user_id", "pay_ts", "receipt_ts", -SIX_HOURS, SIX_HOURS
    )
    return matched.select(
        "user_id",
        F.coalesce("pay_id", F.lit(-1)).cast("bigint").alias("pay_id"),
        F.coalesce("receipt_id", F.lit(-1)).cast("bigint").alias("receipt_id"),
        "status",
    )


@query(
    "join_range_lookup",
    "SELECT event_id, value, coalesce(n_name, 'none') AS band FROM events LEFT JOIN nation ON "
    "value BETWEEN n_nationkey * 15.0 AND n_nationkey * 15.0 + 12.5",
)
def join_range_lookup(spark, sf_dir):
    bands = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") * 15.0).alias("lo"),
        (F.col("n_nationkey") * 15.0 + 12.5).alias("hi"),
        F.col("n_name").alias("band"),
    )
    located = joins.range_lookup(
        table(spark, sf_dir, "events"), bands, "value", "lo", "hi", 50
    )
    return located.select(
        "event_id", "value", F.coalesce("band", F.lit("none")).alias("band")
    )
