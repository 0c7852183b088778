"""Keyed state and sequence patterns, batch forms.

Roles: user readings are ``value`` per user; ``error`` is a failed and ``signup``
a successful login; orders are created at their order date and paid at their
first ship date.
"""

from pyspark.sql import functions as F

from eventmill.operators import patterns as pat
from eventmill.plans.registry import ORACLES, query
from eventmill.sources.tables import table

DAY = 86400
ORDER = ["ts", "event_id"]


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def order_events(spark, sf_dir):
    """One create event per order and one pay event per shipped line."""
    created = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.lit("create").alias("kind"),
        F.col("o_orderdate").alias("ts"),
    )
    paid = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.lit("pay").alias("kind"),
        F.col("l_shipdate").alias("ts"),
    )
    return created.unionByName(paid)


def change_sql(threshold):
    return (
        "SELECT user_id, event_id, prev_value, value FROM (SELECT *, lag(value) OVER "
        "(PARTITION BY user_id ORDER BY ts, event_id) AS prev_value FROM events) "
        f"WHERE abs(value - prev_value) > {threshold}"
    )


@query("state_change_alert", change_sql("10.0"))
def state_change_alert(spark, sf_dir):
    alerts = pat.change_alerts(events(spark, sf_dir), "user_id", ORDER, "value", 10.0)
    return alerts.select("user_id", "event_id", "prev_value", "value")


@query("state_change_alert_sensitive", change_sql("2.0"))
def state_change_alert_sensitive(spark, sf_dir):
    alerts = pat.change_alerts(events(spark, sf_dir), "user_id", ORDER, "value", 2.0)
    return alerts.select("user_id", "event_id", "prev_value", "value")


@query(
    "state_rising_alert",
    "WITH d AS (SELECT *, CASE WHEN value < lag(value) OVER w THEN 1 ELSE 0 END AS dropped "
    "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), "
    "r AS (SELECT *, sum(dropped) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM d) "
    "SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, "
    "count(*) AS readings FROM r GROUP BY user_id, run "
    "HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 86400000000",
)
def state_rising_alert(spark, sf_dir):
    runs = pat.rising_runs(events(spark, sf_dir), "user_id", ORDER, "value", DAY)
    return runs.select(
        "user_id", F.unix_micros("first_ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"), "readings",
    )


@query(
    "state_rate_limit_blacklist",
    "SELECT event_id, user_id, event_type, nth, CASE WHEN nth <= 2 THEN 'pass' ELSE 'warn' END "
    "AS outcome FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, t // 86400 "
    "ORDER BY ts, event_id) AS nth FROM {EV}) WHERE nth <= 3",
)
def state_rate_limit_blacklist(spark, sf_dir):
    kept = pat.rate_limit(
        events(spark, sf_dir), ["user_id", "event_type"], "ts", 2, ["event_id"]
    )
    return kept.select(
        "event_id", "user_id", "event_type", F.col("nth").cast("bigint"), "outcome"
    )


@query(
    "pat_strict_next",
    "SELECT user_id, epoch_us(prev_ts) AS first_us, epoch_us(ts) AS last_us FROM (SELECT *, "
    "lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type FROM events "
    "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'error' "
    "AND prev_type = 'error' AND epoch_us(ts) - epoch_us(prev_ts) < 86400000000",
)
def pat_strict_next(spark, sf_dir):
    pairs = pat.strict_next(events(spark, sf_dir), "user_id", ORDER, "event_type", "error", DAY)
    return pairs.select(
        "user_id", F.unix_micros("first_ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"),
    )


@query(
    "pat_fail_pair_state",
    "SELECT user_id, epoch_us(prev_ts) AS first_us, epoch_us(ts) AS last_us FROM (SELECT *, "
    "lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type FROM events "
    "WHERE event_type IN ('error', 'signup') "
    "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'error' "
    "AND prev_type = 'error' AND epoch_us(ts) - epoch_us(prev_ts) < 86400000000",
)
def pat_fail_pair_state(spark, sf_dir):
    pairs = pat.fail_pairs(
        events(spark, sf_dir), "user_id", ORDER, "event_type", "error", "signup", DAY
    )
    return pairs.select(
        "user_id", F.unix_micros("first_ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"),
    )


@query(
    "pat_fail_burst",
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
def pat_fail_burst(spark, sf_dir):
    bursts = pat.fail_bursts(
        events(spark, sf_dir), "user_id", ORDER, "event_type", "error", "signup", 2, 2 * DAY
    )
    return bursts.select(
        "user_id", F.unix_micros("first_ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"), "fails",
    )


@query(
    "pat_followed_by",
    "SELECT event_id, user_id, epoch_us(ts) AS create_us, CASE WHEN pay_us - epoch_us(ts) < "
    "86400000000 THEN pay_us ELSE -1 END AS pay_us, CASE WHEN pay_us - epoch_us(ts) < 86400000000 "
    "THEN 'paid' ELSE 'timeout' END AS status FROM (SELECT *, min(CASE WHEN event_type = "
    "'purchase' THEN epoch_us(ts) END) OVER (PARTITION BY user_id ORDER BY ts, event_id "
    "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_us FROM events) "
    "WHERE event_type = 'signup'",
)
def pat_followed_by(spark, sf_dir):
    judged = pat.followed_by(
        events(spark, sf_dir), "user_id", ORDER, "event_type", "signup", "purchase", DAY
    )
    return judged.select(
        "event_id", "user_id", F.unix_micros("ts").alias("create_us"),
        F.coalesce(F.unix_micros("then_ts"), F.lit(-1)).cast("bigint").alias("pay_us"), "status",
    )


FIRST_TIMES_SQL = (
    "(SELECT order_id, min(create_us) AS create_us, min(pay_us) AS pay_us FROM ("
    "SELECT o_orderkey AS order_id, epoch_us(o_orderdate) AS create_us, NULL AS pay_us "
    "FROM orders UNION ALL SELECT l_orderkey, NULL, epoch_us(l_shipdate) FROM lineitem) "
    "GROUP BY order_id)"
)
SIXTY_DAYS = 60 * DAY


@query(
    "pat_timeout_at_deadline",
    "SELECT order_id, CASE WHEN pay_us - create_us <= 5184000000000 THEN 'paid' ELSE 'timeout' "
    f"END AS result FROM {FIRST_TIMES_SQL} WHERE create_us IS NOT NULL",
)
def pat_timeout_at_deadline(spark, sf_dir):
    judged = pat.timeout_at_deadline(
        order_events(spark, sf_dir), "order_id", "ts", "kind", "create", "pay", SIXTY_DAYS
    )
    return judged.select("order_id", "result")


@query(
    "pat_order_outcome",
    "SELECT order_id, CASE WHEN create_us IS NULL THEN 'paid_without_create' WHEN pay_us IS NULL "
    "THEN 'timeout' WHEN pay_us - create_us < 5184000000000 THEN 'paid' ELSE 'paid_late' END "
    f"AS outcome FROM {FIRST_TIMES_SQL}",
)
def pat_order_outcome(spark, sf_dir):
    judged = pat.order_outcomes(
        order_events(spark, sf_dir), "order_id", "ts", "kind", "create", "pay", SIXTY_DAYS
    )
    return judged.select("order_id", "outcome")


# -- the same patterns with every key cut into time chunks ---------------------------------

# Keys of so few rows count as hot here, so the carried summaries decide the answers.
CHUNKED = {"chunk_seconds": 6 * 3600, "hot_rows": 20}


def chunked(name):
    """Register the query ``name`` again, over chunks, with the same SQL check."""
    def register(fn):
        return query(f"{name}_chunked", ORACLES[name])(fn)

    return register


@chunked("state_change_alert")
def state_change_alert_chunked(spark, sf_dir):
    alerts = pat.change_alerts(
        events(spark, sf_dir), "user_id", ORDER, "value", 10.0, **CHUNKED
    )
    return alerts.select("user_id", "event_id", "prev_value", "value")


@chunked("state_rising_alert")
def state_rising_alert_chunked(spark, sf_dir):
    runs = pat.rising_runs(events(spark, sf_dir), "user_id", ORDER, "value", DAY, **CHUNKED)
    return runs.select(
        "user_id", F.unix_micros("first_ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"), "readings",
    )


@chunked("pat_strict_next")
def pat_strict_next_chunked(spark, sf_dir):
    pairs = pat.strict_next(
        events(spark, sf_dir), "user_id", ORDER, "event_type", "error", DAY, **CHUNKED
    )
    return pairs.select(
        "user_id", F.unix_micros("first_ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"),
    )


@chunked("pat_followed_by")
def pat_followed_by_chunked(spark, sf_dir):
    judged = pat.followed_by(
        events(spark, sf_dir), "user_id", ORDER, "event_type", "signup", "purchase", DAY, **CHUNKED
    )
    return judged.select(
        "event_id", "user_id", F.unix_micros("ts").alias("create_us"),
        F.coalesce(F.unix_micros("then_ts"), F.lit(-1)).cast("bigint").alias("pay_us"), "status",
    )
