"""The sample files as streams give the known answers too."""

import os

from conftest import FIXTURES, rows
from pyspark.sql import functions as F

from eventmill.session import use_rocksdb_state, work_dir
from eventmill.sources.readers import stream_source
from eventmill.streaming import drain, ordered, windowed


def stream_of(spark, name, schema, closing):
    """The file, then one far later row that lets the watermark pass everything."""
    use_rocksdb_state(spark)
    inbox = work_dir(spark, "golden")
    spark.read.text(os.path.join(FIXTURES, name)).coalesce(1).write.text(inbox)
    spark.createDataFrame([(closing,)], "v string").coalesce(1).write.mode("append").text(inbox)
    stream = stream_source(spark, "csv", inbox, schema, maxFilesPerTrigger=1)
    return stream.withColumn("ts", F.timestamp_seconds("t"))


def test_login_burst(spark):
    logins = stream_of(
        spark, "logins.csv", "user_id bigint, ip string, kind string, t bigint",
        "0,0.0.0.0,success,1558500000",
    )
    rule = ordered.FailBurstRule("fail", "success", 3, 2)
    found = drain.drain_append(
        ordered.apply_rule(logins, ("user_id",), "ts", rule, 5, kind="kind"), "golden-burst"
    )
    assert rows(found) == [(1035, 1558430842_000000, 1558430844_000000, 3)]


def test_order_outcomes(spark):
    orders = stream_of(
        spark, "orders.csv", "order_id bigint, kind string, tx string, t bigint",
        "0,create,,1558500000",
    )
    # In one second a create comes before a pay: line numbers are not in the file.
    ranked = orders.withColumn("rank", F.when(F.col("kind") == "create", 0).otherwise(1))
    rule = ordered.OrderOutcomeRule("create", "pay", 900)
    stream = ordered.apply_rule(
        ranked, ("order_id",), "ts", rule, 5, row_id="rank", kind="kind", mode="update"
    )
    batches = drain.drain_batches(
        stream, "golden-orders", "update", "order_id bigint, outcome string, judged_us bigint",
    )
    final = batches.groupBy("order_id").agg(F.max_by("outcome", "judged_us").alias("outcome"))
    assert dict(rows(final.groupBy("outcome").count())) == {
        "paid": 37, "paid_late": 2, "paid_without_create": 1
    }


def test_blacklist_and_province_windows(spark):
    schema = "user_id bigint, ad_id bigint, province string, city string, t bigint"
    closing = "0,0,nowhere,nowhere,1511800000"
    limited = drain.drain_append(
        ordered.apply_rule(
            stream_of(spark, "ad_clicks.csv", schema, closing), ("user_id", "ad_id"), "ts",
            ordered.RateLimitRule(100), 0, row_id="t",
        ), "golden-blacklist",
    )
    warned = limited.filter("outcome = 'warn'").select("user_id", "ad_id", "event_id")
    assert rows(warned) == [(937166, 1715, 1511661701)]
    clicks = windowed.ascending(stream_of(spark, "ad_clicks.csv", schema, closing), "ts")
    counts = drain.drain_append(
        windowed.window_counts(clicks, "ts", 3600, 300, ["province"]), "golden-provinces"
    ).filter("province <> 'nowhere'")
    assert counts.count() == 99
    assert counts.agg(F.sum("cnt")).first()[0] == 1716


def test_matching_of_two_streams(spark):
    orders = stream_of(
        spark, "orders.csv", "order_id bigint, kind string, tx string, t bigint",
        "0,pay,end,1558500000",
    ).filter("kind = 'pay' AND tx <> ''").select("tx", "order_id", F.col("ts").alias("pay_ts"))
    receipts = stream_of(
        spark, "receipts.csv", "tx string, channel string, t bigint", "none,x,1558500000"
    ).select(F.col("tx"), "channel", F.col("ts").alias("receipt_ts"))
    pairs = windowed.interval_pairs(
        orders.withWatermark("pay_ts", "5 seconds"),
        receipts.withWatermark("receipt_ts", "5 seconds"),
        "tx", "pay_ts", "receipt_ts", -5, 5, "left_outer",
    )
    found = drain.drain_append(pairs.select("order_id", "channel"), "golden-pairs")
    matched = found.filter("channel IS NOT NULL").select("order_id")
    assert rows(matched) == [(34729,), (34730,), (34734,), (34746,), (34747,)]
    assert found.filter("channel IS NULL AND order_id <> 0").count() == 35
