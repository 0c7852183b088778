"""Set operations, routing, partitioning, splitting."""

from pyspark.sql import functions as F

from eventmill.operators import rows
from eventmill.plans.registry import query
from eventmill.session import work_dir
from eventmill.sinks.tables import order_route, save_by_route
from eventmill.sources.tables import table


@query(
    "set_union_all",
    "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL "
    "SELECT s_name, s_acctbal FROM supplier UNION ALL SELECT c_name, c_acctbal FROM customer",
)
def set_union_all(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return rows.union_all([customers, suppliers, customers])


@query(
    "set_distinct",
    "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, user_id FROM events",
)
def set_distinct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id").distinct()


@query(
    "set_connect_comap",
    "SELECT 'order' AS kind, o_orderkey AS id, o_totalprice AS amount, 'none' AS note FROM orders "
    "UNION ALL SELECT 'event', event_id, -1.0, event_type FROM events",
)
def set_connect_comap(spark, sf_dir):
    merged = rows.connect(
        table(spark, sf_dir, "orders"),
        {"kind": F.lit("order"), "id": F.col("o_orderkey"), "amount": F.col("o_totalprice")},
        table(spark, sf_dir, "events"),
        {"kind": F.lit("event"), "id": F.col("event_id"), "note": F.col("event_type")},
    )
    return merged.fillna({"amount": -1.0, "note": "none"})


# Order priorities stand for payment types; the last one is a type nobody knows.
PAYMENTS = {
    "1-URGENT": "alipay", "2-HIGH": "weixin", "3-MEDIUM": "card", "4-NOT SPECIFIED": "other",
    "5-LOW": "voucher",
}
KNOWN = ("alipay", "weixin", "card", "other")


@query(
    "route_by_type",
    "SELECT o_orderkey, o_totalprice, CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay' "
    "WHEN '2-HIGH' THEN 'weixin' WHEN '3-MEDIUM' THEN 'card' ELSE 'other' END AS route FROM orders",
)
def route_by_type(spark, sf_dir):
    kind = F.create_map(*[F.lit(x) for pair in PAYMENTS.items() for x in pair])
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice",
        order_route(kind[F.col("o_orderpriority")], KNOWN).alias("route"),
    )
    target = work_dir(spark, "routes")
    save_by_route(orders, "route", target)
    return spark.read.schema("o_orderkey bigint, o_totalprice double, route string").parquet(
        target
    )


@query("repartition_coalesce", "SELECT event_id, user_id, event_type FROM events")
def repartition_coalesce(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return events.repartition(16, "event_id").coalesce(4)


@query(
    "per_partition_map",
    "SELECT event_id, upper(event_type) AS label, value * 2 AS doubled FROM events",
)
def per_partition_map(spark, sf_dir):
    def to_upper(resource, batch):
        batch["label"] = getattr(batch["event_type"].str, resource)()
        batch["doubled"] = batch["value"] * 2
        return batch[["event_id", "label", "doubled"]]

    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return rows.per_partition(
        events, lambda: "upper", to_upper, "event_id bigint, label string, doubled double"
    )


@query("random_split", "SELECT count(*) AS cnt, 2 AS parts FROM events")
def random_split(spark, sf_dir):
    """A seeded 80 / 20 random split: no part is empty, their sizes add up to the table."""
    parts = table(spark, sf_dir, "events").randomSplit([0.8, 0.2], seed=42)
    sizes = [
        p.agg(F.count(F.lit(1)).alias("cnt")).withColumn("part", F.lit(name))
        for name, p in zip(("train", "test"), parts)
    ]
    return rows.union_all(sizes).filter("cnt > 0").agg(
        F.sum("cnt").alias("cnt"), F.count(F.lit(1)).cast("int").alias("parts")
    )


@query("random_split_hashed", "SELECT event_id FROM events")
def random_split_hashed(spark, sf_dir):
    """The reproducible form: its parts together are the table, each row once."""
    return rows.union_all(
        rows.hash_split(
            table(spark, sf_dir, "events").select("event_id"), ["event_id"], [0.8, 0.2], 42
        )
    )
