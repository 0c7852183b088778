"""Sorting, top-k and ranking."""

from pyspark.sql import functions as F

from eventmill.operators import aggregates as agg
from eventmill.operators import topk
from eventmill.plans.aggregates import WORDS_SQL, customer_totals
from eventmill.plans.registry import query
from eventmill.session import work_dir
from eventmill.sinks.tables import sort_for_key_store
from eventmill.sources.order import with_position
from eventmill.sources.tables import table


@query(
    "sort_by_count_desc",
    f"SELECT *, row_number() OVER (ORDER BY cnt DESC, word) AS position FROM "
    f"(SELECT word, count(*) AS cnt FROM {WORDS_SQL} GROUP BY word)",
)
def sort_by_count_desc(spark, sf_dir):
    """Sorted, written, and read back with the place each row has in the files."""
    counts = agg.word_counts(table(spark, sf_dir, "documents"), "text")
    path = work_dir(spark, "by-count")
    counts.orderBy(F.desc("cnt"), "word").write.parquet(path)
    return with_position(spark, path, counts.schema)


@query(
    "topk_global",
    "SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY 1 ORDER BY cnt DESC, l_partkey LIMIT 10",
)
def topk_global(spark, sf_dir):
    counts = agg.counts_by(table(spark, sf_dir, "lineitem"), "l_partkey")
    return topk.top(counts, "cnt", 10, ["l_partkey"])


TOP3_SQL = (
    "SELECT o_custkey, o_totalprice, o_orderkey, rank_no FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank_no FROM orders) "
    "WHERE rank_no <= 3"
)


@query("topk_per_group", TOP3_SQL)
def topk_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderkey")
    return topk.top_per_group(orders, ["o_custkey"], "o_totalprice", 3, ["o_orderkey"])


@query("topk_per_group_salted", TOP3_SQL)
def topk_per_group_salted(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderkey")
    return topk.top_per_group_salted(orders, ["o_custkey"], "o_totalprice", 3, ["o_orderkey"])


@query(
    "topk_province_orders",
    "SELECT CAST(c_nationkey AS BIGINT) AS province_id, count(*) AS orders FROM orders JOIN "
    "customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY orders DESC, province_id LIMIT 10",
)
def topk_province_orders(spark, sf_dir):
    totals = customer_totals(spark, sf_dir).select("province_id", "orders")
    return topk.top(totals, "orders", 10, ["province_id"])


@query(
    "sort_within_partitions",
    "SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_custkey NULLS FIRST, "
    "o_orderkey NULLS FIRST) AS position FROM orders",
)
def sort_within_partitions(spark, sf_dir):
    """Disjoint ranges, each sorted: the files one after the other are in order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    path = work_dir(spark, "sorted-orders")
    sort_for_key_store(orders, ["o_custkey", "o_orderkey"]).write.parquet(path)
    return with_position(spark, path, orders.schema)
