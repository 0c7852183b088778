"""Sources and sinks: every format is written from a table and read back."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.plans.registry import query
from eventmill.session import work_dir
from eventmill.sinks import tables as sink
from eventmill.sources import readers
from eventmill.sources.order import with_position
from eventmill.sources.tables import SCHEMAS, table, with_item

ORDER_ROWS = "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")


ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderpriority string"


def tables_dir(spark, sf_dir, label, write):
    path = work_dir(spark, label)
    write(orders(spark, sf_dir), path)
    return path


@query("src_text", "SELECT concat(o_orderkey, ' ', o_custkey) AS value FROM orders")
def src_text(spark, sf_dir):
    path = tables_dir(
        spark, sf_dir, "text",
        lambda df, p: df.select(F.concat_ws(" ", "o_orderkey", "o_custkey")).write.text(p),
    )
    return readers.text_lines(spark, path, min_partitions=3)


@query("src_csv_schema", ORDER_ROWS)
def src_csv_schema(spark, sf_dir):
    path = tables_dir(
        spark, sf_dir, "csv", lambda df, p: df.write.option("sep", ";").option("header", True).csv(p)
    )
    return readers.csv_rows(spark, path, ORDER_SCHEMA, separator=";", header=True)


@query("src_csv_inferred", ORDER_ROWS)
def src_csv_inferred(spark, sf_dir):
    path = tables_dir(spark, sf_dir, "csv", lambda df, p: df.write.option("header", True).csv(p))
    rows = readers.csv_rows(spark, path, header=True, infer=True)
    return rows.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderpriority"
    )


@query("src_tsv", ORDER_ROWS)
def src_tsv(spark, sf_dir):
    path = tables_dir(spark, sf_dir, "tsv", lambda df, p: df.write.option("sep", "\t").csv(p))
    return readers.csv_rows(spark, path, ORDER_SCHEMA, separator="\t")


@query("src_json", ORDER_ROWS)
def src_json(spark, sf_dir):
    path = tables_dir(spark, sf_dir, "json", lambda df, p: df.write.json(p))
    return readers.json_rows(spark, path).select("o_orderkey", "o_custkey", "o_orderpriority")


@query(
    "src_collection",
    "SELECT event_type, title, count(*) AS cnt FROM events JOIN (VALUES ('view', 'page view'), "
    "('signup', 'launch'), ('purchase', 'order')) t(kind, title) ON event_type = kind GROUP BY 1, 2",
)
def src_collection(spark, sf_dir):
    """An in-memory dimension list applied to the whole table."""
    titles = readers.collection(
        spark, [("view", "page view"), ("signup", "launch"), ("purchase", "order")],
        "event_type string, title string",
    )
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counts.join(titles, "event_type").select("event_type", "title", "cnt")


@query("src_rows_with_schema", "SELECT o_orderkey, o_custkey FROM orders")
def src_rows_with_schema(spark, sf_dir):
    path = tables_dir(
        spark, sf_dir, "rows",
        lambda df, p: df.select(F.concat_ws("|", "o_orderkey", "o_custkey")).write.text(p),
    )
    schema = [("o_orderkey", "bigint"), ("o_custkey", "bigint")]
    return readers.rows_with_schema(readers.text_lines(spark, path), "value", schema, r"\|")


@query("src_catalog_table", ORDER_ROWS)
def src_catalog_table(spark, sf_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS eventmill_db")
    path = work_dir(spark, "catalog")
    # A name of its own: runs side by side do not meet.
    name = f"eventmill_db.orders_{uuid.uuid4().hex}"
    orders(spark, sf_dir).write.option("path", path).saveAsTable(name)
    if not spark.catalog.tableExists(name):
        raise RuntimeError("table was not registered")
    return spark.sql(f"SELECT * FROM {name}")


def save_events_by_month_day(spark, sf_dir):
    path = work_dir(spark, "by-day")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.date_format("ts", "yyyyMM").alias("month"), F.date_format("ts", "yyyyMMdd").alias("day"),
    )
    # The rows of a day gather in few files; AQE splits a day too big for one task.
    events.hint("rebalance", F.col("month"), F.col("day")).write.partitionBy(
        "month", "day"
    ).parquet(path)
    return path


@query(
    "src_partitioned_files",
    "SELECT event_id, user_id, event_type FROM events WHERE strftime(ts, '%Y%m%d') = '20240115'",
)
def src_partitioned_files(spark, sf_dir):
    path = save_events_by_month_day(spark, sf_dir)
    schema = "event_id bigint, user_id bigint, event_type string, month string, day string"
    day = readers.partition_slice(spark, path, schema, month="202401", day="20240115")
    return day.select("event_id", "user_id", "event_type")


@query("src_sql_on_files", ORDER_ROWS)
def src_sql_on_files(spark, sf_dir):
    path = tables_dir(spark, sf_dir, "sql", lambda df, p: df.write.parquet(p))
    return readers.sql_on_files(spark, "parquet", path)


@query(
    "src_formats",
    "SELECT f.fmt, o_orderkey, o_custkey, o_orderpriority FROM orders, (VALUES ('parquet'), "
    "('orc'), ('json'), ('csv')) f(fmt)",
)
def src_formats(spark, sf_dir):
    merged = None
    for fmt in ("parquet", "orc", "json", "csv"):
        path = tables_dir(spark, sf_dir, fmt, lambda df, p: df.write.format(fmt).save(p))
        copy = readers.source(spark, fmt, path, ORDER_SCHEMA).withColumn("fmt", F.lit(fmt))
        merged = copy if merged is None else merged.unionByName(copy)
    return merged


@query(
    "src_document_store",
    "SELECT user_id, CAST(item_id AS VARCHAR) AS item, event_type FROM {EV}",
)
def src_document_store(spark, sf_dir):
    """Nested JSON documents read back under an enforced schema."""
    path = work_dir(spark, "documents")
    with_item(table(spark, sf_dir, "events")).select(
        F.struct("user_id", F.struct("event_type", "item_id").alias("action")).alias("doc")
    ).select("doc.*").write.json(path)
    documents = readers.documents(
        spark, path, "user_id bigint, action struct<event_type: string, item_id: string>"
    )
    return documents.select("user_id", F.col("action.item_id").alias("item"), "action.event_type")


@query(
    "snk_text",
    "SELECT concat(event_type, ' ', count(*)) AS value FROM events GROUP BY event_type",
)
def snk_text(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    path = work_dir(spark, "counts")
    for _ in range(2):  # the second save finds the path and leaves it alone
        sink.save_text(counts, F.concat_ws(" ", "event_type", "cnt"), path)
    return readers.text_lines(spark, path)


@query("snk_table_overwrite", ORDER_ROWS)
def snk_table_overwrite(spark, sf_dir):
    path = work_dir(spark, "result")
    for _ in range(2):  # replaced, not appended
        sink.overwrite_table(orders(spark, sf_dir), path)
    return readers.source(spark, "parquet", path, ORDER_SCHEMA)


@query(
    "snk_upsert",
    "SELECT c_custkey, CASE WHEN o.total IS NULL THEN c_acctbal ELSE o.total END AS amount FROM "
    "customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS total FROM orders WHERE "
    "o_orderstatus = 'F' GROUP BY 1) o ON c_custkey = o_custkey UNION ALL SELECT o_custkey, "
    "max(o_totalprice) FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN "
    "(SELECT c_custkey FROM customer) GROUP BY 1",
)
def snk_upsert(spark, sf_dir):
    current = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("amount")
    )
    updates = (
        table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
        .select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("amount"))
    )
    # A customer has many orders: the sink itself keeps one update per key.
    path = sink.upsert_to_version(
        current, updates, ["c_custkey"], ["amount"], work_dir(spark, "upsert"), 1
    )
    return readers.source(spark, "parquet", path, "c_custkey bigint, amount double")


@query(
    "snk_kv_latest",
    "SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2",
)
def snk_kv_latest(spark, sf_dir):
    return sink.latest_per_key(
        table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["value"]
    )


@query(
    "snk_kafka",
    "SELECT CAST(o_custkey AS VARCHAR) AS key, concat('{\"o_orderkey\":', o_orderkey, "
    "',\"o_custkey\":', o_custkey, ',\"o_orderpriority\":\"', o_orderpriority, '\"}') AS value "
    "FROM orders",
)
def snk_kafka(spark, sf_dir):
    path = work_dir(spark, "messages")
    sink.send(orders(spark, sf_dir), "parquet", key="o_custkey", path=path)
    return readers.message_values(readers.source(spark, "parquet", path, "key string, value string"))


@query(
    "snk_day_table",
    "SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS day FROM events",
)
def snk_day_table(spark, sf_dir):
    path = work_dir(spark, "day-table")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.date_format("ts", "yyyyMMdd").alias("day")
    )
    sink.save_by_day(events, "day", path)
    # A failed day is loaded again: its partition is replaced, the others stay.
    sink.save_by_day(events.filter(F.col("day") == "20240115"), "day", path)
    return spark.read.schema("event_id bigint, user_id bigint, day string").parquet(path)


@query(
    "snk_sorted_cells",
    "SELECT *, row_number() OVER (ORDER BY row_key, qualifier) AS position FROM (SELECT "
    "CAST(event_id AS VARCHAR) AS row_key, 'info' AS family, u.qualifier, u.value FROM "
    "events, LATERAL (VALUES ('event_type', event_type), ('props', props), "
    "('user_id', CAST(user_id AS VARCHAR))) u(qualifier, value) WHERE u.value IS NOT NULL)",
)
def snk_sorted_cells(spark, sf_dir):
    path = work_dir(spark, "cells")
    exploded = sink.cells(
        table(spark, sf_dir, "events"), "event_id", "info", ["event_type", "props", "user_id"]
    )
    sink.sort_for_key_store(exploded, ["row_key", "qualifier"]).write.parquet(path)
    return with_position(
        spark, path, "row_key string, family string, qualifier string, value string"
    )


@query(
    "src_table_schemas",
    " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS cnt FROM {n}" for n in SCHEMAS),
)
def src_table_schemas(spark, sf_dir):
    """Rows of every table, each opened under its declared schema."""
    counts = [
        table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(n).alias("name"), "cnt")
        for n in SCHEMAS
    ]
    return reduce(DataFrame.unionByName, counts)
