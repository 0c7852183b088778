"""User-defined functions and views."""

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F

from eventmill.plans.registry import query
from eventmill.sources.tables import table, with_item


@query("udf_scalar_register", "SELECT c_custkey, c_nationkey + 100 AS shifted FROM customer")
def udf_scalar_register(spark, sf_dir):
    @F.pandas_udf("int")
    def add_hundred(values: pd.Series) -> pd.Series:
        return values + 100

    spark.udf.register("eventmill_add_hundred", add_hundred)
    table(spark, sf_dir, "customer").createOrReplaceTempView("eventmill_people")
    return spark.sql(
        "SELECT c_custkey, eventmill_add_hundred(c_nationkey) AS shifted FROM eventmill_people"
    )


@query(
    "udf_generic_string",
    "SELECT c_custkey, coalesce(lower(nullif(CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE "
    "c_mktsegment END, '')), 'none') AS segment FROM customer",
)
def udf_generic_string(spark, sf_dir):
    @F.pandas_udf("string")
    def lower_or_null(values: pd.Series) -> pd.Series:
        return values.where(values != "", None).str.lower()

    text = F.when(F.col("c_nationkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.coalesce(lower_or_null(text), F.lit("none")).alias("segment")
    )


@query("udf_vector", "SELECT event_id, CAST(item_id % 7 AS BIGINT) AS hot FROM {EV}")
def udf_vector(spark, sf_dir):
    """Index of the 1.0 in a one-hot vector."""
    from pyspark.ml.functions import array_to_vector

    flags = F.transform(
        F.sequence(F.lit(0), F.lit(6)), lambda i: (i == F.col("item_id") % 7).cast("double")
    )
    vectors = with_item(table(spark, sf_dir, "events")).select(
        "event_id", array_to_vector(flags).alias("v")
    )
    assert isinstance(vectors.schema["v"].dataType, VectorUDT)
    hot = F.array_position(vector_to_array("v"), F.lit(1.0)) - 1
    return vectors.select("event_id", hot.cast("bigint").alias("hot"))


@query(
    "udaf_udtf",
    "SELECT event_id, unnest(string_split(event_type || '-' || item_id, '-')) AS word FROM {EV}",
)
def udaf_udtf(spark, sf_dir):
    """A Python table function; the aggregate form is ``agg_group_max_udaf``."""

    @F.udtf(returnType="word: string", useArrow=True)
    class SplitWords:
        def eval(self, text: str):
            for word in text.split("-"):
                yield (word,)

    spark.udtf.register("eventmill_split_words", SplitWords)
    with_item(table(spark, sf_dir, "events")).selectExpr(
        "event_id", "concat(event_type, '-', item_id) AS text"
    ).createOrReplaceTempView("eventmill_texts")
    return spark.sql(
        "SELECT event_id, w.word FROM eventmill_texts, LATERAL eventmill_split_words(text) w"
    )


@query(
    "view_temp_global",
    "SELECT event_type, count(*) AS cnt FROM events GROUP BY 1 HAVING count(*) > 1",
)
def view_temp_global(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    events.createOrReplaceTempView("eventmill_events")
    events.createOrReplaceGlobalTempView("eventmill_events_all")
    return spark.sql(
        "SELECT event_type, count(*) AS cnt FROM eventmill_events WHERE event_type IN "
        "(SELECT DISTINCT event_type FROM global_temp.eventmill_events_all) "
        "GROUP BY event_type HAVING count(*) > 1"
    )
