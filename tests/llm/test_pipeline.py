"""The corpus pipeline: stages keep columns, decide as their operators do, handle nothing."""

from pyspark.sql import functions as F

import corpus_pipeline
from eventmill.llm.packing import LIMIT


def test_run_is_the_stages_one_after_the_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == columns
        seen[name] = docs.select("doc_id").distinct().count()
    assert before >= seen["toxicity"] >= seen["language"] >= seen["near_dedup"] == seen["mixing"]
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.select("doc_id").distinct().count() == seen["mixing"]
    fill = pieces.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in fill) <= LIMIT


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


LONG = " ".join(f"word{i % 900} and{i % 31}." for i in range(12_000))
CLASHES = ("severity", "toxic_pred", "lang_pred", "score", "mix_tokens", "epoch", "weight",
           "mix_order", "_key", "_block", "_place", "_scored", "_found", "_n", "kept", "_row",
           "component_id", "n_shingles", "label", "cid")


def awkward(spark, sf_dir):
    """Given documents and awkward ones, with an extra column of every name the stages use."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [None, "", " \t\n", LONG, LONG, "the same short text of some words here",
             "the same short text of some words here", "1234 5678", "x" * 5_000]
    rows = [(10**6 + i, t, None if i % 2 else "en", None if i % 3 else "web", None)
            for i, t in enumerate(texts)]
    rows += [rows[5], (None, "a text without an id", "en", "web", 1), (rows[5][0], "another text of this id", "en", "web", 1)]
    docs = given.unionByName(spark.createDataFrame(rows, given.schema))
    for name in CLASHES:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}="), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return docs


def test_extra_columns_and_awkward_rows_travel_through_every_stage(spark, sf_dir):
    docs = awkward(spark, sf_dir)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        seen[name] = docs.collect()
        for r in seen[name]:
            for c in CLASHES:
                assert r[c] == f"{c}={'none' if r.doc_id is None else r.doc_id}"
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    assert {10**6 + i for i in range(9)} <= set(ids["toxicity"])
    # Without a letter there is no language; all else stays.
    assert set(ids["toxicity"]) - set(ids["language"]) >= {10**6, 10**6 + 1, 10**6 + 2, 10**6 + 7}
    assert {10**6 + i for i in (3, 4, 5, 6)} <= set(ids["language"])
    # One of the equal long texts, one row of the repeated id, the row without an id.
    assert 10**6 + 3 in ids["near_dedup"] and 10**6 + 4 not in ids["near_dedup"]
    assert ids["near_dedup"].count(10**6 + 5) == 1 and ids["near_dedup"].count(None) == 1
    assert set(ids["mixing"]) == set(ids["near_dedup"])
    pieces = corpus_pipeline.packing(spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == set(ids["mixing"])


def test_the_row_kept_of_a_repeated_id_does_not_depend_on_order(spark, sf_dir):
    docs = awkward(spark, sf_dir)
    rows = [sorted(map(repr, corpus_pipeline.near_dedup(spark, d, sf_dir).collect()))
            for d in (docs, docs.orderBy(F.desc("text")).repartition(5))]
    assert rows[0] == rows[1]
