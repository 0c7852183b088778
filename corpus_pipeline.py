"""A corpus pipeline: toxicity, language, near-duplicates, mixing, packing.

Each stage takes what the stage before kept, written as Parquet and read again. All
but the last return the columns of ``documents``:

* toxicity drops documents whose chance of any toxic grade is a half or more;
* language drops documents without a letter or text, and those whose language the
  kernels cannot tell (a share below ``LEAST_LANGUAGE``); clean texts of all learned
  languages stay;
* near-duplicates keep the smallest id of each component (five-word shingles, 0.8);
  rows that repeat an id are one document, rows without an id stay;
* mixing repeats documents of sources that are short of their weight, at most
  ``REPETITIONS`` times, and loses none;
* packing returns pieces of sequences of 2,048 tokens.

Each stage of an empty table returns no rows. Input rows travel whole through the first
four stages, so an extra column keeps its values whatever its name. A null or empty text
is not toxic, has no language (the second stage drops it) and, where a stage gets it
alone, is like no other, counts one token and packs as its end id. Very long texts are
read whole. Ties: equal texts share their verdicts; of rows that repeat an id the one
with the smallest hash of its columns stays; copies of a row are mixed together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import labels, stored
from eventmill.llm.langid import UNKNOWN, fit_languages, held_out, predict_languages
from eventmill.llm.mixing import mix
from eventmill.llm.neardup import near_duplicates
from eventmill.llm.packing import pack
from eventmill.llm.toxicity import fit_toxicity, score_toxicity
from eventmill.session import broadcast_if_small, prepare, work_dir

LEAST_LANGUAGE = 0.3
ENTROPY = 0.95
REPETITIONS = 2.0


def whole(docs: DataFrame, *read: str) -> DataFrame:
    """The columns a stage reads, and the input row as one, out of reach of its own names."""
    return docs.select(F.struct(*docs.columns).alias("_row"), *read)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_toxicity(docs, labels(spark, sf_dir))
    return score_toxicity(whole(docs, "text"), model).filter("NOT toxic_pred").select("_row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_languages(docs.filter(~held_out()))
    found = predict_languages(whole(docs, "text"), model)
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)
    return found.filter(known).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = stored(
        near_duplicates(docs, width=5).filter("kept AND doc_id IS NOT NULL")
        .select("doc_id").distinct(),
        "kept",
    )
    named = docs.join(broadcast_if_small(kept), "doc_id", "left_semi").select(*docs.columns)
    repeated = stored(
        docs.groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1 AND doc_id IS NOT NULL")
        .select("doc_id"),
        "repeated",
    )
    # Few ids repeat, if any; of their rows one stays, picked by a hash of its columns.
    once = named.join(broadcast_if_small(repeated), "doc_id", "left_anti")
    first = (
        named.join(broadcast_if_small(repeated), "doc_id", "left_semi")
        .groupBy("doc_id").agg(
            F.min_by(F.struct(*docs.columns), F.xxhash64(F.struct(*docs.columns))).alias("_row")
        ).select("_row.*")
    )
    nameless = docs.filter("doc_id IS NULL")
    columns = docs.columns
    return once.select(*columns).unionByName(first.select(*columns)).unionByName(nameless)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = whole(docs, "doc_id", "source", "text")
    return mix(rows, entropy=ENTROPY, repetitions=REPETITIONS).select("_row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Trained models, hashed minima and token ids are beyond SQL; tests/llm holds the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
