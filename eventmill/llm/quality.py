"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target and the corpus.

Words and word pairs are hashed into buckets. The corpus multinomial counts every
document; the target multinomial counts half of the trusted ones (all documents
labelled good, halved by a hash of the id), smoothed towards the corpus. The score of a document is the
mean log ratio of its n-grams. The threshold is a low quantile of trusted documents
that the target has not seen, less a margin, so it is the same for the same tables.
Before it come base rules on length and repetition.

Only column expressions: texts are split and counted in the JVM. The weights are one
number per bucket, whatever the data. Repeated windows are found inside the row by sorting
its window hashes. All figures of a row are taken in one branch, so nothing is joined by a
row number, and no text is shuffled.

Nulls: a null or blank text has no words and fails the base. Rows that repeat are
judged each. Without trusted labels the ratio is 0 and the base alone decides. Labels
that repeat an id count once (the larger). An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import SPACE_CLASS, documents, labels, stored, words
from eventmill.session import broadcast_if_small

BUCKETS = 1 << 15
SMOOTHING = 0.2  # weight of the corpus against the target's own counts
QUANTILE = 0.002
MARGIN = 0.01
LEAST_WORDS = 50


def numbered(df: DataFrame) -> DataFrame:
    """Rows with a key of their own, good within one branch of a plan: never join on it."""
    return df.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id())


def with_windows(df: DataFrame) -> DataFrame:
    """A row for each word ``a`` with its two followers ``b``, ``c`` and its place ``pos``."""
    w = F.col("_words")
    zipped = F.arrays_zip(
        w.alias("a"), F.slice(w, 2, F.size(w)).alias("b"), F.slice(w, 3, F.size(w)).alias("c")
    )
    keep = [c for c in df.columns if c != "text"]
    split = df.withColumn("_words", words(F.col("text"))).select(*keep, zipped.alias("_zip"))
    return split.select(*keep, F.posexplode_outer("_zip").alias("pos", "_w")).select(
        *keep, "pos", F.col("_w.a").alias("a"), F.col("_w.b").alias("b"), F.col("_w.c").alias("c")
    )


def bucket(*parts: Column, buckets: int = BUCKETS) -> Column:
    """0-based bucket of an n-gram; null where it is not whole."""
    whole = F.lit(True)
    for p in parts:
        whole = whole & p.isNotNull()
    return F.when(whole, F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int"))


def trusted_ids(marks: DataFrame) -> DataFrame:
    """All trusted ids with ``fold`` 0 (target) or 1 (threshold)."""
    good = marks.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.select(
        "doc_id", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2)).alias("fold")
    )


def fit_weights(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING
) -> list[float]:
    """Log ratio of every bucket; empty if the target has no n-gram."""
    marked = docs.join(broadcast_if_small(trusted.filter("fold = 0")), "doc_id", "left")
    a, b = F.col("a"), F.col("b")
    grams = with_windows(marked.select("text", "fold")).select(
        "fold", F.explode(F.array(bucket(a, buckets=buckets), bucket(a, b, buckets=buckets))).alias("at")
    )
    counts = (
        grams.filter("at IS NOT NULL").groupBy("at")
        .agg(F.count("*").alias("corpus"), F.count("fold").alias("target"))
        .toPandas()
    )
    corpus, target = [1.0] * buckets, [0.0] * buckets
    for at, c, t in zip(counts["at"], counts["corpus"], counts["target"], strict=True):
        corpus[at] += c
        target[at] += t
    all_corpus, all_target = sum(corpus), sum(target)
    if not all_target:
        return []
    held = smoothing * all_target
    return [
        math.log((t + held * c / all_corpus) / (all_target + held)) - math.log(c / all_corpus)
        for c, t in zip(corpus, target, strict=True)
    ]


def gram_score(weights: list[float]) -> Column:
    """Summed weight of the one or two n-grams that start at a word.

    The weights are a constant array: an indexed look-up inside the generated code.
    """
    table = F.split(F.lit(",".join(f"{w:.9g}" for w in weights)), ",").cast("array<double>")
    a, b, n = F.col("a"), F.col("b"), len(weights)
    return table[bucket(a, buckets=n)] + F.coalesce(table[bucket(a, b, buckets=n)], F.lit(0.0))


def mean_ratio(weights: list[float]) -> Column:
    if not weights:
        return F.lit(0.0)
    grams = F.count("a") + F.count("b")
    return F.coalesce(F.sum(gram_score(weights)) / grams, F.lit(0.0))


def fit_threshold(
    docs: DataFrame, trusted: DataFrame, weights: list[float], quantile: float, margin: float
) -> float:
    if not weights:
        return 0.0
    held = docs.join(broadcast_if_small(trusted.filter("fold = 1")), "doc_id")
    scored = (
        with_windows(numbered(held)).groupBy("_row")
        .agg(mean_ratio(weights).alias("ratio"), F.count("a").alias("n"))
        .filter(F.col("n") >= LEAST_WORDS)
    )
    low = scored.agg(F.percentile_approx("ratio", quantile, 100_000)).first()[0]
    return (0.0 if low is None else low) - margin


def with_repeat_words(docs: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in a 3-word window found twice or more in the text.

    Equal windows stand side by side once a row's (hash, place) pairs are sorted. Texts
    without a repeated window are not sorted.
    """
    w, spots, repeated = F.col("_words"), F.col("_spots"), F.col("_repeated")
    whole = F.greatest(F.size(w) - 2, F.lit(0))
    windows = F.arrays_zip(*(F.slice(w, i + 1, whole).alias(f"w{i}") for i in range(3)))
    hashes = F.transform(windows, lambda x: F.xxhash64(x["w0"], x["w1"], x["w2"]))
    placed = F.transform(F.col("_hashes"), lambda x, i: F.struct(x.alias("h"), i.alias("at")))
    same = lambda x, i: F.coalesce(F.get(spots, i)["h"] == x["h"], F.lit(False))
    covered = F.flatten(F.transform(repeated, lambda x: F.sequence(x["at"], x["at"] + 2)))
    return (
        docs.withColumn("_words", words(F.col("text")))
        .withColumn("_hashes", hashes)
        .withColumn("_spots", F.when(
            F.size("_hashes") > F.size(F.array_distinct("_hashes")), F.array_sort(placed)
        ))
        .withColumn("_repeated", F.filter(spots, lambda x, i: same(x, i - 1) | same(x, i + 1)))
        .withColumn(
            "n_repeat_words",
            F.when(spots.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered))).cast("long"),
        )
        .drop("_words", "_hashes", "_spots", "_repeated")
    )


def quality_verdicts(
    docs: DataFrame,
    marks: DataFrame,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
) -> DataFrame:
    """Base figures, ratio and verdict of every document (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    trusted = stored(trusted_ids(marks), "trusted")
    weights = fit_weights(docs, trusted, buckets, smoothing)
    threshold = fit_threshold(docs, trusted, weights, quantile, margin)

    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda x: x.rlike("[^" + SPACE_CLASS[1:])
    lines = F.filter(F.split(text, "\n"), has_word)
    figures = with_repeat_words(numbered(docs)).withColumn("_lines", lines).select(
        "_row", "doc_id", "text", "n_repeat_words",
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    scored = (
        with_windows(figures)
        .groupBy("_row", "doc_id", "n_symbols", "n_dup_lines", "n_repeat_words")
        .agg(
            F.count("a").alias("n_words"),
            F.coalesce(F.sum(F.length("a")), F.lit(0)).cast("long").alias("word_chars"),
            mean_ratio(weights).alias("log_ratio"),
        )
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    return (
        scored.withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept", "log_ratio",
        )
    )


def op2_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir), labels(spark, sf_dir))
