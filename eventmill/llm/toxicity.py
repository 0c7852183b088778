"""Toxicity: cumulative-link ordinal regression over sparse text features.

Features are words and word beginnings (4 to 8 letters of a longer word), picked by
their G-squared association with the toxic label in a stable, bounded sample of
labelled documents. Values are 1 + log count. The grades of the training rows are 0 for
clean documents and, for toxic ones, 1 to ``grades`` by the terciles of how many
associated words they hold: labels say toxic or not, severity follows the amount.

The model shares one weight vector over ordered thresholds,
``P(grade >= k) = sigmoid(x.w - t_k)``, fitted by proximal gradient steps (so weights of
chance words are exactly 0). Expected severity is the sum of these probabilities; a
document is toxic if ``P(grade >= 1) >= 1/2``.

Nulls: a null or empty text has no features and so the severity of an empty document.
Rows that repeat are scored each, labels that repeat an id count once (the larger),
null labels are ignored, other columns are kept. Without labels of both kinds the
severity is 0 and nothing is toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents, handed_back, labels, unit_interval

SAMPLE = 8_000  # labelled documents, half of them toxic where there are enough
FEATURES = 1_024
MIN_ASSOCIATION = 25.0  # G-squared; chance of about 6e-7 per candidate
GRADES = 3
PREFIXES = range(4, 9)
WORD = re.compile(r"\w+")
SPARK_WORD = r"[\p{L}\p{N}_]+"


def features_of(text: Column) -> Column:
    """The distinct words of a text and their proper beginnings, marked by a star."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(SPARK_WORD), F.lit(0)))

    def shapes(word):
        starts = [
            F.when(F.length(word) > k, F.concat(F.substring(word, 1, k), F.lit("*")))
            for k in PREFIXES
        ]
        return F.array(word, *starts)

    return F.array_distinct(F.array_compact(F.flatten(F.transform(words, shapes))))


@dataclass
class OrdinalModel:
    names: list[str]
    weights: np.ndarray
    thresholds: np.ndarray
    lookup: dict[str, list[int]] = field(default_factory=dict)

    def __post_init__(self):
        self.index = {n: i for i, n in enumerate(self.names)}
        self.words = {n for n in self.names if not n.endswith("*")}
        self.starts = {n[:-1] for n in self.names if n.endswith("*")}
        self.lengths = sorted({len(s) for s in self.starts})

    def vector(self, text: str | None) -> dict[int, float]:
        """One plus the log count of each feature a text has."""
        found: Counter = Counter()
        words, starts, lengths = self.words, self.starts, self.lengths
        for word in WORD.findall((text or "").lower()):
            if word in words:
                found[word] += 1
            for k in lengths:
                if k < len(word) and word[:k] in starts:
                    found[word[:k] + "*"] += 1
        return {self.index[n]: 1.0 + math.log(c) for n, c in found.items()}

    def probabilities(self, vectors: list[dict[int, float]]) -> np.ndarray:
        """P(grade >= k) for k = 1.., never rising in k."""
        eta = np.asarray([sum(self.weights[i] * v for i, v in x.items()) for x in vectors])
        return sigmoid(eta[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def ordinal_loss(eta: np.ndarray, thresholds: np.ndarray, grades: np.ndarray, weight: np.ndarray):
    """Weighted negative log likelihood, its slope by eta and by the thresholds."""
    upper = np.concatenate((sigmoid(eta[:, None] - thresholds), np.zeros((len(eta), 1))), 1)
    upper = np.concatenate((np.ones((len(eta), 1)), upper), 1)
    rows = np.arange(len(eta))
    hi, lo = upper[rows, grades], upper[rows, grades + 1]
    p = np.maximum(hi - lo, 1e-12)
    dhi, dlo = hi * (1 - hi), lo * (1 - lo)
    by_eta = -weight * (dhi - dlo) / p
    by_threshold = np.zeros(len(thresholds))
    inside = grades > 0
    np.add.at(by_threshold, grades[inside] - 1, (weight * dhi / p)[inside])
    inside = grades < len(thresholds)
    np.add.at(by_threshold, grades[inside], -(weight * dlo / p)[inside])
    return float(-(weight * np.log(p)).sum()), by_eta, by_threshold


def fit_ordinal(
    vectors: list[dict[int, float]],
    grades: np.ndarray,
    names: list[str],
    levels: int,
    lasso: float = 1e-5,
    ridge: float = 1e-6,
    steps: int = 4000,
) -> OrdinalModel:
    """Accelerated proximal gradient; thresholds are kept in order."""
    n = len(vectors)
    row = np.repeat(np.arange(n), [len(v) for v in vectors])
    col = np.asarray([i for v in vectors for i in v], int)
    val = np.asarray([x for v in vectors for x in v.values()], float)
    weight = np.full(n, 1.0 / max(1, n))
    share = np.asarray([(grades >= k).mean() for k in range(1, levels + 1)])
    start = -np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    w, t = np.zeros(len(names)), np.maximum.accumulate(start + 1e-3 * np.arange(levels))
    square = np.bincount(row, val**2, n)
    rate = 1.0 / (0.25 * (weight @ square) * 4 + 1.0)
    vw, vt, momentum = w.copy(), t.copy(), 1.0
    for _ in range(steps):
        eta = np.bincount(row, val * vw[col], n)
        _, by_eta, by_t = ordinal_loss(eta, vt, grades, weight)
        by_w = np.bincount(col, val * by_eta[row], len(names)) + ridge * vw
        step = vw - rate * by_w
        new_w = np.sign(step) * np.maximum(0.0, np.abs(step) - rate * lasso)
        new_t = np.maximum.accumulate(vt - rate * by_t + 1e-6 * np.arange(levels))
        after = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        vw = new_w + (momentum - 1) / after * (new_w - w)
        vt = np.maximum.accumulate(new_t + (momentum - 1) / after * (new_t - t))
        w, t, momentum = new_w, new_t, after
    kept = np.flatnonzero(w)
    return OrdinalModel([names[i] for i in kept], w[kept], t)


def association(a: np.ndarray, b: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """Signed G-squared of being in a of pos toxic and b of neg clean documents."""
    total = pos + neg
    out = np.zeros(len(a))
    for seen, size in ((a, pos), (b, neg)):
        for part, share in ((seen, (a + b) / total), (size - seen, 1 - (a + b) / total)):
            with np.errstate(divide="ignore", invalid="ignore"):
                out += np.where(part > 0, 2 * part * np.log(part / np.maximum(size * share, 1e-12)), 0)
    return np.where(a / max(1, pos) >= b / max(1, neg), out, -out)


def sample_labelled(docs: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """About ``size`` labelled documents, drawn by a hash of their ids.

    The ids are few by construction (``size``), so they are broadcast and the texts of
    all documents stay where they are.
    """
    marks = (
        marks.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    counts = dict(marks.groupBy("toxic").count().collect())
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    want_toxic = min(toxic, size // 2)
    share = F.when(F.col("toxic") == 1, want_toxic / max(1, toxic)).otherwise(
        min(1.0, (size - want_toxic) / max(1, clean))
    )
    drawn = marks.filter(unit_interval(F.lit("toxicity"), F.col("doc_id")) < share).limit(2 * size)
    return docs.filter(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id")


def fit_toxicity(
    docs: DataFrame,
    marks: DataFrame,
    sample: int = SAMPLE,
    features: int = FEATURES,
    least: float = MIN_ASSOCIATION,
    grades: int = GRADES,
) -> OrdinalModel:
    """Fit on labels ``marks`` (doc_id, toxic 0/1) of ``docs`` (doc_id, text)."""
    none = OrdinalModel([], np.zeros(0), np.full(grades, 40.0))
    chosen = sample_labelled(docs.select("doc_id", "text"), marks, sample)

    sizes = dict(chosen.groupBy("toxic").count().collect())
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return none
    # Only what toxic documents hold more often can pass; the best few reach the driver.
    a, b = F.col("a"), F.col("b")
    enough = (a >= 4) & (a / pos > 1.5 * b / neg)
    top = (
        chosen.select("toxic", F.explode(features_of(F.col("text"))).alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .filter(enough)
        .withColumn("_gain", a * F.log((a / pos) / ((b + 0.5) / neg)))
        .orderBy(F.desc("_gain"), "feature").limit(8 * features).toPandas()
    )
    score = association(top["a"].to_numpy(float), top["b"].to_numpy(float), pos, neg)
    order = np.lexsort((top["feature"].to_numpy(), -score))
    names = [top["feature"].iloc[i] for i in order if score[i] >= least][:features]
    if not names:
        return none
    finder = OrdinalModel(names, np.zeros(len(names)), np.zeros(grades))

    def vectors(frames):
        for frame in frames:
            got = [finder.vector(t) for t in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "toxic": frame["toxic"],
                "at": [list(v) for v in got], "value": [list(v.values()) for v in got],
            })

    data = (
        chosen.mapInPandas(
            vectors, "doc_id long, toxic int, at array<int>, value array<double>"
        ).toPandas().sort_values("doc_id", kind="stable")
    )
    rows = [
        dict(zip(map(int, i), map(float, v), strict=True))
        for i, v in zip(data["at"], data["value"], strict=True)
    ]
    amount = np.asarray([sum(math.exp(x - 1.0) for x in r.values()) for r in rows])
    toxic = data["toxic"].to_numpy() == 1
    cuts = np.quantile(amount[toxic], np.arange(1, grades) / grades)
    grade = np.where(toxic, 1 + np.searchsorted(cuts, amount, side="left"), 0)
    return fit_ordinal(rows, grade.astype(int), names, grades)


def score_toxicity(df: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``df`` with ``severity`` (expected grade) and ``toxic_pred``."""

    @F.pandas_udf("severity double, toxic_pred boolean")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def scored():
            known = model
            for texts in parts:
                got = [known.vector(t if isinstance(t, str) else None) for t in texts]
                chance = known.probabilities(got)
                yield pd.DataFrame({"severity": chance.sum(1), "toxic_pred": chance[:, 0] >= 0.5})

        return handed_back(scored())

    rest = [F.col(c) for c in df.columns if c not in ("severity", "toxic_pred")]
    return df.withColumn("_scored", score(F.col(text_col))).select(
        *rest, F.col("_scored.severity").alias("severity"),
        F.col("_scored.toxic_pred").alias("toxic_pred"),
    )


def op3_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_toxicity(docs, labels(spark, sf_dir))
    return score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", "severity", "toxic_pred"
    )
