"""Language ID: blended-spectrum string kernels, Nystroem landmarks, kernel ridge regression.

A text is the set of its character n-grams (n = 1 to ``max_n``, hashed to
``buckets``); the kernel of two texts is the size of the common set over the square
root of the product of the sizes. Landmarks z give the Nystroem features
``k(x, Z) K(Z, Z)^(-1/2)``; one ridge regression per language is fitted on them
(one versus rest). Texts are scored by batched matrix products
``presence [rows x buckets] @ (landmarks' presence @ weights)``, which is the same
sum in an order that never forms rows x landmarks.

Fit: a stable sample of about ``per_class`` labelled texts for each language
(documented bound), whole texts; only packed n-gram bits reach the driver.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Null languages
are not learned. Without any labelled row every text is ``und``. Rows that repeat are
scored each; other columns are ignored. Ties fall to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents, handed_back, unit_interval

BUCKETS = 1 << 13
MAX_N = 4
PER_CLASS = 800
LANDMARKS = 256
RIDGE = 1e-2
SHARPNESS = 6.0
UNKNOWN = "und"
CHUNK = 1 << 16  # characters hashed at a time
KERNEL_ROWS = 256  # rows that are numbers, not bits, at a time
MIX = np.uint64(0x9E3779B97F4A7C15)


def presence(text: str, buckets: int, max_n: int) -> np.ndarray:
    """Which n-gram buckets occur in a text."""
    seen = np.zeros(buckets, bool)
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    for start in range(0, len(points), CHUNK):
        part = points[start : start + CHUNK + max_n - 1].astype(np.uint64)
        rolled = np.zeros(len(part), np.uint64)
        for n in range(1, min(max_n, len(part)) + 1):
            rolled = (rolled[: len(part) - n + 1] + part[n - 1 :] + np.uint64(n)) * MIX
            rolled ^= rolled >> np.uint64(29)
            seen[((rolled * MIX) >> shift)[:CHUNK]] = True
    return seen


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


@dataclass
class KernelRidge:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, landmarks already multiplied in
    offsets: np.ndarray
    buckets: int
    max_n: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Regression values of presence rows, one column per language."""
        sizes = np.sqrt(np.maximum(1, rows.sum(1)))[:, None]
        return rows.astype(np.float32) @ self.weights / sizes + self.offsets

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        if at:
            rows = np.stack([presence(texts[i], self.buckets, self.max_n) for i in at])
            values = SHARPNESS * self.scores(rows)
            shares = np.exp(values - values.max(1, keepdims=True))
            shares /= shares.sum(1, keepdims=True)
            best = values.argmax(1)
            for i, b, s in zip(at, best, shares[np.arange(len(at)), best], strict=True):
                names[i], scores[i] = self.languages[b], float(s)
        return names, scores


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows in blocks: counts below 2^24 are exact in single precision, and few are wide."""
    right = b.T.astype(np.float32)
    common = np.empty((len(a), len(b)), np.float64)
    for i in range(0, len(a), KERNEL_ROWS):
        common[i : i + KERNEL_ROWS] = a[i : i + KERNEL_ROWS].astype(np.float32) @ right
    return common / np.sqrt(np.outer(np.maximum(1, a.sum(1)), np.maximum(1, b.sum(1))))


def fit_kernel_ridge(
    rows: np.ndarray, names: list[str], landmarks: int, ridge: float, max_n: int
) -> KernelRidge:
    """Ridge regression on Nystroem features; landmarks alternate between the languages."""
    languages = sorted(set(names))
    buckets = rows.shape[1]
    if not languages:
        empty = np.zeros((buckets, 0), np.float32)
        return KernelRidge([], empty, np.zeros(0, np.float32), buckets, max_n)
    target = np.asarray([languages.index(n) for n in names])
    nth = np.empty(len(names), int)
    for k in range(len(languages)):
        own = np.flatnonzero(target == k)
        nth[own] = np.arange(len(own))
    chosen = np.lexsort((target, nth))[: max(landmarks, len(languages))]
    marks = rows[chosen]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    keep = values > 1e-8 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel(rows, marks) @ whiten
    signs = np.where(target[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Every language weighs the same, however many texts it has.
    weight = 1.0 / np.bincount(target, minlength=len(languages))[target]
    mean, middle = weight @ features / weight.sum(), weight @ signs / weight.sum()
    centred = features - mean
    gram = (centred * weight[:, None]).T @ centred / len(languages)
    gram[np.diag_indices_from(gram)] += ridge * np.trace(gram) / len(gram) + 1e-12
    solved = np.linalg.solve(gram, (centred * weight[:, None]).T @ (signs - middle) / len(languages))
    scale = np.sqrt(np.maximum(1, marks.sum(1)))[:, None]
    weights = marks.T.astype(np.float64) @ (whiten @ solved / scale)
    return KernelRidge(
        languages, weights.astype(np.float32), (middle - mean @ solved).astype(np.float32),
        buckets, max_n,
    )


def fit_languages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_class: int = PER_CLASS,
    landmarks: int = LANDMARKS,
    buckets: int = BUCKETS,
    max_n: int = MAX_N,
    ridge: float = RIDGE,
) -> KernelRidge:
    """Fit on a stable sample of about ``per_class`` rows of every language in ``df``."""
    usable = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = dict(usable.groupBy(lang_col).count().collect())
    if not counts:
        return fit_kernel_ridge(np.zeros((0, buckets), bool), [], landmarks, ridge, max_n)
    shares = F.create_map(
        *(F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, per_class / n)))
    )
    drawn = unit_interval(F.lit("language"), F.col(id_col).cast("string"))
    sample = usable.filter(drawn < shares[F.col(lang_col)])

    def featurize(frames):
        for frame in frames:
            lettered = frame[[has_letter(t) for t in frame["text"]]]
            yield pd.DataFrame({
                "order": lettered["order"],
                "name": lettered["name"],
                "bits": [
                    np.packbits(presence(t, buckets, max_n)).tobytes() for t in lettered["text"]
                ],
            })

    got = (
        sample.select(
            F.xxhash64(F.col(id_col), F.col(text_col)).alias("order"),
            F.col(lang_col).alias("name"), F.col(text_col).alias("text"),
        )
        .mapInPandas(featurize, "order long, name string, bits binary")
        .toPandas()
        .sort_values(["order", "name"], kind="stable")
    )
    rows = np.empty((len(got), buckets), bool)
    for i, b in enumerate(got["bits"]):
        rows[i] = np.unpackbits(np.frombuffer(b, np.uint8))
    return fit_kernel_ridge(rows, list(got["name"]), landmarks, ridge, max_n)


def predict_languages(
    df: DataFrame, model: KernelRidge, text_col: str = "text", batch: int = 64
) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``; the weights travel with the function.

    Their size is buckets x languages, whatever the data.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def predicted():
            for texts in parts:
                names, scores = [], []
                for i in range(0, len(texts), batch):
                    part = [t if isinstance(t, str) else None for t in texts.iloc[i : i + batch]]
                    n, s = model.predict(part)
                    names += n
                    scores += s
                yield pd.DataFrame({"lang_pred": names, "score": scores})

        return handed_back(predicted())

    rest = [F.col(c) for c in df.columns if c not in ("lang_pred", "score")]
    return df.withColumn("_found", predict(F.col(text_col))).select(
        *rest, F.col("_found.lang_pred").alias("lang_pred"), F.col("_found.score").alias("score")
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def op9_language_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_languages(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict_languages(rows, model).select("doc_id", "held_out", "lang_pred", "score")
