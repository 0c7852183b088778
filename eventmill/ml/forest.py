"""Deep forests on large tables: top levels by Spark, each subtree where its rows lie.

Spark's forest sums a dense histogram of every node in every partition, but most nodes
of a deep tree hold a few rows. Here it grows only the top levels of each tree; the rows
of a leaf then meet in one group, which is split on to the full depth.
"""

from __future__ import annotations

import math
import re
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.session import stored

#: Up to so many training rows Spark's own forest is used for all levels.
WHOLE_ROWS = 16_384
#: Rows a leaf of the top levels has on average, at most.
LEAF_ROWS = 500
FITS_AT_ONCE = 4
LEAST_GAIN = 1e-12


def fit_predict(forest, train: DataFrame, test: DataFrame, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """``test`` with rawPrediction, probability and prediction of a forest grown on ``train``.

    The forest has the settings of ``forest``: bagged trees, ``sqrt`` features at each
    node, gini, numeric features. Above ``whole_rows`` only its random draws and the places
    of its cuts are others than Spark's, which vary with the partitions as well.
    """
    rows = train.count()
    if rows <= whole_rows or forest.getMaxBins() > 256:
        return forest.fit(train).transform(test)
    depth = min(forest.getMaxDepth(), max(1, math.ceil(math.log2(rows / LEAF_ROWS))))
    train, cuts = _binned_train(forest, train)
    test = stored(test.withColumn("_bins", _bins(cuts)("features")), "forest-test")
    classes = int(train.agg(F.max("label")).first()[0]) + 1

    def top(tree):
        bagged = train.select(
            "features", "label", F.get("_bag", F.lit(tree)).cast("double").alias("_weight")
        )
        one = forest.copy({
            forest.numTrees: 1, forest.maxDepth: depth, forest.bootstrap: False,
            forest.weightCol: "_weight", forest.seed: forest.getSeed() + tree,
            forest.leafCol: f"_leaf_{tree}", forest.predictionCol: "",
            forest.rawPredictionCol: "", forest.probabilityCol: "",
        })
        return one.fit(bagged.filter("_weight > 0"))

    trees = range(forest.getNumTrees())
    with ThreadPool(FITS_AT_ONCE) as pool:
        tops = pool.map(inheritable_thread_target(train.sparkSession)(top), trees)
    known = _by_leaf(train, tops).filter("_weight > 0").groupBy("_tree", "_leaf", "_bins", "label").agg(
        F.sum("_weight").alias("_weight")
    )
    asked = _by_leaf(
        test.select("_bins").distinct()
        .withColumn("features", _vector("_bins")).withColumn("_bag", F.lit(None).cast("array<int>")),
        tops,
    ).select("_tree", "_leaf", "_bins")
    grow = _grower(forest, classes, [_leaf_depths(model) for model in tops])
    votes = known.groupBy("_tree", "_leaf").cogroup(asked.groupBy("_tree", "_leaf")).applyInPandas(
        grow, "_bins binary, _tree int, _votes array<double>"
    )
    # Summed tree by tree, so that equal votes stay equal on every run.
    summed = votes.groupBy("_bins").agg(
        F.sort_array(F.collect_list(F.struct("_tree", "_votes"))).alias("_all")
    ).select("_bins", F.array(*[_votes_for(k) for k in range(classes)]).alias("_raw"))
    share = F.transform("_raw", lambda x: x / F.lit(float(len(tops))))
    best = F.array_position("_raw", F.array_max("_raw")) - 1
    return test.join(summed, "_bins").select(
        *[c for c in test.columns if c != "_bins"], array_to_vector("_raw").alias("rawPrediction"),
        array_to_vector(share).alias("probability"), best.cast("double").alias("prediction"),
    )


def _binned_train(forest, train):
    """Rows as bin numbers, with how often each tree has drawn them; and the bins' cuts."""
    width = len(train.select("features").first()["features"])
    slots = train.select(vector_to_array("features").alias("a")).select(
        *[F.col("a")[i].alias(f"f{i}") for i in range(width)]
    )
    bins = forest.getMaxBins()
    shares = [i / bins for i in range(1, bins)]
    cuts = [
        np.unique(found)
        for found in slots.approxQuantile([f"f{i}" for i in range(width)], shares, 0.001)
    ]
    # Draws with replacement: Poisson counts of mean 1, by the places of even draws.
    below = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
    even = F.array(*[F.rand(forest.getSeed() + tree) for tree in range(forest.getNumTrees())])
    drawn = F.transform(even, lambda u: sum((u >= F.lit(float(c))).cast("int") for c in below))
    binned = train.select(
        _bins(cuts, finite=True)("features").alias("_bins"), "label", drawn.alias("_bag")
    ).withColumn("features", _vector("_bins"))
    return stored(binned, "forest-train"), cuts


def _bins(cuts, finite=False):
    @F.pandas_udf("binary")
    def numbers(arrays: pd.Series) -> pd.Series:
        values = np.stack(arrays.to_numpy())
        if finite and not np.isfinite(values).all():
            raise ValueError("vectors to train on have to be finite")
        columns = [np.searchsorted(c, values[:, i]) for i, c in enumerate(cuts)]
        return pd.Series([row.tobytes() for row in np.stack(columns, axis=1).astype(np.uint8)])

    return lambda column: numbers(vector_to_array(column))


def _vector(column):
    @F.pandas_udf("array<double>")
    def numbers(rows: pd.Series) -> pd.Series:
        return rows.map(lambda row: np.frombuffer(row, np.uint8).astype(float))

    return array_to_vector(numbers(column))


def _by_leaf(rows, tops):
    """Each row once for every tree, with the leaf of the top levels that it falls in."""
    for model in tops:
        rows = model.transform(rows)
    places = [
        F.struct(
            F.lit(tree).alias("_tree"),
            vector_to_array(f"_leaf_{tree}")[0].cast("int").alias("_leaf"),
            F.get("_bag", F.lit(tree)).alias("_weight"),
        )
        for tree in range(len(tops))
    ]
    kept = [c for c in ("_bins", "label") if c in rows.columns]
    return rows.select(*kept, F.explode(F.array(*places)).alias("_at")).select(*kept, "_at.*")


def _votes_for(number):
    return F.aggregate("_all", F.lit(0.0), lambda total, one: total + one["_votes"][number])


def _leaf_depths(model):
    """Depth of each leaf in the order of its number, which is that of the printed tree."""
    lines = re.findall(r"^( *)(?:Predict|If|Else)", model.trees[0].toDebugString, re.M)
    least = min(len(x) for x in lines)
    leaves = re.findall(r"^( *)Predict", model.trees[0].toDebugString, re.M)
    return [len(x) - least for x in leaves]


def _grower(forest, classes, depths):
    bins, limit, seed = forest.getMaxBins(), forest.getMaxDepth(), forest.getSeed()

    def grow(key, known: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        tree, leaf = (int(k) for k in key)
        votes = np.zeros((len(asked), classes))
        if len(asked):
            _split_on(
                _matrix(known["_bins"]), known["label"].to_numpy(np.int64),
                known["_weight"].to_numpy(float), _matrix(asked["_bins"]), votes,
                bins, limit - depths[tree][leaf], np.random.default_rng([seed, tree, leaf]),
            )
        shares = pd.Series(list(votes), asked.index, dtype=object)
        return pd.DataFrame({"_bins": asked["_bins"], "_tree": np.int32(tree), "_votes": shares})

    return grow


def _matrix(rows):
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _split_on(x, label, weight, asked, votes, bins, limit, rng):
    """Grow the subtree of ``x``; fill ``votes`` with the class shares of the leaves of ``asked``.

    A branch that no asked row takes is only grown to see whether it is merged: as in
    Spark, two leaves that predict the same class become one.
    """
    classes, width = votes.shape[1], x.shape[1]
    tried = math.ceil(math.sqrt(width))
    places = np.arange(tried) * bins

    def best_split(rows, totals):
        features = rng.permutation(width)[:tried]
        cells = (places + x[rows[:, None], features]) * classes + label[rows, None]
        found = np.bincount(
            cells.ravel(), np.repeat(weight[rows], tried), tried * bins * classes
        ).reshape(tried, bins, classes)
        left = np.cumsum(found, axis=1)[:, :-1]
        right = totals - left
        n_left, n_right = left.sum(2), right.sum(2)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = (left * left).sum(2) / n_left + (right * right).sum(2) / n_right
        score[(n_left == 0) | (n_right == 0)] = -1
        at = int(score.argmax())
        n = totals.sum()
        if score.flat[at] / n - (totals * totals).sum() / n**2 <= LEAST_GAIN:
            return None
        return features[at // (bins - 1)], at % (bins - 1)

    def grow(rows, takers, left_levels):
        """The class of a leaf, None for a node with different leaves."""
        totals = np.bincount(label[rows], weight[rows], classes)
        split = None
        if left_levels > 0 and np.count_nonzero(totals) > 1:
            split = best_split(rows, totals)
        if split is not None:
            feature, cut = split
            low, asked_low = x[rows, feature] <= cut, asked[takers, feature] <= cut
            children = [(rows[low], takers[asked_low]), (rows[~low], takers[~asked_low])]
            children.sort(key=lambda child: len(child[1]) == 0)
            ends = set()
            for inside, going in children:
                if len(going) or None not in ends:
                    ends.add(grow(inside, going, left_levels - 1))
            if None in ends or len(ends) > 1:
                return None
        votes[takers] = totals / totals.sum()
        return int(totals.argmax())

    grow(np.arange(len(x)), np.arange(len(asked)), limit)
