"""Registered searches and feature sizes are those of the reference."""

import collections
import math
import threading

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from eventmill.functions.scalar import normalize_tokens
from eventmill.ml import features, models, recommend
from eventmill.plans import models as plans

QUERIES = entry_module.queries()


def settings(grid):
    found = {}
    for point in grid:
        for param, value in point.items():
            found.setdefault(param.name, set()).add(value)
    return found


def test_tree_grid_is_whole(spark, sf_dir, monkeypatch):
    class Stop(Exception):
        pass

    def caught(tree, grid, *_):
        assert len(grid) == 36
        assert settings(grid) == {"impurity": {"gini", "entropy"}, "maxDepth": {10, 20, 30},
                                  "maxBins": {16, 32, 64}, "minInfoGain": {0.01, 0.05}}
        raise Stop

    monkeypatch.setattr(models, "split_validated", caught)
    try:
        QUERIES["tune_train_validation"](spark, sf_dir)
    except Stop:
        return
    raise AssertionError("the search has not been called")


def test_als_grid_is_whole(spark, sf_dir):
    found = {(r["rank"], r["lambda"]): r.rmse for r in QUERIES["rec_als_grid"](spark, sf_dir).collect()}
    assert set(found) == {(k, x) for k in (5, 10, 20, 30, 50, 100) for x in (0.01, 0.1, 1.0)}
    assert recommend.als_grid.__defaults__ == (5,)


def test_hashed_weights_are_those_of_the_slots(spark, sf_dir):
    hashing = HashingTF(inputCol="tokens", outputCol="v", numFeatures=100_000)
    counted = {r.doc_id: r.v for r in hashing.transform(plans.documents(spark, sf_dir)).collect()}
    df = collections.Counter(int(s) for v in counted.values() for s in v.indices)
    idf = {s: math.log((len(counted) + 1) / (n + 1)) for s, n in df.items()}
    got = {r.doc_id: r.weight for r in QUERIES["feat_tokenize_hash_idf"](spark, sf_dir).collect()}
    assert set(got) == set(counted)
    for k, v in counted.items():
        want = sum(n * idf[int(s)] for s, n in zip(v.indices, v.values, strict=True))
        assert math.isclose(got[k], want, abs_tol=1e-3)


@pytest.fixture
def observed(spark):
    """A session that has served an Observation cannot be serialised any more."""
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).count()
    assert seen.get["n"] == 3
    return spark


@pytest.mark.parametrize("name", ["clf_logistic", "clf_svm", "clf_random_forest", "reg_ridge",
                                  "clu_kmeans", "tune_pipeline", "tune_cross_validate"])
def test_models_score_after_an_observation(observed, sf_dir, name):
    assert QUERIES[name](observed, sf_dir).count() > 0


def test_fitted_models_refer_to_no_session(observed, sf_dir):
    train = plans.binary_vectors(observed, sf_dir)[0]
    out = observed._jvm.java.io.ByteArrayOutputStream()
    for name in ("logistic", "svm", "random_forest"):
        model = models.CLASSIFIERS[name]().fit(train)
        assert not model.hasSummary
        observed._jvm.java.io.ObjectOutputStream(out).writeObject(model._java_obj)


def test_coded_ratings_are_worked_out_once(spark, sf_dir):
    """Fits and predictions read stored rows; a pair's prediction needs no further join."""
    known = recommend.coded(plans.ratings(spark, sf_dir))
    plan = known.rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    judged = QUERIES["rec_als_pairs"](spark, sf_dir)
    assert "Join" not in judged._jdf.queryExecution().executedPlan().toString()
    assert judged.columns == ["user", "item", "prediction", "rating", "rmse"]


def test_grid_scores_every_point(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(9)]
    known = recommend.coded(spark.createDataFrame(rows, "user long, item long, rating float"))
    got = recommend.als_grid(known.rows, [2, 3], [0.1, 1.0], 2)
    assert [r[:2] for r in got] == [(2.0, 0.1), (2.0, 1.0), (3.0, 0.1), (3.0, 1.0)]
    assert all(score > 0 for *_, score in got)


def test_folds_hold_vectors_not_texts(spark, sf_dir, monkeypatch):
    held, validated = [], models.cross_validated

    def seen(estimator, grid, evaluator, train, folds=3):
        held.extend(train.columns)
        return validated(estimator, grid, evaluator, train, folds)

    monkeypatch.setattr(models, "cross_validated", seen)
    got = QUERIES["tune_cross_validate"](spark, sf_dir).collect()
    assert held == ["doc_id", "label", "hashed_10", "hashed_100", "hashed_1000"]
    assert [(r.features, r.regularisation) for r in got] == [
        (n, x) for n in (10.0, 100.0, 1000.0) for x in (0.1, 0.01)
    ]


def test_sketch_is_not_kept_for_every_user(spark, sf_dir):
    plan = QUERIES["agg_approx_distinct"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    by_user = [x for x in plan.splitlines() if "keys=[" in x and "user_id" in x.split("]")[0]]
    assert by_user and not [x for x in by_user if "approx_count_distinct" in x]


def test_words_are_counted_before_they_are_grouped(spark):
    rows = [(["b", "a", "a"],), (["", "é"],), ([],), (None,)] * 500
    counts = features.word_counts(spark.createDataFrame(rows, "tokens array<string>"), "tokens")
    assert dict(map(tuple, counts.collect())) == {"a": 1000, "b": 500, "": 500, "é": 500}
    grouped = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in grouped


def test_common_word_is_found_without_a_row_for_every_word(spark, tmp_path, monkeypatch):
    rows = [(n, "b a. a, a B c") for n in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    counted, count = [], features.word_counts

    def seen(df, tokens):
        counted.append(count(df, tokens))
        return counted[-1]

    monkeypatch.setattr(features, "word_counts", seen)
    got = QUERIES["feat_word2vec_synonyms"](spark, str(tmp_path)).collect()
    assert dict(map(tuple, counted[0].collect())) == {"a": 60, "b": 40, "c": 20}
    assert {r.word for r in got} == {"b", "c"}


def test_words_are_those_of_the_characters(spark):
    texts = ["", " ", ".,", "A.b,C", " x\t\ty\n\x0bz\x0c\r", "a\u00a0b\u2003c", "É, ß. İ", "..a,,b",
             None]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string")
    plain = F.array_remove(F.split(F.translate(F.lower("text"), ",.", ""), r"\s+"), "")
    words = rows.select("n", normalize_tokens("text").alias("got"), plain.alias("want"))
    assert not words.filter(~F.col("got").eqNullSafe(F.col("want"))).collect()
    assert words.filter("n = 4").first()["got"] == ["x", "y", "z"]
    mended = rows.select(normalize_tokens("text"))._jdf.queryExecution().analyzed().toString()
    assert "translate" not in mended


def test_fit_drops_the_exchange_of_past_iterations(spark):
    """Eight iterations exchange factors sixteen times; few of these are kept."""
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(9)]
    known = recommend.coded(spark.createDataFrame(rows, "user long, item long, rating float"))
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = shuffles.size()
    model = recommend.fitted(recommend.als(rank=2, iterations=8), known.rows)
    assert shuffles.size() - before <= 10 and model.rank == 2


def test_shares_bound_what_runs_together():
    share, running, seen, lock = recommend.Share(10), [0], [], threading.Lock()

    def work(weight):
        with share.of(weight):
            with lock:
                running[0] += min(weight, 10)
                seen.append(running[0])
            threading.Event().wait(0.02)
            with lock:
                running[0] -= min(weight, 10)

    threads = [threading.Thread(target=work, args=(w,)) for w in (10, 5, 5, 3, 2, 20, 10, 5, 4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(10)
    assert len(seen) == len(threads) and max(seen) == 10


def test_blocks_of_a_fit_are_bounded(spark, monkeypatch):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(20) for i in range(9)]
    known = recommend.coded(spark.createDataFrame(rows, "user long, item long, rating float"))
    seen = []
    fit = recommend.ALS.fit

    def noted(self, dataset, params=None):
        seen.append({param.name: value for param, value in params.items()})
        return fit(self, dataset, params)

    monkeypatch.setattr(recommend.ALS, "fit", noted)
    few = recommend.fitted(recommend.als(rank=2), known.rows)
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 15)
    many = recommend.fitted(recommend.als(rank=2), known.rows)
    assert seen == [{}, {"numUserBlocks": 12, "numItemBlocks": 12}]
    assert few.userFactors.count() == many.userFactors.count() == 20
    assert many.transform(known.rows).count() == len(rows)
