"""Toxicity, mixing and language kernels against plain restatements of their methods."""

import collections
import math
import re

import numpy as np
from pyspark.sql import functions as F

from eventmill.llm import langid, mixing, toxicity
from eventmill.llm.common import unit_interval

LONG = " ".join(f"word{i % 900} and{i % 31}." for i in range(12_000))


# -- toxicity ------------------------------------------------------------------------


def test_vectors_count_words_and_beginnings():
    names = ["bad", "badl*", "worse", "wors*", "unseen"]
    model = toxicity.OrdinalModel(names, np.zeros(5), np.zeros(3))
    for text in (None, "", "bad badly BAD, worse worse_x worst", "éé badly-bad", LONG + " bad"):
        words = re.findall(r"\w+", (text or "").lower())
        want = {}
        for i, name in enumerate(names):
            if name.endswith("*"):
                n = sum(w.startswith(name[:-1]) and len(w) > len(name) - 1 for w in words)
            else:
                n = words.count(name)
            if n:
                want[i] = 1.0 + math.log(n)
        assert model.vector(text) == want


def test_the_fit_is_a_minimum_of_its_loss():
    """At a minimum no weight, zero or not, and no threshold can be moved to a lower loss."""
    rng = np.random.default_rng(7)
    x = np.where(rng.random((300, 12)) < 0.3, 1 + rng.random((300, 12)), 0.0)
    eta = x @ np.r_[2.0, -1.5, 1.0, np.zeros(9)] + rng.logistic(size=300)
    grades = np.searchsorted([0.5, 2.0, 3.5], eta).astype(int)
    vectors = [{i: float(v) for i, v in enumerate(row) if v} for row in x]
    names = [f"f{i}" for i in range(12)]
    lasso, ridge = 0.01, 1e-3
    model = toxicity.fit_ordinal(vectors, grades, names, 3, lasso, ridge)
    w = np.zeros(12)
    for name, value in zip(model.names, model.weights, strict=True):
        w[names.index(name)] = value
    assert 3 <= np.count_nonzero(w) < 12
    assert (np.diff(model.thresholds) > 0).all()

    def loss(w, t):
        p = toxicity.sigmoid((x @ w)[:, None] - t)
        upper = np.c_[np.ones(300), p, np.zeros(300)]
        chance = upper[np.arange(300), grades] - upper[np.arange(300), grades + 1]
        return -np.log(chance).mean() + lasso * np.abs(w).sum() + ridge / 2 * (w**2).sum()

    best = loss(w, model.thresholds)
    for size in (1e-2, 1e-1):
        for i in range(12):
            for sign in (size, -size):
                assert loss(w + sign * np.eye(12)[i], model.thresholds) > best
        for k in range(3):
            for sign in (size, -size):
                assert loss(w, model.thresholds + sign * np.eye(3)[k]) > best


def test_severity_and_verdict_equal_the_formula(spark):
    model = toxicity.OrdinalModel(
        ["bad", "awfu*", "kind"], np.array([1.5, 2.0, -1.0]), np.array([1.0, 2.5, 4.0])
    )
    texts = [None, "", "bad", "bad bad awful", "kind words", "awful awfully bad kind", LONG + " bad",
             "bad"]
    rows = [(i, t, "kept") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, severity string")
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, model).collect()}
    for i, text in enumerate(texts):
        eta = sum(model.weights[j] * v for j, v in model.vector(text).items())
        chances = [1 / (1 + math.exp(t - eta)) for t in model.thresholds]
        assert math.isclose(got[i].severity, sum(chances), rel_tol=1e-9)
        assert got[i].toxic_pred == (chances[0] >= 0.5)
    assert got[2].severity == got[7].severity


# -- mixing --------------------------------------------------------------------------


def dealt_by_hand(rows, found, blocks):
    """Uses (doc_id, epoch): blocks in the epoch's permutation, until the due tokens are met."""
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r.key].append(r)
    out, weights = set(), {}
    for key, own in by_source.items():
        whole = sum(r.n for r in own)
        weights[key] = (whole / found.tokens) ** found.exponent / found.normaliser
        turns = round(weights[key] * found.budget / whole, 6)
        for epoch in range(math.ceil(turns)):
            due, spent = min(1.0, turns - epoch) * whole, 0
            for r in sorted(own, key=lambda r: (r.turns[epoch], r.block, r.place)):
                if spent < due - 1e-6 * whole / blocks:
                    out.add((r.doc_id, epoch))
                spent += r.n
    return out, weights


def test_budget_blocks_and_cut_equal_brute_force(spark):
    blocks, epochs = 8, 12
    rows = [(i, None if i % 97 == 0 else "a" if i < 700 else "b" if i < 900 else "c",
             "w " * (3 + i * i % 11)) for i in range(1_000)]
    rows += [(2_000, "c", None), (2_001, "c", ""), (2_002, "a", LONG)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    hashed = df.select(
        "doc_id", key.alias("key"), "text",
        F.pmod(F.xxhash64(F.lit("block"), F.col("doc_id").cast("string"), key), F.lit(blocks))
        .cast("int").alias("block"),
        unit_interval(F.lit("place"), F.col("doc_id").cast("string"), key).alias("place"),
    ).select(
        "*", F.array(*(F.xxhash64(F.lit("turn"), "key", "block", F.lit(e)) for e in range(epochs)))
        .alias("turns"),
    ).collect()
    Row = collections.namedtuple("Row", "doc_id key n block place turns")
    plain = [Row(r.doc_id, r.key, len((r.text or "").split()) + 1, r.block, r.place, r.turns)
             for r in hashed]
    totals = collections.Counter()
    for r in plain:
        totals[r.key] += r.n
    sources = spark.createDataFrame(list(totals.items()), "_key string, tokens long")
    for entropy, repetitions, budget in ((0.9, 3.0, None), (0.99, 9.0, None), (0.5, 9.0, 4_321.0)):
        found = mixing.find_temperature(sources, entropy, repetitions, budget)
        want, weights = dealt_by_hand(plain, found, blocks)
        got = mixing.mix(df, entropy=entropy, repetitions=repetitions, budget=budget, blocks=blocks)
        got = got.collect()
        assert len(got) == len(want) and {(r.doc_id, r.epoch) for r in got} == want
        sizes = {r.doc_id: (r.n, weights[r.key]) for r in plain}
        for r in got:
            assert r.mix_tokens == sizes[r.doc_id][0]
            assert math.isclose(r.weight, sizes[r.doc_id][1], rel_tol=1e-9)
            assert 0 <= r.mix_order <= 1 + 1e-6
        if budget is None:
            assert {r.doc_id for r in got} == {r.doc_id for r in plain}


# -- language kernels ----------------------------------------------------------------


def test_presence_does_not_depend_on_the_chunks(monkeypatch):
    texts = ["", "a", "abc", "Straße naïve", LONG[:5_000]]
    whole = [langid.presence(t, 1 << 10, 4) for t in texts]
    for chunk in (1, 3, 64):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        for t, want in zip(texts, whole, strict=True):
            assert (langid.presence(t, 1 << 10, 4) == want).all()


def test_scores_equal_the_kernel_ridge_regression():
    """Features k(x, Z) K(Z, Z)^(-1/2) from sets; weighted ridge with a free offset by least squares."""
    rng = np.random.default_rng(5)
    rows = rng.random((90, 256)) < np.where(np.arange(90) % 3 == 0, 0.15, 0.3)[:, None]
    rows[::3, :40] |= rng.random((30, 40)) < 0.5
    rows[1::3, 40:80] |= rng.random((30, 40)) < 0.6
    names = [("x", "y", "z")[i % 3] for i in range(84)] + ["x"] * 6
    landmarks, ridge = 12, 1e-2
    model = langid.fit_kernel_ridge(rows, names, landmarks, ridge, 3)
    sets = [set(np.flatnonzero(r)) for r in rows]

    def k(a, b):
        return len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))

    # Landmarks: the first of each language, the second of each, and so on.
    seen, ranked = collections.Counter(), []
    for i, name in enumerate(names):
        ranked.append((seen[name], name, i))
        seen[name] += 1
    marks = [sets[i] for _, _, i in sorted(ranked)[:landmarks]]
    values, vectors = np.linalg.eigh([[k(a, b) for b in marks] for a in marks])
    root = vectors @ np.diag(values**-0.5) @ vectors.T
    features = np.array([[k(a, b) for b in marks] for a in sets]) @ root
    weight = np.array([1 / seen[n] for n in names])
    mean = weight @ features / weight.sum()
    spread = ((features - mean) * weight[:, None]).T @ (features - mean) / 3
    penalty = ridge * np.trace(spread) / landmarks + 1e-12
    left = np.sqrt(weight / 3)[:, None] * np.c_[features, np.ones(90)]
    left = np.r_[left, np.c_[math.sqrt(penalty) * np.eye(landmarks), np.zeros(landmarks)]]
    for at, language in enumerate(("x", "y", "z")):
        signs = np.where(np.array(names) == language, 1.0, -1.0)
        right = np.r_[np.sqrt(weight / 3) * signs, np.zeros(landmarks)]
        solved = np.linalg.lstsq(left, right, rcond=None)[0]
        want = np.c_[features, np.ones(90)] @ solved
        assert np.allclose(model.scores(rows)[:, at], want, atol=2e-4)


def test_kernel_takes_few_rows_wide():
    import tracemalloc

    from eventmill.llm import langid

    a = np.random.default_rng(1).random((1500, 8192)) < 0.1
    b = a[:64]
    wide = (a.astype(float) @ b.astype(float).T) / np.sqrt(np.outer(a.sum(1), b.sum(1)))
    tracemalloc.start()
    got = langid.kernel(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == wide).all() and peak < 40 << 20
