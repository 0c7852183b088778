"""Machine-learning jobs on whole tables.

Models have no SQL twin; feature steps, metrics and pair patterns do.
"""

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from eventmill.ml import evaluate, features, forest, models, recommend
from eventmill.ml import patterns as fpm
from eventmill.operators.rows import hash_split
from eventmill.plans.registry import query
from eventmill.session import stored, work_dir
from eventmill.sources.tables import table

# -- features ------------------------------------------------------------------------


@query(
    "feat_index_categories",
    "SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS segment FROM customer",
)
def feat_index_categories(spark, sf_dir):
    indexed = features.index_categories(table(spark, sf_dir, "customer"), "c_mktsegment", "i")
    return indexed.select("c_custkey", F.col("i").cast("bigint").alias("segment"))


@query(
    "feat_one_hot",
    "SELECT c_custkey, "
    + ", ".join(f"CASE WHEN i = {n} THEN 1.0::DOUBLE ELSE 0.0 END AS hot_{n}" for n in range(5))
    + " FROM (SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS i FROM customer)",
)
def feat_one_hot(spark, sf_dir):
    indexed = features.index_categories(table(spark, sf_dir, "customer"), "c_mktsegment", "i")
    hot = features.one_hot(indexed, "i", "v").withColumn("a", vector_to_array("v"))
    return hot.select("c_custkey", *[F.col("a")[n].alias(f"hot_{n}") for n in range(5)])


TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "feat_unone_hot",
    "SELECT p_partkey, CASE p_type "
    + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TYPES))
    + " END::BIGINT AS category FROM part",
)
def feat_unone_hot(spark, sf_dir):
    flags = [F.when(F.col("p_type") == t, 1).otherwise(0).alias(f"is_{t}") for t in TYPES]
    wide = table(spark, sf_dir, "part").select("p_partkey", *flags)
    category = features.from_one_hot([f"is_{t}" for t in TYPES])
    return wide.select("p_partkey", category.cast("bigint").alias("category"))


@query(
    "feat_mean_impute",
    "SELECT c_custkey, round(coalesce(CASE WHEN c_nationkey % 5 <> 0 THEN c_acctbal END, "
    "(SELECT avg(c_acctbal) FROM customer WHERE c_nationkey % 5 <> 0)), 4) AS balance "
    "FROM customer",
)
def feat_mean_impute(spark, sf_dir):
    gaps = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_acctbal")).alias("raw")
    )
    filled = features.mean_impute(gaps, "raw", "filled")
    return filled.select("c_custkey", F.round("filled", 4).alias("balance"))


@query(
    "feat_bucket_age",
    "SELECT p_partkey, CASE WHEN p_size * 2 >= 61 THEN 'old' WHEN p_size * 2 >= 26 THEN 'middle' "
    "WHEN p_size * 2 >= 16 THEN 'young' ELSE 'child' END AS age_group FROM part",
)
def feat_bucket_age(spark, sf_dir):
    aged = table(spark, sf_dir, "part").withColumn("age", F.col("p_size") * 2)
    return aged.select("p_partkey", features.age_group("age").alias("age_group"))


LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query(
    "feat_assemble",
    "SELECT l_orderkey, l_partkey, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
)
def feat_assemble(spark, sf_dir):
    assembled = features.assemble(table(spark, sf_dir, "lineitem"), LINE_FEATURES)
    values = assembled.withColumn("a", vector_to_array("features"))
    return values.select(
        "l_orderkey", "l_partkey", *[F.col("a")[i].alias(f"f{i}") for i in range(3)]
    )


@query(
    "feat_vector_index",
    "SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS nation, c_acctbal AS balance FROM customer",
)
def feat_vector_index(spark, sf_dir):
    """The nation becomes a category (its numbers run from zero), the balance stays."""
    customers = features.assemble(
        table(spark, sf_dir, "customer"), ["c_nationkey", "c_acctbal"], "raw"
    )
    indexed = features.index_vector(customers, "raw", "features").withColumn(
        "a", vector_to_array("features")
    )
    return indexed.select(
        "c_custkey", F.col("a")[0].alias("nation"), F.col("a")[1].alias("balance")
    )


def documents(spark, sf_dir):
    return features.tokenized(table(spark, sf_dir, "documents"), "text")


@query("feat_tokenize_hash_idf")
def feat_tokenize_hash_idf(spark, sf_dir):
    weighted = features.hashed_idf(documents(spark, sf_dir), "tokens")
    return weighted.select(
        "doc_id", F.round(features.summed_values("features"), 4).alias("weight")
    )


@query(
    "feat_term_idf",
    "WITH t AS (SELECT DISTINCT doc_id, w AS term FROM (SELECT doc_id, unnest("
    "regexp_split_to_array(translate(lower(text), ',.', ''), '\\s+')) AS w FROM documents) "
    "WHERE w <> '') SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM documents) + 1.0) "
    "/ (count(*) + 1.0)), 6) AS idf FROM t GROUP BY term",
)
def feat_term_idf(spark, sf_dir):
    weights = features.term_weights(documents(spark, sf_dir), "doc_id", "tokens")
    return weights.select("term", "df", F.round("idf", 6).alias("idf"))


@query("feat_word2vec_synonyms")
def feat_word2vec_synonyms(spark, sf_dir):
    """Ten nearest words of the most frequent word."""
    texts = documents(spark, sf_dir).select("tokens")
    model = features.word_vectors(texts, "tokens")
    counts = features.word_counts(texts, "tokens")
    common = counts.orderBy(F.desc("count"), "w").first()["w"]
    return model.findSynonyms(common, 10)


# -- classification ------------------------------------------------------------------


def vectors(spark, sf_dir):
    """Embeddings with their class, as train and test part."""
    rows = features.array_features(table(spark, sf_dir, "embeddings"), "embedding").select(
        "vec_id", "features", F.col("label").cast("double").alias("label")
    )
    return hash_split(rows, ["vec_id"], [0.8, 0.2], 42)


def binary_vectors(spark, sf_dir):
    return [
        part.withColumn("label", (F.col("label") >= 5).cast("double"))
        for part in vectors(spark, sf_dir)
    ]


def predicted(estimator, parts, params=None):
    train, test = parts
    return evaluate.confusion(
        models.fit_predict(estimator, train, test, params), "label", "prediction"
    )


def scored_by_forest(spark, sf_dir):
    train, test = vectors(spark, sf_dir)
    return forest.fit_predict(models.CLASSIFIERS["random_forest"](), train, test)


@query("clf_naive_bayes")
def clf_naive_bayes(spark, sf_dir):
    """Language of a text from its weighted terms."""
    weighted = features.hashed_idf(documents(spark, sf_dir), "tokens")
    rows = features.index_categories(weighted, "lang", "label").select(
        "doc_id", "features", "label"
    )
    return predicted(
        models.CLASSIFIERS["naive_bayes"](), hash_split(rows, ["doc_id"], [0.8, 0.2], 42)
    )


@query("clf_decision_tree")
def clf_decision_tree(spark, sf_dir):
    return predicted(models.CLASSIFIERS["decision_tree"](), vectors(spark, sf_dir))


@query("clf_random_forest")
def clf_random_forest(spark, sf_dir):
    return evaluate.confusion(scored_by_forest(spark, sf_dir), "label", "prediction")


@query("clf_gbt")
def clf_gbt(spark, sf_dir):
    return predicted(models.CLASSIFIERS["gbt"](), binary_vectors(spark, sf_dir))


@query("clf_svm")
def clf_svm(spark, sf_dir):
    return predicted(models.CLASSIFIERS["svm"](), binary_vectors(spark, sf_dir))


@query("clf_logistic")
def clf_logistic(spark, sf_dir):
    """With one setting overridden at training time."""
    logistic = models.CLASSIFIERS["logistic"]()
    return predicted(logistic, binary_vectors(spark, sf_dir), {logistic.maxIter: 30})


@query("clf_probability")
def clf_probability(spark, sf_dir):
    """Chance of each class for every test row, beside the predicted one."""
    return scored_by_forest(spark, sf_dir).select(
        "vec_id", "label", "prediction", vector_to_array("probability").alias("probability")
    )


@query("clf_importances")
def clf_importances(spark, sf_dir):
    """How much each named column of a line decides its return flag in a forest."""
    lines = features.index_categories(table(spark, sf_dir, "lineitem"), "l_returnflag", "label")
    rows = features.assemble(lines, [*LINE_FEATURES, "l_extendedprice"]).select("features", "label")
    model = models.Forest(numTrees=10, maxDepth=5, seed=42).fit(rows)
    return models.importances(model, rows)


# -- regression ----------------------------------------------------------------------


def priced_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    for column in ("l_returnflag", "l_linestatus"):
        lines = features.index_categories(lines, column, f"{column}_i")
    assembled = features.assemble(
        lines, [*LINE_FEATURES, "l_returnflag_i", "l_linestatus_i"], "raw"
    ).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "raw",
        F.col("l_extendedprice").alias("label"),
    )
    indexed = features.index_vector(assembled, "raw", "features", 8)
    return hash_split(indexed, ["l_orderkey", "l_linenumber"], [0.9, 0.1], 42)


def regression(name):
    def run(spark, sf_dir):
        train, test = priced_lines(spark, sf_dir)
        scored = models.fit_predict(models.REGRESSORS[name](), train, test)
        return evaluate.regression_metrics(scored, "label", "prediction")

    return run


query("reg_decision_tree")(regression("decision_tree"))
query("reg_random_forest")(regression("random_forest"))
query("reg_linear")(regression("linear"))
query("reg_lasso")(regression("lasso"))
query("reg_ridge")(regression("ridge"))


@query(
    "reg_linear_slope",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, "
    "round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem",
)
def reg_linear_slope(spark, sf_dir):
    """Least squares on one feature over the whole table, by the normal equations."""
    lines = features.assemble(table(spark, sf_dir, "lineitem"), ["l_quantity"]).select(
        "features", F.col("l_extendedprice").cast("double").alias("label")
    )
    model = models.Linear(solver="normal").fit(lines)
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 3), round(float(model.intercept), 2))],
        "slope double, intercept double",
    )


# -- clustering ----------------------------------------------------------------------


@query("clu_kmeans")
def clu_kmeans(spark, sf_dir):
    rows = features.array_features(table(spark, sf_dir, "embeddings"), "embedding")
    assigned = models.kmeans(rows.select("vec_id", "features")).transform(rows)
    return assigned.select("vec_id", F.col("prediction").cast("bigint").alias("cluster"))


@query("clu_kmeans_centres")
def clu_kmeans_centres(spark, sf_dir):
    rows = features.array_features(table(spark, sf_dir, "embeddings"), "embedding").select(
        "vec_id", "features"
    )
    return models.centres(models.kmeans(rows), rows)


@query("clu_kmeans_nearest", "SELECT vec_id, true AS nearest FROM embeddings")
def clu_kmeans_nearest(spark, sf_dir):
    """Every row lies with the centre that is nearest to it, by its own distances."""
    rows = features.array_features(table(spark, sf_dir, "embeddings"), "embedding")
    model = models.kmeans(rows.select("vec_id", "features"))

    def distance(centre):
        squares = F.zip_with(
            F.col("embedding").cast("array<double>"),
            F.array(*[F.lit(float(c)) for c in centre]),
            lambda x, c: (x - c) * (x - c),
        )
        return F.aggregate(squares, F.lit(0.0), lambda a, s: a + s)

    distances = F.array(*[distance(c) for c in model.clusterCenters()])
    assigned = model.transform(rows).withColumn("_d", distances)
    nearest = F.get("_d", F.col("prediction")) <= F.array_min("_d") + 1e-9
    return assigned.select("vec_id", nearest.alias("nearest"))


CENTRES = ((0.0, 0.0), (25.0, 6.0), (50.0, 12.0), (75.0, 18.0))


@query(
    "clu_assign_centres",
    "SELECT c_custkey, arg_min(n, (d, n)) AS cluster FROM (SELECT c_custkey, n, "
    "power(c_acctbal / 100 - x, 2) + power(c_nationkey - y, 2) AS d FROM customer, (VALUES "
    + ", ".join(f"({i}::BIGINT, {x}::DOUBLE, {y}::DOUBLE)" for i, (x, y) in enumerate(CENTRES))
    + ") c(n, x, y)) GROUP BY c_custkey",
)
def clu_assign_centres(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 100).alias("x"),
        F.col("c_nationkey").cast("double").alias("y"),
    )
    assigned = models.nearest_centre(points, ["x", "y"], CENTRES, "cluster")
    return assigned.select("c_custkey", F.col("cluster").cast("bigint"))


# -- recommendation ------------------------------------------------------------------


def ratings(spark, sf_dir):
    """Mean quantity of a part bought by a customer, as its rating."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    bought = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return bought.groupBy(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")
    ).agg(F.avg("l_quantity").cast("float").alias("rating"))


def busiest(df, key, n=5):
    """Keys to recommend for: the n with most ratings."""
    return df.groupBy(key).count().orderBy(F.desc("count"), key).limit(n).select(key)


def als_scored(spark, sf_dir, implicit=False):
    known = recommend.coded(ratings(spark, sf_dir))
    train, test = hash_split(known.rows, ["user", "item"], [0.9, 0.1], 42)
    return recommend.fitted(recommend.als(implicit), train).transform(test)


@query("rec_als_explicit")
def rec_als_explicit(spark, sf_dir):
    return evaluate.regression_metrics(als_scored(spark, sf_dir), "rating", "prediction")


@query("rec_als_implicit")
def rec_als_implicit(spark, sf_dir):
    return als_scored(spark, sf_dir, implicit=True).select("user", "item", "prediction")


@query("rec_als_factors")
def rec_als_factors(spark, sf_dir):
    known = recommend.coded(ratings(spark, sf_dir))
    return recommend.factors(recommend.fitted(recommend.als(), known.rows), known)


@query("rec_top_items")
def rec_top_items(spark, sf_dir):
    known = recommend.coded(ratings(spark, sf_dir))
    return recommend.top_items(recommend.fitted(recommend.als(), known.rows), known, busiest(known.rows, "user"))


@query("rec_top_users")
def rec_top_users(spark, sf_dir):
    known = recommend.coded(ratings(spark, sf_dir))
    return recommend.top_users(recommend.fitted(recommend.als(), known.rows), known, busiest(known.rows, "item"))


@query("rec_als_grid")
def rec_als_grid(spark, sf_dir):
    rows = recommend.als_grid(
        recommend.coded(ratings(spark, sf_dir)).rows, [5, 10, 20, 30, 50, 100], [0.01, 0.1, 1.0]
    )
    return spark.createDataFrame(rows, "rank double, lambda double, rmse double")


# -- patterns ------------------------------------------------------------------------


def type_baskets(spark, sf_dir):
    """Part types of an order; there are six of them."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    bought = lines.join(parts, lines.l_partkey == parts.p_partkey)
    return fpm.baskets(bought, "l_orderkey", "p_type")


BASKET_SQL = (
    "WITH b AS (SELECT DISTINCT l_orderkey AS o, p_type AS i FROM lineitem JOIN part ON "
    "l_partkey = p_partkey), n AS (SELECT ceil(0.1 * count(DISTINCT o)) AS least FROM b), "
    "one AS (SELECT i, count(*) AS freq FROM b GROUP BY i), "
    "two AS (SELECT x.i AS a, y.i AS c, count(*) AS freq FROM b x JOIN b y ON x.o = y.o AND "
    "x.i < y.i GROUP BY 1, 2), "
    "pair AS (SELECT a, c, freq FROM two UNION ALL SELECT c, a, freq FROM two), "
    "rules AS (SELECT a AS antecedent, c AS consequent, round(p.freq / one.freq, 6) AS confidence "
    "FROM pair p JOIN one ON one.i = p.a WHERE p.freq >= (SELECT least FROM n) AND "
    "p.freq / one.freq >= 0.3) "
)


@query(
    "fpm_itemsets",
    BASKET_SQL + "SELECT items, size, freq FROM (SELECT i AS items, 1::BIGINT AS size, freq FROM one "
    "UNION ALL SELECT concat(a, ',', c), 2, freq FROM two UNION ALL SELECT concat(x.i, ',', y.i, "
    "',', z.i), 3, count(*) FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON z.o = y.o "
    "AND y.i < z.i GROUP BY 1, 2) WHERE freq >= (SELECT least FROM n)",
)
def fpm_itemsets(spark, sf_dir):
    return fpm.itemsets(fpm.mine(type_baskets(spark, sf_dir), 0.1, 0.3), 1, 3)


# Rules from sets of two and of three items; six types at this support have no larger sets.
ALL_RULES_SQL = BASKET_SQL + (
    ", three AS (SELECT x.i AS a, y.i AS c, z.i AS e, count(*) AS freq FROM b x JOIN b y ON "
    "x.o = y.o AND x.i < y.i JOIN b z ON z.o = y.o AND y.i < z.i GROUP BY 1, 2, 3 "
    "HAVING count(*) >= (SELECT least FROM n)), "
    "turned AS (SELECT a, c, e, freq FROM three UNION ALL SELECT a, e, c, freq FROM three "
    "UNION ALL SELECT c, e, a, freq FROM three) "
    "SELECT antecedent, 1::BIGINT AS size, consequent, confidence FROM rules UNION ALL "
    "SELECT concat(t.a, ',', t.c), 2, t.e, round(t.freq / two.freq, 6) FROM turned t JOIN two "
    "ON two.a = t.a AND two.c = t.c WHERE t.freq / two.freq >= 0.3"
)


@query("fpm_rules", ALL_RULES_SQL)
def fpm_rules(spark, sf_dir):
    found = fpm.rules(fpm.mine(type_baskets(spark, sf_dir), 0.1, 0.3))
    return found.withColumn("confidence", F.round("confidence", 6))


@query("fpm_pair_rules", BASKET_SQL + "SELECT antecedent, consequent, confidence FROM rules")
def fpm_pair_rules(spark, sf_dir):
    pairs = fpm.rules(fpm.mine(type_baskets(spark, sf_dir), 0.1, 0.3)).filter("size = 1")
    return pairs.select("antecedent", "consequent", F.round("confidence", 6).alias("confidence"))


@query(
    "fpm_recommend",
    BASKET_SQL + "SELECT antecedent, consequent, rank_no FROM (SELECT *, row_number() OVER "
    "(PARTITION BY antecedent ORDER BY confidence DESC, consequent) AS rank_no FROM rules) "
    "WHERE rank_no <= 5",
)
def fpm_recommend(spark, sf_dir):
    best = fpm.also_bought(fpm.mine(type_baskets(spark, sf_dir), 0.1, 0.3), 5)
    return best.select("antecedent", "consequent", "rank_no")


@query("fpm_prefixspan")
def fpm_prefixspan(spark, sf_dir):
    """Event-type sequences of user days, one item set per hour."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), "event_type"
    )
    found = fpm.prefix_span(
        fpm.sequences(events, ["user_id", "day"], "hour", "event_type"), 0.05, 5
    )
    text = F.array_join(
        F.transform("sequence", lambda s: F.concat(F.lit("("), F.array_join(s, "|"), F.lit(")"))),
        ",",
    )
    return fpm.recommended_sequences(found, 3).select(text.alias("sequence"), "freq")


# -- evaluation ----------------------------------------------------------------------


@query(
    "eval_regression",
    "SELECT round(sqrt(avg(power(y - p, 2))), 2) AS rmse, round(avg(power(y - p, 2)) / 1e6, 4) AS "
    "mse_millions, round(avg(abs(y - p)), 2) AS mae, round(1 - sum(power(y - p, 2)) / "
    "sum(power(y - m, 2)), 6) AS r2, round(avg(power(p - m, 2)) / 1e6, 4) AS explained_millions "
    "FROM (SELECT l_extendedprice AS y, l_quantity * 1500 AS p, avg(l_extendedprice) OVER () AS m "
    "FROM lineitem)",
)
def eval_regression(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p")
    )
    m = evaluate.regression_metrics(scored, "y", "p")
    return m.select(
        F.round("rmse", 2).alias("rmse"), F.round(F.col("mse") / 1e6, 4).alias("mse_millions"),
        F.round("mae", 2).alias("mae"), F.round("r2", 6).alias("r2"),
        F.round(F.col("explained_variance") / 1e6, 4).alias("explained_millions"),
    )


@query(
    "eval_binary_auc",
    "SELECT round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / "
    "(sum(y) * (count(*) - sum(y))), 6) AS auc FROM (SELECT y, rank() OVER (ORDER BY s) + "
    "(count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM (SELECT CASE WHEN event_type IN "
    "('view', 'click') THEN 1.0::DOUBLE ELSE 0.0 END AS y, value AS s FROM events))",
)
def eval_binary_auc(spark, sf_dir):
    scored = table(spark, sf_dir, "events").select(
        F.col("event_type").isin("view", "click").cast("double").alias("y"),
        F.col("value").alias("s"),
    )
    return spark.createDataFrame(
        [(round(evaluate.area_under_roc(scored, "y", "s"), 6),)], "auc double"
    )


LABELLED = (
    "(SELECT quality AS y, toxic AS p FROM labels)"
)


@query(
    "eval_multiclass",
    f"SELECT y::BIGINT AS label, p::BIGINT AS prediction, count(*) AS cnt FROM {LABELLED} GROUP BY 1, 2",
)
def eval_multiclass(spark, sf_dir):
    return evaluate.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


@query(
    "eval_multiclass_scores",
    f"WITH t AS {LABELLED}, c AS (SELECT k, (SELECT count(*) FROM t WHERE y = k) AS a, "
    "(SELECT count(*) FROM t WHERE p = k) AS g, (SELECT count(*) FROM t WHERE y = k AND p = k) "
    "AS h FROM (SELECT DISTINCT y AS k FROM t)) SELECT round(sum(h) / sum(a), 6) AS accuracy, "
    "round(sum(2.0 * h / (a + g) * a) / sum(a), 6) AS weighted_f1 FROM c",
)
def eval_multiclass_scores(spark, sf_dir):
    confused = evaluate.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")
    scores = evaluate.multiclass_metrics(confused)
    return scores.select(
        F.round("accuracy", 6).alias("accuracy"), F.round("weighted_f1", 6).alias("weighted_f1")
    )


# -- pipelines and tuning ------------------------------------------------------------


def labelled_texts(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")


def text_pipeline():
    hashing = HashingTF(inputCol="words", outputCol="features", numFeatures=1000)
    logistic = models.Logistic(maxIter=10, regParam=0.001)
    stages = [Tokenizer(inputCol="text", outputCol="words"), hashing, logistic]
    return Pipeline(stages=stages), hashing, logistic


@query("tune_pipeline")
def tune_pipeline(spark, sf_dir):
    pipeline, _, _ = text_pipeline()
    return predicted(pipeline, hash_split(labelled_texts(spark, sf_dir), ["doc_id"], [0.8, 0.2], 1))


@query("tune_cross_validate")
def tune_cross_validate(spark, sf_dir):
    """Three folds over three feature sizes and two regularisations.

    Words and their three hashed vectors depend on no fold: they are made once and
    written, and the folds hold sparse vectors instead of texts.
    """
    sizes = [10, 100, 1000]
    words = Tokenizer(inputCol="text", outputCol="words").transform(labelled_texts(spark, sf_dir))
    for size in sizes:
        hashing = HashingTF(inputCol="words", outputCol=f"hashed_{size}", numFeatures=size)
        words = hashing.transform(words)
    hashed = stored(words.select("doc_id", "label", *[f"hashed_{s}" for s in sizes]), "hashed")
    logistic = models.Logistic(maxIter=10, regParam=0.001)
    grid = (
        ParamGridBuilder().addGrid(logistic.featuresCol, [f"hashed_{s}" for s in sizes])
        .addGrid(logistic.regParam, [0.1, 0.01]).build()
    )
    fitted = models.cross_validated(
        logistic, grid, MulticlassClassificationEvaluator(metricName="accuracy"), hashed
    )
    rows = [
        (float(point[logistic.featuresCol].split("_")[1]), float(point[logistic.regParam]), float(score))
        for point, score in zip(grid, fitted.avgMetrics)
    ]
    return spark.createDataFrame(rows, "features double, regularisation double, accuracy double")


@query("tune_train_validation")
def tune_train_validation(spark, sf_dir):
    """90 / 10 split over impurity, depth, bins and least gain; the best settings."""
    tree = DecisionTreeClassifier(seed=42)
    grid = (
        ParamGridBuilder().addGrid(tree.impurity, ["gini", "entropy"])
        .addGrid(tree.maxDepth, [10, 20, 30]).addGrid(tree.maxBins, [16, 32, 64])
        .addGrid(tree.minInfoGain, [0.01, 0.05]).build()
    )
    train = vectors(spark, sf_dir)[0].persist()
    fitted = models.split_validated(
        tree, grid, MulticlassClassificationEvaluator(metricName="accuracy"), train
    )
    train.unpersist()
    best = models.best_settings(fitted, fitted.validationMetrics, True)
    return spark.createDataFrame(sorted(best.items()), "setting string, best string")


@query("model_save_load", "SELECT true AS same, count(*) AS cnt FROM embeddings")
def model_save_load(spark, sf_dir):
    """Predictions of a stored and reloaded model for all rows, against the original's."""
    train, held_out = vectors(spark, sf_dir)
    test = train.unionByName(held_out)
    model = models.CLASSIFIERS["decision_tree"]().fit(train)
    loaded = models.save_and_load(model, work_dir(spark, "model"))
    both = model.transform(test).select("vec_id", F.col("prediction").alias("before")).join(
        loaded.transform(test).select("vec_id", F.col("prediction").alias("after")), "vec_id"
    )
    return both.groupBy((F.col("before") == F.col("after")).alias("same")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


@query("rec_als_pairs")
def rec_als_pairs(spark, sf_dir):
    """Predictions joined to the actual ratings they are judged by."""
    rated = recommend.coded(ratings(spark, sf_dir)).rows
    model = recommend.fitted(recommend.als(), rated)
    # A user's rating of an item is one row, so the prediction is made beside it.
    judged = stored(
        model.transform(rated).select("user", "item", "prediction", "rating"), "judged"
    )
    error = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(judged)
    return judged.withColumn("rmse", F.lit(float(error)))
