"""Feature steps, training, search, scoring and learning loops (L4-L26)."""

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from brightledger.operators import models as m
from brightledger.operators import selection as sel
from brightledger.operators import text as tx
from brightledger.operators import tuning
from brightledger.operators import word_space as ws
from brightledger.operators.evaluation import classification_summary
from brightledger.operators.principal import principal_components
from brightledger.operators.retrieval import mean_word_vectors
from brightledger.plans.registry import query
from brightledger.plans.view_sql import GAPS, WORDS, with_views
from brightledger.session import materialise, scratch_path

DIMS = 64


@query("l4_one_hot", """SELECT o_orderkey, """ + ", ".join(
    f"CASE WHEN o_orderpriority = '{v}' THEN 1.0::DOUBLE ELSE 0 END AS hot_{i}" for i, v in
    enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))) + " FROM orders")
def _(t):
    fitted = Pipeline(stages=m.one_hot_steps(["o_orderpriority"])).fit(t.orders)
    hot = vector_to_array("o_orderpriority_hot")
    return fitted.transform(t.orders).select("o_orderkey", *[hot[i].alias(f"hot_{i}") for i in range(5)])


@query("l6_impute", with_views(GAPS) + """SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM gaps)), 6) AS by_mean,
coalesce(CAST(floor(value) AS DOUBLE), (SELECT CAST(floor(value) AS DOUBLE) AS v FROM gaps WHERE value IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS by_mode FROM gaps""")
def _(t):
    g = t.events_with_gaps.select("event_id", "value", F.floor("value").cast("double").alias("whole"))
    g = m.imputer(["value"]).fit(g).transform(g)
    g = m.imputer(["whole"], "mode").fit(g).transform(g)
    return g.select("event_id", F.round("value_filled", 6).alias("by_mean"), F.col("whole_filled").alias("by_mode"))


def order_rows(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "c_mktsegment", F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("balance"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))


@query("l7_column_transformer", """WITH r AS (SELECT o_orderkey, o_totalprice AS price, c_acctbal AS balance, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, round((price - avg(price) OVER ()) / stddev_samp(price) OVER (), 6) AS price_scaled, round((balance - avg(balance) OVER ()) / stddev_samp(balance) OVER (), 6) AS balance_scaled,
CASE WHEN c_mktsegment = (SELECT min(c_mktsegment) FROM r) THEN 1.0::DOUBLE ELSE 0 END AS first_segment FROM r""")
def _(t):
    rows = order_rows(t)
    v = vector_to_array("features")
    out = m.column_transformer(["price", "balance"], ["c_mktsegment"]).fit(rows).transform(rows)
    return out.select("o_orderkey", F.round(v[0], 6).alias("price_scaled"), F.round(v[1], 6).alias("balance_scaled"), v[2].alias("first_segment"))


def labelled_vectors(t):
    """Vectors of documents that carry a quality label."""
    j = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding").join(t.labels, "doc_id")
    return m.for_rounds(materialise(m.with_features(j, "embedding").select("doc_id", "features", F.col("quality").alias("label")), "labelled"))


def class_vectors(t):
    v = m.with_features(t.embeddings, "embedding").select("vec_id", "features", (F.col("label") % 3).alias("label"))
    return m.for_rounds(materialise(v, "vectors"))


def price_vectors(t):
    cols = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    rows = t.lineitem.withColumn("key", F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.lit(2 ** 31)))
    v = VectorAssembler(inputCols=cols, outputCol="features").transform(rows)
    return v.select("key", "features", F.col("l_extendedprice").alias("label"))


def price_rows(t):
    return materialise(price_vectors(t), "prices")


@query("l8_logistic_regression_cv")
def _(t):
    train, test = m.split_parts(labelled_vectors(t), "doc_id")
    weighted = m.balanced_weights(train, "label")
    cv = m.cross_validated(LogisticRegression(maxIter=30, weightCol="weight"), {"regParam": [10.0 ** (k / 2 - 4) for k in range(10)]}, m.auc_evaluator("label"), 5)
    model = cv.fit(weighted)
    scored = model.transform(test)
    return classification_summary(scored.select(F.col("label").cast("double").alias("y"), "prediction"), "y", "prediction").withColumn(
        "best_reg", F.lit(float(model.bestModel.getRegParam())))


@query("l9_random_forest")
def _(t):
    train, test = m.split_parts(class_vectors(t), "vec_id")
    return m.compare({"random_forest": m.binary_classifiers(DIMS)["random_forest"]}, train, test, "label")


@query("l10_gradient_boosting")
def _(t):
    train, test = m.split_parts(class_vectors(t), "vec_id")
    return m.compare({"boosted_one_vs_rest": m.boosted_multiclass(20, 3)}, train, test, "label")


@query("l11_regressors")
def _(t):
    train, test = m.split_parts(price_vectors(t), "key", stored="prices")
    return m.compare(m.regressors(), train, test, "label", "regression")


@query("l12_linear_svc")
def _(t):
    train, test = m.split_parts(labelled_vectors(t), "doc_id")
    return m.compare({"linear_svc": m.binary_classifiers(DIMS)["linear_svc"]}, train, test, "label")


@query("l13_perceptron")
def _(t):
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    train, test = m.split_parts(class_vectors(t), "vec_id")
    net = MultilayerPerceptronClassifier(layers=[DIMS, 32, 32, 32, 3], maxIter=40, seed=m.SEED)
    return m.compare({"perceptron": net}, train, test, "label")


@query("l14_grid_search")
def _(t):
    train, _ = m.split_parts(class_vectors(t), "vec_id")
    cv = m.cross_validated(RandomForestClassifier(seed=m.SEED), {"numTrees": [10, 20], "maxDepth": [3, 5, 8]}, m.accuracy_evaluator("label"), 5)
    return m.search_table(t.spark, cv.fit(train))


@query("l14_random_search")
def _(t):
    train, _ = m.split_parts(class_vectors(t), "vec_id")
    space = {"regParam": [0.0, 0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [10, 20]}
    return m.search_table(t.spark, m.random_search(LogisticRegression(), space, 10, m.accuracy_evaluator("label"), 5).fit(train))


SEARCHED = {"regParam": tuning.Interval(1e-4, 1.0, log=True), "elasticNetParam": tuning.Interval(0.0, 1.0), "maxIter": tuning.Choice((5, 10, 20))}


@query("l14_adaptive_search")
def _(t):
    """The history of an adaptive search: each trial's setting and loss, and the best so far."""
    train, _ = m.split_parts(class_vectors(t), "vec_id")
    losses = tuning.cross_validated_losses(train, LogisticRegression(), m.accuracy_evaluator("label"), 3)
    return tuning.adaptive_search(t.spark, SEARCHED, losses, scratch_path(t.spark, "trials"), trials=15, batch=5, startup=5)


@query("l15_model_comparison")
def _(t):
    train, test = m.split_parts(labelled_vectors(t), "doc_id")
    return m.compare(m.binary_classifiers(DIMS), train, test, "label")


@query("l16_importance")
def _(t):
    rows = order_rows(t)
    steps = m.column_transformer(["price", "balance"], ["c_mktsegment", "o_orderpriority"])
    frame = steps.fit(rows).transform(rows)
    forest = RandomForestClassifier(labelCol="label", numTrees=5, maxDepth=4, seed=m.SEED).fit(frame)
    linear = LogisticRegression(labelCol="label", maxIter=10).fit(frame)
    names = m.feature_names(frame)
    a = m.importance_table(t.spark, names, forest.featureImportances.toArray()).withColumn("model", F.lit("forest"))
    return a.unionByName(m.importance_table(t.spark, names, linear.coefficients.toArray()).withColumn("model", F.lit("linear")))


@query("t6_extreme_coefficients")
def _(t):
    rows = order_rows(t)
    frame = m.column_transformer(["price", "balance"], ["c_mktsegment", "o_orderpriority"]).fit(rows).transform(rows)
    linear = LogisticRegression(labelCol="label", maxIter=10).fit(frame)
    return sel.extremes_by_size(m.importance_table(t.spark, m.feature_names(frame), linear.coefficients.toArray()), "value", "feature", 3)


@query("l17_score_table")
def _(t):
    train, test = m.split_parts(price_vectors(t), "key", stored="prices")
    return m.score_table(m.regressors()["linear_regression"].fit(train), test, "key")


@query("l18_saved_model", "SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER (), 6) AS price_scaled FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    rows = order_rows(t)
    fitted = m.column_transformer(["price"], ["c_mktsegment"]).fit(rows)
    path = scratch_path(t.spark, "model")
    m.save_model(fitted, path)
    v = vector_to_array("features")
    return m.load_pipeline(path).transform(rows).select("o_orderkey", F.round(v[0], 6).alias("price_scaled"))


@query("l19_prediction_table")
def _(t):
    train, test = m.split_parts(labelled_vectors(t), "doc_id")
    kinds = m.binary_classifiers(DIMS)
    fitted = {n: kinds[n].fit(train) for n in ("logistic_regression", "random_forest", "linear_svc")}
    return m.prediction_table(fitted, test, "doc_id")


def learning_parts(df, key):
    s = sel.random_split(df, key, {"labelled": 0.2, "pool": 0.6, "test": 0.2})
    return [s.filter(F.col("split") == p).drop("split") for p in ("labelled", "pool", "test")]


@query("l22_self_training")
def _(t):
    labelled, pool, test = learning_parts(class_vectors(t), "vec_id")
    return m.self_training(labelled, pool, test, "vec_id", "label", rounds=3)


@query("l22_self_training_regression")
def _(t):
    labelled, pool, test = learning_parts(price_rows(t), "key")
    return m.self_training_regression(labelled, pool, test, "key", "label", rounds=3)


@query("l24_active_learning")
def _(t):
    labelled, pool, test = learning_parts(class_vectors(t), "vec_id")
    out = None
    for s in (sel.LEAST_CONFIDENCE, sel.MARGIN, sel.ENTROPY):
        part = m.active_learning(labelled, pool, pool, test, "vec_id", "label", s, 20, 5).withColumn("strategy", F.lit(s))
        out = part if out is None else out.unionByName(part)
    return out


@query("l24_active_learning_regression")
def _(t):
    labelled, pool, test = learning_parts(price_rows(t), "key")
    return m.active_learning_regression(labelled, pool, pool, test, "key", "label", 50, 5)


_INFORMATION = f"""WITH w AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents), k AS (SELECT unnest(range(1, 6)) AS k),
p AS (SELECT w[i] AS a, w[i + k] AS b FROM (SELECT w, k, unnest(range(1, len(w) - k + 1)) AS i FROM w, k WHERE len(w) > k)),
d AS MATERIALIZED (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) GROUP BY 1, 2), t AS MATERIALIZED (SELECT a, sum(n)::DOUBLE AS t FROM d GROUP BY 1),
m AS (SELECT d.a, d.b, ln(n) + ln((SELECT sum(CAST(t ** 0.75 AS DECIMAL(28, 6)))::DOUBLE FROM t)) - 0.875 * (ln(x.t) + ln(y.t)) AS m FROM d JOIN t AS x ON d.a = x.a JOIN t AS y ON d.b = y.a)
SELECT a AS word, count(*) AS contexts, round(sum(m), 6) AS total, round(max(m), 6) AS best FROM m WHERE m > 1e-9 GROUP BY 1"""


def word_lists(t):
    return materialise(t.documents.select("doc_id", "text", tx.words(F.col("text")).alias("w")), "tokens")


@query("l25_word_information", _INFORMATION)
def _(t):
    """The matrix behind the word vectors: contexts a word prefers, and how strongly."""
    docs = word_lists(t)
    vocabulary = ws.vocabulary_of(docs, "w")
    names = vocabulary.select(F.col("id").alias("i"), "word")
    lists, keyed = ws.coded(docs, "w", vocabulary)
    found = ws.information(ws.word_pairs(lists, "w", 5), keyed).filter("m > 1e-9").groupBy("i").agg(
        F.count("*").alias("contexts"), F.round(F.sum("m"), 6).alias("total"), F.round(F.max("m"), 6).alias("best"))
    return found.join(names, "i").select("word", "contexts", "total", "best")


@query("l25_word_vectors")
def _(t):
    return ws.word_vectors(word_lists(t), "w", dims=100, window=5, min_count=1).select("word", "vector")


@query("x18_embedding_table")
def _(t):
    docs = word_lists(t).dropDuplicates(["doc_id", "text"]).withColumn("row", F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)))
    docs = materialise(docs, "texts")
    vectors = mean_word_vectors(docs, "row", "w", ws.word_vectors(docs, "w", dims=32, window=5, min_count=1), 32)
    return materialise(docs.join(vectors, "row").select("doc_id", "text", F.col("vector").cast("array<float>").alias("embedding")), "vectors")


# the power of a symmetric matrix, squared 18 times, is the outer product of its first component; the second is that of what it leaves
_POWER = """SELECT k, list_transform(a, lambda x: list_transform(x, lambda y: y / list_sum(list_transform(range(1, 65), lambda i: a[i][i])))) AS a"""
_FIRST = """SELECT list_transform(r, lambda y: y / sqrt(list_dot_product(r, r))) AS v FROM (SELECT unnest(a) AS r FROM {0} WHERE k = 18) ORDER BY list_dot_product(r, r) DESC LIMIT 1"""
_VALUE = "list_dot_product(v, list_transform(a, lambda x: list_dot_product(x, v)))"
_SQUARED = _POWER + """ FROM (SELECT k + 1 AS k, list_transform(a, lambda x: list_transform(a, lambda y: list_dot_product(x, y))) AS a FROM {0} WHERE k < 18)"""
_SIGNED = "CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END"
_COMPONENTS = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), d AS (SELECT unnest(range(1, 65)) AS i),
c AS MATERIALIZED (SELECT d.i, f.i AS j, covar_samp(e[d.i], e[f.i]) AS c FROM e, d, d AS f GROUP BY 1, 2), r AS (SELECT i, list(c ORDER BY j) AS r FROM c GROUP BY 1),
m AS MATERIALIZED (SELECT list(r ORDER BY i) AS a FROM r), mean AS MATERIALIZED (SELECT list(m ORDER BY i) AS m FROM (SELECT i, avg(e[i]) AS m FROM e, d GROUP BY 1)),
p AS ({_POWER} FROM (SELECT 0 AS k, a FROM m) UNION ALL {_SQUARED.format("p")}), v1 AS MATERIALIZED ({_FIRST.format("p")}),
l1 AS MATERIALIZED (SELECT v, {_VALUE} AS l FROM v1, m), m2 AS MATERIALIZED (SELECT list_transform(a, lambda x, i: list_transform(x, lambda y, j: y - l * v[i] * v[j])) AS a FROM m, l1),
q AS ({_POWER} FROM (SELECT 0 AS k, a FROM m2) UNION ALL {_SQUARED.format("q")}), v2 AS MATERIALIZED ({_FIRST.format("q")}), l2 AS MATERIALIZED (SELECT v, {_VALUE} AS l FROM v2, m),
s1 AS (SELECT list_transform(v, lambda y: y * {_SIGNED}) AS v, l FROM l1), s2 AS (SELECT list_transform(v, lambda y: y * {_SIGNED}) AS v, l FROM l2)
SELECT vec_id, round(list_dot_product(e, s1.v) - list_dot_product(m, s1.v), 5) AS x, round(list_dot_product(e, s2.v) - list_dot_product(m, s2.v), 5) AS y,
round(1 - (s1.l + s2.l) / list_sum(list_transform(range(1, 65), lambda i: a[i][i])), 6) AS lost_variance FROM e, mean, m, s1, s2"""


@query("l26_principal_components", _COMPONENTS)
def _(t):
    found = principal_components(t.embeddings, "embedding", k=2)
    v = F.col("components")
    return found.project(t.embeddings.select("vec_id", "embedding"), "embedding").select(
        "vec_id", F.round(v[0], 5).alias("x"), F.round(v[1], 5).alias("y"), F.round(F.lit(found.lost), 6).alias("lost_variance"))


@query("l26_variance_share")
def _(t):
    found = principal_components(t.embeddings, "embedding", share=0.95)
    return found.project(t.embeddings.select("vec_id", "embedding"), "embedding").select("vec_id", F.size("components").alias("k"))
