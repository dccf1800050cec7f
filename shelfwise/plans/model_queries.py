"""Model fitting, evaluation, factorisation and recommendation queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from shelfwise.functions.scalars import fold_of, in_sample, r6
from shelfwise.operators import blocks, evaluate as ev, factor, features as feat, models, recommend, relational as rel, text as tx
from shelfwise.operators.telemetry import measure_columns
from shelfwise.plans.registry import TARGET, query
from shelfwise.plans.telemetry_queries import facts
from shelfwise.plans.text_queries import MIN_DOCUMENTS, TOKENS
from shelfwise.session import durable, release


def _embeddings(t):
    return feat.as_vector(t.embeddings, "embedding").select("vec_id", "features", "label")


def _svd(t):
    """Five factors of the 0/1 user-item matrix."""
    return factor.pair_svd(rel.order_pairs(t.orders, t.lineitem).select(F.col("u").alias("row"), F.col("i").alias("col")), 5, tolerance=1e-6)


def _labelled_text(t):
    labels = t.labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    return t.documents.select("doc_id", "text", "n_chars").join(labels, "doc_id")


def _text_shape(t):
    """Length, token count and mean token length of the labelled documents."""
    rows = tx.token_count(tx.tokenize(_labelled_text(t))).select(
        "doc_id", "label", "n_chars", "n", (F.col("n_chars") / F.greatest("n", F.lit(1))).alias("mean_len")
    )
    return feat.assemble(rows, ["n_chars", "n", "mean_len"])


def _prices(t):
    rows = t.lineitem.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey").alias("line"),
        F.col("l_extendedprice").alias("label"), "l_quantity", "l_discount", "l_tax",
    )
    return feat.assemble(rows, ["l_quantity", "l_discount", "l_tax"])


def _scored(df, key, stage):
    scored, _ = models.fit_and_score(df, key, stage)
    return models.predictions(scored, key)


@query("hash_split", "SELECT CASE WHEN md5(CAST(o_orderkey AS varchar)) < 'b333' THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM orders GROUP BY 1")
def hash_split(t):
    side = F.when(in_sample(F.col("o_orderkey"), 0.7), "train").otherwise("test")
    return t.orders.groupBy(side.alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "confusion",
    """
    SELECT CAST(quality AS bigint) AS label, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END::bigint AS prediction, count(*) AS n
    FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2
    """,
)
def confusion(t):
    rows = t.documents.select("doc_id", (F.col("n_chars") > 500).cast("long").alias("prediction")).join(
        t.labels.select("doc_id", F.col("quality").cast("long").alias("label")), "doc_id"
    )
    return ev.confusion(rows)


@query(
    "class_metrics",
    """
    WITH p AS (SELECT CAST(quality AS bigint) AS label, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END::bigint AS prediction
               FROM documents JOIN labels USING (doc_id)),
    a AS (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM p),
    l AS (SELECT label FROM p UNION SELECT prediction FROM p),
    c AS (SELECT l.label, count(*) FILTER (WHERE p.label = l.label) AS support, count(*) FILTER (WHERE p.prediction = l.label) AS predicted,
                 count(*) FILTER (WHERE p.label = l.label AND p.prediction = l.label) AS hit
          FROM l JOIN p ON p.label = l.label OR p.prediction = l.label GROUP BY 1)
    SELECT label, support, round(accuracy, 6) AS accuracy, round(hit / nullif(support, 0), 6) AS recall,
           round(hit / nullif(predicted, 0), 6) AS "precision", round(2 * hit / (support + predicted), 6) AS f1 FROM c, a
    """,
)
def class_metrics(t):
    rows = t.documents.select("doc_id", (F.col("n_chars") > 500).cast("long").alias("prediction")).join(
        t.labels.select("doc_id", F.col("quality").cast("long").alias("label")), "doc_id"
    )
    return ev.class_metrics(rows).select("label", "support", *(r6(F.col(c)).alias(c) for c in ("accuracy", "recall", "precision", "f1")))


@query(
    "linreg_summary",
    """
    WITH d AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x FROM lineitem),
    f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM d), e AS (SELECT y - a - b * x AS r FROM d, f)
    SELECT count(*) AS n, round(avg(r * r), 6) AS mse, round(sqrt(avg(r * r)), 6) AS rmse, round(avg(abs(r)), 6) AS mae FROM e
    """,
)
def linreg_summary(t):
    rows = t.lineitem.select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    return models.linear_errors(rows, "l_quantity", "price").select("n", *(r6(F.col(c)).alias(c) for c in ("mse", "rmse", "mae")))


@query(
    "regression_metrics",
    """
    WITH e AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS p FROM lineitem)
    SELECT round(avg((y - p) * (y - p)), 6) AS mse, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
           round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2, round(avg(abs(y - p)), 6) AS mae FROM e
    """,
)
def regression_metrics(t):
    rows = t.lineitem.select((F.col("l_extendedprice") / 1000).alias("label"), F.col("l_quantity").alias("prediction"))
    return ev.regression_metrics(rows).select(*(r6(F.col(c)).alias(c) for c in ("mse", "rmse", "r2", "mae")))


@query(
    "linreg",
    """
    SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(regr_r2(y, x), 6) AS r2
    FROM (SELECT l_extendedprice / 1000 AS y, l_quantity AS x FROM lineitem)
    """,
)
def linreg(t):
    rows = t.lineitem.select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    return models.linear_fit(rows, "l_quantity", "price").select(*(r6(F.col(c)).alias(c) for c in ("slope", "intercept", "r2")))


@query(
    "naive_bayes",
    f"""
    WITH {TOKENS}, c AS (SELECT doc_id, term, count(*) AS n FROM tok WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1, 2),
    v AS (SELECT term FROM c GROUP BY term HAVING count(*) >= {MIN_DOCUMENTS}),
    x AS (SELECT term, sum(CASE WHEN quality = 0 THEN n ELSE 0 END) c0, sum(CASE WHEN quality = 1 THEN n ELSE 0 END) c1
          FROM c JOIN v USING (term) JOIN labels USING (doc_id) GROUP BY 1)
    SELECT 0 AS label, term, round(ln((c0 + 1) / ((SELECT sum(c0) FROM x) + (SELECT count(*) FROM x))), 6) AS logprob FROM x
    UNION ALL SELECT 1, term, round(ln((c1 + 1) / ((SELECT sum(c1) FROM x) + (SELECT count(*) FROM x))), 6) FROM x
    """,
)
def naive_bayes(t):
    counts, labels = _labelled_counts(t)
    table = models.bayes_log_probabilities(counts, labels, "doc_id", [0, 1])
    return table.select("label", "term", r6(F.col("logprob")).alias("logprob"))


def _labelled_counts(t):
    """Term counts of the labelled documents, without rare terms, and the labels."""
    labels = t.labels.select("doc_id", F.col("quality").cast("long").alias("label"))
    rows = rel.keep_keys(tx.tokenize(t.documents.select("doc_id", "text")), labels, "doc_id")
    return tx.count_terms(tx.document_terms(rows, "doc_id"), "doc_id", MIN_DOCUMENTS), labels


_BAYES = f"""
    WITH {TOKENS}, c AS (SELECT doc_id, term, count(*) AS n FROM tok WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1, 2),
    v AS (SELECT term FROM c GROUP BY term HAVING count(*) >= {MIN_DOCUMENTS}),
    y AS (SELECT doc_id, CAST(quality AS bigint) AS label, md5(CAST(doc_id AS varchar)) < 'b333' AS train FROM labels),
    x AS (SELECT term, sum(CASE WHEN label = 0 THEN n ELSE 0 END) c0, sum(CASE WHEN label = 1 THEN n ELSE 0 END) c1
          FROM c JOIN v USING (term) JOIN y USING (doc_id) WHERE train GROUP BY 1),
    z AS (SELECT sum(c0) AS s0, sum(c1) AS s1, count(*) AS w FROM x),
    lp AS (SELECT term, ln((c0 + 1) / (s0 + w)) AS l0, ln((c1 + 1) / (s1 + w)) AS l1 FROM x, z),
    prior AS (SELECT ln(count(*) FILTER (WHERE label = 0) / count(*)) AS p0, ln(count(*) FILTER (WHERE label = 1) / count(*)) AS p1 FROM y WHERE train),
    s AS (SELECT y.doc_id, y.label, coalesce(sum(n * l0), 0) AS s0, coalesce(sum(n * l1), 0) AS s1
          FROM y LEFT JOIN c ON c.doc_id = y.doc_id LEFT JOIN lp ON lp.term = c.term WHERE NOT train GROUP BY 1, 2),
    p AS (SELECT doc_id, label, CASE WHEN s1 + p1 > s0 + p0 THEN 1 ELSE 0 END::bigint AS prediction FROM s, prior)
    """


def _bayes_predictions(t):
    """Fitted on seven tenths of the labelled documents, applied to the rest."""
    counts, labels = _labelled_counts(t)
    counts = durable(counts)
    train, test = models.split(labels, "doc_id")
    table = models.bayes_log_probabilities(counts, train, "doc_id", [0, 1])
    return models.bayes_predict(counts, test, table, models.log_priors(train, [0, 1]), "doc_id")


@query("naive_bayes_predict", f"{_BAYES} SELECT doc_id, label, prediction FROM p")
def naive_bayes_predict(t):
    return _bayes_predictions(t)


@query(
    "naive_bayes_metrics",
    f"""{_BAYES},
    a AS (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM p),
    l AS (SELECT label FROM p UNION SELECT prediction FROM p),
    m AS (SELECT l.label, count(*) FILTER (WHERE p.label = l.label) AS support, count(*) FILTER (WHERE p.prediction = l.label) AS predicted,
                 count(*) FILTER (WHERE p.label = l.label AND p.prediction = l.label) AS hit
          FROM l JOIN p ON p.label = l.label OR p.prediction = l.label GROUP BY 1)
    SELECT label, support, round(accuracy, 6) AS accuracy, round(hit / nullif(support, 0), 6) AS recall,
           round(hit / nullif(predicted, 0), 6) AS "precision", round(2 * hit / (support + predicted), 6) AS f1 FROM m, a
    """,
)
def naive_bayes_metrics(t):
    return _rounded_metrics(durable(_bayes_predictions(t)))


def _rounded_metrics(scored):
    return ev.class_metrics(scored).select("label", "support", *(r6(F.col(c)).alias(c) for c in ("accuracy", "recall", "precision", "f1")))


@query("linreg_history")
def linreg_history(t):
    """The objective at each iteration of the price regression fitted by steps; the first row is the start."""
    model = models.estimator("linreg", maxIter=30, regParam=0.01, solver="l-bfgs").fit(_prices(t).select("features", "label"))
    found = models.linear_summary(model)
    rows = [(k, float(x), found["iterations"], float(found["rmse"]), float(found["r2"])) for k, x in enumerate(found["objective"])]
    return t.spark.createDataFrame(rows, "iteration long, objective double, iterations long, rmse double, r2 double")


@query("rf_metrics")
def rf_metrics(t):
    """Held-out quality of the alarm classifier."""
    return _rounded_metrics(durable(rf_classify(t)))


@query("rf_classify")
def rf_classify(t):
    rows = feat.assemble(facts(t), measure_columns()).select(
        F.col("machine_record_id").alias("id"), F.col("machine_record_state").alias("label"), "features"
    )
    return _scored(rows, "id", models.estimator("rf_classify", numTrees=10, maxDepth=5, seed=42, featureSubsetStrategy="all"))


@query("dt_classify")
def dt_classify(t):
    return _scored(_text_shape(t), "doc_id", models.estimator("dt_classify", maxDepth=4, seed=42))


@query("logreg")
def logreg(t):
    return _scored(_text_shape(t), "doc_id", models.estimator("logreg", maxIter=10, regParam=0.01))


@query("dt_regress")
def dt_regress(t):
    return _scored(_prices(t), "line", models.estimator("dt_regress", maxDepth=5, seed=42))


@query("rf_regress")
def rf_regress(t):
    return _scored(_prices(t), "line", models.estimator("rf_regress", numTrees=10, maxDepth=5, seed=42))


@query("tree_rules")
def tree_rules(t):
    """The printed rules of the tree behind ``dt_classify``, a row for each line."""
    _, model = models.fit_and_score(_text_shape(t), "doc_id", models.estimator("dt_classify", maxDepth=4, seed=42))
    return t.spark.createDataFrame(list(enumerate(models.rules(model).splitlines())), "line long, rule string")


def _cluster_model(t, kind):
    rows = _embeddings(t)
    return rows, models.estimator(kind, k=10, seed=42).fit(rows)


def _clusters(t, kind):
    rows, model = _cluster_model(t, kind)
    return model.transform(rows).select("vec_id", F.col("prediction").cast("long").alias("cluster"))


@query("kmeans")
def kmeans(t):
    return _clusters(t, "kmeans")


@query("bisecting_kmeans")
def bisecting_kmeans(t):
    return _clusters(t, "bisecting_kmeans")


@query("kmeans_centres")
def kmeans_centres(t):
    return models.centres(_cluster_model(t, "kmeans")[1], t.spark)


def _gaussian_model(t):
    projected, _ = factor.pca(_embeddings(t), "vec_id", "features", 5, out="reduced")
    return models.estimator("gmm", k=10, seed=42, featuresCol="reduced", maxIter=20).fit(projected)


@query("gmm_parts")
def gmm_parts(t):
    """Weight, mean and covariance of each component."""
    return models.gaussians(_gaussian_model(t), t.spark)


@query("gmm")
def gmm(t):
    model = _gaussian_model(t)
    rows = [(n, float(w)) for n, w in enumerate(model.weights)]
    return t.spark.createDataFrame(rows, "component long, weight double")


@query(
    "silhouette",
    """
    WITH e AS (SELECT vec_id, label, CAST(embedding AS double[]) AS v FROM embeddings),
    d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, avg(pow(list_distance(a.v, b.v), 2)) AS m
          FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
    x AS (SELECT vec_id, max(CASE WHEN la = lb THEN m END) AS a, min(CASE WHEN la <> lb THEN m END) AS b FROM d GROUP BY 1)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS score FROM x
    """,
)
def silhouette(t):
    rows = _embeddings(t).withColumn("label", F.col("label").cast("double"))
    return t.spark.createDataFrame([(round(ev.silhouette(rows, cluster="label"), 6),)], "score double")


def _topic_model(t):
    """Tokens, stop words, counts, inverse document frequency, then topics over every term of enough documents."""
    docs = tx.tokenize_regex(t.documents.select("doc_id", "text"))
    weighted, words = tx.weighted_vectors(docs, "doc_id", 20, MIN_DOCUMENTS)
    model = models.estimator("lda", k=5, maxIter=10, seed=42, optimizer="online").fit(weighted)
    return model, words, weighted


@query("lda_topics")
def lda_topics(t):
    model, words, _ = _topic_model(t)
    return models.topics(model, words, 10)


@query("lda_mixtures")
def lda_mixtures(t):
    """The share of each topic in each document."""
    model, _, weighted = _topic_model(t)
    return models.mixtures(model, weighted, "doc_id")


@query("lda_fit")
def lda_fit(t):
    """Log-likelihood and log-perplexity of the documents under their topics."""
    model, _, weighted = _topic_model(t)
    found = models.topic_fit(model, weighted)
    return t.spark.createDataFrame([(found["log_likelihood"], found["log_perplexity"])], "log_likelihood double, log_perplexity double")


def _factors(t):
    return models.Factors(rel.ratings(t.orders, t.lineitem))


@query("als_users")
def als_users(t):
    return _factors(t).for_users(10)


@query("als_items")
def als_items(t):
    return _factors(t).for_items(10)


@query("als_user_subset")
def als_user_subset(t):
    pairs = rel.order_pairs(t.orders, t.lineitem)
    peers = recommend.copurchase_users(pairs, TARGET).select(F.col("user_id").alias("u"))
    return _factors(t).for_users(10, peers)


@query("als_item_subset")
def als_item_subset(t):
    return _factors(t).for_items(10, rel.items_of(rel.order_pairs(t.orders, t.lineitem), TARGET))


@query("cross_validate")
def cross_validate(t):
    """The texts are tokenized and hashed once for all folds and grid points; a fit reads the vectors of its width only."""
    rows = _labelled_text(t).withColumn("fold", fold_of(F.col("doc_id"), 2))
    hashed, hashing, widths = tx.tokenize(rows, out="words"), HashingTF(inputCol="words"), [10, 100, 1000]
    for width in widths:
        hashed = hashing.copy({hashing.numFeatures: width, hashing.outputCol: f"features{width}"}).transform(hashed)
    hashed = durable(hashed.select("label", "fold", *(f"features{width}" for width in widths)))
    grid, metrics = [], []
    for width in widths:
        model = LogisticRegression(maxIter=10)
        points = ParamGridBuilder().addGrid(model.regParam, [0.1, 0.01]).build()
        vectors = hashed.select("label", "fold", F.col(f"features{width}").alias("features"))
        metrics += ev.cross_validate(vectors, model, points, MulticlassClassificationEvaluator(), folds=2, fold_column="fold").avgMetrics
        grid += [{hashing.numFeatures: width, **point} for point in points]
    release(hashed)
    return ev.metric_table(t.spark, grid, metrics)


@query("train_val_split")
def train_val_split(t):
    model = LinearRegression(maxIter=10)
    grid = (
        ParamGridBuilder()
        .addGrid(model.regParam, [0.1, 0.01])
        .addGrid(model.fitIntercept, [True, False])
        .addGrid(model.elasticNetParam, [0.0, 0.5, 1.0])
        .build()
    )
    train, held_out = models.split(_prices(t).select("line", "features", "label"), "line", 0.8)
    return ev.metric_table(t.spark, grid, ev.validate_once(train, held_out, model, grid, RegressionEvaluator()))


@query("pca")
def pca(t):
    _, shares = factor.pca(_embeddings(t), "vec_id", "features", 5)
    rows = [(n + 1, float(x)) for n, x in enumerate(shares)]
    return t.spark.createDataFrame(rows, "component long, ratio double")


def _size_spectrum(t):
    """Singular values of the user-by-size purchase matrix, its columns and its squared weight."""
    sizes = t.part.select(F.col("p_partkey").alias("i"), F.col("p_size").cast("long").alias("col"))
    bought = rel.purchases(t.orders, t.lineitem).join(sizes, "i").select(F.col("u").alias("row"), "col").where("col IS NOT NULL").distinct()
    bought = durable(bought)
    width, total = bought.agg(F.countDistinct("col"), F.count(F.lit(1))).first()
    return factor.pair_svd(bought, width).s, width, total


@query("svd_energy")
def svd_energy(t):
    """Energy curve of the user-by-size purchase matrix, a row for each column; null directions add nothing."""
    s, width, total = _size_spectrum(t)
    curve = factor.energy(np.pad(s, (0, width - len(s))), total)
    rows = [(k + 1, float(np.round(e, 6))) for k, e in enumerate(curve)]
    return t.spark.createDataFrame(rows, "k long, energy double")


@query("svd_rank")
def svd_rank(t):
    """Least number of singular values that keep 95 % of the energy."""
    s, _, total = _size_spectrum(t)
    return t.spark.createDataFrame([(factor.rank_for(s, total, 0.95),)], "rank long")


@query("rec_svd_items")
def rec_svd_items(t):
    items = _svd(t).columns.withColumnRenamed("col", "i")
    return recommend.factor_top(items, rel.order_pairs(t.orders, t.lineitem), TARGET)


@query("rec_unseen_per_user")
def rec_unseen_per_user(t):
    found = _svd(t)
    users, items = found.rows.withColumnRenamed("row", "u"), found.columns.withColumnRenamed("col", "i")
    return blocks.unseen_top(users, items, rel.order_pairs(t.orders, t.lineitem))
