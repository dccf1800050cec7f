"""Spark ML estimators used by the jobs: fit on one table, score another."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import LDA, BisectingKMeans, GaussianMixture, GaussianMixtureModel, KMeans, LDAModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.scalars import in_sample
from shelfwise.operators.blocks import best_items
from shelfwise.operators.ids import dense_index
from shelfwise.session import durable

RATINGS = 1 << 22  # ratings of a block of ALS, which a task holds several times over while it is built

ESTIMATORS = {
    "naive_bayes": NaiveBayes,
    "rf_classify": RandomForestClassifier,
    "dt_classify": DecisionTreeClassifier,
    "logreg": LogisticRegression,
    "linreg": LinearRegression,
    "dt_regress": DecisionTreeRegressor,
    "rf_regress": RandomForestRegressor,
    "kmeans": KMeans,
    "bisecting_kmeans": BisectingKMeans,
    "gmm": GaussianMixture,
    "lda": LDA,
}


def estimator(kind: str, **params) -> Estimator:
    return ESTIMATORS[kind](**params)


def split(df: DataFrame, key: str, share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a fixed hash of the key."""
    chosen = in_sample(F.col(key), share)
    return df.where(chosen), df.where(~chosen)


def fit_and_score(df: DataFrame, key: str, stage: Estimator, share: float = 0.7) -> tuple[DataFrame, Model]:
    """Fit on the training part and score the test part of ``df``.

    The iterations of the fit reread the training rows, so those are kept while it runs.
    """
    train, test = split(df, key, share)
    train = train.persist()
    try:
        model = stage.fit(train)
    finally:
        train.unpersist()
    return model.transform(test), model


def predictions(scored: DataFrame, key: str, label: str = "label") -> DataFrame:
    return scored.select(F.col(key).alias("id"), F.col(label).cast("double").alias("label"), "prediction")


def rules(model: Model) -> str:
    """Printed rules of a fitted tree."""
    return model.toDebugString


def bayes_log_probabilities(counts: DataFrame, labels: DataFrame, key: str, classes: Sequence[int], smoothing: float = 1.0) -> DataFrame:
    """``(label, term, logprob)`` of multinomial naive Bayes from ``(key, term, n)`` counts.

    Terms stay in a table: one grouped sum gives the counts of all classes side by side. It is written once, and the class
    totals and the number of terms are one row of it.
    """
    per_class = [F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in classes]
    table = durable(counts.join(labels, key).groupBy("term").agg(*per_class))
    *totals, width = table.agg(*(F.coalesce(F.sum(f"c{c}"), F.lit(0)) for c in classes), F.count(F.lit(1))).first()
    cells = [
        F.struct(F.lit(c).alias("label"), F.log((F.col(f"c{c}") + smoothing) / F.lit(float(total + smoothing * width))).alias("logprob"))
        for c, total in zip(classes, totals, strict=True)
    ]
    return table.select("term", F.inline(F.array(*cells))).select("label", "term", "logprob")


def log_priors(labels: DataFrame, classes: Sequence[int]) -> dict[int, float]:
    """The log of each class's share of the labelled rows; a class without rows is minus infinity."""
    *counts, total = labels.agg(*(F.count_if(F.col("label") == c) for c in classes), F.count(F.lit(1))).first()
    return {c: math.log(n / total) if n else -math.inf for c, n in zip(classes, counts, strict=True)}


def bayes_predict(counts: DataFrame, labels: DataFrame, table: DataFrame, priors: dict[int, float], key: str) -> DataFrame:
    """``(key, label, prediction)``: the likeliest class of each labelled document, of equal ones the first.

    Scores are the log-priors plus the log-probabilities of the terms, a join of term rows and one grouped sum. Terms that
    the table does not know add nothing; a document without known terms has its priors alone.
    """
    held = counts.join(labels.select(key), key)
    sums = held.join(table.withColumnRenamed("label", "of"), "term").groupBy(key).agg(
        *(F.sum(F.when(F.col("of") == c, F.col("n") * F.col("logprob")).otherwise(0.0)).alias(f"s{c}") for c in priors)
    )
    totals = [F.struct((F.coalesce(f"s{c}", F.lit(0.0)) + F.lit(p)).alias("s"), F.lit(-c).alias("c")) for c, p in priors.items()]
    return labels.join(sums, key, "left").select(key, "label", (-F.array_max(F.array(*totals))["c"]).cast("long").alias("prediction"))


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(slope, intercept, r2)`` of a least-squares line."""
    points = VectorAssembler(inputCols=[x], outputCol="features").transform(df.select(x, F.col(y).alias("label")))
    model = LinearRegression(maxIter=10, solver="normal").fit(points)
    found = (float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))
    return df.sparkSession.createDataFrame([found], "slope double, intercept double, r2 double")


def linear_errors(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(n, mse, rmse, mae)`` of the residuals of a least-squares line."""
    points = VectorAssembler(inputCols=[x], outputCol="features").transform(df.select(x, F.col(y).alias("label")))
    found = residuals(LinearRegression(maxIter=10, solver="normal").fit(points))
    error = F.col("residuals")
    return found.agg(
        F.count(error).alias("n"), F.avg(error * error).alias("mse"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae")
    )


def topics(model: LDAModel, words: DataFrame, top: int = 10) -> DataFrame:
    """``(topic, rank, term, weight)`` for the heaviest terms of each topic.

    ``words`` is ``(term, ix)``, the places of the vectors the model was fitted on.
    """
    described = model.describeTopics(top).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "t")
    )
    return described.join(words, F.col("t.termIndices") == F.col("ix")).select(
        F.col("topic").cast("long").alias("topic"),
        (F.col("pos") + 1).cast("long").alias("rank"),
        "term",
        F.col("t.termWeights").alias("weight"),
    )


def mixtures(model: LDAModel, df: DataFrame, key: str) -> DataFrame:
    """``(key, topic, share)``: the topic mixture of each document."""
    shares = vector_to_array("topicDistribution")
    return model.transform(df).select(key, F.posexplode(shares).alias("topic", "share")).withColumn("topic", F.col("topic").cast("long"))


def _digamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by recurrence and the asymptotic series."""
    x, out = np.array(x, np.float64), np.zeros(np.shape(x))
    while (low := x < 8).any():
        out[low] -= 1 / x[low]
        x[low] += 1
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y * (1 / 132 - y * 691 / 32760)))))


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by recurrence and the asymptotic series."""
    x, out = np.array(x, np.float64), np.zeros(np.shape(x))
    while (low := x < 8).any():
        out[low] -= np.log(x[low])
        x[low] += 1
    y = 1 / (x * x)
    return out + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y * (1 / 1680 - y / 1188)))) / x


def _expectation(weights: np.ndarray) -> np.ndarray:
    """The expected logarithms under Dirichlet distributions, one for each row."""
    return _digamma(weights) - _digamma(weights.sum(axis=-1, keepdims=True))


def _bounds(terms, alpha: np.ndarray):
    """Function adding up the documents' parts of the variational bound, and their counts, in each task.

    ``terms`` is the broadcast expected logarithm of each term's weight (row) in each topic.
    """

    def bounds(batches):
        bound = tokens = 0.0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                shares = part.column("shares").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(alpha))
                ix, n, of = [], [], []
                for row, v in enumerate(part.column("v")):
                    w = v["values"].values.to_numpy(zero_copy_only=False)
                    at = v["indices"].values.to_numpy(zero_copy_only=False) if v["indices"].is_valid else np.arange(len(w))
                    ix, n, of = [*ix, at[w != 0]], [*n, w[w != 0]], [*of, np.full(np.count_nonzero(w), row)]
                ix, n, of = (np.concatenate(x) for x in (ix, n, of))
                counts = np.bincount(of, n, part.num_rows)
                held = np.bincount(of, minlength=part.num_rows) > 0
                # Spark gives a document's gamma as shares; it adds up to the prior and the counts
                gamma = np.where(held[:, None], shares * (alpha.sum() + counts)[:, None], alpha)
                topics = _expectation(gamma)
                logs = topics[of] + terms.value[ix]
                most = logs.max(axis=1) if len(logs) else np.zeros(0)
                bound += float(n @ (most + np.log(np.exp(logs - most[:, None]).sum(axis=1))))
                bound += float(((alpha - gamma) * topics + _lgamma(gamma) - _lgamma(alpha)).sum() + (math.lgamma(alpha.sum()) - _lgamma(gamma.sum(axis=1))).sum())
                tokens += float(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([bound]), pa.array([tokens])], ["bound", "tokens"])

    return bounds


def topic_fit(model: LDAModel, df: DataFrame, features: str = "features") -> dict[str, float]:
    """Log-likelihood and log-perplexity of a corpus under a topic model: the variational bound of Spark ML's own, from the
    documents' mixtures, for both numbers at once. Spark's methods take the exponential of all the model's numbers for each document.
    """
    weights = model.topicsMatrix().toArray().T
    eta, alpha = float(model._java_obj.getEffectiveTopicConcentration()), np.array(model.estimatedDocConcentration().toArray())
    logs = _expectation(weights)
    topics = ((eta - weights) * logs).sum() + _lgamma(weights).sum() - weights.size * math.lgamma(eta)
    topics += len(weights) * math.lgamma(eta * weights.shape[1]) - _lgamma(weights.sum(axis=1)).sum()
    terms = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs.T))
    held = model.transform(df.select(features)).select(vector_to_array("topicDistribution").alias("shares"), F.unwrap_udt(features).alias("v"))
    bound, tokens = held.mapInArrow(_bounds(terms, alpha), "bound double, tokens double").agg(F.sum("bound"), F.sum("tokens")).first()
    terms.destroy()
    return {"log_likelihood": float(topics + bound), "log_perplexity": -float(topics + bound) / tokens if tokens else math.nan}


def centres(model: Model, spark: SparkSession) -> DataFrame:
    """``(cluster, pos, value)`` of a fitted k-means or bisecting k-means model."""
    rows = [(c, p, float(v)) for c, centre in enumerate(model.clusterCenters()) for p, v in enumerate(centre)]
    return spark.createDataFrame(rows, "cluster long, pos long, value double")


def gaussians(model: GaussianMixtureModel, spark: SparkSession) -> DataFrame:
    """``(component, weight, mean, covariance)`` of a fitted mixture, covariances row by row."""
    rows = [
        (c, float(weight), part.mean.toArray().tolist(), part.cov.toArray().ravel().tolist())
        for c, (weight, part) in enumerate(zip(model.weights, model.gaussiansDF.collect()))
    ]
    return spark.createDataFrame(rows, "component long, weight double, mean array<double>, covariance array<double>")


def linear_summary(model: LinearRegressionModel) -> dict:
    """Iterations, objective by iteration, RMSE and r2 of a fit; residuals stay in its summary."""
    found = model.summary
    return {
        "iterations": found.totalIterations,
        "objective": list(found.objectiveHistory),
        "rmse": found.rootMeanSquaredError,
        "r2": found.r2,
    }


def residuals(model: LinearRegressionModel) -> DataFrame:
    return model.summary.residuals


class Factors:
    """Alternating least squares on ``(u, i, w)``; ids of any size.

    Spark's ALS takes 32-bit ids and lays its blocks out by them. Ids are always numbered densely first and translated
    back, so the size of an id never changes the model.
    """

    def __init__(self, weighted: DataFrame, rank: int = 8, rounds: int = 5, reg: float = 0.01, seed: int = 42):
        weighted = durable(weighted)
        blocks = max(10, -(-weighted.count() // RATINGS))  # ten is what Spark takes at any size
        self.users, self.items = dense_index(weighted, "u", "u_ix"), dense_index(weighted, "i", "i_ix")
        self.model: ALSModel = ALS(
            numUserBlocks=blocks, numItemBlocks=blocks, rank=rank, maxIter=rounds, regParam=reg, seed=seed, userCol="u_ix", itemCol="i_ix", ratingCol="w", coldStartStrategy="drop"
        ).fit(self._numbered(weighted))

    def _number(self, df: DataFrame, column: str, index: DataFrame) -> DataFrame:
        ix = f"{column}_ix"
        return df.join(index, column).withColumn(ix, F.col(ix).cast("int"))

    def _numbered(self, df: DataFrame) -> DataFrame:
        return self._number(self._number(df, "u", self.users), "i", self.items)

    def predict(self, pairs: DataFrame) -> DataFrame:
        return self.model.transform(self._numbered(pairs)).drop("u_ix", "i_ix")

    def _best(self, n: int, of: str, to: str, some: DataFrame | None) -> DataFrame:
        """Best ``n`` of the side ``to`` for each of the side ``of``, by bounds on blocks of factors."""
        index = {"u": self.users, "i": self.items}
        sides = {"u": self.model.userFactors, "i": self.model.itemFactors}
        asked, offered = (sides[x].select(F.col("id").cast("long").alias(y), F.col("features").alias("v")) for x, y in ((of, "u"), (to, "i")))
        if some is not None:
            asked = asked.join(self._number(some, of, index[of]).select(F.col(f"{of}_ix").cast("long").alias("u")), "u", "left_semi")
        found, _ = best_items(asked, offered, n)
        full = {"u": "user_id", "i": "item_id"}
        left, right = (index[x].toDF(full[x], y) for x, y in ((of, "_of"), (to, "_to")))
        return found.toDF("_of", "rank", "_to", "score").join(left, "_of").join(right, "_to").select(full[of], "rank", full[to], "score")

    def for_users(self, n: int, users: DataFrame | None = None) -> DataFrame:
        """Best ``n`` items per user, for all users or the given ``(u)``."""
        return self._best(n, "u", "i", users)

    def for_items(self, n: int, items: DataFrame | None = None) -> DataFrame:
        """Best ``n`` users per item, for all items or the given ``(i)``."""
        return self._best(n, "i", "u", items)
