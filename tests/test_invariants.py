"""Properties of the queries that have no SQL counterpart."""

from collections import defaultdict

import numpy as np
import pytest

from conftest import SMALL
from shelfwise.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: QUERIES[name](spark, SMALL).collect()


@pytest.fixture(scope="module")
def bought(run):
    held = defaultdict(set)
    for r in run("distinct_pairs"):
        held[r["u"]].add(r["i"])
    return held


def test_list_of_queries_without_sql():
    assert set(QUERIES) - set(ORACLES) == {
        "hashing_tf", "word2vec", "feature_hasher", "pca", "svd_energy", "rf_classify", "dt_classify", "logreg", "dt_regress",
        "rf_regress", "kmeans", "bisecting_kmeans", "gmm", "lda_topics", "als_users", "als_items",
        "tree_rules", "kmeans_centres", "gmm_parts", "lda_mixtures", "lda_fit", "svd_rank",
        "als_user_subset", "als_item_subset", "cross_validate", "train_val_split", "rec_svd_items", "rec_unseen_per_user",
    }


def test_hashing_keeps_every_token(run):
    held = defaultdict(float)
    for r in run("hashing_tf"):
        held[r["doc_id"]] += r["value"]
    assert dict(held) == {r["doc_id"]: float(r["n"]) for r in run("token_count")}


def test_document_vectors(run):
    rows = run("word2vec")
    assert {r["pos"] for r in rows} == {0, 1, 2} and len(rows) == 3 * len(run("token_count"))


def test_feature_hasher(run):
    rows = run("feature_hasher")
    assert all(0 <= r["pos"] < 300 for r in rows) and len({r["p_partkey"] for r in rows}) == 200


def test_pca_shares_fall(run):
    shares = [r["ratio"] for r in sorted(run("pca"), key=lambda r: r["component"])]
    assert shares == sorted(shares, reverse=True) and len(shares) == 5 and 0 < sum(shares) <= 1


def test_energy_reaches_one(run):
    curve = [r["energy"] for r in sorted(run("svd_energy"), key=lambda r: r["k"])]
    assert curve == sorted(curve) and curve[-1] == pytest.approx(1.0, abs=1e-6) and len(curve) == 50
    (row,) = run("svd_rank")
    assert curve[row["rank"] - 1] >= 0.95 - 1e-6 and (row["rank"] == 1 or curve[row["rank"] - 2] < 0.95 + 1e-6)


def test_tree_rules(run):
    lines = [r["rule"] for r in sorted(run("tree_rules"), key=lambda r: r["line"])]
    assert "DecisionTreeClassificationModel" in lines[0] and any("Predict:" in x for x in lines)


def test_rows_lie_nearest_their_centre(run, spark):
    import numpy as np

    from conftest import SMALL

    centres = np.zeros((10, 64))
    for r in run("kmeans_centres"):
        centres[r["cluster"], r["pos"]] = r["value"]
    chosen = {r["vec_id"]: r["cluster"] for r in run("kmeans")}
    for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect():
        far = np.linalg.norm(centres - np.array(r["embedding"], dtype=float), axis=1)
        assert far[chosen[r["vec_id"]]] == pytest.approx(far.min(), abs=1e-6)


def test_gaussian_parts(run):
    import numpy as np

    rows = run("gmm_parts")
    assert len(rows) == 10 and sum(r["weight"] for r in rows) == pytest.approx(1.0)
    for r in rows:
        spread = np.array(r["covariance"]).reshape(5, 5)
        assert len(r["mean"]) == 5 and np.allclose(spread, spread.T) and np.linalg.eigvalsh(spread).min() > -1e-9


def test_topic_mixtures_and_fit(run):
    shares = defaultdict(float)
    for r in run("lda_mixtures"):
        shares[r["doc_id"]] += r["share"]
    assert len(shares) == len(run("token_count")) and all(x == pytest.approx(1.0) or x == 0 for x in shares.values())
    (fit,) = run("lda_fit")
    assert fit["log_likelihood"] < 0 < fit["log_perplexity"]


def test_values_outside_a_closed_list_fail(spark):
    from pyspark.ml.linalg import Vectors

    from shelfwise.operators import features as feat, relational as rel, text as tx

    odd = spark.createDataFrame([(1, "a"), (2, "new"), (3, None)], "id long, kind string")
    assert feat.dummies(odd.where("id <> 2"), ["id"], "kind", ["a"], strict=True).count() == 2
    with pytest.raises(Exception, match="value outside the list: new"):
        feat.dummies(odd, ["id"], "kind", ["a"], strict=True).collect()
    wide = rel.indicator_pivot(odd, "id", "kind", "is_")
    assert wide.columns == ["id", "is_a", "is_new"] and sorted(map(tuple, wide.collect())) == [(1, 1.0, 0.0), (2, 0.0, 1.0), (3, 0.0, 0.0)]
    long = rel.indicator_pivot(odd, "id", "kind", "is_", most=1)
    assert sorted(map(tuple, long.collect())) == [(1, "a", 1.0), (2, "new", 1.0)]
    rows = spark.createDataFrame([(k, Vectors.dense(float(k))) for k in range(5)], ["id", "features"])
    with pytest.raises(ValueError, match="more than 4 values"):
        feat.index_categories(rows, "features", 4, expected=[0])
    words = spark.createDataFrame([(["x", "y", "z"],)], "tokens array<string>")
    with pytest.raises(ValueError, match="more than 2 terms"):
        tx.fit_counts(words, 2, whole=True)
    assert len(tx.fit_counts(words, 3, whole=True).vocabulary) == 3


def test_unsettled_factors_fail(spark):
    from pyspark.sql import functions as F

    from shelfwise.operators import krylov

    entries = spark.range(40).select((F.col("id") % 8).alias("row"), (F.col("id") % 5).alias("col"), F.xxhash64("id").cast("double").alias("w"))
    with pytest.raises(RuntimeError, match="after 0 rounds"):
        krylov.table_svd(entries, 2, rounds=0)


@pytest.mark.parametrize("name", ["rf_classify", "dt_classify", "logreg"])
def test_classes(run, name):
    rows = run(name)
    assert rows and all(r["label"] in (0.0, 1.0) and r["prediction"] in (0.0, 1.0) for r in rows)


@pytest.mark.parametrize("name", ["dt_regress", "rf_regress"])
def test_regressors(run, spark, name):
    rows = run(name)
    labels = [r["label"] for r in rows]
    assert len(rows) > 1000 and all(0 < r["prediction"] < 2 * max(labels) for r in rows)
    from shelfwise.operators import features as feat, models

    line = feat.assemble(spark.range(300).selectExpr("id", "cast(id % 20 as double) AS x", "3.0 * (id % 20) AS label"), ["x"])
    line = line.withColumn("label", line["label"].cast("double"))
    scored, _ = models.fit_and_score(line, "id", models.estimator(name, seed=1))
    errors = [abs(r["label"] - r["prediction"]) for r in scored.collect()]
    assert errors and sum(errors) / len(errors) < 3


@pytest.mark.parametrize("name", ["kmeans", "bisecting_kmeans"])
def test_clusters(run, name):
    rows = run(name)
    assert len(rows) == len({r["vec_id"] for r in rows}) == 500 and {r["cluster"] for r in rows} <= set(range(10))


def test_mixture_weights(run):
    assert sum(r["weight"] for r in run("gmm")) == pytest.approx(1.0)


def test_silhouette_range(run):
    (row,) = run("silhouette")
    assert -1 <= row["score"] <= 1


def test_topics(run):
    rows = run("lda_topics")
    assert len(rows) == 50 and all(0 < r["weight"] < 1 and r["term"] for r in rows)
    assert {(r["topic"], r["rank"]) for r in rows} == {(t, k) for t in range(5) for k in range(1, 11)}


@pytest.mark.parametrize("name, key", [("als_users", "user_id"), ("als_items", "item_id"), ("als_user_subset", "user_id"), ("als_item_subset", "item_id")])
def test_als_lists(run, name, key):
    lists = defaultdict(list)
    for r in run(name):
        lists[r[key]].append((r["rank"], r["score"]))
    for ranks in lists.values():
        ranks.sort()
        assert [k for k, _ in ranks] == list(range(1, len(ranks) + 1)) and len(ranks) <= 10
        assert [s for _, s in ranks] == sorted((s for _, s in ranks), reverse=True)


def test_search_grids(run):
    assert len({r["params"] for r in run("cross_validate")}) == 6
    assert len({r["params"] for r in run("train_val_split")}) == 12


def test_svd_items_are_new(run, bought):
    rows = sorted(run("rec_svd_items"), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert not {r["item_id"] for r in rows} & bought[42] and all(-1 <= r["score"] <= 1 for r in rows)


def test_unseen_items_are_new(run, bought):
    rows = run("rec_unseen_per_user")
    assert {r["user_id"] for r in rows} == set(bought) and len(rows) == 5 * len(bought)
    assert all(r["item_id"] not in bought[r["user_id"]] for r in rows)


def test_metrics_match_spark(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    from shelfwise.operators import evaluate as ev

    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (0.0, -1.0)], ["label", "prediction"])
    ours = ev.regression_metrics(df).first().asDict()
    assert ours == pytest.approx({m: RegressionEvaluator(metricName=m).evaluate(df) for m in ("mse", "rmse", "r2", "mae")})
    classes = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0)], ["label", "prediction"])
    assert ev.class_metric(classes, "accuracy") == 0.75
    assert ev.class_metric(classes, "recallByLabel", 0.0) == 0.5
    assert ev.class_metric(classes, "precisionByLabel", 1.0) == pytest.approx(2 / 3)


def test_tree_rules_and_splits(spark):
    from shelfwise.operators import features as feat, models

    df = feat.assemble(spark.range(60).selectExpr("id", "cast(id as double) AS x", "cast(id >= 30 as double) AS label"), ["x"])
    scored, model = models.fit_and_score(df, "id", models.estimator("dt_classify", maxDepth=2, seed=1))
    assert "If (feature 0 <=" in models.rules(model)
    train, test = models.split(df, "id")
    assert train.count() + test.count() == 60 and scored.count() == test.count() and train.intersect(test).count() == 0


def test_cluster_and_topic_details(spark):
    from shelfwise.operators import features as feat, models, text as tx

    rng = np.random.default_rng(1)
    points = [(k, float(x), float(y)) for k, (x, y) in enumerate(np.vstack([rng.normal(0, 0.1, (40, 2)), rng.normal(5, 0.1, (20, 2))]))]
    df = feat.assemble(spark.createDataFrame(points, "id long, x double, y double"), ["x", "y"])
    for kind in ("kmeans", "bisecting_kmeans"):
        found = {(r["cluster"], r["pos"]): r["value"] for r in models.centres(models.estimator(kind, k=2, seed=1).fit(df), spark).collect()}
        assert sorted(round(v) for v in found.values()) == [0, 0, 5, 5]
    parts = models.gaussians(models.estimator("gmm", k=2, seed=1).fit(df), spark).orderBy("weight").collect()
    assert [round(p["weight"], 3) for p in parts] == [0.333, 0.667] and all(len(p["covariance"]) == 4 for p in parts)

    docs = tx.tokenize(spark.createDataFrame([(k, "a b a" if k % 2 else "x y x") for k in range(20)], "id long, text string"))
    counts = tx.fit_counts(docs, out="features").transform(docs)
    model = models.estimator("lda", k=2, maxIter=10, seed=1).fit(counts)
    shares = models.mixtures(model, counts, "id").groupBy("id").sum("share").collect()
    assert len(shares) == 20 and all(r[1] == pytest.approx(1.0) for r in shares)
    fit = models.topic_fit(model, counts)
    assert fit["log_likelihood"] < 0 < fit["log_perplexity"]


def test_linear_details(spark):
    from shelfwise.operators import features as feat, models

    df = feat.assemble(spark.range(50).selectExpr("id", "cast(id as double) AS x", "2.0D * id + 1.0D AS label"), ["x"])
    model = models.estimator("linreg", maxIter=10).fit(df)
    found = models.linear_summary(model)
    assert found["r2"] == pytest.approx(1.0) and found["rmse"] < 1e-6 and found["iterations"] >= 0 and found["objective"]
    assert models.residuals(model).count() == 50


def test_alarm_model_finds_alarms(spark):
    """Held-out rows: a model that always answers one class fails."""
    from pyspark.sql import functions as F

    from shelfwise.operators import evaluate as ev
    from shelfwise.plans.catalog import QUERIES

    folder = "/root/testdata/sf0.01"
    state = spark.read.parquet(f"{folder}/events.parquet").select(F.col("event_id").alias("id"), (F.col("event_type") == "error").cast("double").alias("label"))
    scored = QUERIES["rf_classify"](spark, folder).select("id", F.col("prediction").cast("double").alias("prediction")).join(state, "id")
    found = {r["label"]: r for r in ev.class_metrics(scored).collect()}
    assert found[1.0]["recall"] > 0.4 and found[1.0]["precision"] > 0.8 and found[0.0]["recall"] > 0.9


def test_latest_day_is_pushed_to_the_scan(spark):
    from shelfwise.plans.catalog import QUERIES

    plan = QUERIES["latest_partition"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ts#" in plan and "date_format" not in plan.split("Filter")[1].split("\n")[0]
