"""Model quality and parameter search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.evaluation import ClusteringEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, support, accuracy, recall, precision, f1)`` for every label that occurs or is predicted.

    One grouped pass gives the confusion counts; the rest is arithmetic on one row per label pair. A label without
    rows has no recall, one never predicted no precision; ``f1`` is then null or 0 as its parts demand.
    """
    cells = confusion(scored, label, prediction)
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("of"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"), right.cast("long").alias("right"), F.col("n").alias("rows")),
        F.struct(F.col("prediction").alias("of"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("right"), F.lit(0).cast("long").alias("rows")),
    )))
    per_label = sides.groupBy("of").agg(*(F.sum(c).alias(c) for c in ("actual", "predicted", "right")))
    accuracy = cells.agg(F.sum(right) / F.sum("n")).scalar()
    return per_label.select(
        F.col("of").alias("label"), F.col("actual").alias("support"), accuracy.alias("accuracy"),
        F.try_divide("right", "actual").alias("recall"), F.try_divide("right", "predicted").alias("precision"),
        F.try_divide(2 * F.col("right"), F.col("actual") + F.col("predicted")).alias("f1"),
    )


def class_metric(scored: DataFrame, metric: str = "f1", of_class: float = 0.0, label: str = "label") -> float:
    """Any Spark ML multiclass metric, such as ``accuracy``, ``f1`` or ``recallByLabel``."""
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric, metricLabel=of_class)
    return evaluator.evaluate(scored)


def regression_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(mse, rmse, r2, mae)`` from one pass over the rows."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    sums = scored.agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(y).alias("spread")
    )
    return sums.select(
        "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"), "mae"
    )


def silhouette(clustered: DataFrame, features: str = "features", cluster: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(clustered)


def cross_validate(
    df: DataFrame, stage: Estimator, grid: Sequence[dict], evaluator: Evaluator, folds: int = 2, fold_column: str | None = None, parallelism: int = 2, seed: int = 42
) -> CrossValidatorModel:
    """Mean metric of every grid point over the folds; ``fold_column`` fixes the folds."""
    search = CrossValidator(
        estimator=stage, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds, parallelism=parallelism, seed=seed
    )
    return (search.setFoldCol(fold_column) if fold_column else search).fit(df)


def validate_once(train: DataFrame, held_out: DataFrame, stage: Estimator, grid: Sequence[dict], evaluator: Evaluator) -> list[float]:
    """Metric of every grid point on one held-out part, which the caller splits off by a hash, so it never depends on
    the order or partitioning of the rows."""
    train.persist()
    held_out.persist()
    try:
        return [evaluator.evaluate(model.transform(held_out)) for _, model in sorted(stage.fitMultiple(train, list(grid)))]
    finally:
        train.unpersist()
        held_out.unpersist()


def metric_table(spark: SparkSession, grid: Sequence[dict], metrics: Sequence[float]) -> DataFrame:
    """``(point, params, metric)``, one row per grid point."""
    rows = [
        (n, ",".join(sorted(f"{p.name}={v}" for p, v in point.items())), float(m))
        for n, (point, m) in enumerate(zip(grid, metrics))
    ]
    return spark.createDataFrame(rows, "point long, params string, metric double")
