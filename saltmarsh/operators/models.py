"""Spark ML estimators on the feature table."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import classification as mc
from pyspark.ml import regression as mr
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .stats import LevelVectors, hash_split, regression_metrics, roc_auc, standard_scale, stratified_folds

NUMERIC = ["tenure_days", "mrr", "total_usage", "feature_count", "total_events"]
SEED = 42


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in memory and on disk while an estimator passes over it repeatedly."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def feature_frame(profile: DataFrame, numeric: list[str] | None = None, category: str | None = "plan_tier", folds: int = 0) -> tuple[DataFrame, list[str]]:
    """Split by user hash, scale on the training rows only, and assemble; returns the frame and feature names.

    The frame is materialised once: every estimator pass then reads stored rows, not the joins behind them.
    """
    numeric = list(numeric or NUMERIC)
    rows = hash_split(profile, "user_id")
    if folds:
        rows = stratified_folds(rows, "churned", "user_id", folds)
    rows = standard_scale(rows, numeric, rows.where("split = 'train'"))
    names = [f"{c}_z" for c in numeric]
    inputs = list(names)
    if category:
        levels = LevelVectors(rows.where("split = 'train'"), category)
        if levels.names:
            rows = levels.transform(rows, "_levels")
            inputs.append("_levels")
            names += [f"{category}_{v}" for v in levels.names]
    rows = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows).drop("_levels")
    return cut_lineage(rows.withColumn("label", F.col("churned").cast("double"))), names


def probability(column: str = "probability") -> Column:
    return F.round(vector_to_array(F.col(column))[1], 9)


def logistic(max_iter: int = 50) -> mc.LogisticRegression:
    # penalty 1 / (C n) of the usual C = 1 is negligible at scale; a small fixed one keeps it stable
    return mc.LogisticRegression(maxIter=max_iter, regParam=1e-4, standardization=False)


def forest(trees: int = 100, depth: int = 10) -> mc.RandomForestClassifier:
    return mc.RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED)


def boosted(rounds: int = 20, rate: float = 0.1, depth: int = 5) -> mc.GBTClassifier:
    return mc.GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, seed=SEED)


def network(inputs: int, max_iter: int = 60) -> mc.MultilayerPerceptronClassifier:
    return mc.MultilayerPerceptronClassifier(layers=[inputs, 32, 16, 2], maxIter=max_iter, seed=SEED)


ROWS_A_TASK = 10_000  # training rows that are worth a task of their own


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over as many tasks as there are cores, if there are enough rows: a stored table of few megabytes is read by few
    tasks, however long an estimator works on each row. Not over more: tree ensembles add up the statistics of
    all nodes once for every task."""
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))
    return rows.repartition(tasks) if tasks > rows.rdd.getNumPartitions() else rows


def fit_on_train(frame: DataFrame, estimator):
    with held(spread(frame.where("split = 'train'").select("features", "label"))) as train:
        return estimator.fit(train)


def classifier_report(name: str, frame: DataFrame, model) -> DataFrame:
    """AUC and accuracy on the held-out rows."""
    scored = model.transform(frame.where("split = 'test'")).withColumn("p", probability())
    acc = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).scalar()
    return roc_auc(scored, "churned", "p").select(F.lit(name).alias("model"), "n", "auc", acc.alias("accuracy"))


def importances(df: DataFrame, names: list[str], values) -> DataFrame:
    """One row per feature; there are as many as model inputs."""
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double").orderBy(F.abs("weight").desc(), "feature")


def soft_vote(frame: DataFrame, models: list) -> DataFrame:
    """Mean positive probability of several models."""
    out = frame
    for i, m in enumerate(models):
        out = m.transform(out).withColumn(f"p{i}", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")
    mean = sum(F.col(f"p{i}") for i in range(len(models))) / len(models)
    return out.withColumn("p", F.round(mean, 9))


def stacked(frame: DataFrame, bases: list, folds: int):
    """Second-level model on out-of-fold base predictions; returns scored held-out rows."""
    with held(spread(frame)) as rows:
        train = rows.where("split = 'train'")
        out_of_fold = None
        for f in range(folds):
            fitted = [b.fit(train.where(F.col("fold") != f)) for b in bases]
            part = base_scores(train.where(F.col("fold") == f), fitted)
            out_of_fold = part if out_of_fold is None else out_of_fold.unionByName(part)
        meta = logistic().fit(meta_input(out_of_fold, len(bases)))
        finals = [b.fit(train) for b in bases]
    test = meta_input(base_scores(frame.where("split = 'test'"), finals), len(bases))
    return meta.transform(test).withColumn("p", probability())


def base_scores(rows: DataFrame, models: list) -> DataFrame:
    return soft_vote(rows, models).drop("p")


def meta_input(rows: DataFrame, n: int) -> DataFrame:
    return rows.drop("features").withColumn("features", array_to_vector(F.array(*[F.col(f"p{i}") for i in range(n)])))


def tune_boosting(frame: DataFrame, rates: list[float], rounds: list[int], folds: int, parallelism: int = 4) -> DataFrame:
    """Cross-validated AUC over the grid, folds taken from the ``fold`` column."""
    gbt = boosted()
    grid = ParamGridBuilder().addGrid(gbt.stepSize, rates).addGrid(gbt.maxIter, rounds).build()
    cv = CrossValidator(
        estimator=gbt, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds, foldCol="fold", parallelism=parallelism, seed=SEED
    )
    with held(spread(frame.where("split = 'train'").select("features", "label", "fold"))) as train:
        fitted = cv.fit(train)
    rows = [(float(g[gbt.stepSize]), int(g[gbt.maxIter]), float(a)) for g, a in zip(grid, fitted.avgMetrics)]
    out = frame.sparkSession.createDataFrame(rows, "learning_rate double, rounds int, auc double")
    best = max(rows, key=lambda r: r[2])
    return out.withColumn("is_best", (F.col("learning_rate") == best[0]) & (F.col("rounds") == best[1]))


# ---- regression


def regression_frame(profile: DataFrame) -> tuple[DataFrame, list[str]]:
    frame, names = feature_frame(profile)
    return frame.withColumn("label", F.col("mrr") * F.col("tenure_days") / 30.0), names


def linear() -> mr.LinearRegression:
    return mr.LinearRegression(regParam=0.0, solver="normal")


def ridge(alpha: float, train: DataFrame, label: str = "label") -> mr.LinearRegression:
    """Penalty ``alpha`` of the sum-of-squares form; the estimator divides by rows and by the label's spread."""
    s = train.agg(F.count("*").alias("n"), F.coalesce(F.stddev_pop(label), F.lit(1.0)).alias("spread")).first()
    return mr.LinearRegression(regParam=alpha * s["spread"] / max(s["n"], 1), elasticNetParam=0.0, standardization=False, solver="normal")


def forest_regressor(trees: int = 100, depth: int = 10) -> mr.RandomForestRegressor:
    return mr.RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=SEED)


def regressor_report(name: str, frame: DataFrame, model) -> DataFrame:
    scored = model.transform(frame.where("split = 'test'"))
    return regression_metrics(scored, "label", "prediction").select(F.lit(name).alias("model"), "n", "mae", "rmse", "r2")


def bands(scored: DataFrame, score: str = "p") -> DataFrame:
    return scored.withColumn("band", F.when(F.col(score) < 0.33, "low").when(F.col(score) < 0.66, "medium").otherwise("high"))


def intervention_table(banded: DataFrame, cost: float, saved_share: float) -> DataFrame:
    """Per band: size, churn share, what contacting everyone costs, and the MRR kept if it works."""
    return banded.groupBy("band").agg(
        F.count("*").alias("users"), F.avg("churned").alias("churn_rate"), (F.count("*") * F.lit(cost)).alias("cost"),
        (F.sum(F.col("mrr") * F.col("p")) * saved_share).alias("kept_mrr"),
    ).withColumn("net", F.col("kept_mrr") - F.col("cost"))


def save_versioned(model, path: str, version: str, features: list[str], metrics: dict[str, float], spark) -> DataFrame:
    """Write the model under its version, and a manifest row beside it."""
    target = f"{path}/version={version}"
    model.write().overwrite().save(f"{target}/model")
    row = [(version, f"{target}/model", json.dumps(features), json.dumps(metrics), int(time.time()))]
    manifest = spark.createDataFrame(row, "version string, path string, features string, metrics string, saved_at bigint")
    manifest.write.mode("overwrite").json(f"{target}/manifest")
    return spark.read.schema(manifest.schema).json(f"{target}/manifest")
