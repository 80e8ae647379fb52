"""The classifier: a cross-validated random forest over the feature vector."""

from __future__ import annotations

from math import ceil
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the parameters the stored model was trained with
FOREST = dict(
    numTrees=40,
    maxDepth=5,
    maxBins=32,
    impurity="gini",
    featureSubsetStrategy="auto",
    subsamplingRate=1.0,
    minInstancesPerNode=1,
    minInfoGain=0.0,
    maxMemoryInMB=256,
    checkpointInterval=10,
    cacheNodeIds=False,
    seed=207336481,
)
#: one split by all features over all rows: no draw decides, so plain SQL can state its scores
STUMP = FOREST | dict(numTrees=1, maxDepth=1, maxBins=4096, featureSubsetStrategy="all", minInstancesPerNode=100, bootstrap=False)
FOLDS = 10
FOLD_SEED = -1191137437
TASK_ROWS = 100_000  # training rows of a partition


def with_folds(features: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Add `fold`, 0 to folds - 1, by a digest of the id: a subject's records stay together, wherever they lie."""
    digest = F.conv(F.substring(F.md5(F.col("id").cast("binary")), 1, 8), 16, 10).cast("long")
    return features.withColumn("fold", (digest % folds).cast("int"))


def fold_sizes(folded: DataFrame, folds: int = FOLDS) -> DataFrame:
    """fold, training and validation rows of every fold that has a row."""
    rows = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("validation"))
    total = folded.agg(F.count(F.lit(1)).alias("total"))  # one row
    return rows.join(F.broadcast(total)).select("fold", (F.col("total") - F.col("validation")).alias("training"), "validation")


def _laid_out(folded: DataFrame, rows: int) -> DataFrame:
    """The same rows in the same partitions in the same order, however they came: draws go by partition and place."""
    dealt = folded.repartition(max(1, ceil(rows / TASK_ROWS)), "id", "sid")
    return dealt.sortWithinPartitions("id", "sid", F.xxhash64("features"))


def _light(fitted: PipelineModel) -> PipelineModel:
    """Without the summary, which would tie a model to its training table and travel with every scoring task."""
    for stage in fitted.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return fitted


def train(
    training: DataFrame, folds: int = FOLDS, parallelism: int = 4, parameters: dict = FOREST
) -> CrossValidatorModel:
    """Fit on id, sid, label (int) and features; pass a written table, it is read more than once.

    The accuracy is the mean over the folds that have rows; each is scored by a fit of the others. Rows without a
    label are left out. Equal rows give an equal model, in whatever order and partitions they come.
    """
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", **parameters)
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    pipeline = Pipeline(stages=[forest])
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=[{}],
        evaluator=evaluator,
        numFolds=folds,
        seed=FOLD_SEED,
        parallelism=parallelism,
        foldCol="fold",
    )
    folded = with_folds(training.select("id", "sid", "label", "features").filter("label is not null"), folds)
    sizes = fold_sizes(folded, folds).collect()  # a row per fold
    rows = sum(r.validation for r in sizes)
    laid = _laid_out(folded, rows).persist(StorageLevel.MEMORY_AND_DISK)

    def accuracy(fold: int) -> float:
        fitted = _light(pipeline.fit(laid.filter(F.col("fold") != fold)))
        return evaluator.evaluate(fitted.transform(laid.filter(F.col("fold") == fold)))

    try:
        with ThreadPool(parallelism) as pool:
            found = pool.map(accuracy, sorted(r.fold for r in sizes if r.training)) or [float("nan")]
        best = _light(pipeline.fit(laid))
    finally:
        laid.unpersist()
    return search._copyValues(CrossValidatorModel(best, [fmean(found)], None, [pstdev(found)]))


def save(model: CrossValidatorModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> CrossValidatorModel:
    return CrossValidatorModel.load(path)


def score(model: CrossValidatorModel, features: DataFrame) -> DataFrame:
    """Add rawPrediction, probability and prediction."""
    return model.transform(features)
