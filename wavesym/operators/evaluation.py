"""Confusion counts and the metrics made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavesym.functions.columns import ratio


def confusion(predictions: DataFrame) -> DataFrame:
    """One row tp, fn, fp, tn, total in one pass. `total` counts rows of any label."""

    def cell(label: int, prediction: int):
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    return predictions.agg(
        cell(1, 1).alias("tp"),
        cell(1, 0).alias("fn"),
        cell(0, 1).alias("fp"),
        cell(0, 0).alias("tn"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("label") == F.col("prediction")).alias("hits"),
    )


def metrics(counts: DataFrame, also: list[str] | None = None) -> DataFrame:
    """accuracy, acc, precision, recall, sensitivity, specificity, f1; 0/0 is NaN. `also` names counts to keep.

    `accuracy` is the evaluator's share of equal labels, `acc` the share of the two true cells.
    """
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    recall = ratio(tp, tp + fn)
    # the reciprocal mean of precision and recall, with their zeros and NaNs followed through
    f1 = F.when((tp == 0) & ((fp == 0) | (fn == 0)), F.lit(float("nan"))).otherwise(
        ratio(2 * tp, 2 * tp + fp + fn)
    )
    return counts.select(
        ratio(F.col("hits"), F.col("total")).alias("accuracy"),
        ratio(tp + tn, F.col("total")).alias("acc"),
        ratio(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
        recall.alias("sensitivity"),
        ratio(tn, tn + fp).alias("specificity"),
        f1.alias("f1"),
        *(also or []),
    )


def split_by_id(features: DataFrame, test_ids: list[str] | Column) -> tuple[DataFrame, DataFrame]:
    """(training, testing) by membership of id, or by a condition on it; a null id is in neither.

    An empty list puts every row with an id in training. Labels become int.
    """
    labelled = features.filter("id is not null").withColumn("label", F.col("label").try_cast("int"))
    is_test = test_ids if isinstance(test_ids, Column) else F.col("id").isin(test_ids)
    return labelled.filter(~is_test), labelled.filter(is_test)
