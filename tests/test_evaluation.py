"""Metrics for every pattern of empty cells, against plain floating point."""

import itertools
import math

import pytest

from wavesym.operators.evaluation import confusion, metrics, split_by_id


def divide(x, y):
    if y == 0:
        return math.nan if x == 0 or math.isnan(x) else math.inf
    return x / y


def expected(tp, fn, fp, tn):
    total = tp + fn + fp + tn
    precision, recall = divide(tp, tp + fp), divide(tp, tp + fn)
    inverse = divide(1.0, precision) + divide(1.0, recall)
    f1 = math.nan if math.isnan(inverse) else (0.0 if math.isinf(inverse) else 2 / inverse)
    return {
        "accuracy": divide(tp + tn, total),
        "acc": divide(tp + tn, total),
        "precision": precision,
        "recall": recall,
        "sensitivity": recall,
        "specificity": divide(tn, tn + fp),
        "f1": f1,
    }


def test_all_patterns(spark):
    for cells in itertools.product([0, 3], repeat=4):
        tp, fn, fp, tn = cells
        rows = [(1, 1.0)] * tp + [(1, 0.0)] * fn + [(0, 1.0)] * fp + [(0, 0.0)] * tn
        counts = confusion(spark.createDataFrame(rows, "label int, prediction double"))
        row = counts.first()
        assert (row.tp, row.fn, row.fp, row.tn, row.total) == (*cells, sum(cells))
        got = metrics(counts).first().asDict()
        for name, want in expected(*cells).items():
            if math.isnan(want):
                assert math.isnan(got[name]), (cells, name)
            else:
                assert got[name] == pytest.approx(want), (cells, name)


def test_other_labels_count_in_the_total_only(spark):
    rows = [(1, 1.0), (None, 1.0), (2, 0.0), (0, 0.0)]
    row = confusion(spark.createDataFrame(rows, "label int, prediction double")).first()
    assert (row.tp, row.fn, row.fp, row.tn, row.total) == (1, 0, 0, 1, 4)


# fixed values: figures of logged results that must agree with each other
@pytest.mark.parametrize(
    "tp, fn, fp, tn, sensitivity, specificity, f1",
    [(0, 2, 0, 228, 0.0, 1.0, math.nan), (5, 0, 0, 0, 1.0, math.nan, 1.0)],
)
def test_logged_patterns(spark, tp, fn, fp, tn, sensitivity, specificity, f1):
    counts = spark.createDataFrame(
        [(tp, fn, fp, tn, tp + fn + fp + tn, tp + tn)],
        "tp long, fn long, fp long, tn long, total long, hits long",
    )
    row = metrics(counts).first()
    for got, want in zip((row.sensitivity, row.specificity, row.f1), (sensitivity, specificity, f1)):
        assert got == want or (math.isnan(got) and math.isnan(want))


def test_split(spark):
    rows = [("1", "a"), ("0", "b"), ("N", "c"), ("1", None)]
    training, testing = split_by_id(spark.createDataFrame(rows, "label string, id string"), ["a"])
    assert [tuple(r) for r in testing.collect()] == [(1, "a")]
    assert sorted(map(tuple, training.collect()), key=str) == [(0, "b"), (None, "c")]
