"""The scores of the stored forest against its trees, applied in plain Python."""

import numpy as np
import pytest

from wavesym.catalog import stored_scores
from wavesym.plans import model

FOLDER = "/root/testdata/sf0.001"


def plain(node):
    """A node as (feature, threshold, left, right), a leaf as its shares of the classes."""
    if node.getClass().getSimpleName() == "LeafNode":
        counts = np.array(list(node.impurityStats().stats()))
        return counts / counts.sum()
    split = node.split()
    return split.featureIndex(), split.threshold(), plain(node.leftChild()), plain(node.rightChild())


def leaf(node, x):
    while isinstance(node, tuple):
        feature, threshold, left, right = node
        node = left if x[feature] <= threshold else right
    return node


def test_scores_are_those_of_the_stored_trees(spark):
    loaded, scored = stored_scores(spark, FOLDER, model.FOREST)
    trees = [plain(t._java_obj.rootNode()) for t in loaded.bestModel.stages[0].trees]
    rows = scored.select("features", "rawPrediction", "probability", "prediction").collect()
    assert len(trees) == 40 and rows
    for row in rows:
        raw = sum(leaf(t, row.features.toArray()) for t in trees)
        assert row.rawPrediction.toArray() == pytest.approx(raw)
        assert row.probability.toArray() == pytest.approx(raw / raw.sum())
        assert row.prediction == raw.argmax()
