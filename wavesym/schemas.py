"""Column layouts shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_KEY = ["label", "id", "sid"]

# a message as it arrives; `data` is a comma-separated series of numbers
MESSAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("label", "id", "sid", "data")]
)

# fixed values: the order of the classifier's features
DESCRIPTIVES = ["mean", "min", "max", "stdev", "kurt", "skew", "variance", "sum", "range"]


def feature_names(word_lengths) -> list[str]:
    return DESCRIPTIVES + [f"dist{a}" for a in word_lengths]


RESULT = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("epoch_ms", T.LongType()),
        T.StructField("duration_s", T.DoubleType()),  # of which, by stage:
        T.StructField("ingest_s", T.DoubleType()),
        T.StructField("features_s", T.DoubleType()),
        T.StructField("score_s", T.DoubleType()),
        T.StructField("n_messages", T.LongType()),
        T.StructField("n_records", T.LongType()),  # usable ones
        T.StructField("n_rejects", T.LongType()),
        T.StructField("n_points", T.LongType()),  # of all messages that could be read
        T.StructField("n_features", T.LongType()),  # records with features
        T.StructField("n_scored", T.LongType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("sensitivity", T.DoubleType()),
        T.StructField("specificity", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
    ]
)
