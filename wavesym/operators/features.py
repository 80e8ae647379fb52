"""One row of features per record: nine descriptives and a distance per word length."""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavesym.operators.moments import moment_statistics, record_moments
from wavesym.operators.segments import record_sizes
from wavesym.operators.skew import join_per_key
from wavesym.schemas import DESCRIPTIVES, RECORD_KEY, feature_names
from wavesym.settings import Scale, Spec


def statistics(x: str = "x") -> list[Column]:
    """Sample deviation and variance, population skewness, excess kurtosis; null where undefined."""
    return [
        F.mean(x).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.stddev(x).alias("stdev"),
        F.kurtosis(x).alias("kurt"),
        F.skewness(x).alias("skew"),
        F.variance(x).alias("variance"),
        F.sum(x).alias("sum"),
    ]


def values(segments: DataFrame) -> DataFrame:
    """label, id, sid, x: the points of segments, without their places."""
    return segments.select(*RECORD_KEY, F.explode("data").alias("x"))


def _described(stats: DataFrame) -> DataFrame:
    return stats.withColumn("range", F.col("max") - F.col("min")).select(*RECORD_KEY, *DESCRIPTIVES)


def descriptives(points: DataFrame) -> DataFrame:
    """The nine descriptives per record of points (label, id, sid, x), in any order."""
    return _described(points.groupBy(*RECORD_KEY).agg(*statistics()))


def segment_descriptives(segments: DataFrame, scale: Scale) -> DataFrame:
    """The same from the moments stored with the segments; no point is read."""
    return _described(record_moments(segments, scale).select(*RECORD_KEY, *moment_statistics()))


def point_statistics(segments: DataFrame, scale: Scale) -> DataFrame:
    """Every point with the eight statistics of its record (the unordered-window result).

    The statistics are aggregated, then joined to whole segments before these are exploded.
    """
    sizes = record_sizes(segments, RECORD_KEY, scale)
    joined = join_per_key(
        segments.select(*RECORD_KEY, "start", "data"),
        record_moments(segments, scale).select(*RECORD_KEY, *moment_statistics()),
        sizes,
        spread=["start"],
    )
    return joined.select(
        *RECORD_KEY, "start", *DESCRIPTIVES[:-1], F.posexplode("data").alias("i", "x")
    ).select(*RECORD_KEY, (F.col("start") + F.col("i")).alias("pos"), "x", *DESCRIPTIVES[:-1])


def distance_sums(distances: DataFrame, spec: Spec) -> DataFrame:
    """Per record and word length the sum and the number of distances: dist{a}_sum, dist{a}_n."""
    columns = []
    for a in spec.word_lengths:
        here = F.col("word_length") == a
        columns += [
            F.sum(F.when(here, F.col("dist") * F.col("weight"))).alias(f"dist{a}_sum"),
            F.sum(F.when(here, F.col("weight"))).alias(f"dist{a}_n"),
        ]
    return distances.groupBy(*RECORD_KEY).agg(*columns)


def reduced_distances(distances: DataFrame) -> DataFrame:
    """Per record and word length sqrt(sum) / count of its distances; a weight counts as that many rows."""
    total, n = F.sum(F.col("dist") * F.col("weight")), F.sum("weight")
    return distances.groupBy(*RECORD_KEY, "word_length").agg((F.sqrt(total) / n).alias("dist"))


def merge_lengths(sums: DataFrame, spec: Spec) -> DataFrame:
    """Totals over all combinations of a record's distances, one of each word length.

    A distance of length a occurs once for every combination of the others, so its total is its sum
    times pairs / n. Records without a match in every length are dropped.
    """
    counts = [F.col(f"dist{a}_n") for a in spec.word_lengths]
    everywhere = reduce(lambda x, y: x & y, [n.isNotNull() for n in counts])
    pairs = reduce(mul, [n.cast("double") for n in counts])
    return sums.filter(everywhere).select(
        *RECORD_KEY,
        pairs.alias("pairs"),
        *[
            (F.col(f"dist{a}_sum") * (pairs / F.col(f"dist{a}_n"))).alias(f"dist{a}_total")
            for a in spec.word_lengths
        ],
    )


def distance_features(merged: DataFrame, spec: Spec) -> DataFrame:
    """dist{a} = sqrt(total) / pairs."""
    return merged.select(
        *RECORD_KEY,
        *[
            (F.sqrt(F.col(f"dist{a}_total")) / F.col("pairs")).alias(f"dist{a}")
            for a in spec.word_lengths
        ],
    )


def feature_table(described: DataFrame, distanced: DataFrame, spec: Spec) -> DataFrame:
    return described.join(distanced, RECORD_KEY).select(
        *RECORD_KEY, *feature_names(spec.word_lengths)
    )


def feature_vector(features: DataFrame, spec: Spec) -> DataFrame:
    """Add `features`; an undefined statistic (null) becomes NaN in the vector."""
    assembler = VectorAssembler(
        inputCols=feature_names(spec.word_lengths), outputCol="features", handleInvalid="keep"
    )
    return assembler.transform(features)
