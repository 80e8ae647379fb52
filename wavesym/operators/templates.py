"""Templates: transition tables of a reference cohort, and the distance of records to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavesym.functions.columns import euclidean
from wavesym.operators.skew import join_per_key, key_sizes
from wavesym.schemas import RECORD_KEY
from wavesym.settings import Scale, Spec


def build_templates(transitions: DataFrame, spec: Spec, mode: str = "pooled") -> DataFrame:
    """word_length, A..E, SEQ, HEX, weight.

    ``pooled``: the mean over the cohort's records, one row per prefix. ``rows``: the cohort's own
    rows, equal ones counted in `weight` instead of repeated.
    """
    if mode == "pooled":
        return transitions.groupBy("word_length", "SEQ", "HEX").agg(
            *[F.avg(c).alias(c) for c in spec.letters], F.lit(1).cast("long").alias("weight")
        )
    if mode == "rows":
        return transitions.groupBy("word_length", "SEQ", "HEX", *spec.letters).agg(
            F.count(F.lit(1)).alias("weight")
        )
    raise ValueError(f"unknown mode {mode!r}")


def write_templates(templates: DataFrame, path: str, batch_id: int = 0) -> None:
    """Add the templates of a batch to a collection; writing the same batch again replaces it."""
    templates.write.mode("overwrite").partitionBy("word_length").parquet(f"{path}/batch_id={batch_id}")


def read_templates(spark: SparkSession, path: str, spec: Spec) -> DataFrame:
    """A stored collection, without its `_id` and batches; nulls are zeros, a row without weight counts once."""
    stored = spark.read.parquet(path).drop("_id", "batch_id")
    if "weight" not in stored.columns:
        stored = stored.withColumn("weight", F.lit(1).cast("long"))
    return stored.na.fill(0.0, subset=list(spec.letters))


def match_templates(
    transitions: DataFrame, templates: DataFrame, spec: Spec, scale: Scale
) -> DataFrame:
    """Join each prefix of a record with the template rows of the same prefix (inner).

    `templates` is a stored table and is counted here. Pooled, it has a row per prefix at most,
    5^(a-1) for five letters, and is broadcast; a large set of rows is joined by prefix, common
    prefixes in salts.
    """
    key = ["word_length", "SEQ"]
    side = templates.select(*key, "weight", *[F.col(c).alias(f"t{c}") for c in spec.letters])
    n = templates.count()
    if n <= scale.broadcast_rows:
        return transitions.join(F.broadcast(side), key)
    sizes = key_sizes(transitions, key, scale)
    return join_per_key(transitions, side, sizes, spread=["id", "sid"], small_rows=n)


def template_distance(matched: DataFrame, spec: Spec) -> DataFrame:
    """label, id, sid, word_length, SEQ, HEX, weight, dist (Euclidean, of the probabilities)."""
    dist = euclidean(
        [F.col(c) for c in spec.letters], [F.col(f"t{c}") for c in spec.letters]
    )
    return matched.select(*RECORD_KEY, "word_length", "SEQ", "HEX", "weight", dist.alias("dist"))
