"""Words over the letters of a record and the probabilities of the letter that follows a prefix."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavesym.operators.skew import KeySizes
from wavesym.schemas import RECORD_KEY
from wavesym.settings import Spec


def _points(lettered: DataFrame) -> DataFrame:
    """One row per point with its place in `bytes`, the letters as binary (read by offset)."""
    # two steps: the conversion belongs below the explode
    binary = lettered.withColumn("bytes", F.col("symbols").cast("binary"))
    return binary.select(
        *RECORD_KEY, "start", "bytes", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")
    )


def _part(first: Column, length: int) -> Column:
    return F.substr("bytes", first, F.lit(length)).cast("string")


def sliding_words(lettered: DataFrame, a: int) -> DataFrame:
    """label, id, sid, pos, word: the a letters from pos on, fewer at the end of the record."""
    return _points(lettered).select(
        *RECORD_KEY,
        (F.col("start") + F.col("i") - 1).alias("pos"),
        _part(F.col("i"), a).alias("word"),
    )


def word_columns(words: DataFrame, a: int) -> DataFrame:
    """label, sid, id, s1..sa: the letters of a word as columns, null past the end of the record."""
    letters = [
        F.nullif(F.substr("word", F.lit(i), F.lit(1)), F.lit("")).alias(f"s{i}")
        for i in range(1, a + 1)
    ]
    return words.select("label", "sid", "id", *letters)


def prefix_totals(columns: DataFrame, a: int) -> DataFrame:
    """Rows per prefix s1..s(a-1), incomplete prefixes (with nulls) included."""
    prefix = [f"s{i}" for i in range(1, a)]
    return columns.groupBy("label", "sid", "id", *prefix).agg(
        F.count(F.lit(1)).alias("n_prefix")
    )


def transition_counts(columns: DataFrame, a: int) -> DataFrame:
    """Rows per prefix and next letter."""
    word = [f"s{i}" for i in range(1, a + 1)]
    return columns.groupBy("label", "sid", "id", *word).agg(
        F.count(F.lit(1)).alias("n_word")
    )


def transition_pivot(counts: DataFrame, a: int, spec: Spec) -> DataFrame:
    """label, sid, id, A..E, SEQ, HEX from the counts; a letter that never follows stays null."""
    prefix = [F.col(f"s{i}") for i in range(1, a)]
    end = "-"  # stands for "no next letter"; it only counts in the total
    wide = (
        counts.select(
            *RECORD_KEY,
            F.concat(*prefix).alias("SEQ"),
            F.coalesce(f"s{a}", F.lit(end)).alias("next"),
            "n_word",
        )
        .filter(F.col("SEQ").isNotNull())
        .groupBy(*RECORD_KEY, "SEQ")
        .pivot("next", [*spec.letters, end])
        .agg(F.sum("n_word"))
    )
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in [*spec.letters, end]), F.lit(0))
    return wide.select(
        "label",
        "sid",
        "id",
        *[(F.col(c) / total).alias(c) for c in spec.letters],
        "SEQ",
        F.hex("SEQ").alias("HEX"),
    )


def _word_tasks(spark: SparkSession, records: KeySizes) -> int:
    """As many tasks as the session shuffles to, fewer for few points, more for very many."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few, many = records.scale.task_points
    return max(1, min(partitions, ceil(records.rows / few)), ceil(records.rows / many))


def transitions(lettered: DataFrame, spec: Spec, records: KeySizes, in_place: bool = False) -> DataFrame:
    """label, sid, id, word_length, A..E, SEQ, HEX for all word lengths, in one pass.

    The letters (a byte per point) are brought together by record before they become words, so no
    words are shuffled. `records` holds the points per (id, sid): words of a hot record are counted
    where they are, and the counts meet by record and prefix. (Points per id will do as `records`
    if no id is hot.) `in_place` says that the segments lie in buckets by id already.
    """
    if in_place:
        return _shares(lettered, spec)
    n_tasks = _word_tasks(lettered.sparkSession, records)
    hot = records.hot
    if hot is None:
        return _shares(lettered.repartition(n_tasks, "id", "sid"), spec)
    keys = records.hinted(hot.select("id", "sid"))
    cold = lettered.join(keys, ["id", "sid"], "left_anti").repartition(n_tasks, "id", "sid")
    return _shares(cold, spec).unionByName(
        _shares(lettered.join(keys, ["id", "sid"], "left_semi"), spec)
    )


def _shares(lettered: DataFrame, spec: Spec) -> DataFrame:
    """Share of each next letter per prefix.

    The prefix that ends a record has no next letter: it counts in the total only.
    """
    # bytes until the groups are made: no text is built for a word, nor a structure for a point
    places = _points(lettered).withColumn("a", F.explode(F.array(*[F.lit(a) for a in spec.word_lengths])))
    # a plain length would make Spark ask ahead of the exchange if there are letters, and so make them twice
    size = F.coalesce(F.octet_length("bytes"), F.lit(0))
    whole = (F.col("i") > 0) & (F.col("i") + F.col("a") - 2 <= size)
    words = places.filter(whole).select(
        *RECORD_KEY,
        F.substr("bytes", F.col("i"), F.col("a") - 1).alias("prefix"),
        F.substr("bytes", F.col("i") + F.col("a") - 1, F.lit(1)).alias("next"),
    )
    total = F.count(F.lit(1))
    shares = [(F.count_if(F.col("next") == F.lit(c.encode())) / total).alias(c) for c in spec.letters]
    return (
        words.groupBy(*RECORD_KEY, "prefix")
        .agg(*shares)
        .select(
            "label", "sid", "id", (F.octet_length("prefix") + 1).alias("word_length"), *spec.letters,
            F.col("prefix").cast("string").alias("SEQ"), F.hex("prefix").alias("HEX"),
        )
    )
