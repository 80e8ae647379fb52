"""Trailing moving average over all records of an id, in the order of sid and position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavesym.functions.columns import trailing_mean
from wavesym.operators.segments import last_points
from wavesym.operators.skew import KeySizes, positions
from wavesym.schemas import RECORD_KEY
from wavesym.settings import Scale, Spec
from wavesym.sources.staging import Staging

POINT = [*RECORD_KEY, "pos", "x", "smoothed_x"]


def _whole_frames(segments: DataFrame, spec: Spec) -> DataFrame:
    """Points whose frame lies inside their record: read off the segment, no exchange."""
    # `series` is made below the explode: once per segment, not once per point
    series = segments.select(
        *RECORD_KEY,
        (F.col("start") - F.size("before")).alias("first"),
        F.concat("before", "data").alias("series"),
    )
    return (
        series.select(*RECORD_KEY, "first", "series", F.posexplode("series").alias("i", "x"))
        .filter(F.col("i") >= spec.lookback)
        .select(
            *RECORD_KEY,
            (F.col("first") + F.col("i")).alias("pos"),
            "x",
            trailing_mean(F.col("series"), F.col("i"), spec.lookback).alias("smoothed_x"),
        )
    )


def _record_ends(segments: DataFrame) -> DataFrame:
    """label, id, sid, head, tail; only records of several segments need grouping."""
    ends = segments.select(*RECORD_KEY, "head", "tail")
    has_head, has_tail = F.col("head").isNotNull(), F.col("tail").isNotNull()
    halves = (
        ends.filter(has_head != has_tail)
        .groupBy(*RECORD_KEY)
        .agg(
            F.first("head", ignorenulls=True).alias("head"),
            F.first("tail", ignorenulls=True).alias("tail"),
        )
    )
    return ends.filter(has_head & has_tail).unionByName(halves)


def _record_starts(
    segments: DataFrame, spec: Spec, scale: Scale, staging: Staging, cold: bool
) -> DataFrame:
    """The first `lookback` points of each record, whose frames reach into earlier records.

    Works on one short row per record (its two ends). Records of an id are taken in blocks; the last
    rows of a block are repeated in the next, so a frame never needs more than its own block.
    """
    k, block = spec.lookback, max(scale.hot_rows, spec.lookback)
    placed = positions(_record_ends(segments), ["id"], ["sid"], "at", scale, staging, cold)
    own = F.floor(F.col("at") / block)
    wanted = F.when(F.col("at") % block >= block - k, F.array(own, own + 1)).otherwise(F.array(own))
    copies = placed.select("*", F.explode(wanted).alias("block"))
    previous = Window.partitionBy("id", "block").orderBy("at").rowsBetween(-k, -1)
    carried = (
        copies.withColumn("tails", F.collect_list("tail").over(previous))
        .filter(F.col("block") == own)
        .withColumn("carried", last_points(F.flatten("tails"), k))
    )
    at = F.col("i") + F.size("carried")
    frame = F.slice(
        F.concat("carried", "head"),
        F.greatest(at - k, F.lit(0)) + 1,
        F.least(at, F.lit(k)) + 1,
    )
    total = F.aggregate("frame", F.lit(0.0), lambda acc, v: acc + v)
    return (
        carried.select(*RECORD_KEY, "carried", "head", F.posexplode("head").alias("i", "x"))
        .select(*RECORD_KEY, F.col("i").cast("long").alias("pos"), "x", frame.alias("frame"))
        .select(*RECORD_KEY, "pos", "x", (total / F.size("frame")).alias("smoothed_x"))
    )


def moving_average(
    segments: DataFrame,
    spec: Spec,
    scale: Scale,
    staging: Staging,
    sizes: KeySizes | None = None,
) -> DataFrame:
    """label, id, sid, pos, x, smoothed_x for every point; `sizes` are the points per id, if known."""
    # an id has at least as many points as records
    cold = sizes is not None and sizes.hot is None
    starts = _record_starts(segments, spec, scale, staging, cold)
    return _whole_frames(segments, spec).unionByName(starts)
