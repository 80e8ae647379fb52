"""Letters: where each raw point lies among the breakpoints of its id."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.functions.columns import letter
from wavesym.operators.breakpoints import breakpoints
from wavesym.operators.skew import KeySizes, join_per_key, key_sizes
from wavesym.operators.smoothing import moving_average
from wavesym.schemas import RECORD_KEY
from wavesym.settings import Scale, Spec
from wavesym.sources.staging import Staging


def _cuts(spec: Spec):
    return [F.get("quantiles", F.lit(i)) for i in range(len(spec.probs))]


def with_breakpoints(
    segments: DataFrame,
    spec: Spec,
    scale: Scale,
    staging: Staging,
    sizes: KeySizes | None = None,
) -> DataFrame:
    """Segments with the breakpoints of their id; `sizes` are the points per id, if known.

    The cuts of few ids are broadcast. Those of many lie in the same buckets by id as the segments, so the join, and
    what is grouped by id after it, needs no exchange; segments of hot ids stay where they are.
    """
    sizes = sizes or key_sizes(segments, ["id"], scale, weight="n")
    if sizes.n_keys <= scale.broadcast_rows:
        cuts = staging.table(_cuts_of(segments, spec, scale, staging, sizes), "breakpoints")
        return join_per_key(segments, cuts, sizes, spread=["sid", "start"])
    cold, hot = by_bucket(segments, sizes, scale, staging)
    whole = cold if hot is None else cold.unionByName(hot)
    cuts = staging.table(_cuts_of(whole, spec, scale, staging, sizes), "breakpoints")
    buckets = bucket_count(sizes)
    if hot is None:
        return cold.join(staging.bucketed(cuts, "cuts", "id", buckets), "id")
    ids = sizes.hot.select("id")
    others = cuts.join(sizes.hinted(ids), "id", "left_anti")
    few = cuts.join(sizes.hinted(ids), "id", "left_semi")
    near = hot.join(F.broadcast(few), "id") if sizes.few_hot else join_per_key(hot, few, sizes, spread=["sid", "start"])
    return cold.join(staging.bucketed(others, "cuts", "id", buckets), "id").unionByName(near)


def _cuts_of(segments: DataFrame, spec: Spec, scale: Scale, staging: Staging, sizes: KeySizes) -> DataFrame:
    return breakpoints(moving_average(segments, spec, scale, staging, sizes), spec, scale, staging, sizes)


def bucket_count(ids: KeySizes) -> int:
    return max(int(ids.table.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(ids.rows / ids.scale.bucket_points))


def by_bucket(segments: DataFrame, ids: KeySizes, scale: Scale, staging: Staging) -> tuple[DataFrame, DataFrame | None]:
    """Segments stored in buckets by id, and those of hot ids (points per id above the limit) as they are."""
    cold, hot = segments, None
    if ids.hot is not None:
        keys = ids.hinted(ids.hot.select("id"))
        cold, hot = (segments.join(keys, "id", how).select(segments.columns) for how in ("left_anti", "left_semi"))
    return staging.bucketed(cold, "segments-by-id", "id", bucket_count(ids)), hot


def point_symbols(cut_segments: DataFrame, spec: Spec) -> DataFrame:
    """label, id, sid, pos, x, SAX for every point."""
    return cut_segments.select(
        *RECORD_KEY, "start", "quantiles", F.posexplode("data").alias("i", "x")
    ).select(
        *RECORD_KEY,
        (F.col("start") + F.col("i")).alias("pos"),
        "x",
        letter(F.col("x"), _cuts(spec), spec.letters).alias("SAX"),
    )


def letter_segments(cut_segments: DataFrame, spec: Spec) -> DataFrame:
    """label, id, sid, start, n and `symbols`: the letters of the segment and of what follows it."""
    cuts = cut_segments.select(
        *RECORD_KEY,
        "start",
        "n",
        F.concat("data", "after").alias("series"),
        *[cut.alias(f"q{i}") for i, cut in enumerate(_cuts(spec))],
    )
    names = [F.col(f"q{i}") for i in range(len(spec.probs))]
    return cuts.select(
        *RECORD_KEY,
        "start",
        "n",
        F.array_join(
            F.transform("series", lambda x: letter(x, names, spec.letters)), ""
        ).alias("symbols"),
    )
