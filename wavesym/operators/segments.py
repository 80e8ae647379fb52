"""Segments: the stored form of a series, arrays of at most `Scale.segment` points.

Columns: ``label, id, sid``, ``start`` (position of the first point), ``n``, ``data``; ``before``
and ``after`` repeat the few neighbouring points of the same record that a trailing mean or a word
reaches, so later operators need no exchange between segments. ``head`` (first segment of a record)
and ``tail`` (last one) hold the ends that the mean carries from one record to the next. ``moments`` are the central
moments of ``data``, from which the statistics of a record are combined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavesym.operators.moments import with_moments
from wavesym.operators.skew import KeySizes, join_per_key, positions, totals
from wavesym.schemas import RECORD_KEY
from wavesym.settings import Scale, Spec
from wavesym.sources.staging import Staging


def last_points(values: Column, k: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - k, F.lit(0)) + 1, k)


def _with_ends(df: DataFrame, spec: Spec, also: list[str]) -> DataFrame:
    """Add n, head, tail and moments to label, id, sid, start, before, data, after."""
    k = spec.lookback
    ends = df.select(
        *RECORD_KEY,
        F.col("start").cast("long").alias("start"),
        F.when(F.col("data").isNotNull(), F.size("data")).alias("n"),
        "before",
        "data",
        "after",
        F.when(F.col("start") == 0, F.slice("data", 1, k)).alias("head"),
        F.when(F.size("after") == 0, last_points(F.concat("before", "data"), k)).alias("tail"),
        *also,
    )
    return with_moments(ends)


def segments_of_records(
    records: DataFrame, spec: Spec, scale: Scale, also: list[str] | None = None
) -> DataFrame:
    """Cut records (label, id, sid, data array) into segments, each inside its own row.

    A record without points, or with a null series, stays one row without points. `also` names
    further columns to keep.
    """
    also = also or []
    k, reach, size = spec.lookback, spec.reach, scale.segment
    starts = F.when(
        F.size("data") > 0, F.sequence(F.lit(0), F.size("data") - 1, F.lit(size))
    )
    cut = records.select(
        *RECORD_KEY, F.col("data").alias("series"), F.explode_outer(starts).alias("start"), *also
    ).select(
        *RECORD_KEY,
        "start",
        F.slice(
            "series",
            F.greatest(F.col("start") - k, F.lit(0)) + 1,
            F.least(F.col("start"), F.lit(k)),
        ).alias("before"),
        F.slice("series", F.col("start") + 1, size).alias("data"),
        F.slice("series", F.col("start") + size + 1, reach).alias("after"),
        *also,
    )
    return _with_ends(cut, spec, also)


def labelled_sizes(points: DataFrame) -> DataFrame:
    """id, sid, n and `mixed`: has the record more than one label (a null counts as one)?"""
    # counts alone: the least label would make Spark sort all points, as it has no hash aggregate for texts
    by_label = points.groupBy("id", "sid", "label").agg(F.count(F.lit(1)).alias("n"))
    return by_label.groupBy("id", "sid").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) > 1).alias("mixed"))


def _small_records(points: DataFrame, order: list[str]) -> DataFrame:
    """Records that fit into one segment, gathered and sorted whole, without numbering their points first; those of
    several labels (a null counts as one) are left out here."""
    none = F.array().cast("array<double>")
    fields = order if "x" in order else [*order, "x"]
    ordered = F.sort_array(F.collect_list(F.struct(*fields))).getField("x")
    n_labelled = F.count("label")
    one_label = (n_labelled == 0) | ((n_labelled == F.count(F.lit(1))) & (F.min("label") == F.max("label")))
    dealt = points.repartition("id", "sid")  # ahead of the groups, or each task would sort its points by them first
    # the id comes first: groups are sorted by it, and its first bytes tell most of them apart
    gathered = dealt.groupBy("id", "sid").agg(F.min("label").alias("label"), ordered.alias("data"), one_label.alias("_one"))
    start = F.lit(0).cast("long").alias("start")
    return gathered.filter("_one").select(*RECORD_KEY, start, none.alias("before"), "data", none.alias("after"))


def segments_of_points(
    points: DataFrame, order: list[str], spec: Spec, scale: Scale, staging: Staging
) -> DataFrame:
    """Gather single points (label, id, sid, x and the columns of `order`) into segments.

    A record has one label; others are left out whole. Records that fit into one segment are gathered in one step:
    those of an id whose points fit into one need no count of their own. The points of longer ones are numbered first
    and then gathered by segment: a point close to a border is sent to the neighbouring segment as well; no task ever
    holds more of a record than one segment, or more of it in a window than `Scale.hot_rows`.
    """
    k, reach, size = spec.lookback, spec.reach, scale.segment
    if size < k + reach:
        raise ValueError("a segment must be longer than lookback + reach")
    key = ["id", "sid"]
    limit = min(size, scale.hot_rows)
    counted = points.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    ids = totals(staging.table(counted, "ids"), ["id"], scale)
    if ids.largest <= limit:
        return _with_ends(_small_records(points, order), spec, [])
    parts = []
    large = staging.table(ids.table.filter(F.col("n") > limit).select("id"), "large-ids")
    n_large = large.count()
    if n_large < ids.n_keys:
        few = join_per_key(points, large, ids, order, "left_anti", small_rows=n_large)
        parts.append(_small_records(few, order))
        points = join_per_key(points, large, ids, order, "left_semi", small_rows=n_large)
    records = staging.table(labelled_sizes(points), "records")
    sizes = totals(records.select(*key, "n"), key, scale)
    mixed = records.filter("mixed").select(*key)
    n_mixed = mixed.count()
    if n_mixed:
        points = join_per_key(points, mixed, sizes, order, "left_anti", small_rows=n_mixed)
        sizes = totals(records.filter("not mixed").select(*key, "n"), key, scale)
    if sizes.largest <= limit:
        parts.append(_small_records(points, order))
        return _with_ends(reduce(DataFrame.unionByName, parts), spec, [])
    large = staging.table(sizes.table.filter(F.col("n") > limit).select(*key), "large")
    n_large = large.count()
    if n_large < sizes.n_keys:
        few = join_per_key(points, large, sizes, order, "left_anti", small_rows=n_large)
        parts.append(_small_records(few, order))
        points = join_per_key(points, large, sizes, order, "left_semi", small_rows=n_large)
    placed = positions(points, key, order, "pos", scale, staging, sizes=sizes)
    at = F.col("pos") % size
    own = F.floor(F.col("pos") / size)
    wanted = (
        F.when(at >= size - k, F.array(own, own + 1))
        .when((own > 0) & (at < reach), F.array(own, own - 1))
        .otherwise(F.array(own))
    )
    copies = placed.select(*RECORD_KEY, "pos", "x", F.explode(wanted).alias("segment"))
    start = F.col("segment") * size
    gathered = (
        copies.groupBy(*RECORD_KEY, "segment")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "x"))).getField("x").alias("xs"),
            F.count_if(F.col("pos") < start).cast("int").alias("n_before"),
            F.count_if((F.col("pos") >= start) & (F.col("pos") < start + size))
            .cast("int")
            .alias("n_own"),
        )
        .filter(F.col("n_own") > 0)
        .select(
            *RECORD_KEY,
            start.alias("start"),
            F.slice("xs", F.lit(1), F.col("n_before")).alias("before"),
            F.slice("xs", F.col("n_before") + 1, F.col("n_own")).alias("data"),
            F.slice("xs", F.col("n_before") + F.col("n_own") + 1, F.lit(reach)).alias("after"),
        )
    )
    for more in parts:
        gathered = gathered.unionByName(more)
    return _with_ends(gathered, spec, [])


def record_sizes(segments: DataFrame, keys: list[str], scale: Scale) -> KeySizes:
    """Points per record, read off the last segment of each: no grouping."""
    ends = segments.filter(F.col("tail").isNotNull())
    return totals(ends.select(*keys, (F.col("start") + F.col("n")).alias("n")), keys, scale)


def explode_points(segments: DataFrame) -> DataFrame:
    """One row per point: label, id, sid, pos, x."""
    return segments.select(
        *RECORD_KEY, "start", F.posexplode("data").alias("i", "x")
    ).select(*RECORD_KEY, (F.col("start") + F.col("i")).alias("pos"), "x")
