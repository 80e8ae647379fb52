"""Breakpoints: exact quantiles of the smoothed points of an id.

A quantile is the value at a rank. The points of an id that has few are gathered and sorted. Of the others, one pass
counts the points of each id by value bin; bins keep the order of the values, so the running counts say which bin
holds each rank. Only the points of these bins are looked at again: bins of very many points are cut into finer ones
first, the others are ranked. No step depends on how points lie in tasks, so neither do the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavesym.operators.skew import KeySizes, join_per_key, key_sizes, totals
from wavesym.settings import Scale, Spec
from wavesym.sources.staging import Staging

PER_DOUBLING = 32  # bins
FINER = 1024  # parts that a bin is cut into


def value_bin(x: Column) -> Column:
    """A number that never falls as x rises: some 32 for each power of two, on both sides of zero."""
    # fixed values: doubles lie between 2^-1074 and 2^1024
    size = F.greatest(F.least(F.log2(F.abs(x)), F.lit(1100.0)), F.lit(-1100.0)) + 1101
    signed = F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * size)
    return F.when(F.isnan(x), F.lit(2500 * PER_DOUBLING)).otherwise(F.floor(signed * PER_DOUBLING)).cast("long")


def _rank(n: Column, p: float) -> Column:
    """n - floor(n - p n): the least rank that leaves no more than a share of 1 - p above it."""
    return F.greatest(n - F.floor(n - F.lit(p) * n), F.lit(1)).cast("long")


def _holding(bins: DataFrame, ranks: DataFrame | None, spec: Spec) -> DataFrame:
    """The bins that hold a rank: the keys, lo, hi, n, i (which quantile) and rank (within the bin).

    `bins` has id, lo, hi, n; with `ranks` (id, within, i, rank) it has `within` too, the bin it was cut from.
    """
    key = ["id"] if ranks is None else ["id", "within"]
    inside = Window.partitionBy(*key)
    upto = inside.orderBy("lo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = bins.withColumn("upto", F.sum("n").over(upto))
    if ranks is None:
        total = F.sum("n").over(inside)
        wanted = F.array(
            *[F.struct(F.lit(i).alias("i"), _rank(total, p).alias("rank")) for i, p in enumerate(spec.probs)]
        )
        counted = counted.withColumn("wanted", wanted).select("*", F.inline("wanted"))
    else:
        counted = counted.join(ranks, key)
    before = F.col("upto") - F.col("n")
    held = counted.filter((F.col("rank") > before) & (F.col("rank") <= F.col("upto")))
    return held.select("id", "lo", "hi", "n", "i", (F.col("rank") - before).alias("rank"))


def _value() -> Column:
    """The cut, where the ends of the bin tell it."""
    one = (F.col("rank") == 1) | F.col("lo").eqNullSafe(F.col("hi"))
    return F.when(one, F.col("lo")).when(F.col("rank") == F.col("n"), F.col("hi"))


def _gathered(smoothed: DataFrame, spec: Spec) -> DataFrame:
    """id, quantiles from the sorted points of each id; a null is the least value, but no cut."""
    points = smoothed.groupBy("id").agg(
        F.sort_array(F.collect_list("smoothed_x")).alias("xs"), F.count(F.lit(1)).alias("n")
    )
    nulls = F.col("n") - F.size("xs")
    cuts = [F.get("xs", (_rank(F.col("n"), p) - nulls - 1).cast("int")) for p in spec.probs]
    found = points.select("id", F.array_compact(F.array(*cuts)).alias("quantiles"))
    return found.filter(F.size("quantiles") > 0)


def breakpoints(
    smoothed: DataFrame, spec: Spec, scale: Scale, staging: Staging, sizes: KeySizes | None = None
) -> DataFrame:
    """id, quantiles: for each probability the least value that leaves no larger share above it.

    `smoothed` has id and smoothed_x; `sizes` are the points per id, if known. Ids of at most `scale.gathered` points
    send these, once; a task holds those of few ids at a time. NaN is the greatest value. An id without points has
    no row.
    """
    sizes = sizes or key_sizes(smoothed, ["id"], scale)
    limit = min(scale.gathered, scale.hot_rows)
    if sizes.largest <= limit:
        return _gathered(smoothed, spec)
    large = staging.table(sizes.table.filter(F.col("n") > limit).select("id"), "large")
    n_large = large.count()
    if n_large == sizes.n_keys:
        return _binned(smoothed, spec, scale, staging)
    ids = F.broadcast(large) if n_large <= scale.broadcast_rows else large
    few, many = (smoothed.join(ids, "id", how) for how in ("left_anti", "left_semi"))
    return _gathered(few, spec).unionByName(_binned(many, spec, scale, staging))


def _binned(smoothed: DataFrame, spec: Spec, scale: Scale, staging: Staging) -> DataFrame:
    """id, quantiles by value bins: `smoothed` is read twice, the second time for the points of bins that hold a cut.

    An id sends at most one row per bin and task; a bin that is ranked has at most `scale.hot_rows` points.
    """
    binned = smoothed.select("id", F.col("smoothed_x").alias("x"), value_bin(F.col("smoothed_x")).alias("bin"))
    bins = binned.groupBy("id", "bin").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"))
    held = staging.table(_holding(bins, None, spec).withColumn("value", _value()), "cuts")
    done = [held.filter("value is not null").select("id", "i", "value")]
    open_ = held.filter("value is null")

    points = None
    while True:
        wide = staging.table(open_.select("id", "lo", "hi", "n").distinct(), "open")
        sizes = totals(wide, ["id", "lo"], scale)
        if not sizes.n_keys:
            break
        if points is None:
            bin_of = wide.withColumn("bin", value_bin(F.col("lo"))).select("id", "bin", "lo", "hi", "n")
            by_bin = totals(bin_of.select("id", "bin", "n"), ["id", "bin"], scale)
            near = join_per_key(binned, bin_of, by_bin, spread=["x"])
        else:
            near = join_per_key(points, wide, sizes, spread=["x"])
        points = near.select("id", "lo", "hi", "n", "x")
        if sizes.largest <= scale.hot_rows:
            order = Window.partitionBy("id", "lo").orderBy("x")
            ranked = points.withColumn("rank", F.row_number().over(order).cast("long"))
            wanted = open_.select("id", "lo", "i", "rank")
            done.append(ranked.join(wanted, ["id", "lo", "rank"]).select("id", "i", F.col("x").alias("value")))
            break
        # the finer bins of the bin that begins at lo
        part = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * FINER), F.lit(FINER - 1))
        cut = staging.table(points.select("id", F.col("lo").alias("within"), "x", part.alias("part")), "points")
        finer = cut.groupBy("id", "within", "part").agg(
            F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n")
        )
        finer = staging.table(finer, "bins")
        ranks = open_.select("id", F.col("lo").alias("within"), "i", "rank")
        held = staging.table(_holding(finer, ranks, spec).withColumn("value", _value()), "cuts")
        done.append(held.filter("value is not null").select("id", "i", "value"))
        open_ = held.filter("value is null")
        names = finer.select("id", "within", "part", "lo")
        sizes = totals(finer.select("id", "within", "part", "n"), ["id", "within", "part"], scale)
        points = join_per_key(cut, names, sizes, spread=["x"]).select("id", "lo", "x")
    values = done[0]
    for more in done[1:]:
        values = values.unionByName(more)
    # one value per probability and id
    ordered = F.sort_array(F.collect_list(F.struct("i", "value"))).getField("value")
    return values.groupBy("id").agg(ordered.alias("quantiles"))
