"""Central moments of series: made once per segment, stored with it, and combined pairwise.

Combining needs no point again, and two segments of very different means lose no digits, as sums of powers would.
"""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavesym.schemas import RECORD_KEY
from wavesym.settings import Scale

FIELDS = ("n", "mean", "m2", "m3", "m4", "min", "max", "sum")


def _struct(**fields: Column) -> Column:
    return F.struct(*[fields[name].cast("double").alias(name) for name in FIELDS])


def with_moments(segments: DataFrame) -> DataFrame:
    """Add `moments` of `data`; null where there is no point."""
    zero = F.lit(0.0)
    x = F.col("data")
    total = F.aggregate(x, zero, lambda s, v: s + v)
    # one expression after the other, so that each is evaluated once per segment
    sums = segments.withColumn("_sum", total).withColumn("_min", F.array_min(x)).withColumn("_max", F.array_max(x))
    same = F.col("_min") == F.col("_max")
    means = sums.withColumn("_mean", F.when(same, F.col("_min")).otherwise(F.col("_sum") / F.size(x)))
    off = F.transform(x, lambda v: v - F.col("_mean"))
    parts = means.withColumn("_off", off)
    sums_of = [F.aggregate("_off", zero, _adds_power(k)).alias(f"_s{k}") for k in (1, 2, 3, 4)]
    parts = parts.select("*", *sums_of).withColumn("_by", F.col("_s1") / F.size(x))  # by which the mean is off
    n, by, s2, s3, s4 = F.size(x), F.col("_by"), F.col("_s2"), F.col("_s3"), F.col("_s4")
    about = {
        "m2": s2 - n * by * by,
        "m3": s3 - 3 * by * s2 + 2 * n * by * by * by,
        "m4": s4 - 4 * by * s3 + 6 * by * by * s2 - 3 * n * by * by * by * by,
    }
    moments = _struct(
        n=n,
        mean=F.when(same, F.col("_min")).otherwise(F.col("_mean") + by),
        **{name: F.when(same, zero).otherwise(m) for name, m in about.items()},
        min=F.col("_min"),
        max=F.col("_max"),
        sum=F.col("_sum"),
    )
    return parts.select(*segments.columns, F.when(F.size(x) > 0, moments).alias("moments"))


def _adds_power(k: int):
    return lambda s, v: s + reduce(mul, [v] * k)


def _merge(a: Column, b: Column) -> Column:
    """The moments of two sets of points together."""
    na, nb = a["n"], b["n"]
    n = na + nb
    d = b["mean"] - a["mean"]
    m2 = a["m2"] + b["m2"] + d * d * na * nb / n
    m3 = a["m3"] + b["m3"] + d * d * d * na * nb * (na - nb) / (n * n) + 3 * d * (na * b["m2"] - nb * a["m2"]) / n
    m4 = (
        a["m4"]
        + b["m4"]
        + d * d * d * d * na * nb * (na * na - na * nb + nb * nb) / (n * n * n)
        + 6 * d * d * (na * na * b["m2"] + nb * nb * a["m2"]) / (n * n)
        + 4 * d * (na * b["m3"] - nb * a["m3"]) / n
    )
    return _struct(
        n=n,
        mean=a["mean"] + d * nb / n,
        m2=m2,
        m3=m3,
        m4=m4,
        min=F.least(a["min"], b["min"]),
        max=F.greatest(a["max"], b["max"]),
        sum=a["sum"] + b["sum"],
    )


def _folded(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    gathered = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, "moments"))).alias("parts"))
    parts = F.col("parts.moments")
    return gathered.select(*keys, F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.get(parts, F.lit(0)), _merge).alias("moments"))


def record_moments(segments: DataFrame, scale: Scale) -> DataFrame:
    """label, id, sid, moments: those of its segments, combined in their order.

    In two steps: of `scale.fan` segments at once, then of the blocks these make, so a task never gathers more
    than `fan` segments or one row per block of a record.
    """
    width = scale.segment * scale.fan
    rows = segments.filter(F.col("moments").isNotNull()).select(
        *RECORD_KEY, "start", F.floor(F.col("start") / width).alias("block"), "moments"
    )
    blocks = _folded(rows, [*RECORD_KEY, "block"], "start")
    return _folded(blocks, RECORD_KEY, "block")


def moment_statistics() -> list[Column]:
    """The eight statistics as `features.statistics` has them, from `moments`."""
    m = {name: F.col("moments")[name] for name in FIELDS}
    variance = F.when(m["n"] > 1, m["m2"] / (m["n"] - 1))
    uneven = ~(m["m2"] == 0)  # NaN is
    return [
        m["mean"].alias("mean"),
        m["min"].alias("min"),
        m["max"].alias("max"),
        F.sqrt(variance).alias("stdev"),
        F.when(uneven, m["n"] * m["m4"] / (m["m2"] * m["m2"]) - 3).alias("kurt"),
        F.when(uneven, F.sqrt(m["n"]) * m["m3"] / F.sqrt(m["m2"] * m["m2"] * m["m2"])).alias("skew"),
        variance.alias("variance"),
        m["sum"].alias("sum"),
    ]
