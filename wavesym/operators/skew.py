"""Joins and row numbers that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavesym.settings import Scale
from wavesym.sources.staging import Staging


@dataclass(frozen=True)
class KeySizes:
    """Row counts per key: a lazy table plus the three totals that decide the strategy."""

    keys: tuple[str, ...]
    table: DataFrame  # keys, n
    n_keys: int
    rows: int
    largest: int
    scale: Scale

    @property
    def limit(self) -> int:
        return self.scale.hot_rows

    @cached_property
    def hot(self) -> DataFrame | None:
        """Keys above the limit, with their counts, as a stored table; None if there is none."""
        if self.largest <= self.limit:
            return None
        return Staging(self.table.sparkSession).table(self.table.filter(F.col("n") > self.limit), "hot-keys")

    @cached_property
    def few_hot(self) -> bool:
        return self.hot is not None and self.hot.count() <= self.scale.hot_keys

    def hinted(self, hot: DataFrame) -> DataFrame:
        """A table of the hot keys for a join: broadcast where they are few."""
        return F.broadcast(hot) if self.few_hot else hot


def key_sizes(df: DataFrame, keys: list[str], scale: Scale, weight: str | None = None) -> KeySizes:
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return totals(df.groupBy(*keys).agg(n.cast("long").alias("n")), keys, scale)


def totals(table: DataFrame, keys: list[str], scale: Scale) -> KeySizes:
    """Key sizes from a table that has one row per key already (keys, n)."""
    total = table.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
    ).first()
    return KeySizes(tuple(keys), table, total.n_keys, total.rows, total.largest, scale)


def join_per_key(
    big: DataFrame,
    small: DataFrame,
    sizes: KeySizes,
    spread: list[str] | None,
    how: str = "inner",
    small_rows: int | None = None,
) -> DataFrame:
    """Join `small` to the rows of `big`, whose key counts are `sizes`.

    `small` has at most one row per key, or `small_rows` rows. Few rows: it is broadcast. Otherwise
    both sides are shuffled by key, and a hot key is cut into as many salts as it holds limits;
    `spread` names the columns that deal its rows out. None deals them out by their place in the
    table, copies too; `big` must then come straight from a stored table, whose order is fixed.
    """
    keys = list(sizes.keys)
    if (sizes.n_keys if small_rows is None else small_rows) <= sizes.scale.broadcast_rows:
        return big.join(F.broadcast(small), keys, how)
    hot = sizes.hot
    if hot is None:
        return big.join(small, keys, how)
    salts = sizes.hinted(hot.select(*keys, F.ceil(F.col("n") / sizes.limit).alias("_salts")))
    n_salts = F.coalesce("_salts", F.lit(1))
    deal = F.xxhash64(*spread) if spread else F.monotonically_increasing_id()
    big = big.join(salts, keys, "left").withColumn("_salt", F.pmod(deal, n_salts))
    small = small.join(salts, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), n_salts - 1))
    )
    return big.drop("_salts").join(small.drop("_salts"), [*keys, "_salt"], how).drop("_salt")


def positions(
    df: DataFrame,
    group: list[str],
    order: list[str | Column],
    name: str,
    scale: Scale,
    staging: Staging,
    cold: bool = False,
    sizes: KeySizes | None = None,
) -> DataFrame:
    """Add the 0-based rank of each row inside its group; `group` holds no nulls.

    `cold` says that no group is known to be hot; otherwise the groups are counted first,
    unless their `sizes` are given.
    Ordinary groups take one window. Rows of hot groups are sorted across tasks by range, numbered
    inside each range, and moved up by the rows of their group in earlier ranges. Rows that are
    equal in group and order, in whatever number, are told apart by their place in `df`.
    """
    inside = Window.partitionBy(*group).orderBy(*order)
    number = (F.row_number().over(inside).cast("long") - 1).alias(name)
    if cold:
        return df.select("*", number)
    sizes = sizes or key_sizes(df, group, scale)
    hot = sizes.hot
    if hot is None:
        return df.select("*", number)
    hot_keys = sizes.hinted(hot.select(*group))
    cold = df.join(hot_keys, group, "left_anti").select(*df.columns, number)

    n_ranges = max(1, ceil(hot.agg(F.sum("n")).first()[0] / sizes.limit) * 2)
    ranged = (
        df.join(hot_keys, group, "left_semi")
        .withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(n_ranges, *group, *order, "_place")
        .withColumn("_range", F.spark_partition_id())
    )
    # written out, so that the ranges are facts for both passes below
    ranged = staging.table(ranged, "ranges")
    by_range = Window.partitionBy(*group).orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    # one row per range and hot group in it: at most n_ranges + the number of hot groups
    offsets = (
        ranged.groupBy(*group, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    in_range = Window.partitionBy("_range", *group).orderBy(*order, "_place")
    spread = (
        ranged.withColumn("_row", F.row_number().over(in_range).cast("long") - 1)
        .join(F.broadcast(offsets), [*group, "_range"])
        .select(*df.columns, (F.col("_offset") + F.col("_row")).alias(name))
    )
    return cold.unionByName(spread)
