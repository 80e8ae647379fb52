"""Globally ordered results: stored in sorted files, one range of the keys each, read back with their positions.

Sorting writes one file per range, so no task sees more than a range. The position of a row is its place in its
file plus the rows of the files before it; reading needs no sort and no exchange of rows, only one count per file.
A stretch of positions is read from the files that hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavesym.settings import Scale


def store_ordered(df: DataFrame, keys: list[str | Column], path: str, files: int | None = None) -> None:
    """Write `df` in the order of `keys`; rows with equal keys stay in one file, in no particular order.

    `files` fixes the number of ranges; by default the session's shuffle partitions hold, fewer for few rows.
    """
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.parquet(path)


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows with `_part`, `_cut` (the file's number, and of a file cut by size the number of its part) and
    `_row` (place in the file)."""
    name = F.col("_metadata.file_name")
    return spark.read.schema(schema).parquet(path).select(
        "*",
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("_part"),
        F.coalesce(F.regexp_extract(name, r"[.-]c(\d+)\.", 1).try_cast("long"), F.lit(0)).alias("_cut"),
        F.col("_metadata.row_index").alias("_row"),
        F.col("_metadata.file_path").alias("_path"),
    )


def file_positions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """_part, _cut, path, first, rows: a row per file with the position of its first row. Reads no column."""
    counts = _rows(spark, path, schema).groupBy("_part", "_cut").agg(
        F.first("_path").alias("path"), F.count(F.lit(1)).alias("rows")
    )
    # one row per file; the files are as many as the tasks that wrote them
    before = Window.orderBy("_part", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_part", "_cut", "path", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"), "rows")


def read_ordered(spark: SparkSession, path: str, schema: T.StructType, scale: Scale) -> DataFrame:
    """The rows with `position`, counted from 1."""
    files = file_positions(spark, path, schema).select("_part", "_cut", "first")
    if files.count() <= scale.broadcast_rows:
        files = F.broadcast(files)
    placed = _rows(spark, path, schema).join(files, ["_part", "_cut"])
    return placed.select(*schema.names, (F.col("first") + F.col("_row") + 1).alias("position"))


def read_positions(spark: SparkSession, path: str, schema: T.StructType, first: int, last: int) -> DataFrame:
    """The rows at positions `first` to `last` (counted from 1, both included), from the files that hold them."""
    files = file_positions(spark, path, schema)
    held = files.filter((F.col("first") < last) & (F.col("first") + F.col("rows") >= first)).collect()  # files of the stretch
    if not held:
        return spark.createDataFrame([], schema).withColumn("position", F.lit(0).cast("long"))
    names = F.create_map(*[F.lit(x) for f in held for x in (f.path, f.first)])
    rows = spark.read.schema(schema).parquet(*[f.path for f in held])
    position = names[F.col("_metadata.file_path")] + F.col("_metadata.row_index") + 1
    return rows.select("*", position.alias("position")).filter(F.col("position").between(first, last))
