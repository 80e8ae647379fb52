"""Series taken from ordinary tables: single points with an order, arrays, or JSON messages.

Each function returns ``label, id, sid`` and either ``x`` plus the columns that order a record's
points, or the whole series as ``data``. Rows without a full key or a value are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavesym.functions.columns import format_series
from wavesym.schemas import RECORD_KEY

EVENT_ORDER = ["ts", "event_id"]
LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "x"]


def _points(df: DataFrame, subject: str, sid: str, x: str, order: list[str]) -> DataFrame:
    return df.filter(
        F.col(subject).isNotNull() & F.col(sid).isNotNull() & F.col(x).isNotNull()
    ).select(
        (F.col(subject) % 2).cast("string").alias("label"),
        F.col(subject).cast("string").alias("id"),
        F.col(sid).alias("sid"),
        F.col(x).alias("x"),
        *[c for c in order if c != "x"],
    )


def event_points(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    return _points(events, "user_id", "event_type", "value", EVENT_ORDER)


def lineitem_points(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    return _points(items, "l_suppkey", "l_returnflag", "l_extendedprice", LINEITEM_ORDER)


def embedding_records(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(
        (F.col("label") % 2).cast("string").alias("label"),
        F.col("vec_id").cast("string").alias("id"),
        F.lit("w0").alias("sid"),
        F.col("embedding").cast("array<double>").alias("data"),
    )


def to_messages(records: DataFrame) -> DataFrame:
    """One JSON text per record, in column `value`."""
    text = format_series(F.col("data")).alias("data")
    return records.select(F.to_json(F.struct(*RECORD_KEY, text)).alias("value"))
