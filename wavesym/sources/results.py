"""Where results go: one folder per batch, and the latest result on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append a batch to the log at `path`; writing the same batch again replaces it."""
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_latest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log with `batch_id` from the folder names."""
    fields = [f for f in schema.fields if f.name != "batch_id"]
    whole = T.StructType([*fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(whole).parquet(path)


def schema_profile(df: DataFrame) -> DataFrame:
    """The schema of a collection as rows (position, column, type) with the nulls of each."""
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col(f"n{i}").alias("n_null"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    return df.agg(*counts).select(F.inline(described))
