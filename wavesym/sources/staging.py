"""Intermediate tables, written once to the shared folder and read back by column.

A table that several passes read is written as Parquet under the folder the cluster names in
``spark.checkpoint.dir``: lost executors cost no recomputation, and each pass reads only the
columns it needs.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="wavesym-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; where none is named, a temporary one, if everything runs in this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


class Staging:
    """A private folder for the tables of one run; as a context manager it is removed at the end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark).rstrip('/')}/wavesym-{uuid.uuid4().hex}"
        self._tables = 0
        self._named: list[str] = []

    def folder(self, name: str) -> str:
        self._tables += 1
        return f"{self.path}/{self._tables:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """Like `table`, one file per bucket of `key`: joins and groups by it need no exchange afterwards.

        A bucket is written and read by one task: `df` holds no hot key.
        """
        table = f"wavesym_{uuid.uuid4().hex}"
        rows = df.repartition(buckets, key)
        rows.write.bucketBy(buckets, key).sortBy(key).option("path", self.folder(name)).saveAsTable(table)
        self._named.append(table)
        return self.spark.table(table)

    def remove(self) -> None:
        for table in self._named:
            self.spark.sql(f"drop table if exists {table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *exc) -> None:
        self.remove()
