"""Several sinks of a batch that become visible together.

Every attempt at a batch writes its tables to folders of its own. A small file, renamed into place when all of them
are written, names the folders that hold the batch; readers look at these files only. An attempt that dies leaves
folders that no reader sees, and a batch that is delivered again after its commit is not written again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "commits"


def _hadoop(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(output: str, batch_id: int) -> str:
    return f"{output}/{COMMITS}/batch-{batch_id:012d}.json"


def is_committed(spark: SparkSession, output: str, batch_id: int) -> bool:
    path, files = _hadoop(spark, _manifest(output, batch_id))
    return files.exists(path)


def write_sinks(sinks: dict[str, DataFrame], output: str, batch_id: int, after=None) -> None:
    """Write the tables of a batch and commit them; `after(name)` is called when a table is written.

    Tables get a column `batch_id`. A committed batch is left as it is.
    """
    spark = next(iter(sinks.values())).sparkSession
    if is_committed(spark, output, batch_id):
        return
    attempt, paths = uuid.uuid4().hex, {}
    for name, table in sinks.items():
        paths[name] = f"{output}/{name}/batch-{batch_id:012d}-{attempt}"
        table.drop("batch_id").withColumn("batch_id", F.lit(batch_id).cast("long")).write.parquet(paths[name])
        if after is not None:
            after(name)
    text = json.dumps({"batch_id": batch_id, "attempt": attempt, "sinks": paths})
    hidden, files = _hadoop(spark, f"{output}/{COMMITS}/_{attempt}.tmp")
    out = files.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(hidden, _hadoop(spark, _manifest(output, batch_id))[0]):
        files.delete(hidden, False)  # another attempt was first


def committed(spark: SparkSession, output: str) -> DataFrame:
    """batch_id, attempt, sinks (name to folder): a row per committed batch."""
    schema = "batch_id long, attempt string, sinks map<string, string>"
    path, files = _hadoop(spark, f"{output}/{COMMITS}")
    if not files.exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "batch-*.json").json(f"{output}/{COMMITS}")


def read_sink(spark: SparkSession, output: str, name: str) -> DataFrame | None:
    """All committed batches of a sink, None if there is none."""
    folders = [r.path for r in committed(spark, output).select(F.col("sinks")[name].alias("path")).collect() if r.path]
    return spark.read.parquet(*folders) if folders else None


def read_last(spark: SparkSession, output: str, name: str) -> DataFrame | None:
    """The sink's table of the last committed batch that has one."""
    path = F.col("sinks")[name]
    last = committed(spark, output).filter(path.isNotNull()).orderBy(F.desc("batch_id")).select(path.alias("path")).first()
    return spark.read.parquet(last.path) if last else None
