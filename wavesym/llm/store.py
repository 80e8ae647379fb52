"""Files that tasks write to, and tables that stages leave in, the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wavesym.sources.staging import Staging


def uri_of(path: str) -> str:
    if "://" in path:
        return path
    return "file://" + path.removeprefix("file:")


def filesystem_of(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri_of(path))


def new_file(folder: str, stem: str, suffix: str) -> str:
    """A path that no other attempt of the task writes to."""
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def make_folder(folder: str) -> None:
    filesystem, path = filesystem_of(folder)
    filesystem.create_dir(path, recursive=True)


def open_write(path: str):
    filesystem, path = filesystem_of(path)
    return filesystem.open_output_stream(path, compression=None)


def open_read(path: str):
    filesystem, path = filesystem_of(path)
    return filesystem.open_input_file(path)


class Work(Staging):
    """Staged tables of one operator call; `drop` removes one that no later pass reads."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        self._paths: dict[int, str] = {}

    def table(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        path = self.folder(name)
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, table: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
