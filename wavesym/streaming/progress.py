"""What a stream reports of each batch, kept as a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = "run string, batch_id long, n_input long, trigger_ms long, batch_ms long"


class ProgressLog(StreamingQueryListener):
    """Collects the progress of every query of the session while it is attached (`with ProgressLog(spark) as log`)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._rows: dict[tuple[str, int], tuple] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        spent = p.durationMs
        row = str(p.runId), p.batchId, p.numInputRows, spent.get("triggerExecution"), spent.get("addBatch")
        if p.numInputRows:  # an idle trigger reports no batch of its own
            with self._lock:
                self._rows[row[:2]] = row

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60) -> bool:
        """Until the end of a run is reported; reports come in order, so all its batches are there then."""
        return self._event(run).wait(seconds)

    def table(self) -> DataFrame:
        with self._lock:
            return self.spark.createDataFrame(list(self._rows.values()), PROGRESS)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)
