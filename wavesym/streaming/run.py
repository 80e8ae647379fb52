"""The batch plan on a stream of messages.

Breakpoints, words and statistics belong to one micro-batch: nothing is carried to the next, so an
id whose records arrive in two batches has two sets of breakpoints. All outputs of a batch become
visible together, and a batch that is delivered again after that is not worked on again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wavesym.plans.batch import Classifier, run_batch
from wavesym.sources.commits import is_committed, write_sinks
from wavesym.sources.staging import Staging


def classify_stream(
    messages: DataFrame,
    classifier: Classifier,
    output: str,
    checkpoint: str,
    interval: str = "5 seconds",
    available_now: bool = False,
    transitions: bool = False,
    after: Callable[[int, str], None] | None = None,
) -> StreamingQuery:
    """Start the query. Its sinks below `output` are `features`, `predictions`, `rejects` and `results`,
    `transitions` too if asked for; `sources.commits` reads them. `after(batch_id, sink)` is called when the
    table of a sink is written, before the batch is committed.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty() or is_committed(batch.sparkSession, output, batch_id):
            return
        with Staging(batch.sparkSession) as staging:
            done = run_batch(batch, classifier, staging, batch_id, transitions)
            sinks = {"features": done.features, "predictions": done.predictions, "rejects": done.rejects}
            if done.transitions is not None:
                sinks["transitions"] = done.transitions
            sinks["results"] = done.result
            write_sinks(sinks, output, batch_id, after and (lambda sink: after(batch_id, sink)))

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        messages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
