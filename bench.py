"""Time the headline queries; prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from wavesym.catalog import QUERIES, batch_output

HEADLINE = [
    "ingest_records",
    "moving_average",
    "quantile_breakpoints",
    "quantiles_hot",
    "ordered_points",
    "sax_symbols",
    "transition_probs",
    "template_build",
    "template_distance",
    "distance_features",
    "stats_window",
    "descriptives",
    "feature_table",
    "metrics",
    "rf_train",
    "rf_score",
    "pipeline_batch",
    "stream_features",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wavesym-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="wavesym-bench-"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the engine
    seconds, batch = {}, None
    for name in HEADLINE:
        started = time.time()
        result = QUERIES[name](spark, folder)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        if name == "pipeline_batch":
            # one row: the time from messages to metrics, without training
            row = batch_output(spark, folder).result.first()
            batch = {"seconds": round(row.duration_s, 3), "records": row.n_records}
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "batch": batch,
                "sf": float(scale.group(1)) if scale else folder,
                "cores": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
