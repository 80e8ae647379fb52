"""Ingest of waveform messages: parse, decode, and set bad records aside with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavesym.functions.columns import parse_series
from wavesym.operators.segments import segments_of_records
from wavesym.operators.skew import join_per_key, key_sizes
from wavesym.schemas import MESSAGE, RECORD_KEY
from wavesym.settings import Scale, Spec
from wavesym.sources.staging import Staging


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Files of one JSON message per line, as text; `parse_messages` gives them columns."""
    return spark.read.text(path)


def stream_messages(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same files as a stream. A queue source with a string `value` column fits as well."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def parse_messages(messages: DataFrame) -> DataFrame:
    """label, id, sid, data as text, and the whole `message`; numbers become text, malformed JSON nulls.

    As in Spark's JSON reader, a message that is an array holds several records, and a blank one none.
    """
    value = F.col("value").cast("string")
    several = F.from_json(value, T.ArrayType(MESSAGE), {"mode": "PERMISSIVE"})
    return (
        messages.filter(F.length(F.trim(value)) > 0)
        .select(value.alias("message"), F.explode_outer(several).alias("m"))
        .select("m.*", "message")
    )


def decode(parsed: DataFrame) -> DataFrame:
    """label, id, sid, text, data, reason; `reason` is null for a usable record.

    `text` is the series as it came, or the whole message where no field could be read.
    """
    no_field = F.coalesce(*MESSAGE.names).isNull()
    series = parsed.select(
        *RECORD_KEY,
        F.when(no_field, F.col("message")).otherwise(F.col("data")).alias("text"),
        parse_series(F.col("data")).alias("data"),
        no_field.alias("unread"),
    )
    no_key = F.col("label").isNull() | F.col("id").isNull() | F.col("sid").isNull()
    reason = (
        F.when(F.col("unread"), "bad_json")
        .when(no_key, "null_key")
        .when(F.col("text").isNull(), "null_data")
        .when(F.exists("data", lambda e: e.isNull()), "bad_number")
        .when(F.size("data") == 0, "no_points")
    )
    return series.withColumn("reason", reason).drop("unread")


def ingest(
    messages: DataFrame, spec: Spec, scale: Scale, staging: Staging, counts: dict[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(segments, rejects): segments of the usable records, and label, id, sid, text, reason.

    Messages are read and parsed once and written once: segments, of which the first of a record
    keeps its text, and the rejects among them. All later passes read columns of that table.
    `counts` is given what that pass saw: messages, points (of readable messages) and rejects.
    """
    decoded = decode(parse_messages(messages))
    usable = decoded.withColumn("data", F.when(F.col("reason").isNull(), F.col("data")))
    cut = segments_of_records(usable, spec, scale, ["text", "reason"])
    first = F.coalesce("start", F.lit(0)) == 0  # a reject has no start
    good = F.col("reason").isNull()
    seen = Observation()
    watched = cut.withColumn("text", F.when(first, F.col("text"))).observe(
        seen,
        F.count_if(first).alias("messages"),
        F.coalesce(F.sum(F.when(good, F.col("n"))), F.lit(0)).cast("long").alias("points"),
        F.count_if(~good).alias("rejects"),
    )
    table = staging.table(watched, "ingested")
    if counts is not None:
        counts.update(seen.get)
    kept = table.filter("reason is null").drop("text", "reason")
    rejects = table.filter("reason is not null").select(*RECORD_KEY, "text", "reason")

    key = ["id", "sid"]
    sizes = key_sizes(kept.filter("start = 0"), key, scale)
    if sizes.largest <= 1:
        return kept, rejects
    repeated = staging.table(sizes.table.filter("n > 1").select(*key, "n"), "repeated")
    n = repeated.count()
    keys = repeated.select(*key)
    whole = table.filter("reason is null and start = 0").select(*RECORD_KEY, "text")
    copies = join_per_key(whole, keys, sizes, None, "left_semi", small_rows=n)
    copies = copies.select(*RECORD_KEY, "text", F.lit("duplicate_key").alias("reason"))
    if counts is not None:
        counts["rejects"] += repeated.agg(F.sum("n")).first()[0]
    kept = join_per_key(kept, keys, sizes, None, "left_anti", small_rows=n)
    return kept, rejects.unionByName(copies)
