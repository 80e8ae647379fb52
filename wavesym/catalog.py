"""Every operator as a query over the tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property
from math import ceil

from pyspark.errors import StreamingQueryException
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wavesym.functions import sql as sql_functions
from wavesym.operators import breakpoints as bp
from wavesym.operators import evaluation, segments, smoothing, symbols, words
from wavesym.operators import features as ft
from wavesym.operators import templates as tp
from wavesym.operators.ordering import read_ordered, store_ordered
from wavesym.operators.skew import key_sizes
from wavesym.plans import batch, model
from wavesym.schemas import DESCRIPTIVES, RECORD_KEY, RESULT, feature_names
from wavesym.settings import Scale, Spec
from wavesym.sources import commits, records, results, tables
from wavesym.sources.staging import Staging
from wavesym.streaming.progress import ProgressLog
from wavesym.streaming.run import classify_stream

SPEC = Spec()
SCALE = Scale()
COHORT = "cast(id as bigint) % 10 = 0"  # the records that templates are made of; all are compared with them
TEST_RULE = "cast(id as bigint) % 7 = 0"  # which ids test; a rule over all ids
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]


# ---- inputs -----------------------------------------------------------------------------------


class Run:
    """The tables one query builds on, each written once when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, source: str, spec: Spec = SPEC):
        self.spark, self.folder, self.source, self.spec = spark, folder, source, spec
        self.staging = Staging(spark)

    def lazy_segments(self) -> DataFrame:
        if self.source == "embeddings":
            records_ = tables.embedding_records(self.spark, self.folder)
            return segments.segments_of_records(records_, self.spec, SCALE)
        points, order = {
            "events": (tables.event_points, tables.EVENT_ORDER),
            "lineitem": (tables.lineitem_points, tables.LINEITEM_ORDER),
        }[self.source]
        return segments.segments_of_points(
            points(self.spark, self.folder), order, self.spec, SCALE, self.staging
        )

    @cached_property
    def segments(self) -> DataFrame:
        return self.staging.table(self.lazy_segments(), "segments")

    def smoothed(self) -> DataFrame:
        return smoothing.moving_average(self.segments, self.spec, SCALE, self.staging)

    def cut_segments(self) -> DataFrame:
        return symbols.with_breakpoints(self.segments, self.spec, SCALE, self.staging)

    def lettered(self) -> DataFrame:
        return symbols.letter_segments(self.cut_segments(), self.spec)

    def transitions(self, segments_: DataFrame | None = None) -> DataFrame:
        segments_ = self.segments if segments_ is None else segments_
        return batch.transition_table(segments_, self.spec, SCALE, self.staging)

    def word_columns(self, a: int) -> DataFrame:
        return words.word_columns(words.sliding_words(self.lettered(), a), a)

    def templates(self, segments_: DataFrame) -> DataFrame:
        """Pooled templates of the cohort."""
        table = self.transitions(segments_.filter(COHORT))
        return self.staging.table(tp.build_templates(table, self.spec), "templates")

    def matched(self) -> DataFrame:
        stored = self.segments
        subjects = self.transitions(stored)
        return tp.match_templates(subjects, self.templates(stored), self.spec, SCALE)

    def distances(self) -> DataFrame:
        return tp.template_distance(self.matched(), self.spec)

    def features(self, templates: DataFrame | None = None) -> DataFrame:
        stored = self.segments
        templates = self.templates(stored) if templates is None else templates
        return batch.features(stored, templates, self.spec, SCALE, self.staging)


def tidy(column: Column) -> Column:
    """Six digits; moved off exact ties, which the noise of another summation order would decide."""
    return F.round(column + 1e-9, DIGITS)


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: tidy(F.col(c)) for c in columns})


def quantile_columns(df: DataFrame) -> DataFrame:
    cuts = [
        tidy(F.get("quantiles", F.lit(i))).alias(f"q{i + 1}")
        for i in range(len(SPEC.probs))
    ]
    return df.select("id", *cuts)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return tables.to_messages(tables.embedding_records(spark, folder))


def flawed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All records as messages, some of them spoilt: one id in 97 for each kind of flaw."""
    records_ = tables.embedding_records(spark, folder)
    kind = F.col("id").cast("bigint") % 97
    text = tables.format_series(F.col("data"))
    data = (
        F.when(kind == 2, F.concat(text, F.lit(",x")))
        .when(kind == 5, F.concat(text, F.lit(",,")))
        .otherwise(text)
    )
    sid = F.when(kind != 3, F.col("sid"))
    body = F.to_json(F.struct("label", "id", sid.alias("sid"), data.alias("data")))
    value = F.when(kind == 1, F.concat(F.lit("not json "), F.col("id"))).otherwise(body)
    copies = F.when(kind == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return records_.select(value.alias("value"), F.explode(copies).alias("copy")).select("value")


# ---- sources and sinks ------------------------------------------------------------------------


def ingest_records(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = records.ingest(flawed_messages(spark, folder), SPEC, SCALE, Staging(spark))
    return segments.explode_points(good)


def ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = records.ingest(flawed_messages(spark, folder), SPEC, SCALE, Staging(spark))
    return described_rejects(bad)


def described_rejects(bad: DataFrame) -> DataFrame:
    """The rejects with their texts taken apart, so that engines need not write numbers alike."""
    parts = F.split("text", ",")
    return bad.select(
        "reason",
        *RECORD_KEY,
        F.when(F.col("reason") == "bad_json", F.col("text")).alias("message"),
        F.size(parts).cast("long").alias("n_parts"),
        tidy(F.get(parts, F.lit(0)).try_cast("double")).alias("first"),
        F.when(F.col("reason") == "bad_number", F.element_at(parts, -1)).alias("last"),
    )


def batch_profile(spark: SparkSession, folder: str) -> DataFrame:
    good, bad = records.ingest(flawed_messages(spark, folder), SPEC, SCALE, Staging(spark))
    sizes = good.select((F.col("start") == 0).alias("good"), F.lit(False).alias("bad"), "n")
    both = sizes.unionByName(
        bad.select(F.lit(False).alias("good"), F.lit(True).alias("bad"), F.lit(0).alias("n"))
    )
    return both.agg(
        F.count_if(F.col("good") | F.col("bad")).alias("n_messages"),
        F.count_if("good").alias("n_records"),
        F.count_if("bad").alias("n_rejects"),
        F.sum("n").alias("n_points"),
    )


def schema_profile(spark: SparkSession, folder: str) -> DataFrame:
    return results.schema_profile(spark.read.parquet(f"{folder}/events.parquet"))


def result_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches of results in a log, the second delivered twice, and the latest on its own."""
    staging = Staging(spark)
    log, latest = staging.folder("log"), staging.folder("latest")
    guesses = staging.table(labelled_guesses(spark, folder), "guesses")
    for batch_id in (0, 1, 1, 2):
        part = guesses.filter(F.col("id").cast("bigint") % 3 == batch_id)
        row = staging.table(evaluation.metrics(evaluation.confusion(part)), "result")
        results.write_batch(row, log, batch_id)
        results.write_latest(row.withColumn("batch_id", F.lit(batch_id).cast("long")), latest)
    names = ["accuracy", "sensitivity", "specificity", "f1"]
    sinks = {"log": results.read_log(spark, log, RESULT), "latest": spark.read.parquet(latest)}
    both = [df.select(F.lit(sink).alias("sink"), "batch_id", *names) for sink, df in sinks.items()]
    return rounded(both[0].unionByName(both[1]), names)


def transition_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Transition tables of three batches of records, the second delivered twice."""
    run = Run(spark, folder, "events")
    path = run.staging.folder("sink")
    for batch_id in (0, 1, 1, 2):
        part = run.segments.filter(F.col("id").cast("bigint") % 3 == batch_id)
        results.write_batch(run.transitions(part), path, batch_id)
    stored = spark.read.parquet(path)
    return stored.withColumn("batch_id", F.col("batch_id").cast("long"))


# ---- points, smoothing, letters ---------------------------------------------------------------


def explode_points(spark: SparkSession, folder: str) -> DataFrame:
    return segments.explode_points(Run(spark, folder, "lineitem").lazy_segments())


def moving_average(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(Run(spark, folder, "lineitem").smoothed(), ["smoothed_x"])


def quantile_breakpoints(spark: SparkSession, folder: str) -> DataFrame:
    run = Run(spark, folder, "lineitem")
    stored = run.segments
    sizes = key_sizes(stored, ["id"], SCALE, weight="n")
    smoothed = smoothing.moving_average(stored, SPEC, SCALE, run.staging, sizes)
    return quantile_columns(bp.breakpoints(smoothed, SPEC, SCALE, run.staging, sizes))


def quantiles_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Breakpoints of ids whose records arrive in two batches: each batch has its own, nothing is carried over."""
    run = Run(spark, folder, "events")
    batches = []
    for batch_id in (0, 1):
        part = run.segments.filter((F.length("sid") % 2) == batch_id)
        smoothed = smoothing.moving_average(part, SPEC, SCALE, run.staging)
        cuts = quantile_columns(bp.breakpoints(smoothed, SPEC, SCALE, run.staging))
        batches.append(cuts.withColumn("batch_id", F.lit(batch_id).cast("long")))
    return batches[0].unionByName(batches[1])


def hot_points(spark: SparkSession, folder: str) -> DataFrame:
    """All prices, seven suppliers of ten taken together as one id: it holds most points."""
    hot = F.when(F.col("l_suppkey") % 10 < 7, F.lit("hot")).otherwise(F.col("l_suppkey").cast("string"))
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    return items.select(hot.alias("id"), F.col("l_extendedprice").cast("double").alias("smoothed_x"))


def quantiles_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles where one id holds most points, which are ranked in finer and finer bins of few points."""
    scale = replace(SCALE, hot_rows=200, broadcast_rows=0)
    return quantile_columns(bp.breakpoints(hot_points(spark, folder), SPEC, scale, Staging(spark)))


def ordered(df: DataFrame, keys: list[str], staging: Staging) -> DataFrame:
    """The rows of `df` with their positions in the order of `keys`, from a stored result in that order."""
    path = staging.folder("ordered")
    store_ordered(df, keys, path)
    return read_ordered(df.sparkSession, path, df.schema, SCALE)


def quantiles_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Plain SQL over a view of the smoothed points, its rows in the order of id."""
    run = Run(spark, folder, "events")
    view = f"smoothed_{uuid.uuid4().hex}"
    run.smoothed().createOrReplaceTempView(view)
    names = [f"q{i + 1}" for i in range(len(SPEC.probs))]
    cuts = ", ".join(f"approx_percentile(smoothed_x, {p}D, {SPEC.accuracy}) as {n}" for n, p in zip(names, SPEC.probs))
    found = rounded(spark.sql(f"select id, {cuts} from {view} group by id"), names)
    return ordered(found, ["id"], run.staging)


def ordered_points(spark: SparkSession, folder: str) -> DataFrame:
    """Every point with its position in the order of value, id, sid and place."""
    run = Run(spark, folder, "events")
    return ordered(segments.explode_points(run.segments), ["x", "id", "sid", "pos"], run.staging)


def sax_symbols(spark: SparkSession, folder: str) -> DataFrame:
    lettered = symbols.point_symbols(Run(spark, folder, "lineitem").cut_segments(), SPEC)
    return lettered.withColumnRenamed("SAX", "letter")


# ---- words and transitions --------------------------------------------------------------------


def sax_words(spark: SparkSession, folder: str) -> DataFrame:
    return words.sliding_words(Run(spark, folder, "events").lettered(), 6)


def word_columns(spark: SparkSession, folder: str) -> DataFrame:
    return Run(spark, folder, "events").word_columns(6)


def prefix_totals(spark: SparkSession, folder: str) -> DataFrame:
    return words.prefix_totals(Run(spark, folder, "events").word_columns(6), 6)


def transition_counts(spark: SparkSession, folder: str) -> DataFrame:
    return words.transition_counts(Run(spark, folder, "events").word_columns(6), 6)


def transition_pivot(spark: SparkSession, folder: str) -> DataFrame:
    counts = words.transition_counts(Run(spark, folder, "events").word_columns(6), 6)
    return words.transition_pivot(counts, 6, SPEC)


def transition_probs(spark: SparkSession, folder: str) -> DataFrame:
    spec = replace(SPEC, word_lengths=(2, 3, 6, 7))
    return Run(spark, folder, "lineitem", spec).transitions()


def word_keys(spark: SparkSession, folder: str) -> DataFrame:
    found = Run(spark, folder, "lineitem").transitions()
    return found.groupBy("word_length", "SEQ", "HEX").agg(F.count(F.lit(1)).alias("n_records"))


# ---- templates and distances ------------------------------------------------------------------


def template_build(spark: SparkSession, folder: str) -> DataFrame:
    run = Run(spark, folder, "lineitem")
    built = tp.build_templates(run.transitions(run.segments.filter(COHORT)), SPEC)
    return rounded(built, list(SPEC.letters)).drop("weight")


def template_rows(spark: SparkSession, folder: str) -> DataFrame:
    run = Run(spark, folder, "events")
    return tp.build_templates(run.transitions(run.segments.filter(COHORT)), SPEC, mode="rows")


def template_read(spark: SparkSession, folder: str) -> DataFrame:
    run = Run(spark, folder, "events")
    built = tp.build_templates(run.transitions(run.segments.filter(COHORT)), SPEC).drop("weight")
    path = run.staging.folder("collection")
    stored = built.withColumn("_id", F.sha2(F.concat("word_length", "SEQ"), 256))
    for a in (*SPEC.word_lengths, SPEC.word_lengths[-1]):  # a batch for each length, the last one twice
        tp.write_templates(stored.filter(F.col("word_length") == a), path, batch_id=a)
    return rounded(tp.read_templates(spark, path, SPEC), list(SPEC.letters)).drop("weight")


def template_match(spark: SparkSession, folder: str) -> DataFrame:
    matched = Run(spark, folder, "events").matched().drop("weight", "HEX")
    return rounded(matched, [f"t{c}" for c in SPEC.letters])


def template_distance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(Run(spark, folder, "lineitem").distances().drop("weight"), ["dist"])


def distances_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The distances as text alone: named views per word length, and the point functions as SQL functions."""
    run = Run(spark, folder, "events")
    sql_functions.register(spark, SPEC)
    tag = uuid.uuid4().hex
    run.transitions().createOrReplaceTempView(f"shares_{tag}")
    run.templates(run.segments).createOrReplaceTempView(f"pooled_{tag}")
    vector = f"array({', '.join(SPEC.letters)})"
    parts = []
    for a in SPEC.word_lengths:
        for name, columns in ((f"shares_{tag}", "label, id, sid, SEQ"), (f"pooled_{tag}", "SEQ")):
            spark.sql(
                f"create or replace temporary view {name}_{a} as "
                f"select {columns}, {vector} as v from {name} where word_length = {a}"
            )
        parts.append(
            f"select label, id, sid, {a} as word_length, SEQ, round(wave_distance(s.v, t.v) + 1e-9D, {DIGITS}) as dist "
            f"from shares_{tag}_{a} s join pooled_{tag}_{a} t using (SEQ)"
        )
    return spark.sql(" union all ".join(parts))


def letters_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Texts to numbers to letters in SQL text: each vector's values against the cuts of its smoothed series."""
    run = Run(spark, folder, "embeddings")
    sql_functions.register(spark, SPEC)
    tag = uuid.uuid4().hex
    text = tables.format_series(F.col("data")).alias("text")
    tables.embedding_records(spark, folder).select("id", text).createOrReplaceTempView(f"series_{tag}")
    cuts = bp.breakpoints(run.smoothed(), SPEC, SCALE, run.staging)
    run.staging.table(cuts, "cuts").createOrReplaceTempView(f"cuts_{tag}")
    return spark.sql(
        f"select id, pos, wave_letter(x, quantiles) as letter from (select id, wave_series(text) as data from series_{tag}) "
        f"join cuts_{tag} using (id) lateral view posexplode(data) as pos, x"
    )


# ---- features ---------------------------------------------------------------------------------


def merge_lengths(spark: SparkSession, folder: str) -> DataFrame:
    sums = ft.distance_sums(Run(spark, folder, "events").distances(), SPEC)
    merged = ft.merge_lengths(sums, SPEC)
    return rounded(merged, [f"dist{a}_total" for a in SPEC.word_lengths])


def distance_reduce(spark: SparkSession, folder: str) -> DataFrame:
    distances = Run(spark, folder, "events").distances()
    return rounded(ft.reduced_distances(distances), ["dist"])


def distance_features(spark: SparkSession, folder: str) -> DataFrame:
    merged = ft.merge_lengths(
        ft.distance_sums(Run(spark, folder, "lineitem").distances(), SPEC), SPEC
    )
    return rounded(
        ft.distance_features(merged, SPEC), [f"dist{a}" for a in SPEC.word_lengths]
    )


def stats_window(spark: SparkSession, folder: str) -> DataFrame:
    run = Run(spark, folder, "events")
    return rounded(ft.point_statistics(run.segments, SCALE), DESCRIPTIVES[:-1])


def descriptives(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ft.descriptives(tables.event_points(spark, folder)), DESCRIPTIVES)


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    names = feature_names(SPEC.word_lengths)
    table = Run(spark, folder, "lineitem").features()
    # of the order of 1e9: six digits are beyond what a double holds
    variance = F.round(F.col("variance") + 1e-4, 2).alias("variance")
    return table.select(
        *RECORD_KEY, *[variance if n == "variance" else tidy(F.col(n)).alias(n) for n in names]
    )


def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    vectors = ft.feature_vector(Run(spark, folder, "events").features(), SPEC)
    names = feature_names(SPEC.word_lengths)
    values = vectors.withColumn("v", vector_to_array("features"))
    return values.select(
        *RECORD_KEY,
        *[tidy(F.get("v", F.lit(i))).alias(f"f{i + 1}") for i in range(len(names))],
    )


# ---- model and metrics ------------------------------------------------------------------------


def labelled_guesses(spark: SparkSession, folder: str) -> DataFrame:
    """A deterministic prediction per record: is its mean price above 50000?"""
    points = tables.lineitem_points(spark, folder)
    return points.groupBy(*RECORD_KEY).agg(
        F.when(F.avg("x") > 50000, 1.0).otherwise(0.0).alias("prediction")
    ).withColumn("label", F.col("label").try_cast("int"))


def split_by_id(spark: SparkSession, folder: str) -> DataFrame:
    described = ft.descriptives(tables.event_points(spark, folder))
    training, testing = evaluation.split_by_id(described.select(*RECORD_KEY), F.expr(TEST_RULE))
    return training.withColumn("part", F.lit("training")).unionByName(
        testing.withColumn("part", F.lit("testing"))
    )


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion(labelled_guesses(spark, folder))


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        evaluation.metrics(evaluation.confusion(labelled_guesses(spark, folder))),
        ["accuracy", "acc", "precision", "recall", "sensitivity", "specificity", "f1"],
    )


def stored_features(run: Run) -> DataFrame:
    return run.staging.table(ft.feature_vector(run.features(), SPEC), "vectors")


def rf_train(spark: SparkSession, folder: str) -> DataFrame:
    """Train the forest; the rows that each fold trained and validated on."""
    vectors = stored_features(Run(spark, folder, "embeddings"))
    training, _ = evaluation.split_by_id(vectors, F.expr(TEST_RULE))
    folds = model.train(training).getNumFolds()
    return model.fold_sizes(model.with_folds(training.filter("label is not null"), folds), folds)


def stored_scores(spark: SparkSession, folder: str, parameters: dict) -> tuple[CrossValidatorModel, DataFrame]:
    """Train on one side of the split, store the model, load it and score the other side: the model and all scores."""
    run = Run(spark, folder, "embeddings")
    training, testing = evaluation.split_by_id(stored_features(run), F.expr(TEST_RULE))
    path = run.staging.folder("model")
    model.save(model.train(training, parameters=parameters), path)
    loaded = model.load(path)
    return loaded, model.score(loaded, testing)


def shares(scored: DataFrame) -> DataFrame:
    """label, id, sid, the probabilities of the classes as p0 and p1, and the prediction."""
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("probability")
    columns = [tidy(F.get(p, F.lit(k))).alias(f"p{k}") for k in range(2)]
    return scored.select(*RECORD_KEY, *columns, "prediction")


def rf_score(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities and prediction of every test record by the stored forest."""
    return shares(stored_scores(spark, folder, model.FOREST)[1])


def stump_score(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a forest of one split, which SQL can find as well."""
    return shares(stored_scores(spark, folder, model.STUMP)[1])


def trained_classifier(run: Run, test_ids: Column | None, parameters: dict = model.FOREST) -> batch.Classifier:
    templates = run.templates(run.segments)
    table = run.features(templates)
    vectors = run.staging.table(ft.feature_vector(table, SPEC), "vectors")
    training, _ = evaluation.split_by_id(vectors, F.expr(TEST_RULE))
    fitted = model.train(training, parameters=parameters)
    return batch.Classifier(templates, fitted, test_ids, SPEC, SCALE)


def batch_output(spark: SparkSession, folder: str, parameters: dict = model.FOREST) -> batch.BatchOutput:
    run = Run(spark, folder, "embeddings")
    classifier = trained_classifier(run, F.expr(TEST_RULE), parameters)
    return batch.run_batch(flawed_messages(spark, folder), classifier, run.staging)


def pipeline_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch with spoilt messages, from texts to metrics, by a forest of one split."""
    names = ["accuracy", "sensitivity", "specificity", "f1"]
    return rounded(batch_output(spark, folder, model.STUMP).result.select("batch_id", "n_scored", *names), names)


def batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in and out of the stages of a batch, seen by the passes that do the work."""
    done = batch_output(spark, folder, model.STUMP)
    stages = "'messages', n_messages, 'records', n_records, 'rejects', n_rejects, 'points', n_points, 'features', n_features, 'scored', n_scored"
    return done.result.selectExpr("batch_id", f"stack(6, {stages}) as (stage, n)")


class Streamed:
    """A stream of messages in some four batches of files; equal messages are in one file.

    Its classifier is a forest of one split: the streams' queries ask for features, rejects and counts, or for scores
    that SQL can state.
    """

    def __init__(self, spark: SparkSession, folder: str, texts: DataFrame, parameters: dict = model.STUMP):
        self.spark = spark
        run = Run(spark, folder, "embeddings")
        self.inbox, self.output, self.checkpoint = (
            run.staging.folder(n) for n in ("inbox", "output", "checkpoint")
        )
        part = F.pmod(F.xxhash64("value"), F.lit(4)).alias("part")
        texts.select("value", part).repartition("value").write.partitionBy("part").text(self.inbox)
        self.per_batch = max(1, ceil(len(spark.read.text(self.inbox).inputFiles()) / 4))
        self.classifier = trained_classifier(run, None, parameters)

    def start(self, after: Callable[[int, str], None] | None = None) -> StreamingQuery:
        stream = records.stream_messages(self.spark, self.inbox, files_per_batch=self.per_batch)
        return classify_stream(stream, self.classifier, self.output, self.checkpoint, available_now=True, after=after)

    def sink(self, name: str) -> DataFrame:
        return commits.read_sink(self.spark, self.output, name)


def finished(stream: Streamed) -> Streamed:
    stream.start().awaitTermination()
    return stream


def stream_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of all records, from a stream of messages."""
    names = feature_names(SPEC.word_lengths)
    log = finished(Streamed(spark, folder, messages(spark, folder))).sink("features")
    return rounded(log.select(*RECORD_KEY, *names), names)


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a stream of messages sets aside."""
    return described_rejects(finished(Streamed(spark, folder, flawed_messages(spark, folder))).sink("rejects"))


class Stopped(Exception):
    """Raised in a query to stop a stream between two sinks."""


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that dies in its second batch, between two sinks, and goes on from its checkpoint.

    Every record's prediction, and how many committed batches have it: the dead attempt has left no trace.
    """
    stream = Streamed(spark, folder, messages(spark, folder))

    def fail(batch_id: int, sink: str) -> None:
        if (batch_id, sink) == (1, "features"):
            raise Stopped(f"after {sink} of batch {batch_id}")

    try:
        stream.start(fail).awaitTermination()
    except StreamingQueryException:
        pass
    finished(stream)
    seen = stream.sink("features").groupBy(*RECORD_KEY).agg(F.count(F.lit(1)).alias("n_features"))
    scored = shares(stream.sink("predictions")).withColumn("label", F.col("label").cast("string"))
    return scored.join(seen, RECORD_KEY)


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of what the batches of a stream say of themselves, over those that its listener was told of."""
    stream = Streamed(spark, folder, flawed_messages(spark, folder))
    with ProgressLog(spark) as log:
        query = stream.start()
        query.awaitTermination()
        log.wait(str(query.runId))
        told = log.table().filter(F.col("run") == str(query.runId))
    batches = told.select("batch_id").distinct()  # what was not told is missing in the sums
    names = ["n_messages", "n_records", "n_rejects", "n_points", "n_features"]
    return stream.sink("results").join(batches, "batch_id").agg(*[F.sum(c).alias(c) for c in names])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        ingest_records,
        ingest_rejects,
        batch_profile,
        schema_profile,
        result_sink,
        transition_sink,
        explode_points,
        moving_average,
        quantile_breakpoints,
        quantiles_by_batch,
        quantiles_hot,
        quantiles_sql,
        ordered_points,
        sax_symbols,
        sax_words,
        word_columns,
        prefix_totals,
        transition_counts,
        transition_pivot,
        transition_probs,
        word_keys,
        template_build,
        template_rows,
        template_read,
        template_match,
        template_distance,
        distances_sql,
        letters_sql,
        merge_lengths,
        distance_reduce,
        distance_features,
        stats_window,
        descriptives,
        feature_table,
        feature_vector,
        split_by_id,
        confusion,
        metrics,
        rf_train,
        rf_score,
        stump_score,
        pipeline_batch,
        batch_metrics,
        stream_features,
        stream_rejects,
        stream_restart,
        stream_progress,
    )
}
