"""The stream against the batch, replays, ids split over batches, and the stored model."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wavesym.catalog import Run, trained_classifier
from wavesym.operators.evaluation import split_by_id
from wavesym.operators.features import feature_vector
from wavesym.operators.symbols import point_symbols, with_breakpoints
from wavesym.plans import batch, model
from wavesym.schemas import RESULT
from wavesym.sources import commits, results, tables
from wavesym.sources.records import ingest, stream_messages
from wavesym.sources.staging import Staging, shared_folder
from wavesym.streaming.progress import ProgressLog
from wavesym.streaming.run import classify_stream

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    return Run(spark, FOLDER, "embeddings")


@pytest.fixture(scope="module")
def classifier(run):
    return trained_classifier(run, None)


@pytest.fixture(scope="module")
def messages(spark):
    return tables.to_messages(tables.embedding_records(spark, FOLDER))


def stream(spark, classifier, inbox, output, checkpoint):
    source = stream_messages(spark, inbox, files_per_batch=1)
    query = classify_stream(source, classifier, output, checkpoint, available_now=True)
    query.awaitTermination()


def test_stream_equals_batch(spark, run, classifier, messages):
    inbox, output, checkpoint = (run.staging.folder(n) for n in ("in", "out", "cp"))
    messages.repartition(3).write.text(inbox)
    stream(spark, classifier, inbox, output, checkpoint)
    whole = batch.run_batch(messages, classifier, run.staging)
    got = {r.id: r for r in commits.read_sink(spark, output, "features").drop("batch_id").collect()}
    want = whole.features.collect()
    assert len(got) == len(want) > 0
    for r in want:
        # the sums of distances may be added up in another order
        assert tuple(got[r.id])[:3] == tuple(r)[:3]
        assert tuple(got[r.id])[3:] == pytest.approx(tuple(r)[3:], rel=1e-12)
    rows = commits.read_sink(spark, output, "results").orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2]
    assert sum(r.n_records for r in rows) == messages.count()
    assert sum(r.n_features for r in rows) == sum(r.n_scored for r in rows) == len(want)
    assert whole.result.first().n_records == messages.count()
    latest = commits.read_last(spark, output, "results").collect()
    assert [r.batch_id for r in latest] == [2]
    # nothing new: no batch; one more file: one more batch
    stream(spark, classifier, inbox, output, checkpoint)
    assert commits.committed(spark, output).count() == 3
    messages.limit(20).coalesce(1).write.mode("append").text(inbox)
    stream(spark, classifier, inbox, output, checkpoint)
    assert commits.read_sink(spark, output, "results").count() == 4
    assert all(r.duration_s >= r.ingest_s + r.features_s + r.score_s > 0 for r in rows)
    scored = commits.read_sink(spark, output, "predictions").filter("batch_id < 3")
    assert scored.count() == len(want) and scored.filter("prediction is null").count() == 0
    assert commits.read_sink(spark, output, "rejects").count() == 0


def test_sinks_of_a_batch_become_visible_together(spark, run):
    output = run.staging.folder("sinks")
    assert commits.read_sink(spark, output, "a") is None and commits.read_last(spark, output, "a") is None

    def sinks(value):
        return {name: spark.range(value, value + 2).toDF(name) for name in "ab"}

    commits.write_sinks(sinks(0), output, 0)

    def fail(name):
        raise RuntimeError(name)

    with pytest.raises(RuntimeError, match="a"):
        commits.write_sinks(sinks(10), output, 1, fail)
    assert {n: commits.read_sink(spark, output, n).count() for n in "ab"} == {"a": 2, "b": 2}
    commits.write_sinks(sinks(20), output, 1)
    commits.write_sinks(sinks(30), output, 1)  # delivered again after its commit
    assert sorted(r.b for r in commits.read_sink(spark, output, "b").collect()) == [0, 1, 20, 21]
    assert sorted(tuple(r) for r in commits.read_last(spark, output, "a").collect()) == [(20, 1), (21, 1)]


def test_a_stream_that_dies_between_two_sinks_goes_on(spark, run, classifier, messages):
    inbox, output, checkpoint = (run.staging.folder(n) for n in ("in", "out", "cp"))
    messages.limit(60).repartition(3).write.text(inbox)
    written = []

    def fail(batch_id, sink):
        written.append((batch_id, sink))
        if (batch_id, sink) == (1, "predictions"):
            raise RuntimeError("dies")

    source = stream_messages(spark, inbox, files_per_batch=1)
    query = classify_stream(source, classifier, output, checkpoint, available_now=True, after=fail)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert (1, "features") in written and (1, "results") not in written
    for sink in ("features", "predictions", "results"):
        assert {r.batch_id for r in commits.read_sink(spark, output, sink).select("batch_id").collect()} == {0}
    with ProgressLog(spark) as log:
        query = classify_stream(source, classifier, output, checkpoint, available_now=True)
        query.awaitTermination()
        assert log.wait(str(query.runId))
        told = log.table().filter(F.col("run") == str(query.runId)).collect()
    assert {r.batch_id for r in told} == {1, 2} and all(r.trigger_ms >= r.batch_ms > 0 for r in told)
    assert commits.read_sink(spark, output, "results").agg(F.sum("n_messages")).first()[0] == 60
    features = commits.read_sink(spark, output, "features")
    assert features.count() == features.select("id", "sid").distinct().count()


def test_transitions_are_a_sink_if_asked_for(run, classifier, messages):
    done = batch.run_batch(messages, classifier, run.staging, keep_transitions=True)
    want = run.transitions().select(done.transitions.columns)
    assert done.transitions.count() == want.count() > 0
    assert done.transitions.exceptAll(want).count() == 0
    assert batch.run_batch(messages, classifier, run.staging).transitions is None


def test_empty_batches_leave_no_result(spark, run, classifier, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("")
    out = str(tmp_path / "out")
    stream(spark, classifier, str(tmp_path / "in"), out, str(tmp_path / "cp"))
    assert commits.read_sink(spark, out, "results") is None


def test_an_id_in_two_batches_has_two_sets_of_breakpoints(spark, run, classifier):
    def one(sid, low):
        data = ",".join(str(low + (7 * i) % 11) for i in range(40))
        return json.dumps({"label": "1", "id": "1", "sid": sid, "data": data})

    def letters(lines):
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        with Staging(spark) as staging:
            made, _ = ingest(df, classifier.spec, classifier.scale, staging)
            cut = with_breakpoints(made, classifier.spec, classifier.scale, staging)
            rows = point_symbols(cut, classifier.spec).orderBy("sid", "pos").collect()
            return "".join(r.SAX for r in rows)

    low, high = one("a", 0), one("b", 1000)
    together = letters([low, high])
    apart = letters([low]) + letters([high])
    assert together != apart
    # the same shape on its own gets the same letters at any height
    assert apart[:40] == apart[40:]


def test_replayed_batches_replace_themselves(spark, run):
    path = run.staging.folder("log")
    for batch_id, value in ((0, 0.1), (1, 0.2), (1, 0.3)):
        row = spark.createDataFrame([(batch_id, 5, 1.0, 0.5, 0.3, 0.2, 1, 1, 0, 9, 1, 1, *[value] * 4)], RESULT)
        results.write_batch(row, path, batch_id)
    log = results.read_log(spark, path, RESULT).orderBy("batch_id").collect()
    assert [(r.batch_id, r.accuracy) for r in log] == [(0, 0.1), (1, 0.3)]


def test_a_stored_model_scores_alike(run):
    vectors = run.staging.table(feature_vector(run.features(), run.spec), "vectors")
    training, testing = split_by_id(vectors, [str(i) for i in range(0, 500, 7)])
    fitted = model.train(training, folds=2)
    path = run.staging.folder("model")
    model.save(fitted, path)
    loaded = model.load(path)
    names = ["id", "sid", "prediction", F.col("probability").cast("string").alias("p")]
    one, two = (model.score(m, testing).select(names) for m in (fitted, loaded))
    assert one.count() > 0 and one.exceptAll(two).count() == 0
    assert loaded.getNumFolds() == 2
    forest = loaded.bestModel.stages[0]
    assert (forest.getNumTrees, forest.getMaxDepth(), forest.numFeatures) == (40, 5, 11)
    assert (forest.getImpurity(), forest.getSeed()) == ("gini", 207336481)


def test_the_same_rows_give_the_same_forest(run):
    """Folds and draws go by the rows, not by how they lie in partitions."""
    vectors = run.staging.table(feature_vector(run.features(), run.spec), "vectors")
    training, testing = split_by_id(vectors, [str(i) for i in range(0, 500, 7)])
    layouts = [training, training.repartition(7), training.orderBy(F.desc("id")).coalesce(2)]
    fits = [model.train(t, folds=3) for t in layouts]
    assert len({f.bestModel.stages[0]._java_obj.toDebugString().split("\n", 1)[1] for f in fits}) == 1
    assert len({f.avgMetrics[0] for f in fits}) == 1
    folded = model.with_folds(training, 3)
    assert folded.groupBy("id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").isEmpty()
    sizes = model.fold_sizes(folded, 3).collect()
    assert sum(r.validation for r in sizes) == training.count() and len(sizes) == 3


def test_staging_folders_are_removed(spark):
    with Staging(spark) as staging:
        kept = staging.table(spark.range(5).toDF("id"), "five")
        assert kept.count() == 5
        path = spark._jvm.org.apache.hadoop.fs.Path(staging.path)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        assert fs.exists(path)
    assert not fs.exists(path)


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        def __init__(self, master):
            self.sparkContext = type("Context", (), {"master": master})()

    assert shared_folder(Session("local[2]")) == shared_folder(Session("local[8]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("local-cluster[2,1,1024]"))
