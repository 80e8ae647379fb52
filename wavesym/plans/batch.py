"""A batch from messages to features, and on to predictions and one result row."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wavesym.operators.evaluation import confusion, metrics, split_by_id
from wavesym.operators.features import (
    distance_features,
    distance_sums,
    feature_table,
    feature_vector,
    merge_lengths,
    segment_descriptives,
)
from wavesym.operators.segments import record_sizes
from wavesym.operators.skew import key_sizes
from wavesym.operators.symbols import letter_segments, with_breakpoints
from wavesym.operators.templates import match_templates, template_distance
from wavesym.operators.words import transitions
from wavesym.plans.model import score
from wavesym.schemas import RESULT
from wavesym.settings import Scale, Spec
from wavesym.sources.records import ingest
from wavesym.sources.staging import Staging


def transition_table(
    segments: DataFrame, spec: Spec, scale: Scale, staging: Staging
) -> DataFrame:
    """Transition probabilities of every record, from stored segments."""
    ids = key_sizes(segments, ["id"], scale, weight="n")
    lettered = letter_segments(with_breakpoints(segments, spec, scale, staging, ids), spec)
    # without a hot id there is no hot record
    records = ids if ids.hot is None else record_sizes(segments, ["id", "sid"], scale)
    return transitions(lettered, spec, records, in_place=ids.hot is None and ids.n_keys > scale.broadcast_rows)


def distances(
    transition: DataFrame, templates: DataFrame, spec: Spec, scale: Scale
) -> DataFrame:
    """Distance features per record."""
    dist = template_distance(match_templates(transition, templates, spec, scale), spec)
    return distance_features(merge_lengths(distance_sums(dist, spec), spec), spec)


def features(
    segments: DataFrame,
    templates: DataFrame,
    spec: Spec,
    scale: Scale,
    staging: Staging,
    transition: DataFrame | None = None,
) -> DataFrame:
    """The feature table of stored segments, against stored templates.

    `transition` is their transition table, where it is there already.
    """
    if transition is None:
        transition = transition_table(segments, spec, scale, staging)
    return feature_table(
        segment_descriptives(segments, scale), distances(transition, templates, spec, scale), spec
    )


@dataclass(frozen=True)
class Classifier:
    """What a batch is compared and scored with; loaded once per run, not once per batch."""

    templates: DataFrame
    model: CrossValidatorModel
    test_ids: list[str] | Column | None = None  # None: score every record
    spec: Spec = field(default_factory=Spec)
    scale: Scale = field(default_factory=Scale)


@dataclass(frozen=True)
class BatchOutput:
    features: DataFrame
    predictions: DataFrame
    rejects: DataFrame  # label, id, sid, text, reason
    result: DataFrame  # one row, schema RESULT
    transitions: DataFrame | None = None  # only if asked for


def run_batch(
    messages: DataFrame,
    classifier: Classifier,
    staging: Staging,
    batch_id: int = 0,
    keep_transitions: bool = False,
) -> BatchOutput:
    """`keep_transitions` stores the transition table of every record, for a sink of its own."""
    started = time.time()
    spec, scale = classifier.spec, classifier.scale
    counts: dict[str, int] = {}
    segments, rejects = ingest(messages, spec, scale, staging, counts)
    ingested = time.time()
    transition = None
    if keep_transitions:
        transition = staging.table(transition_table(segments, spec, scale, staging), "transitions")
    seen = Observation()
    table = features(segments, classifier.templates, spec, scale, staging, transition)
    table = staging.table(table.observe(seen, F.count(F.lit(1)).alias("records")), "features")
    described = time.time()
    vectors = feature_vector(table, spec)
    # with an empty list of test ids every record with an id is on the first side
    rest, chosen = split_by_id(vectors, [] if classifier.test_ids is None else classifier.test_ids)
    predictions = score(classifier.model, rest if classifier.test_ids is None else chosen)
    row = metrics(confusion(predictions), ["total"]).first()
    scored = now = time.time()
    result = [
        (
            batch_id,
            int(now * 1000),
            now - started,
            ingested - started,
            described - ingested,
            scored - described,
            counts["messages"],
            counts["messages"] - counts["rejects"],
            counts["rejects"],
            counts["points"],
            seen.get["records"],
            row.total,
            row.accuracy,
            row.sensitivity,
            row.specificity,
            row.f1,
        )
    ]
    result = messages.sparkSession.createDataFrame(result, RESULT)
    return BatchOutput(table, predictions, rejects, result, transition)
