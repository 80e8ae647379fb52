"""The rewritten operators against their literal forms, on the tables."""

import math
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import transition_rows
from wavesym import Spec
from wavesym.catalog import COHORT, SCALE, Run
from wavesym.operators import features as ft
from wavesym.operators import segments, symbols, words
from wavesym.operators import templates as tp
from wavesym.schemas import RECORD_KEY

FOLDER = "/root/testdata/sf0.001"
SPEC = Spec()


@pytest.fixture(scope="module")
def run(spark):
    return Run(spark, FOLDER, "lineitem")


@pytest.fixture(scope="module")
def lettered(run):
    return run.staging.table(run.lettered(), "letters")


@pytest.fixture(scope="module")
def points(run):
    return run.staging.table(symbols.point_symbols(run.cut_segments(), SPEC), "points")


@pytest.fixture(scope="module")
def transitions(run):
    return run.staging.table(run.transitions(), "transitions")


def same(one, two):
    assert one.count() > 0
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


@pytest.mark.parametrize("a", [6, 7])
def test_words_by_window(lettered, points, a):
    following = Window.partitionBy("id", "sid").orderBy("pos").rowsBetween(0, a - 1)
    literal = points.select(
        *RECORD_KEY, "pos", F.array_join(F.collect_list("SAX").over(following), "").alias("word")
    )
    same(words.sliding_words(lettered, a), literal)


@pytest.mark.parametrize("a", [6, 7])
def test_transitions_in_plain_python(points, transitions, lettered, a):
    text = {}
    for r in points.collect():
        text.setdefault((r.label, r.id, r.sid), {})[r.pos] = r.SAX
    want = {}
    for key, at in text.items():
        for prefix, shares in transition_rows("".join(at[i] for i in range(len(at))), a).items():
            if len(prefix) == a - 1:
                want[(*key, prefix)] = shares
    got = {}
    for r in transitions.filter(F.col("word_length") == a).collect():
        assert r.HEX == r.SEQ.encode().hex().upper()
        got[r.label, r.id, r.sid, r.SEQ] = [r.A, r.B, r.C, r.D, r.E]
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    columns = words.word_columns(words.sliding_words(lettered, a), a)
    pivoted = words.transition_pivot(words.transition_counts(columns, a), a, SPEC)
    kept = transitions.filter(F.col("word_length") == a).drop("word_length")
    same(pivoted.na.fill(0.0).select(kept.columns), kept)


def test_shares_sum_to_one_except_for_the_end(transitions):
    total = F.col("A") + F.col("B") + F.col("C") + F.col("D") + F.col("E")
    off = transitions.filter(total > 1 + 1e-12).count()
    short = transitions.filter(total < 1 - 1e-12).groupBy(*RECORD_KEY, "word_length").count()
    assert off == 0
    # only the prefix that ends the record
    assert short.agg(F.max("count")).first()[0] == 1
    records = transitions.select(*RECORD_KEY).distinct().count()
    assert short.count() == records * len(SPEC.word_lengths)


def test_merge_in_plain_python(run, transitions):
    """Every distance of one length beside every one of the other, without making the pairs."""
    templates = run.staging.table(tp.build_templates(transitions.filter(COHORT), SPEC), "templates")
    distances = tp.template_distance(tp.match_templates(transitions, templates, SPEC, SCALE), SPEC)
    distances = run.staging.table(distances, "distances")
    got = ft.distance_features(ft.merge_lengths(ft.distance_sums(distances, SPEC), SPEC), SPEC)
    by = {}
    for r in distances.collect():
        by.setdefault((r.label, r.id, r.sid), {}).setdefault(r.word_length, []).append(r.dist)
    want = {}
    for key, found in by.items():
        if all(a in found for a in SPEC.word_lengths):
            pairs = [(x, y) for x in found[6] for y in found[7]]
            want[key] = [math.sqrt(sum(p[k] for p in pairs)) / len(pairs) for k in (0, 1)]
    rows = got.collect()
    assert len(rows) == len(want) > 0
    for r in rows:
        assert [r.dist6, r.dist7] == pytest.approx(want[r.label, r.id, r.sid], rel=1e-9)


def test_templates_of_single_rows_count_equal_rows_once(run, transitions):
    """Weighted distinct rows give the distances of the repeated rows, broadcast or salted."""
    cohort, subjects = transitions.filter(COHORT), transitions.filter(f"not ({COHORT})")
    rows = run.staging.table(tp.build_templates(cohort, SPEC, mode="rows"), "rows")
    assert rows.agg(F.sum("weight")).first()[0] == cohort.count()
    repeated = cohort.select(
        "word_length", "SEQ", *[F.col(c).alias(f"t{c}") for c in "ABCDE"], F.lit(1).alias("weight")
    )
    literal = ft.distance_sums(
        tp.template_distance(subjects.join(repeated, ["word_length", "SEQ"]), SPEC), SPEC
    )
    want = {tuple(r)[:3]: tuple(r)[3:] for r in literal.collect()}
    for scale in (SCALE, type(SCALE)(broadcast_rows=0, hot_rows=30)):
        dist = tp.template_distance(tp.match_templates(subjects, rows, SPEC, scale), SPEC)
        got = ft.distance_sums(dist, SPEC).collect()
        assert len(got) == len(want)
        for r in got:
            assert tuple(r)[3:] == pytest.approx(want[tuple(r)[:3]], rel=1e-9)


def test_statistics_in_plain_python(run):
    values = {}
    for r in segments.explode_points(run.segments).collect():
        values.setdefault((r.label, r.id, r.sid), []).append(r.x)
    for r in ft.point_statistics(run.segments, SCALE).select(*RECORD_KEY, "pos", "stdev", "sum").collect():
        own = values[r.label, r.id, r.sid]
        assert r["sum"] == pytest.approx(math.fsum(own), rel=1e-9)
        if len(own) > 1:
            assert r.stdev == pytest.approx(statistics.stdev(own), rel=1e-9)
