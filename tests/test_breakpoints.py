"""Breakpoints of ids with few and with many points, against plain Python."""

import math
import random

import pytest

from wavesym.operators.breakpoints import breakpoints
from wavesym.settings import Scale, Spec
from wavesym.sources.staging import Staging

SPEC = Spec()


def wanted(points):
    """The least value that leaves no larger share above it; NaN is the greatest."""
    xs = sorted(points, key=lambda x: (math.isnan(x), x))
    n = len(xs)
    return [xs[max(n - math.floor(n - p * n), 1) - 1] for p in SPEC.probs]


@pytest.fixture(scope="module")
def points():
    draw = random.Random(5)
    sizes = {"one": 1, "four": 4, "five": 5, "some": 60, "more": 61, "many": 900}
    made = {k: [draw.choice([draw.gauss(0, 9), draw.uniform(1e6, 2e6), 3.0]) for _ in range(n)] for k, n in sizes.items()}
    made["some"][:20] = [math.nan] * 20
    return made


@pytest.mark.parametrize("gathered,hot_rows", [(65_536, 4_000_000), (60, 4_000_000), (65_536, 60), (0, 4_000_000)])
@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_few_and_many_points(spark, points, gathered, hot_rows, broadcast_rows):
    df = spark.createDataFrame([(k, x) for k, xs in points.items() for x in xs], "id string, smoothed_x double").repartition(7)
    scale = Scale(gathered=gathered, hot_rows=hot_rows, broadcast_rows=broadcast_rows)
    got = {r.id: [str(q) for q in r.quantiles] for r in breakpoints(df, SPEC, scale, Staging(spark)).collect()}
    assert got == {k: [str(q) for q in wanted(xs)] for k, xs in points.items()}


def test_nulls_come_first_and_are_no_cut(spark):
    rows = [("a", None)] * 3 + [("a", x) for x in (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)] + [("none", None)]
    df = spark.createDataFrame(rows, "id string, smoothed_x double")
    got = [
        {r.id: r.quantiles for r in breakpoints(df, SPEC, Scale(gathered=n), Staging(spark)).collect()} for n in (0, 100)
    ]
    assert got[0] == got[1] == {"a": [1.0, 3.0, 5.0]}


def test_few_points_are_read_once(spark, points):
    """Neither a join with the bins that hold a cut nor a rank over points: that took most of a run of many ids."""
    df = spark.createDataFrame([(k, x) for k, xs in points.items() for x in xs], "id string, smoothed_x double")
    plan = breakpoints(df, SPEC, Scale(), Staging(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
