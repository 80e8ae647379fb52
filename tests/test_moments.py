"""Moments combined from segments against those of the points."""

import random

import pytest
from pyspark.sql import functions as F

from wavesym import Scale, Spec
from wavesym.operators.features import descriptives, segment_descriptives, values
from wavesym.operators.segments import segments_of_records
from wavesym.sources.staging import Staging

SPEC = Spec()
RECORDS = "label string, id string, sid string, data array<double>"


def records(spark):
    rng = random.Random(6)
    rows = [
        ("1", "far", "s", [1e9 + rng.gauss(0, 1) for _ in range(900)]),
        ("1", "jump", "s", [rng.gauss(0, 1) + 1000 * (k // 100) for k in range(1000)]),
        ("0", "same", "s", [0.1] * 333),
        ("0", "one", "s", [3.5]),
        ("0", "two", "s", [1.0, 2.0]),
        ("1", "mixed", "s", [0.3] * 64 + [rng.expovariate(1) for _ in range(50)]),
        ("1", "none", "s", []),
        ("1", "null", "s", None),
        ("0", "nan", "s", [1.0, float("nan"), 2.0] * 30),
        *[("1", f"r{k}", f"s{k % 3}", [rng.gauss(5, 2) for _ in range(rng.randrange(1, 300))]) for k in range(40)],
    ]
    return spark.createDataFrame(rows, RECORDS)


@pytest.mark.parametrize("segment,fan", [(4096, 4096), (32, 4096), (32, 3), (32, 1)])
def test_combined_moments_are_those_of_the_points(spark, segment, fan):
    scale = Scale(segment=segment, fan=fan)
    with Staging(spark) as staging:
        made = staging.table(segments_of_records(records(spark), SPEC, scale), "segments")
        got = {r.id: r for r in segment_descriptives(made, scale).collect()}
        want = {r.id: r for r in descriptives(values(made)).collect()}
        assert got.keys() == want.keys()
        for i, row in want.items():
            for g, w in zip(got[i], row):
                if isinstance(w, float):
                    assert g == pytest.approx(w, rel=1e-9, abs=1e-6 if i == "far" else 1e-9, nan_ok=True), (i, got[i], row)
                else:
                    assert g == w, (i, got[i], row)


def test_points_are_not_read_again(spark):
    with Staging(spark) as staging:
        made = staging.table(segments_of_records(records(spark), SPEC, Scale()), "segments")
        plan = segment_descriptives(made, Scale())._jdf.queryExecution().executedPlan().toString()
        schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
        assert schemas and not any("data:" in line for line in schemas)
        assert made.filter(F.col("moments.n") != F.col("n")).isEmpty()
