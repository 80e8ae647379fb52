"""Hand-made records with known results."""

import json
import math

import pytest
from pyspark.sql import functions as F

from wavesym import Scale, Spec
from wavesym.operators import segments, smoothing, symbols
from wavesym.operators.breakpoints import breakpoints
from wavesym.operators.features import (
    descriptives,
    distance_features,
    distance_sums,
    feature_vector,
    merge_lengths,
    values,
)
from wavesym.plans.batch import transition_table
from wavesym.sources.records import decode, ingest, parse_messages, read_messages
from wavesym.sources.staging import Staging

SPEC, SCALE = Spec(), Scale()


@pytest.fixture(scope="module")
def staging(spark):
    with Staging(spark) as s:
        yield s


def stored(spark, staging, *records):
    df = spark.createDataFrame(
        [(la, i, s, [float(v) for v in d]) for la, i, s, d in records],
        "label string, id string, sid string, data array<double>",
    )
    return staging.table(segments.segments_of_records(df, SPEC, SCALE), "segments")


def letters(made, staging):
    cut = symbols.with_breakpoints(made, SPEC, SCALE, staging)
    rows = symbols.point_symbols(cut, SPEC).orderBy("id", "sid", "pos").collect()
    return "".join(r.SAX for r in rows)


def test_ramp(spark, staging):
    made = stored(spark, staging, ("1", "r", "s", range(1, 9)))
    smoothed = smoothing.moving_average(made, SPEC, SCALE, staging)
    means = [r.smoothed_x for r in smoothed.orderBy("pos").collect()]
    assert means == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5]
    cuts = breakpoints(smoothed, SPEC, SCALE, staging).first()
    assert cuts.quantiles == [1.5, 2.5, 3.0, 4.0]
    # 4 lies on the last cut: the upper letter
    assert letters(made, staging) == "ABDEEEEE"


def test_the_frame_is_seventeen_rows(spark, staging):
    made = stored(spark, staging, ("1", "r", "s", [1000] + [0] * 20))
    rows = smoothing.moving_average(made, SPEC, SCALE, staging).orderBy("pos").collect()
    assert [r.smoothed_x > 0 for r in rows] == [True] * 17 + [False] * 4


def test_constant(spark, staging):
    made = stored(spark, staging, ("0", "c", "s", [5] * 8))
    assert letters(made, staging) == "EEEEEEEE"
    row = descriptives(values(made)).first()
    assert (row.mean, row.stdev, row.variance, row.range) == (5.0, 0.0, 0.0, 0.0)
    assert row.kurt is None and row["skew"] is None


def test_single_point(spark, staging):
    made = stored(spark, staging, ("0", "p", "s", [3.5]))
    assert letters(made, staging) == "E"
    row = descriptives(values(made)).first()
    assert (row.mean, row.sum, row.range) == (3.5, 3.5, 0.0)
    assert [row[c] for c in ("stdev", "variance", "kurt", "skew")] == [None] * 4
    two = Spec(word_lengths=(2, 3))
    found = transition_table(made, two, SCALE, staging).collect()
    assert [(r.word_length, r.SEQ, r.A, r.E) for r in found] == [(2, "E", 0.0, 0.0)]


def test_records_as_short_as_a_prefix(spark, staging):
    made = stored(spark, staging, ("0", "x", "s", [1, 2, 3, 4, 5]), ("0", "y", "s", [1, 2, 3, 4]))
    found = transition_table(made, SPEC, SCALE, staging).collect()
    assert [(r.id, r.word_length, len(r.SEQ)) for r in found] == [("x", 6, 5)]
    assert [found[0][c] for c in "ABCDE"] == [0.0] * 5
    assert bytes.fromhex(found[0].HEX).decode() == found[0].SEQ


def test_two_sids_share_breakpoints_and_the_average_but_not_words(spark, staging):
    made = stored(spark, staging, ("0", "i", "a", [0] * 6), ("0", "i", "b", [90] * 6))
    rows = smoothing.moving_average(made, SPEC, SCALE, staging).orderBy("sid", "pos").collect()
    assert rows[6].smoothed_x == pytest.approx(90 / 7)
    found = transition_table(made, SPEC, SCALE, staging).collect()
    assert all(len(set(r.SEQ)) == 1 for r in found)


def test_a_gap_in_length_seven_drops_the_record(spark):
    rows = [("1", "i", "s", 6, "AAAAA", 1, 0.5), ("1", "j", "s", 6, "AAAAA", 1, 0.5)]
    rows += [("1", "j", "s", 7, "AAAAAA", 1, 0.25), ("1", "j", "s", 7, "AAAAAB", 1, 0.25)]
    df = spark.createDataFrame(
        rows, "label string, id string, sid string, word_length int, SEQ string, weight long, dist double"
    )
    got = distance_features(merge_lengths(distance_sums(df, SPEC), SPEC), SPEC).collect()
    assert [r.id for r in got] == ["j"]
    # one distance of length 6 meets two of length 7: twice 0.5 and once 0.25 + 0.25 over two pairs
    assert got[0].dist6 == pytest.approx(math.sqrt(1.0) / 2)
    assert got[0].dist7 == pytest.approx(math.sqrt(0.5) / 2)


def test_undefined_statistics_are_nan_in_the_vector(spark):
    names = ["mean", "min", "max", "stdev", "kurt", "skew", "variance", "sum", "range"]
    schema = "label string, id string, sid string, " + ", ".join(
        f"{n} double" for n in [*names, "dist6", "dist7"]
    )
    row = ("1", "i", "s", 5.0, 5.0, 5.0, 0.0, None, None, 0.0, 40.0, 0.0, 0.1, 0.2)
    vector = feature_vector(spark.createDataFrame([row], schema), SPEC).first().features
    assert vector.size == 11 and math.isnan(vector[4]) and math.isnan(vector[5])
    assert list(vector)[:4] == [5.0, 5.0, 5.0, 0.0] and vector[10] == 0.2


# ---- ingest -----------------------------------------------------------------------------------


def message(**fields):
    return json.dumps({"label": "1", "id": "i", "sid": "s", "data": "1,2", **fields})


@pytest.mark.parametrize(
    "text, reason, values",
    [
        (message(data="1,x,3"), "bad_number", None),
        (message(data="1,2,,"), None, [1.0, 2.0]),
        (message(data=" 1 ,-2.5e1"), None, [1.0, -25.0]),
        (message(data="1,,3"), "bad_number", None),
        (message(data=""), "bad_number", None),
        (message(data=",,"), "no_points", None),
        (message(data=None), "null_data", None),
        (message(sid=None), "null_key", None),
        (message(id=None), "null_key", None),
        (message(label=None), "null_key", None),
        ("garbage", "bad_json", None),
        ('{"other": 1}', "bad_json", None),
        ('{"label": 1, "id": 7, "sid": 2, "data": "4"}', None, [4.0]),
    ],
)
def test_decode(spark, text, reason, values):
    df = spark.createDataFrame([(text,)], "value string")
    row = decode(parse_messages(df)).first()
    assert row.reason == reason
    if reason is None:
        assert row.data == values


def test_rejects_keep_their_text_and_need_no_second_read(spark, staging, tmp_path):
    lines = [message(id="a"), message(id="a"), "garbage", message(id="b", data="1,x")]
    (tmp_path / "in.txt").write_text("\n".join(lines))
    _, bad = ingest(read_messages(spark, str(tmp_path)), SPEC, SCALE, staging)
    assert sorted((r.reason, r.text) for r in bad.collect()) == [
        ("bad_json", "garbage"), ("bad_number", "1,x"), ("duplicate_key", "1,2"), ("duplicate_key", "1,2")
    ]
    assert all(staging.path in path for path in bad.inputFiles())


def test_points_of_two_labels_are_left_out(spark, staging):
    rows = [("01"[t % 2], "i", "s", t, 1.0) for t in range(10)]
    rows += [(None if t else "1", "j", "s", t, 1.0) for t in range(3)]
    rows += [("1", "k", "s", t, float(t)) for t in range(4)] + [(None, "l", "s", 0, 2.0)]
    points = spark.createDataFrame(rows, "label string, id string, sid string, t long, x double")
    for scale in (SCALE, Scale(broadcast_rows=0, hot_rows=3, segment=64)):
        made = segments.segments_of_points(points, ["t"], SPEC, scale, staging)
        got = sorted((r.id, r.pos, r.x) for r in segments.explode_points(made).collect())
        assert got == [("k", 0, 0.0), ("k", 1, 1.0), ("k", 2, 2.0), ("k", 3, 3.0), ("l", 0, 2.0)]


def test_arrays_and_blank_messages(spark):
    two = f'[{message(id="a")}, {message(id="b")}]'
    df = spark.createDataFrame([(two,), ("",), ("  ",), (message(id="c"),), ("[1",)], "value string")
    rows = decode(parse_messages(df)).collect()
    assert [(r.id, r.reason) for r in rows] == [
        ("a", None), ("b", None), ("c", None), (None, "bad_json")
    ]


def test_a_bad_record_does_not_fail_the_batch(spark, staging, tmp_path):
    lines = [
        message(id="a"),
        message(id="b", data="1,x"),
        message(id="c", label="0"),
        message(id="c", label="1", data="9"),
        message(id="d"),
        message(id="d"),
        message(id="e", sid="t", data=",".join("7" * 9000)),
        "{",
    ]
    (tmp_path / "in.txt").write_text("\n".join(lines))
    tight = Scale(broadcast_rows=0, segment=64)
    for scale in (SCALE, tight):
        good, bad = ingest(read_messages(spark, str(tmp_path)), SPEC, scale, staging)
        points = good.groupBy("id").agg(F.sum("n").alias("n")).collect()
        assert {r.id: r.n for r in points} == {"a": 2, "e": 9000}
        reasons = sorted((r.reason, r.id or "", r.text or "") for r in bad.collect())
        assert reasons == [
            ("bad_json", "", "{"),
            ("bad_number", "b", "1,x"),
            ("duplicate_key", "c", "1,2"),
            ("duplicate_key", "c", "9"),
            ("duplicate_key", "d", "1,2"),
            ("duplicate_key", "d", "1,2"),
        ]
