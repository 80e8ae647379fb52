"""Limits small enough that every skew path is taken give the results of the ordinary paths."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

import fixtures
from wavesym import Scale, Spec
from wavesym.operators import breakpoints as bp
from wavesym.operators import segments, smoothing, symbols, words
from wavesym.operators.features import descriptives, point_statistics, values
from wavesym.operators.skew import join_per_key, key_sizes, positions
from wavesym.plans.batch import transition_table
from wavesym.sources import tables
from wavesym.sources.staging import Staging

SPEC = Spec()
WIDE = Scale()
TIGHT = Scale(segment=32, hot_rows=40, hot_keys=1000, broadcast_rows=0, task_points=(20, 64))
RECORDS = fixtures.series(3, fixtures.SHAPE)


@pytest.fixture(scope="module")
def staging(spark):
    with Staging(spark) as s:
        yield s


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        RECORDS, "label string, id string, sid string, data array<double>"
    )


@pytest.fixture(scope="module")
def points(spark):
    rows = [(la, i, s, float(v), p * 10) for la, i, s, d in RECORDS for p, v in enumerate(d)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "label string, id string, sid string, x double, t int")


def build(kind, records, points, scale, staging):
    if kind == "records":
        made = segments.segments_of_records(records, SPEC, scale)
    else:
        made = segments.segments_of_points(points, ["t"], SPEC, scale, staging)
    return staging.table(made, "segments")


def as_set(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("hot_rows", [3, 40, 10**6])
def test_positions_count_each_group_from_zero(spark, staging, points, hot_rows):
    scale = Scale(hot_rows=hot_rows, hot_keys=1000)
    got = positions(points, ["id", "sid"], ["t"], "pos", scale, staging)
    assert got.count() == points.count()
    assert got.filter("pos * 10 <> t").count() == 0


def test_positions_of_a_table_with_one_key(spark, staging):
    one = spark.range(5000).select(F.lit("k").alias("id"), (F.col("id") * 7 % 5000).alias("t"))
    got = positions(one, ["id"], ["t"], "pos", Scale(hot_rows=100), staging)
    assert got.filter("pos <> t").count() == 0


def test_copies_are_spread_over_the_ranges(spark):
    stored = []

    class Watched(Staging):
        def table(self, df, name):
            stored.append(super().table(df, name))
            return stored[-1]

    copies = spark.range(0, 4000, 1, 8).select(F.lit("k").alias("id"), F.lit(1).alias("t"))
    with Watched(spark) as staging:
        got = positions(copies, ["id"], ["t"], "pos", Scale(hot_rows=500), staging)
        assert sorted(r.pos for r in got.collect()) == list(range(4000))
        sizes = [r["count"] for r in stored[0].groupBy("_range").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 1000


def test_join_deals_copies_out(spark, staging):
    big = staging.table(spark.range(3000).select(F.lit(1).alias("k"), F.lit(2).alias("v")), "big")
    small = spark.createDataFrame([(1, 5)], "k int, w int")
    sizes = key_sizes(big, ["k"], Scale(broadcast_rows=0, hot_rows=100))
    joined = join_per_key(big, small, sizes, None)
    assert joined.count() == 3000
    assert join_per_key(big, small, sizes, None, "left_anti").count() == 0
    assert join_per_key(big, small, sizes, None, "left_semi").count() == 3000


@pytest.mark.parametrize("kind", ["records", "points"])
@pytest.mark.parametrize("scale", [WIDE, TIGHT], ids=["wide", "tight"])
def test_segments_hold_every_point_once(records, points, staging, kind, scale):
    made = build(kind, records, points, scale, staging)
    want = sorted((la, i, s, p, v) for la, i, s, d in RECORDS for p, v in enumerate(d))
    assert as_set(segments.explode_points(made)) == want
    assert made.agg(F.max("n")).first()[0] <= scale.segment
    ends = made.filter("head is not null").count(), made.filter("tail is not null").count()
    assert ends == (len(RECORDS), len(RECORDS))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_records_are_gathered_without_a_sort_of_all_points(spark, staging, points):
    """Sizes by hash; no window numbers the points of records that fit into one segment."""
    assert "SortAggregate" not in plan(segments.labelled_sizes(points))
    assert "Window" not in plan(segments.segments_of_points(points, ["t"], SPEC, WIDE, staging))


def test_labelled_sizes_count_a_null_label_as_one(spark):
    rows = [("a", "1", "s"), ("a", "1", "s"), ("a", "2", "s"), ("b", "2", "s"), ("a", "3", "s"), (None, "3", "s"), (None, "4", "s"), (None, "4", "s")]
    got = segments.labelled_sizes(spark.createDataFrame(rows, "label string, id string, sid string"))
    assert sorted((r.id, r.n, r.mixed) for r in got.collect()) == [("1", 2, False), ("2", 2, True), ("3", 2, True), ("4", 2, False)]


@pytest.mark.parametrize("segment", [32, 64, 4096])
def test_records_of_small_ids_are_not_counted(spark, segment):
    """Points are counted by id alone; a record of several labels (a null counts as one) is left out all the same."""
    stored = []

    class Watched(Staging):
        def table(self, df, name):
            stored.append(name)
            return super().table(df, name)

    labels = {"1": ["a", "a"], "2": ["a", "b"], "3": ["a", None], "4": [None, None], "5": ["b"] * 20, "6": ["b"] * 39 + ["a"]}
    rows = [(la, i, f"s{k % 2}", float(k), k) for i, own in labels.items() for k, la in enumerate([x for x in own for _ in (0, 1)])]
    df = spark.createDataFrame(rows, "label string, id string, sid string, x double, t int")
    with Watched(spark) as staging:
        made = segments.segments_of_points(df, ["t"], SPEC, Scale(segment=segment), staging)
        got = sorted((r.label, r.id, r.sid, r.data) for r in made.filter("label is not null and n <= 20").collect())
        nulls = sorted((r.id, r.sid) for r in made.filter("label is null").collect())
    want = [("a", "1", s, [float(s[1]), 2.0 + int(s[1])]) for s in ("s0", "s1")]
    want += [("b", "5", s, [float(k) for k in range(int(s[1]), 40, 2)]) for s in ("s0", "s1")]
    assert got == want
    assert nulls == [("4", "s0"), ("4", "s1")]
    assert ("records" in stored) == (segment < 80)


def test_prices_are_shuffled_once(spark, tmp_path):
    columns = "0L l_orderkey, 0L l_partkey, 0L l_suppkey, 0 l_linenumber, 1.5D l_extendedprice, 'A' l_returnflag, timestamp'2020-01-01' l_shipdate"
    spark.sql(f"select {columns}").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert tables.lineitem_points(spark, str(tmp_path)).columns.count("x") == 1
    assert "l_extendedprice" not in tables.lineitem_points(spark, str(tmp_path)).columns


@pytest.mark.parametrize("segment,hot_rows", [(32, 4_000_000), (64, 10), (4096, 4_000_000)])
def test_small_and_large_records_together(spark, staging, segment, hot_rows):
    """Short records, long ones, equal points, nulls among the order's columns and a null label in one table."""
    rng = random.Random(11)
    rows, want = [], {}
    for k, n in enumerate([1, 31, 32, 33, 64, 65, 200, 5]):
        label = None if k == 3 else "1"
        own = [(label, f"i{k}", "s", float(rng.randrange(9)), rng.choice([None, 1, 2, 3])) for _ in range(n)]
        rows += own
        want[f"i{k}"] = sorted((-1 if t is None else t, x) for _, _, _, x, t in own)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "label string, id string, sid string, x double, t int")
    made = segments.segments_of_points(df, ["t", "x"], SPEC, Scale(segment=segment, hot_rows=hot_rows, broadcast_rows=0), staging)
    got = {}
    for r in sorted(made.collect(), key=lambda r: (r.id, r.start)):
        data = got.setdefault(r.id, [])
        assert r.start == len(data) and r.n == len(r.data) <= segment
        assert list(r.before) == data[-SPEC.lookback :]
        data += r.data
    assert got == {k: [x for _, x in v] for k, v in want.items()}


def test_segments_of_points_and_of_records_are_equal(records, points, staging):
    names = ["label", "id", "sid", "start", "n", "before", "data", "after", "head", "tail"]
    one = build("records", records, points, TIGHT, staging).select(names)
    two = build("points", records, points, TIGHT, staging).select(names)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


@pytest.mark.parametrize("scale", [WIDE, TIGHT], ids=["wide", "tight"])
@pytest.mark.parametrize("kind", ["records", "points"])
def test_moving_average(records, points, staging, kind, scale):
    made = build(kind, records, points, scale, staging)
    got = smoothing.moving_average(made, SPEC, scale, staging).collect()
    want = fixtures.smoothed(RECORDS)
    assert len(got) == len(want)
    for r in got:
        assert r.smoothed_x == pytest.approx(want[r.id, r.sid, r.pos], abs=1e-9)


def test_many_short_records_across_blocks(spark, staging):
    rows = fixtures.series(5, {"x": [1, 2, 1, 3] * 30})
    df = spark.createDataFrame(rows, "label string, id string, sid string, data array<double>")
    scale = Scale(segment=32, hot_rows=20, hot_keys=1000, broadcast_rows=0)
    made = staging.table(segments.segments_of_records(df, SPEC, scale), "segments")
    got = smoothing.moving_average(made, SPEC, scale, staging).collect()
    want = fixtures.smoothed(rows)
    assert {(r.id, r.sid, r.pos) for r in got} == set(want)
    for r in got:
        assert r.smoothed_x == pytest.approx(want[r.id, r.sid, r.pos], abs=1e-9)


def plain_cuts(values, probs=SPEC.probs):
    """The value at rank n - floor(n - p n), NaN last."""
    ordered = sorted((v for v in values if v == v)) + [v for v in values if v != v]
    n = len(ordered)
    return [ordered[max(1, n - math.floor(n - p * n)) - 1] for p in probs]


def odd_values(rng, n):
    kinds = [
        lambda: rng.gauss(0, 1),
        lambda: rng.choice([0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1.7e308, -1.7e308]),
        lambda: rng.uniform(100, 101),
        lambda: 100 + rng.randrange(4) * 2.0**-45,  # neighbours within a bin
        lambda: rng.choice([math.inf, -math.inf, math.nan]),
    ]
    return [rng.choice(kinds[: rng.randrange(1, 6)])() for _ in range(n)]


@pytest.mark.parametrize("hot_rows", [1, 7, 4_000_000])
@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_breakpoints_are_exact(spark, staging, hot_rows, broadcast_rows):
    """Any limit of a task, any layout: the same value at the same rank. One id holds most points."""
    rng = random.Random(hot_rows)
    ids = {"hot": 4000, "same": 300, **{f"i{k}": rng.randrange(1, 60) for k in range(30)}}
    values = {i: odd_values(rng, n) for i, n in ids.items()}
    values["same"] = [2.5] * 300
    values["close"] = [100 + rng.randrange(3000) * 2.0**-46 for _ in range(2000)]
    rows = [(i, v) for i, own in values.items() for v in own]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, smoothed_x double")
    scale = Scale(hot_rows=hot_rows, hot_keys=10, broadcast_rows=broadcast_rows)
    for layout in (df, df.repartition(7), df.repartition("smoothed_x")) if hot_rows == 7 else (df,):
        got = {r.id: list(r.quantiles) for r in bp.breakpoints(layout, SPEC, scale, staging).collect()}
        assert got.keys() == values.keys()
        for i, own in values.items():
            want = plain_cuts(own)
            assert all(g == w or (g != g and w != w) for g, w in zip(got[i], want)), (i, got[i], want)


def test_bins_keep_the_order_of_values(spark):
    rng = random.Random(1)
    values = sorted({*odd_values(rng, 3000), *(s * 2.0**k for k in range(-1074, 1024) for s in (1, -1))} - {math.nan})
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(k, v) for k, v in enumerate([*values, math.nan])], "k int, x double")
    bins = [r.b for r in df.select("k", bp.value_bin(F.col("x")).alias("b")).orderBy("k").collect()]
    assert bins == sorted(bins)


def test_breakpoints_with_heavy_ties(spark, staging):
    df = spark.range(3000).select(
        F.lit("a").alias("id"), F.when(F.col("id") < 2000, 5.0).otherwise(9.0).alias("smoothed_x")
    )
    assert bp.breakpoints(df, SPEC, WIDE, staging).first().quantiles == [5.0, 5.0, 5.0, 9.0]
    assert bp.breakpoints(df.limit(0), SPEC, WIDE, staging).collect() == []


def test_letters_are_the_same_at_any_scale(records, points, staging):
    """One definition of the cuts: no limit of a task changes a letter."""
    want = fixtures.letters(RECORDS)
    for scale in (WIDE, TIGHT):
        made = build("records", records, points, scale, staging)
        cut = symbols.with_breakpoints(made, SPEC, scale, staging)
        got = {}
        for r in symbols.point_symbols(cut, SPEC).collect():
            got.setdefault((r.id, r.sid), {})[r.pos] = r.SAX
        assert {k: "".join(v[i] for i in range(len(v))) for k, v in got.items()} == want


@pytest.mark.parametrize("scale", [WIDE, TIGHT], ids=["wide", "tight"])
@pytest.mark.parametrize("kind", ["records", "points"])
def test_letters_and_transitions(spark, records, points, staging, kind, scale, monkeypatch):
    # exact cuts for both, so that only the layout differs
    cuts = fixtures.quantiles(RECORDS)
    exact = spark.createDataFrame(list(cuts.items()), "id string, quantiles array<double>")
    monkeypatch.setattr(symbols, "breakpoints", lambda smoothed, *limits: exact)
    made = build(kind, records, points, scale, staging)
    want = fixtures.letters(RECORDS)
    cut = symbols.with_breakpoints(made, SPEC, scale, staging)
    for r in symbols.point_symbols(cut, SPEC).collect():
        assert r.SAX == want[r.id, r.sid][r.pos]
    got = {}
    for r in transition_table(made, SPEC, scale, staging).collect():
        key = r.id, r.sid, r.word_length, r.SEQ
        assert key not in got
        got[key] = [r[c] for c in "ABCDE"]
    expected = {
        (*record, a, prefix): shares
        for record, text in want.items()
        for a in SPEC.word_lengths
        for prefix, shares in fixtures.transition_rows(text, a).items()
    }
    assert got == expected
    lettered = symbols.letter_segments(cut, SPEC)
    for r in words.sliding_words(lettered, 7).collect():
        assert r.word == want[r.id, r.sid][r.pos : r.pos + 7]


def test_cuts_of_cold_ids_are_exact(records, points, staging):
    made = build("records", records, points, WIDE, staging)
    cut = symbols.with_breakpoints(made, SPEC, WIDE, staging)
    want = fixtures.quantiles(RECORDS)
    for r in cut.select("id", "quantiles").distinct().collect():
        assert r.quantiles == pytest.approx(want[r.id], abs=1e-9)


@pytest.mark.parametrize("how", ["inner", "left_anti", "left_semi"])
def test_join_strategies_agree(spark, how):
    big = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("row"),
    )
    small = spark.range(0, 50, 2).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    want = None
    for scale in (Scale(), Scale(broadcast_rows=0), Scale(broadcast_rows=0, hot_rows=100)):
        sizes = key_sizes(big, ["k"], scale)
        assert (sizes.hot is None) == (scale.hot_rows > 1500)
        got = as_set(join_per_key(big, small, sizes, ["row"], how))
        want = want or got
        assert got == want and got


def test_point_statistics_equal_the_descriptives(records, points, staging):
    for scale in (WIDE, TIGHT):
        made = build("records", records, points, scale, staging)
        per_record = descriptives(values(made)).drop("range").collect()
        want = {(r.id, r.sid): tuple(r) for r in per_record}
        for r in point_statistics(made, scale).drop("pos", "x").collect():
            for a, b in zip(tuple(r), want[r.id, r.sid]):
                assert a == b or a == pytest.approx(b, abs=1e-9)


def test_the_limit_does_not_grow_with_the_rows(spark):
    for rows in (1000, 5000):
        df = spark.range(rows).select((F.col("id") % 100).alias("k"))
        sizes = key_sizes(df, ["k"], Scale(hot_rows=20, hot_keys=50))
        assert sizes.limit == 20 and (sizes.hot is None) == (rows == 1000)


def exchanges(df):
    """The columns that each exchange of a plan carries."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = []
    for block in text.split("\n\n"):
        if re.match(r"\(\d+\) Exchange", block.strip()):
            found.append(re.search(r"Input \[\d+\]: \[(.*)\]", block)[1])
    return found


@pytest.mark.parametrize("hot_rows", [10**6, 40], ids=["cold", "hot"])
def test_segments_in_buckets_join_their_cuts_in_place(spark, records, points, staging, hot_rows):
    """Many ids: no exchange of the plan carries a series, and letters and words are the same."""
    scale = Scale(segment=64, broadcast_rows=0, hot_rows=hot_rows, hot_keys=1000)
    made = build("records", records, points, scale, staging)
    ids = key_sizes(made, ["id"], scale, weight="n")
    assert (ids.hot is not None) == (hot_rows == 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cut = symbols.with_breakpoints(made, SPEC, scale, staging, ids)
        found = transition_table(made, SPEC, scale, staging)
        assert not any(re.search(r"\bdata#", e) for e in exchanges(found))
        if ids.hot is None:
            assert exchanges(found) == []  # words are counted where the segments lie
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = fixtures.letters(RECORDS)
    for r in symbols.point_symbols(cut, SPEC).collect():
        assert r.SAX == want[r.id, r.sid][r.pos]
    wide = transition_table(build("records", records, points, WIDE, staging), SPEC, WIDE, staging)
    assert sorted(map(tuple, found.select(wide.columns).collect())) == as_set(wide)


def test_hot_keys_are_a_stored_table(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert key_sizes(df, ["k"], Scale(hot_rows=100)).hot is None
    few = key_sizes(df, ["k"], Scale(hot_rows=99))
    assert few.hot.count() == 10 and few.hot.inputFiles() and few.few_hot
    many = key_sizes(df, ["k"], Scale(hot_rows=99, hot_keys=9, broadcast_rows=0))
    assert not many.few_hot
    small = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("y"))
    assert join_per_key(df, small, many, ["k"]).count() == 1000
    assert positions(df.withColumn("t", F.lit(1)), ["k"], ["t"], "pos", Scale(hot_rows=20, hot_keys=3), Staging(spark)).groupBy("k").agg(F.max("pos").alias("m")).filter("m <> 99").isEmpty()


def test_words_are_bytes_until_they_are_grouped(spark, staging, records):
    """No structure for a point, no letters made twice; words of one letter and empty records too."""
    spec = Spec(word_lengths=(2, 3))
    rows = [("1", "a", "s", 0, 4, "ABAB"), ("1", "b", "s", 0, 1, "A"), ("1", "c", "s", 0, 0, ""), ("1", "d", "s", None, None, None)]
    lettered = spark.createDataFrame(rows, "label string, id string, sid string, start long, n int, symbols string")
    sizes = key_sizes(lettered, ["id", "sid"], WIDE)
    made = words.transitions(lettered, spec, sizes)
    assert "inline" not in plan(made)
    got = {(r.id, r.word_length, r.SEQ): (r.A, r.B, r.C, r.HEX) for r in made.collect()}
    assert got == {
        ("a", 2, "A"): (0.0, 1.0, 0.0, "41"), ("a", 2, "B"): (0.5, 0.0, 0.0, "42"), ("b", 2, "A"): (0.0, 0.0, 0.0, "41"),
        ("a", 3, "AB"): (0.5, 0.0, 0.0, "4142"), ("a", 3, "BA"): (0.0, 1.0, 0.0, "4241"),
    }
    series = staging.table(build("records", records, None, WIDE, staging).withColumn("quantiles", F.array(*map(F.lit, [0.0, 1.0, 2.0, 3.0]))), "cut")
    letters = plan(words.transitions(symbols.letter_segments(series, SPEC), SPEC, sizes))
    assert letters.count("array_join(") == 1
