"""Ordered results: files in order, positions without a sort, stretches from the files that hold them."""

import random

import pytest
from pyspark.sql import functions as F

from wavesym import Scale
from wavesym.operators.ordering import file_positions, read_ordered, read_positions, store_ordered

SCHEMA = "id string, x double"


@pytest.fixture
def rows():
    rng = random.Random(4)
    return [(f"k{rng.randrange(400):03d}" if rng.random() < 0.6 else "hot", float(k)) for k in range(3000)]


@pytest.mark.parametrize("files,per_file", [(1, 0), (7, 0), (5, 100)])
@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_positions_follow_the_order(spark, tmp_path, rows, files, per_file, broadcast_rows):
    path = str(tmp_path / "ordered")
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", per_file)
    try:
        store_ordered(df, ["id", F.col("x").desc()], path, files)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = read_ordered(spark, path, df.schema, Scale(broadcast_rows=broadcast_rows))
    want = sorted(rows, key=lambda r: (r[0], -r[1]))
    assert [(r.id, r.x) for r in sorted(got.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in got.collect()) == list(range(1, len(rows) + 1))
    for first, last in [(1, 1), (1, 3000), (900, 1100), (2999, 4000), (3001, 4000)]:
        own = read_positions(spark, path, df.schema, first, last).collect()
        assert [(r.id, r.x) for r in sorted(own, key=lambda r: r.position)] == want[first - 1 : last]
    assert file_positions(spark, path, df.schema).count() >= (30 if per_file else 1)


def test_reading_needs_no_exchange_of_rows(spark, tmp_path, rows):
    path = str(tmp_path / "ordered")
    df = spark.createDataFrame(rows, SCHEMA)
    store_ordered(df, ["id"], path, 4)
    plan = read_ordered(spark, path, df.schema, Scale())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "rangepartitioning" not in plan


def test_empty_result(spark, tmp_path):
    path = str(tmp_path / "ordered")
    df = spark.createDataFrame([], SCHEMA)
    store_ordered(df, ["id"], path)
    assert read_ordered(spark, path, df.schema, Scale()).collect() == []
    assert read_positions(spark, path, df.schema, 1, 5).collect() == []


def test_a_file_id_that_looks_like_a_part_number(spark, tmp_path, rows):
    """Spark names files part-<task>-<uuid>-c<part>; a group of the uuid may begin with c and digits, too."""
    path, named = tmp_path / "ordered", tmp_path / "named"
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        store_ordered(df, ["id", "x"], str(path), 5)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    named.mkdir()
    for file in path.glob("part-*"):
        task, part = file.name.split("-")[1], file.name.rsplit("-c", 1)[1]
        (named / f"part-{task}-0a1b2c3d-c123-4567-89ab-c45678901234-c{part}").write_bytes(file.read_bytes())
    got = read_ordered(spark, str(named), df.schema, Scale()).collect()
    assert [(r.id, r.x) for r in sorted(got, key=lambda r: r.position)] == sorted(rows)
