"""The SQL functions against the column expressions."""

from pyspark.sql import functions as F

from wavesym import Spec
from wavesym.functions import sql
from wavesym.functions.columns import euclidean, letter, parse_series

SPEC = Spec()
TEXTS = ["1,2,3", "1, 2 ,x", ",,", "", "1,,3", "5,,", "1e300,-0.0", None, "NaN"]


def test_series(spark):
    sql.register(spark, SPEC)
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    rows = df.select(F.expr("wave_series(text)").alias("a"), parse_series(F.col("text")).alias("b")).collect()
    assert [str(r.a) for r in rows] == [str(r.b) for r in rows]


def test_letter_and_distance(spark):
    sql.register(spark, SPEC)
    cuts = F.array(*[F.lit(float(c)) for c in (1, 2, 2, 5)])
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 1.5, 2, 3, 5, 9)] + [(None,)], "x double").withColumn("cuts", cuts)
    names = [F.get("cuts", F.lit(i)) for i in range(4)]
    rows = df.select(F.expr("wave_letter(x, cuts)").alias("a"), letter(F.col("x"), names, SPEC.letters).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] == [*"ABBDDEE", "E"]
    pair = df.select(F.expr("wave_distance(array(x, 1D), array(4D, 5D))").alias("a"), euclidean([F.col("x"), F.lit(1.0)], [F.lit(4.0), F.lit(5.0)]).alias("b"))
    assert all(r.a == r.b for r in pair.collect())


def test_the_optimizer_inlines_them(spark):
    sql.register(spark, SPEC)
    plan = spark.sql("select wave_distance(array(id), array(1D)) as d from range(5)")._jdf.queryExecution().optimizedPlan().toString()
    assert "wave_distance" not in plan and "PythonUDF" not in plan
