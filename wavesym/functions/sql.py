"""The point functions as SQL functions, for queries written as text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wavesym.settings import Spec


def register(spark: SparkSession, spec: Spec) -> None:
    """Temporary functions of the session, all of them plain expressions that the optimizer inlines.

    ``wave_series(text)``: the numbers of a comma-separated text, null where a token can't be read.
    ``wave_letter(x, cuts)``: the letter of the half-open interval of x; a value on a cut gets the upper letter.
    ``wave_distance(a, b)``: the Euclidean distance of two arrays.
    """
    letters = spec.letters
    cases = " ".join(f"when x < cuts[{i}] then '{name}'" for i, name in enumerate(letters[:-1]))
    bodies = {
        "wave_series(text string) returns array<double>": "case when text rlike '^,+$' then cast(array() as array<double>) "
        "else transform(split(regexp_replace(text, ',+$', ''), ','), e -> try_cast(trim(e) as double)) end",
        "wave_letter(x double, cuts array<double>) returns string": f"case {cases} else '{letters[-1]}' end",
        "wave_distance(a array<double>, b array<double>) returns double": "sqrt(aggregate("
        "zip_with(a, b, (x, y) -> (x - y) * (x - y)), cast(0 as double), (s, v) -> s + v))",
    }
    for head, body in bodies.items():
        spark.sql(f"create or replace temporary function {head} return {body}")
