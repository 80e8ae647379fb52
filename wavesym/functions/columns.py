"""Column expressions: everything here stays inside Spark's own expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_series(text: Column) -> Column:
    """CSV text to array<double>; an unreadable token becomes a null element.

    Trailing commas carry no value, so text made of commas alone is an empty series.
    """
    trimmed = F.regexp_replace(text, ",+$", "")
    numbers = F.transform(F.split(trimmed, ","), lambda e: F.trim(e).try_cast("double"))
    return F.when(text.rlike("^,+$"), F.array().cast("array<double>")).otherwise(numbers)


def format_series(values: Column) -> Column:
    """array<double> to CSV text that `parse_series` reads back to the same doubles."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


def letter(x: Column, cuts: list[Column], letters: str) -> Column:
    """Letter of the half-open interval x falls in; a value on a cut gets the upper letter."""
    chain = F.when(x < cuts[0], letters[0])
    for cut, name in zip(cuts[1:], letters[1:]):
        chain = chain.when(x < cut, name)
    return chain.otherwise(letters[-1])


def trailing_mean(values: Column, at: Column, lookback: int) -> Column:
    """Mean of values[at-lookback .. at] (0-based), for places that have a whole frame.

    Written out term by term: it compiles to plain array reads, oldest value first.
    """
    terms = [F.get(values, at - d) for d in range(lookback, -1, -1)]
    return reduce(add, terms) / F.lit(float(lookback + 1))


def euclidean(left: list[Column], right: list[Column]) -> Column:
    return F.sqrt(reduce(add, [(a - b) * (a - b) for a, b in zip(left, right)]))


def ratio(x: Column, y: Column) -> Column:
    """x / y with 0/0 as NaN (counts only, so x > 0 never meets y = 0)."""
    return F.coalesce(F.try_divide(x, y), F.lit(float("nan")))
