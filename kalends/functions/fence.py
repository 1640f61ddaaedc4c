"""A barrier for predicate pushdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fenced(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column as the output of a one-element generator.

    A filter on it stays above. Pushed through the projections below, a predicate on a verdict that
    hangs on every derived column would be rewritten into one expression that repeats all their rules.
    The value itself is a column below, for a generator's own expressions are interpreted row by row.
    """
    return df.withColumn(name, value).withColumn(name, F.explode_outer(F.array(name)))
