"""Small column expressions shared by several operators."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def change_rate(current: Column, previous: Column) -> Column:
    """Relative change against the previous value; NULL for the first row."""
    return ratio(current, previous) - F.lit(1.0)


def between_inclusive(value: Column, low: float, high: float) -> Column:
    return (value >= F.lit(low)) & (value <= F.lit(high))


def parse_first(text: Column, formats: Sequence[str]) -> Column:
    """Timestamp from the first format that fits; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def stamp(df: DataFrame, **values) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def churn_call(score: Column, threshold: float = 0.5) -> Column:
    return (score >= F.lit(threshold)).cast("int")
