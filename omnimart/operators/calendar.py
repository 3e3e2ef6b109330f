"""Gap-free daily series and trailing windows over them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F


def day_grid(df: DataFrame, label: str, labels: Sequence[str], start: date, end: date) -> DataFrame:
    """Every (label, day) pair from start to end inclusive; empty when end precedes start."""
    spark = df.sparkSession
    days = max((end - start).days + 1, 0)
    return spark.range(days).select(
        F.explode(F.array(*[F.lit(x) for x in labels])).alias(label),
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"),
    )


def fill_days(
    series: DataFrame, label: str, labels: Sequence[str], start: date, end: date
) -> DataFrame:
    """Series with a zero row for each missing day of each label."""
    measures = [c for c in series.columns if c not in (label, "day")]
    grid = day_grid(series, label, labels, start, end)
    filled = grid.join(series, [label, "day"], "left")
    values = [
        F.coalesce(c, F.lit(0)).cast(series.schema[c].dataType).alias(c) for c in measures
    ]
    return filled.select(label, "day", *values)


def trailing_sum(value: Column | str, label: str, first: int, last: int = 0) -> Column:
    """Sum over rows ``first``..``last`` relative to the current day (e.g. -6..0).

    Valid on a gap-free series, where rows are days; a label has one row per day.
    """
    window = Window.partitionBy(label).orderBy("day").rowsBetween(first, last)
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def days_before(value: str, label: str, days: int) -> Column:
    """Value of the same label that many days earlier, zero before the series starts."""
    window = Window.partitionBy(label).orderBy("day")
    return F.coalesce(F.lag(value, days).over(window), F.lit(0))
