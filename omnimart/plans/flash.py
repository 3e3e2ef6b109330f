"""Daily sales flash: period totals, week and same-day comparisons per channel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from omnimart.functions.scalars import MONEY, ratio, round_half_up, signed_percent
from omnimart.operators.calendar import days_before, fill_days, trailing_sum
from omnimart.operators.cube import ALL, CHANNELS

FULL_DAYS = 28
HISTORY_DAYS = 13  # days before a snapshot that its comparisons reach back


@dataclass(frozen=True)
class Bounds:
    """Days a flash may cover: the partial first and last days are left out."""

    end: date

    @property
    def first_full(self) -> date:
        return self.end - timedelta(days=FULL_DAYS)

    @property
    def last_full(self) -> date:
        return self.end - timedelta(days=1)

    @property
    def first_snapshot(self) -> date:
        return self.first_full + timedelta(days=HISTORY_DAYS)

    @property
    def snapshots(self) -> int:
        return (self.last_full - self.first_snapshot).days + 1


def channel_series(sales: DataFrame) -> DataFrame:
    """Revenue and orders per day for each channel and for all together."""
    per_day = sales.groupBy("channel", F.to_date("ordered_at").alias("day")).agg(
        F.sum("sales_amount").alias("revenue"), F.count("*").alias("orders")
    )
    return (
        per_day.select(
            F.explode(F.array("channel", F.lit(ALL))).alias("channel"), "day", "revenue", "orders"
        )
        .groupBy("channel", "day")
        .agg(F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("orders").alias("orders"))
    )


def filled_series(
    series: DataFrame, bounds: Bounds, channels: Sequence[str] = CHANNELS
) -> DataFrame:
    """The full days of the series, with a zero row for each day without sales."""
    return fill_days(series, "channel", [*channels, ALL], bounds.first_full, bounds.last_full)


def flash_rows(filled: DataFrame, bounds: Bounds, period: int) -> DataFrame:
    """One flash row per channel and day of a filled series.

    The period total is cut at the first full day. The series has at most a month
    of days per channel, so its windows are small whatever the facts weigh.
    """
    start = F.greatest(F.date_sub("day", period - 1), F.lit(bounds.first_full))
    rows = filled.select(
        "channel",
        "day",
        start.alias("from_day"),
        F.col("revenue").alias("day_revenue"),
        trailing_sum("revenue", "channel", 1 - period).cast(MONEY).alias("revenue"),
        trailing_sum("orders", "channel", 1 - period).alias("orders"),
        trailing_sum("revenue", "channel", -6).cast(MONEY).alias("week_revenue"),
        trailing_sum("revenue", "channel", -13, -7).cast(MONEY).alias("previous_week_revenue"),
        days_before("revenue", "channel", 7).cast(MONEY).alias("previous_day_revenue"),
    )
    basket = round_half_up(ratio(F.col("revenue"), F.col("orders")), 2)
    return rows.select(
        "*",
        (F.datediff("day", "from_day") + 1).alias("days"),
        (F.col("from_day") != F.date_sub("day", period - 1)).alias("clipped"),
        F.date_sub("day", 7).alias("comparison_day"),
        basket.alias("basket"),
        signed_percent(F.col("week_revenue"), F.col("previous_week_revenue")).alias("week_change"),
        signed_percent(F.col("day_revenue"), F.col("previous_day_revenue")).alias("day_change"),
    )


def flash_table(rows: DataFrame, day: date, bounds: Bounds, channel: str = ALL) -> DataFrame:
    """The rows of one snapshot day with each channel's share of all revenue.

    A day outside the snapshot range falls back to the last full day. For one
    channel the table holds that channel only; for all, every channel and the total.
    """
    if not bounds.first_snapshot <= day <= bounds.last_full:
        day = bounds.last_full
    snapshot = rows.filter(F.col("day") == F.lit(day))
    total = snapshot.filter(F.col("channel") == ALL).agg(F.max("revenue")).scalar()
    table = snapshot.withColumn("share", ratio(F.col("revenue"), total))
    return table if channel == ALL else table.filter(F.col("channel") == channel)
