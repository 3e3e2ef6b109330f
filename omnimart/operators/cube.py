"""Channel by period cube in one pass over the facts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from omnimart.functions.scalars import moment

ALL = "all"

# Reported channels and periods in days.
CHANNELS = ("web", "store", "marketplace")
PERIODS = (7, 14, 30)


def period_start(as_of: datetime, days: int) -> datetime:
    return as_of - timedelta(days=days)


def smallest_period(time: Column, as_of: datetime, periods: Sequence[int]) -> Column:
    """Shortest period the row falls in; null when it is older than all of them."""
    result = None
    for days in sorted(periods):
        hit = time >= moment(period_start(as_of, days))
        result = F.when(hit, days) if result is None else result.when(hit, days)
    return result


def spread(df: DataFrame, channel: str, period: str, periods: Sequence[int]) -> DataFrame:
    """Repeat each row for its channel and ``all``, and for every period that includes it."""
    rest = [c for c in df.columns if c not in (channel, period)]
    return df.select(
        F.explode(F.array(F.col(channel), F.lit(ALL))).alias(channel), period, *rest
    ).select(
        channel,
        F.explode(
            F.filter(F.array(*[F.lit(p) for p in periods]), lambda p: p >= F.col(period))
        ).alias(period),
        *rest,
    )


def grid(df: DataFrame, channels: Sequence[str], periods: Sequence[int]) -> DataFrame:
    """All cube cells, so that an empty selection is a row of zeros."""
    rows = [(c, p) for c in (*channels, ALL) for p in periods]
    return df.sparkSession.createDataFrame(rows, "channel string, period int")


def reconciliation_cube(
    sales: DataFrame,
    events: DataFrame,
    payments: DataFrame,
    as_of: datetime,
    channels: Sequence[str] = CHANNELS,
    periods: Sequence[int] = PERIODS,
) -> DataFrame:
    """Batch, stream and payment totals of the sales in every cell, with their deltas.

    Events and payments take channel and period from their order. All three
    are summed per channel and shortest period before they are repeated.
    """
    start = period_start(as_of, max(periods))
    chosen = sales.filter(F.col("ordered_at") >= moment(start)).select(
        "order_id",
        "channel",
        smallest_period(F.col("ordered_at"), as_of, periods).alias("period"),
        "quantity",
        "sales_amount",
    )
    cell_of = chosen.select("order_id", "channel", "period")

    def totals(df: DataFrame, **sums: str) -> DataFrame:
        kinds = {"batch_units": "bigint", "stream_units": "bigint"}
        names = ("batch_units", "stream_units", "sales_amount", "payment_amount")
        return df.groupBy("channel", "period").agg(
            *[
                (F.sum(sums[n]) if n in sums else F.lit(0))
                .cast(kinds.get(n, "decimal(38,2)"))
                .alias(n)
                for n in names
            ]
        )

    purchases = events.filter("event_type = 'purchase'").select("order_id", "quantity")
    settled = payments.filter("status = 'settled'").select("order_id", "amount")
    parts = (
        totals(chosen, batch_units="quantity", sales_amount="sales_amount")
        .unionByName(totals(purchases.join(cell_of, "order_id"), stream_units="quantity"))
        .unionByName(totals(settled.join(cell_of, "order_id"), payment_amount="amount"))
    )
    measures = ("batch_units", "stream_units", "sales_amount", "payment_amount")
    cells = (
        spread(parts, "channel", "period", periods)
        .groupBy("channel", "period")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    filled = grid(sales, channels, periods).join(cells, ["channel", "period"], "left")
    return filled.select(
        "channel",
        "period",
        *[F.coalesce(m, F.lit(0)).cast("bigint").alias(m) for m in measures[:2]],
        *[F.coalesce(m, F.lit(0)).cast("decimal(18,2)").alias(m) for m in measures[2:]],
    ).select(
        "*",
        (F.col("batch_units") - F.col("stream_units")).alias("unit_delta"),
        (F.col("sales_amount") - F.col("payment_amount")).cast("decimal(18,2)").alias("amount_delta"),
    )


def sales_cube(
    sales: DataFrame,
    as_of: datetime,
    channels: Sequence[str] = CHANNELS,
    periods: Sequence[int] = PERIODS,
) -> DataFrame:
    """Revenue, orders, customers, units and basket for each channel and period.

    Sales are reduced to (channel, shortest period, customer) before they are
    repeated for the wider cells, so the repetition works on the small side.
    """
    start = period_start(as_of, max(periods))
    per_customer = (
        sales.filter(F.col("ordered_at") >= moment(start))
        .groupBy(
            "channel",
            smallest_period(F.col("ordered_at"), as_of, periods).alias("period"),
            "customer_id",
        )
        .agg(
            F.sum("sales_amount").alias("revenue"),
            F.count("*").alias("orders"),
            F.sum("quantity").alias("units"),
        )
    )
    cells = (
        spread(per_customer, "channel", "period", periods)
        .groupBy("channel", "period")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("orders").alias("orders"),
            F.count_distinct("customer_id").alias("customers"),
            F.sum("units").alias("units"),
        )
    )
    basket = F.round(F.col("revenue").cast("double") / F.col("orders"), 2)
    return (
        grid(sales, channels, periods)
        .join(cells, ["channel", "period"], "left")
        .withColumn("avg_basket", basket)
        .fillna(0, ["orders", "customers", "units", "avg_basket"])
        .withColumn("revenue", F.coalesce("revenue", F.lit(0)).cast("decimal(18,2)"))
    )
