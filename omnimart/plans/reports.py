"""Period reports over the facts. ``as_of`` replaces the clock, so results repeat."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from omnimart.functions.scalars import MONEY, amounts_agree, moment, ratio
from omnimart.operators.cube import ALL, CHANNELS, period_start
from omnimart.operators.quantiles import nearest_rank
from omnimart.session import pin

SHORTEST, LONGEST = 7, 30

# Customer segments by spend and order count, and risk labels.
SEGMENT_CHAMPION = "Champions"
SEGMENT_LOYAL = "Fidèles"
SEGMENT_PROMISING = "Prometteurs"
SEGMENT_NEW = "Nouveaux"
SEGMENTS = (SEGMENT_CHAMPION, SEGMENT_LOYAL, SEGMENT_PROMISING, SEGMENT_NEW)
RISK_LABELS = {"critical": "Sous le seuil", "watch": "À surveiller", "healthy": "Normal"}


@dataclass(frozen=True)
class Selection:
    """Channel and period of a report; out-of-range input falls back or is clamped."""

    as_of: datetime
    channel: str = ALL
    period: int = LONGEST

    def __post_init__(self):
        if self.channel not in CHANNELS:
            object.__setattr__(self, "channel", ALL)
        object.__setattr__(self, "period", max(SHORTEST, min(int(self.period), LONGEST)))

    @property
    def start(self) -> datetime:
        return period_start(self.as_of, self.period)

    def apply(self, df: DataFrame, time: str) -> DataFrame:
        chosen = df.filter(F.col(time) >= moment(self.start))
        return chosen if self.channel == ALL else chosen.filter(F.col("channel") == self.channel)

    def sales(self, sales: DataFrame) -> DataFrame:
        return self.apply(sales, "ordered_at")

    def events(self, events: DataFrame) -> DataFrame:
        return self.apply(events, "event_at")


def _money(c: str):
    return F.coalesce(F.sum(c), F.lit(0)).cast(MONEY)


def _whole(c: str):
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def kpi_block(selected: DataFrame) -> DataFrame:
    basket = F.round(F.sum("sales_amount").cast("double") / F.nullif(F.count("*"), F.lit(0)), 2)
    return selected.agg(
        _money("sales_amount").alias("revenue"),
        F.count("*").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        _whole("quantity").alias("units"),
        F.coalesce(basket, F.lit(0.0)).alias("avg_basket"),
    )


def daily_series(selected: DataFrame) -> DataFrame:
    return selected.groupBy(F.to_date("ordered_at").alias("day")).agg(
        _money("sales_amount").alias("revenue"),
        F.count("*").alias("orders"),
        _whole("quantity").alias("units"),
    ).orderBy("day")


def channel_mix(selected: DataFrame) -> DataFrame:
    return selected.groupBy("channel").agg(
        _money("sales_amount").alias("revenue"), F.count("*").alias("orders")
    ).orderBy(F.desc("revenue"), "channel")


def top_categories(selected: DataFrame, products: DataFrame, limit: int = 7) -> DataFrame:
    """Best categories with their share of the revenue of the whole selection.

    Units and revenue are summed per product before the join with the catalogue.
    """
    per_product = selected.groupBy("product_id").agg(
        F.sum("sales_amount").alias("revenue"), F.sum("quantity").alias("units")
    )
    # Summing both columns keeps the subquery equal to the branch below, so Spark
    # runs the aggregation once and reuses its exchange.
    totals = per_product.agg(
        F.struct(F.sum("revenue").alias("revenue"), F.sum("units").alias("units")).alias("t")
    )
    total = totals.scalar()["revenue"]
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("units").alias("units"))
        .orderBy(F.desc("revenue"), "category")
        .limit(limit)
        .withColumn("share", ratio(F.col("revenue"), total))
    )


def inventory_demand(available: DataFrame, products: DataFrame, selected: DataFrame) -> DataFrame:
    """Network stock with the demand of the selection beside it."""
    demand = selected.groupBy("product_id").agg(F.sum("quantity").alias("selected_units_sold"))
    return (
        available.join(products.select("product_id", "product_name", "category"), "product_id")
        .join(demand, "product_id", "left")
        .fillna(0, ["selected_units_sold"])
    )


def by_risk(inventory: DataFrame) -> DataFrame:
    """Most urgent products first."""
    urgency = (
        F.when(F.col("risk_level") == "critical", 0)
        .when(F.col("risk_level") == "watch", 1)
        .otherwise(2)
    )
    return inventory.orderBy(urgency, "available_to_promise", "product_id")


def with_risk_label(inventory: DataFrame) -> DataFrame:
    label = F.lit(None).cast("string")
    for level, text in RISK_LABELS.items():
        label = F.when(F.col("risk_level") == level, text).otherwise(label)
    return inventory.withColumn("risk_label", F.coalesce(label, F.col("risk_level")))


def spend_segment(spend, orders):
    return (
        F.when((spend >= 1200) | (orders >= 14), SEGMENT_CHAMPION)
        .when((spend >= 650) | (orders >= 8), SEGMENT_LOYAL)
        .when(spend >= 300, SEGMENT_PROMISING)
        .otherwise(SEGMENT_NEW)
    )


def customer_360(selected: DataFrame, customers: DataFrame, limit: int = 20) -> DataFrame:
    """Customers with the highest spend, their channels and segment.

    The top rows are taken before the join with the customer dimension, which
    holds every customer of the facts, so the join handles ``limit`` rows.
    """
    per_channel = selected.groupBy("customer_id", "channel").agg(
        F.sum("sales_amount").alias("spend"),
        F.count("*").alias("order_count"),
        F.max("ordered_at").alias("last_order"),
    )
    # A customer has at most one row per channel here, so the list stays short.
    top = (
        per_channel.groupBy("customer_id")
        .agg(
            F.sum("spend").cast(MONEY).alias("spend"),
            F.sum("order_count").alias("order_count"),
            F.max("last_order").alias("last_order"),
            F.array_join(F.array_sort(F.collect_list("channel")), ",").alias("channels"),
        )
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .orderBy(F.desc("spend"), "customer_id")
        .limit(limit)
    )
    return (
        customers.select("customer_id", "country", "acquisition_channel", "consent_marketing")
        .join(F.broadcast(top), "customer_id")
        .withColumn("segment", spend_segment(F.col("spend"), F.col("order_count")))
        .orderBy(F.desc("spend"), "customer_id")
    )


def segment_distribution(top_customers: DataFrame) -> DataFrame:
    """Customers per segment among the given top rows, with share and omnichannel count."""
    counts = top_customers.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("channels").contains(",")).alias("omnichannel"),
    )
    names = top_customers.sparkSession.createDataFrame([(s,) for s in SEGMENTS], "segment string")
    total = F.sum("customers").over(Window.partitionBy())  # over one row per segment
    return (
        names.join(counts, "segment", "left")
        .fillna(0, ["customers", "omnichannel"])
        .withColumn("share", ratio(F.col("customers"), total))
    )


def event_metrics(selected_events: DataFrame) -> DataFrame:
    """Count of all events, and 95th percentile of the known latencies (0 without any)."""
    latency = nearest_rank(selected_events, "latency_ms", 0.95, name="latency_p95_ms")
    return selected_events.agg(F.count("*").alias("events")).select(
        "events", latency.select("latency_p95_ms").scalar().alias("latency_p95_ms")
    )


def selected_reconciliation(
    selected: DataFrame, events: DataFrame, payments: DataFrame
) -> DataFrame:
    """Units and amounts of the selected sales against their events and payments.

    Events and payments follow their order: they are not filtered by time again.
    """
    sold = selected.agg(_whole("quantity").alias("units"), _money("sales_amount").alias("amount"))
    purchased = (
        events.filter("event_type = 'purchase'")
        .select("order_id", "quantity")
        .join(selected.select("order_id"), "order_id")
        .agg(_whole("quantity"))
    )
    paid = (
        payments.filter("status = 'settled'")
        .select("order_id", "amount")
        .join(selected.select("order_id"), "order_id")
        .agg(_money("amount"))
    )
    return (
        sold.select(
            F.col("units").alias("batch_units"),
            purchased.scalar().alias("stream_units"),
            F.col("amount").alias("sales_amount"),
            paid.scalar().alias("payment_amount"),
        )
        .withColumn("unit_delta", F.col("batch_units") - F.col("stream_units"))
        .withColumn("amount_delta", (F.col("sales_amount") - F.col("payment_amount")).cast(MONEY))
        .withColumn("status", agreement(F.col("unit_delta"), F.col("amount_delta")))
    )


def agreement(unit_delta, amount_delta):
    agreed = (unit_delta == 0) & amounts_agree(amount_delta, F.lit(0))
    return F.when(agreed, "PASS").otherwise("FAIL")


def stock_summary(inventory: DataFrame, period: int) -> DataFrame:
    """Network stock, selected demand, days of cover (null without demand) and risk counts."""
    totals = inventory.agg(
        _whole("available_to_promise").alias("total_atp"),
        _whole("selected_units_sold").alias("selected_units"),
        F.count_if(F.col("risk_level") == "critical").alias("critical"),
        F.count_if(F.col("risk_level") == "watch").alias("watch"),
    )
    per_day = F.col("selected_units").cast("double") / F.lit(float(period))
    cover = F.floor(F.col("total_atp").cast("double") / F.nullif(per_day, F.lit(0.0)) + 0.5)
    return totals.withColumn(
        "coverage_days", F.when(per_day > 0, cover).cast("bigint")
    )


def daily_pivot(selected: DataFrame, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """One row per day, newest first, with revenue and orders of every channel."""
    per_day = selected.groupBy(F.to_date("ordered_at").alias("day"), "channel").agg(
        F.sum("sales_amount").alias("amount"), F.count("*").alias("rows")
    )
    pivoted = (
        per_day.groupBy("day")
        .pivot("channel", list(channels))
        .agg(F.sum("amount").alias("revenue"), F.sum("rows").alias("orders"))
    )
    columns = []
    for c in channels:
        columns.append(F.coalesce(f"{c}_revenue", F.lit(0)).cast(MONEY).alias(f"{c}_revenue"))
        columns.append(F.coalesce(f"{c}_orders", F.lit(0)).alias(f"{c}_orders"))
    return pivoted.select("day", *columns).orderBy(F.desc("day"))


def extremes(series: DataFrame, label: str) -> DataFrame:
    """Lowest and highest day of each series; the first day wins a tie."""
    low = F.min(F.struct("revenue", "day"))
    high = F.max(F.struct(F.col("revenue"), (-F.unix_date("day")).alias("back"), F.col("day")))
    return series.groupBy(label).agg(low.alias("low"), high.alias("high")).select(
        label,
        F.col("low.day").alias("low_day"),
        F.col("low.revenue").alias("low_revenue"),
        F.col("high.day").alias("high_day"),
        F.col("high.revenue").alias("high_revenue"),
    )


def dashboard(
    chosen: Selection,
    sales: DataFrame,
    events: DataFrame,
    payments: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    available: DataFrame,
) -> dict[str, DataFrame]:
    """All blocks of one selection. The selected sales are stored once and shared."""
    selected = pin(chosen.sales(sales), "selected-sales")
    stock = inventory_demand(available, products, selected)
    return {
        "kpis": kpi_block(selected),
        "series": daily_series(selected),
        "channel_mix": channel_mix(selected),
        "categories": top_categories(selected, products),
        "inventory": by_risk(stock),
        "stock": stock_summary(stock, chosen.period),
        "customers": customer_360(selected, customers),
        "events": event_metrics(chosen.events(events)),
        "reconciliation": selected_reconciliation(selected, events, payments),
    }


def kpi_record(
    sales: DataFrame,
    products: DataFrame,
    events: DataFrame,
    available: DataFrame,
    quality_score: float | None = None,
) -> DataFrame:
    """One-row summary over everything loaded."""
    base = sales.agg(
        _money("sales_amount").alias("sales_amount"),
        F.count("*").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
    )
    latency = nearest_rank(events, "latency_ms", 0.95, name="p95")
    return base.select(
        "*",
        products.agg(F.count("*")).scalar().alias("products"),
        events.agg(F.count("*")).scalar().alias("events"),
        latency.select("p95").scalar().alias("latency_p95_ms"),
        available.agg(_whole("available_to_promise")).scalar().alias("total_atp"),
        F.lit(quality_score).cast("double").alias("quality_score"),
    ).select(
        "sales_amount",
        "orders",
        "customers",
        "products",
        "events",
        "total_atp",
        "latency_p95_ms",
        "quality_score",
    )
