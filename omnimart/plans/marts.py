"""Decision marts: stock, payments, customers, prices."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from omnimart.functions.scalars import MONEY, amounts_agree, ratio
from omnimart.operators.keysets import left_join_many
from omnimart.operators.ranking import tile_scores
from omnimart.session import pin

# Reasons shown with each price recommendation.
REASON_PROTECT = "Demande élevée et ATP sous tension"
REASON_ACCELERATE = "Couverture élevée et demande sous la moyenne"
REASON_HOLD = "Équilibre demande-stock, prix maintenu"

# Price factors of the two price moves.
RAISE, CUT = Decimal("1.03"), Decimal("0.95")


def risk_level(available, safety):
    return (
        F.when(available < safety, "critical")
        .when(available < 2 * safety, "watch")
        .otherwise("healthy")
    )


def available_to_promise(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Current stock plus incoming, less reservations and all units sold."""
    sold = sales.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    return _available(inventory.join(sold, "product_id", "left"))


def _available(stock: DataFrame) -> DataFrame:
    units = F.coalesce(F.col("units_sold"), F.lit(0)).cast("bigint")
    on_hand = F.col("store_stock") + F.col("warehouse_stock") + F.col("incoming")
    return (
        stock.withColumn("units_sold", units)
        .withColumn("available_to_promise", on_hand - F.col("reserved") - F.col("units_sold"))
        .withColumn("risk_level", risk_level(F.col("available_to_promise"), F.col("safety_stock")))
    )


def payment_reconciliation(sales: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per sale and payment, or per unpaid sale, with the first failing test.

    A payment without an amount passes the amount test, yet its delta is the full sale.
    """
    paid = payments.select(
        "order_id", F.col("amount").alias("payment_amount"), "status", F.lit(True).alias("has_payment")
    )
    joined = left_join_many(sales.select("order_id", "sales_amount"), paid, "order_id")
    agrees = amounts_agree(F.col("sales_amount"), F.col("payment_amount"))
    status = (
        F.when(F.col("has_payment").isNull(), "missing_payment")
        .when(~agrees, "amount_mismatch")
        .when(F.col("status") != "settled", "not_settled")
        .otherwise("reconciled")
    )
    delta = F.col("sales_amount") - F.coalesce("payment_amount", F.lit(0).cast(MONEY))
    return joined.select(
        "order_id",
        "sales_amount",
        "payment_amount",
        F.round(delta, 2).cast(MONEY).alias("amount_delta"),
        status.alias("reconciliation_status"),
    )


def customer_activity(sales: DataFrame) -> DataFrame:
    """Last order day, order count, spend and channel count of each customer.

    Two steps replace distinct aggregates: first one row per customer and channel
    (reduced before the shuffle, so a very active customer is no hot task).
    """
    per_channel = sales.groupBy("customer_id", "channel").agg(
        F.max(F.to_date("ordered_at")).alias("last_order_date"),
        F.count("order_id").alias("orders"),
        F.sum("sales_amount").alias("spend"),
    )
    return per_channel.groupBy("customer_id").agg(
        F.max("last_order_date").alias("last_order_date"),
        F.sum("orders").alias("frequency"),
        F.sum("spend").cast(MONEY).alias("monetary"),
        F.count("channel").alias("active_channels"),
    )


def customer_rfm(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Quartile scores for recency, frequency and spend, and the segment they give."""
    activity = customer_activity(sales).join(
        customers.select("customer_id"), "customer_id", "left_semi"
    )
    scored = tile_scores(
        activity,
        "customer_id",
        {
            "recency_score": F.unix_date("last_order_date"),
            "frequency_score": F.col("frequency"),
            "monetary_score": F.col("monetary"),
        },
    )
    anchor = scored.agg(F.max("last_order_date")).scalar()
    r, f, m = (F.col(f"{x}_score") for x in ("recency", "frequency", "monetary"))
    segment = (
        F.when(r + f + m >= 10, "champions")
        .when(r + f + m >= 8, "loyal")
        .when((r >= 3) & (f <= 2), "promising")
        .when((r <= 2) & (m >= 3), "at_risk")
        .otherwise("developing")
    )
    return scored.withColumn("recency_days", F.datediff(anchor, "last_order_date")).withColumn(
        "rfm_segment", segment
    )


def price_signals(products: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Demand, discount, realised price, stock cover and demand index per product.

    The facts are aggregated once; stock availability reuses the same unit sums.
    """
    demand = sales.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.round(F.sum("discount_rate").cast("double") / F.count("discount_rate"), 4).alias(
            "average_discount_rate"
        ),
        F.round(ratio(F.sum("sales_amount"), F.sum("quantity")), 2).alias("realized_unit_price"),
    )
    catalogue = products.select("product_id", "product_name", "category", "current_price")
    signals = pin(
        _available(inventory.join(demand, "product_id")).join(catalogue, "product_id"), "signals"
    )
    mean_units = signals.agg(F.avg("units_sold")).scalar()
    return signals.select(
        "product_id",
        "product_name",
        "category",
        "current_price",
        "available_to_promise",
        "risk_level",
        "units_sold",
        "average_discount_rate",
        "realized_unit_price",
        F.round(ratio(F.col("units_sold"), mean_units), 3).alias("demand_index"),
        F.round(ratio(F.col("available_to_promise"), F.col("units_sold")), 3).alias(
            "stock_cover_ratio"
        ),
    )


def repricing(products: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Recommended action, price and reason; thresholds apply to the rounded signals."""
    index, cover = F.col("demand_index"), F.col("stock_cover_ratio")
    action = (
        F.when((F.col("risk_level") == "critical") & (index >= 1.1), "protect_margin")
        .when(
            (F.col("risk_level") == "healthy") & (cover >= 2) & (index < 0.9),
            "accelerate_sell_through",
        )
        .otherwise("hold")
    )
    chosen, price = F.col("recommended_action"), F.col("current_price")
    new_price = (
        F.when(chosen == "protect_margin", price * F.lit(RAISE))
        .when(chosen == "accelerate_sell_through", price * F.lit(CUT))
        .otherwise(price)
    )
    reason = (
        F.when(chosen == "protect_margin", REASON_PROTECT)
        .when(chosen == "accelerate_sell_through", REASON_ACCELERATE)
        .otherwise(REASON_HOLD)
    )
    return (
        price_signals(products, inventory, sales)
        .withColumn("recommended_action", action)
        .withColumn("recommended_price", F.round(new_price, 2).cast(MONEY))
        .withColumn("recommendation_reason", reason)
    )


def ratio_to_max(df: DataFrame, value: str, name: str = "ratio_to_max") -> DataFrame:
    """Value over the largest value of the set; negatives count as 0, the maximum as at least 1."""
    top = F.greatest(df.agg(F.max(value)).scalar(), F.lit(1)).cast("double")
    return df.withColumn(name, F.greatest(F.col(value), F.lit(0)).cast("double") / top)
