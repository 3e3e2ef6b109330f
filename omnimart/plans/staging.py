"""Typed, normalised and deduplicated sources.

``since`` bounds the event time from below. Keeping the latest row per key
commutes with such a bound (a key survives it exactly when its latest row does),
so the source applies it first and the scan skips older data.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime
from typing import Protocol

from pyspark.sql import DataFrame

from omnimart.functions.scalars import line_amount
from omnimart.operators.dedup import keep_latest_part, keep_lowest


class Source(Protocol):
    def table(self, name: str, since: datetime | None = None) -> DataFrame: ...


def typed_orders(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "cast(order_id AS string) AS order_id",
        "cast(source_customer_id AS string) AS source_customer_id",
        "cast(product_id AS string) AS product_id",
        "lower(channel) AS channel",
        "cast(store_id AS string) AS store_id",
        "cast(quantity AS int) AS quantity",
        "cast(unit_price AS decimal(12,2)) AS unit_price",
        "cast(discount_rate AS decimal(5,4)) AS discount_rate",
        "cast(ordered_at AS timestamp) AS ordered_at",
        "lower(payment_status) AS payment_status",
    )


# Tie-breaking order of the rows of one key; often used columns come first.
ORDER_PRECEDENCE = (
    "product_id",
    "quantity",
    "unit_price",
    "source_customer_id",
    "channel",
    "discount_rate",
    "store_id",
    "payment_status",
)
PAYMENT_PRECEDENCE = ("order_id", "amount", "status", "payment_method", "currency")
EVENT_PRECEDENCE = (
    "source_customer_id",
    "event_type",
    "order_id",
    "quantity",
    "channel",
    "latency_ms",
    "product_id",
    "partition_key",
)


def stg_orders(
    source: Source, since: datetime | None = None, wanted: Collection[str] | None = None
) -> DataFrame:
    """Latest row per order; ``wanted`` names the columns a caller uses, by default all."""
    return latest_orders(typed_orders(source.table("orders", since)), wanted)


def latest_orders(typed: DataFrame, wanted: Collection[str] | None = None) -> DataFrame:
    """The same of orders that are typed already, in at least the columns that ``wanted`` calls for."""
    if wanted is not None and "sales_amount" in wanted:
        wanted = {*wanted, "quantity", "unit_price"}
    latest = keep_latest_part(typed, "order_id", "ordered_at", ORDER_PRECEDENCE, wanted)
    if wanted is not None and "sales_amount" not in wanted:
        return latest
    return latest.withColumn("sales_amount", line_amount("quantity", "unit_price"))


def typed_payments(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "cast(transaction_id AS string) AS transaction_id",
        "cast(order_id AS string) AS order_id",
        "cast(amount AS decimal(12,2)) AS amount",
        "cast(currency AS string) AS currency",
        "lower(status) AS status",
        "lower(payment_method) AS payment_method",
        "cast(paid_at AS timestamp) AS paid_at",
    )


def stg_payments(
    source: Source, since: datetime | None = None, wanted: Collection[str] | None = None
) -> DataFrame:
    return keep_latest_part(
        typed_payments(source.table("payments", since)),
        "transaction_id",
        "paid_at",
        PAYMENT_PRECEDENCE,
        wanted,
    )


def typed_events(raw: DataFrame) -> DataFrame:
    """Shared by the batch and the stream path."""
    return raw.selectExpr(
        "cast(event_id AS string) AS event_id",
        "lower(event_type) AS event_type",
        "nullif(cast(order_id AS string), '') AS order_id",
        "cast(source_customer_id AS string) AS source_customer_id",
        "cast(product_id AS string) AS product_id",
        "lower(channel) AS channel",
        "cast(quantity AS int) AS quantity",
        "cast(event_at AS timestamp) AS event_at",
        "cast(latency_ms AS int) AS latency_ms",
        "cast(partition_key AS string) AS partition_key",
    )


def stg_retail_events(
    source: Source, since: datetime | None = None, wanted: Collection[str] | None = None
) -> DataFrame:
    return latest_events(typed_events(source.table("retail_events", since)), wanted)


def latest_events(typed: DataFrame, wanted: Collection[str] | None = None) -> DataFrame:
    return keep_latest_part(typed, "event_id", "event_at", EVENT_PRECEDENCE, wanted)


def typed_identities(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "lower(source_system) AS source_system",
        "cast(source_customer_id AS string) AS source_customer_id",
        "cast(email_hash AS string) AS email_hash",
    )


def stg_customer_identities(source: Source) -> DataFrame:
    typed = typed_identities(source.table("customer_identities"))
    return keep_lowest(typed, "source_customer_id", "source_system")


def stg_customers(source: Source) -> DataFrame:
    return source.table("customers").selectExpr(
        "cast(customer_id AS string) AS customer_id",
        "cast(email_hash AS string) AS email_hash",
        "nullif(cast(loyalty_id AS string), '') AS loyalty_id",
        "cast(country AS string) AS country",
        "cast(acquisition_channel AS string) AS acquisition_channel",
        "cast(consent_marketing AS boolean) AS consent_marketing",
    )


def stg_products(source: Source) -> DataFrame:
    return source.table("products").selectExpr(
        "cast(product_id AS string) AS product_id",
        "cast(name AS string) AS product_name",
        "cast(category AS string) AS category",
        "cast(department AS string) AS department",
        "cast(collection AS string) AS collection_name",
        "cast(price AS decimal(12,2)) AS current_price",
        "cast(currency AS string) AS currency",
    )


def stg_inventory(source: Source) -> DataFrame:
    counts = ("store_stock", "warehouse_stock", "reserved", "incoming", "safety_stock")
    return source.table("inventory").selectExpr(
        "cast(product_id AS string) AS product_id", *[f"cast({c} AS int) AS {c}" for c in counts]
    )


def stg_price_history(source: Source) -> DataFrame:
    return source.table("price_history").selectExpr(
        "cast(product_id AS string) AS product_id",
        "cast(price AS decimal(12,2)) AS price",
        "cast(valid_from AS date) AS valid_from",
        "cast(valid_to AS date) AS valid_to",
        "cast(is_current AS boolean) AS is_current",
    )


def typed_sources(source: Source) -> dict[str, DataFrame]:
    """All sources typed and normalised but with their duplicates, for the contracts."""
    return {
        "orders": typed_orders(source.table("orders")),
        "payments": typed_payments(source.table("payments")),
        "retail_events": typed_events(source.table("retail_events")),
        "customer_identities": typed_identities(source.table("customer_identities")),
        "customers": stg_customers(source),
        "products": stg_products(source),
        "inventory": stg_inventory(source),
        "price_history": stg_price_history(source),
    }
