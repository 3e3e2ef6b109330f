"""Explicit schemas of the eight source tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Table name -> (landing file, columns in file order).
SOURCE_COLUMNS: dict[str, tuple[str, str]] = {
    "products": (
        "products.csv",
        "product_id string, name string, category string, department string, "
        "collection string, price decimal(12,2), currency string",
    ),
    "customers": (
        "customers.csv",
        "customer_id string, email_hash string, loyalty_id string, country string, "
        "acquisition_channel string, consent_marketing boolean",
    ),
    "customer_identities": (
        "customer_identities.csv",
        "source_system string, source_customer_id string, email_hash string",
    ),
    "inventory": (
        "stock.csv",
        "product_id string, store_stock int, warehouse_stock int, reserved int, "
        "incoming int, safety_stock int",
    ),
    "orders": (
        "orders.csv",
        "order_id string, source_customer_id string, product_id string, channel string, "
        "store_id string, quantity int, unit_price decimal(12,2), discount_rate decimal(5,4), "
        "ordered_at timestamp, payment_status string",
    ),
    "payments": (
        "payments.csv",
        "transaction_id string, order_id string, amount decimal(12,2), currency string, "
        "status string, payment_method string, paid_at timestamp",
    ),
    "retail_events": (
        "stream_events.csv",
        "event_id string, event_type string, order_id string, source_customer_id string, "
        "product_id string, channel string, quantity int, event_at timestamp, latency_ms int, "
        "partition_key string",
    ),
    "price_history": (
        "price_history.csv",
        "product_id string, price decimal(12,2), valid_from date, valid_to date, "
        "is_current boolean",
    ),
}

SOURCE_NAMES = tuple(SOURCE_COLUMNS)

# Column whose lower bound may be applied before deduplication (see staging).
EVENT_TIME = {"orders": "ordered_at", "payments": "paid_at", "retail_events": "event_at"}


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(SOURCE_COLUMNS[name][1])


def file_of(name: str) -> str:
    return SOURCE_COLUMNS[name][0]
