"""Identity bridge, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from omnimart.operators.keysets import join_unique


def identity_bridge(identities: DataFrame, customers: DataFrame) -> DataFrame:
    """Source customer ids with the customer their e-mail hash resolves to."""
    known = customers.select("email_hash", "customer_id")
    return identities.join(known, "email_hash").select(
        "source_system", "source_customer_id", "email_hash", "customer_id"
    )


def dim_customer(customers: DataFrame, bridge: DataFrame) -> DataFrame:
    links = bridge.groupBy("customer_id").agg(
        F.count("source_customer_id").alias("resolved_identity_count")
    )
    return customers.join(links, "customer_id", "left").fillna(0, ["resolved_identity_count"])


def dim_product(products: DataFrame) -> DataFrame:
    return products


def dim_product_price(price_history: DataFrame) -> DataFrame:
    return price_history


def _resolve(facts: DataFrame, bridge: DataFrame) -> DataFrame:
    # The bridge has one row per source id, so only the facts can have a hot key.
    links = bridge.select("source_customer_id", "customer_id")
    return join_unique(facts, links, "source_customer_id")


def _columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, as far as the staged rows carry them."""
    return df.select([c for c in names if c in df.columns])


def fct_sales(orders: DataFrame, bridge: DataFrame) -> DataFrame:
    return _columns(
        _resolve(orders, bridge),
        "order_id",
        "customer_id",
        "source_customer_id",
        "product_id",
        "channel",
        "store_id",
        "quantity",
        "unit_price",
        "discount_rate",
        "sales_amount",
        "ordered_at",
    )


def fct_retail_event(events: DataFrame, bridge: DataFrame) -> DataFrame:
    return _columns(
        _resolve(events, bridge),
        "event_id",
        "event_type",
        "order_id",
        "customer_id",
        "source_customer_id",
        "product_id",
        "channel",
        "quantity",
        "event_at",
        "latency_ms",
        "partition_key",
    )


def fct_payments(payments: DataFrame) -> DataFrame:
    return payments


def unresolved(facts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Rows the inner joins above leave out: their source id has no customer."""
    return join_unique(
        facts, bridge.select("source_customer_id"), "source_customer_id", "left_anti"
    )


def require_resolved(facts: DataFrame, bridge: DataFrame) -> None:
    """Strict form of the fact joins: raise when a row would be left out."""
    lost = unresolved(facts, bridge).limit(5).collect()
    if lost:
        raise LookupError(f"no customer for {[row['source_customer_id'] for row in lost]}")


def stamp(df: DataFrame) -> DataFrame:
    """Load time of the row; kept out of comparisons."""
    return df.withColumn("transformed_at", F.current_timestamp())
