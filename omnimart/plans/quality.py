"""The checks each table has to pass, and source freshness."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from omnimart.operators.checks import (
    Check,
    FrameCheck,
    ParentCheck,
    UniqueCheck,
    accepted,
    not_null,
)
from omnimart.operators.keysets import quantity_mismatches
from omnimart.plans.marts import CUT, RAISE
from omnimart.functions.scalars import HALF_CENT, moment

# Columns that may not be null, per table.
NOT_NULL = {
    "stg_orders": ("order_id", "source_customer_id", "quantity"),
    "stg_products": ("product_id",),
    "stg_customers": ("customer_id", "email_hash"),
    "stg_customer_identities": ("source_customer_id", "email_hash"),
    "stg_inventory": ("product_id",),
    "stg_payments": ("transaction_id", "order_id"),
    "stg_retail_events": ("event_id", "source_customer_id"),
    "stg_price_history": ("product_id",),
    "identity_bridge": ("source_customer_id", "customer_id"),
    "dim_product": ("product_id",),
    "dim_customer": ("customer_id", "resolved_identity_count"),
    "dim_product_price": ("product_id", "valid_from", "is_current"),
    "fct_sales": ("order_id", "customer_id", "product_id", "sales_amount"),
    "fct_retail_event": ("event_id",),
    "fct_payments": ("transaction_id", "order_id"),
    "payment_reconciliation": ("order_id",),
    "available_to_promise": ("product_id", "available_to_promise"),
    "customer_rfm": ("customer_id",),
    "repricing": ("product_id", "recommended_price"),
}

# Columns whose values may not repeat, per table.
UNIQUE = {
    "stg_orders": ("order_id",),
    "stg_products": ("product_id",),
    "stg_customers": ("customer_id", "email_hash"),
    "stg_customer_identities": ("source_customer_id",),
    "stg_inventory": ("product_id",),
    "stg_payments": ("transaction_id",),
    "stg_retail_events": ("event_id",),
    "identity_bridge": ("source_customer_id",),
    "dim_product": ("product_id",),
    "dim_customer": ("customer_id",),
    "fct_sales": ("order_id",),
    "fct_retail_event": ("event_id",),
    "fct_payments": ("transaction_id",),
    "payment_reconciliation": ("order_id",),
    "available_to_promise": ("product_id",),
    "customer_rfm": ("customer_id",),
    "repricing": ("product_id",),
}

# Fixed values: (table, key, parent table), the key having the same name in both.
PARENTS = (
    ("identity_bridge", "customer_id", "stg_customers"),
    ("dim_product_price", "product_id", "dim_product"),
    ("fct_sales", "customer_id", "dim_customer"),
    ("fct_sales", "product_id", "dim_product"),
    ("fct_retail_event", "customer_id", "dim_customer"),
    ("fct_retail_event", "product_id", "dim_product"),
    ("fct_payments", "order_id", "fct_sales"),
    ("customer_rfm", "customer_id", "dim_customer"),
    ("repricing", "product_id", "dim_product"),
)

# Columns of the large models that the checks, and the models built on these, read.
USED = {
    "stg_orders": (
        "order_id", "source_customer_id", "product_id", "channel", "quantity", "discount_rate", "sales_amount", "ordered_at",
    ),
    "stg_payments": ("transaction_id", "order_id", "amount", "status"),
    "stg_retail_events": ("event_id", "source_customer_id", "event_type", "order_id", "quantity", "product_id"),
    "fct_sales": (
        "order_id", "customer_id", "product_id", "channel", "quantity", "discount_rate", "sales_amount", "ordered_at",
    ),
    "fct_retail_event": ("event_id", "event_type", "order_id", "customer_id", "product_id", "quantity"),
}

SCORES = (1, 2, 3, 4)

# Fixed values: (table, column, values it may hold).
ACCEPTED = (
    ("fct_sales", "channel", ("web", "store", "marketplace")),
    ("fct_payments", "status", ("settled",)),
    ("payment_reconciliation", "reconciliation_status", ("reconciled",)),
    ("available_to_promise", "risk_level", ("critical", "watch", "healthy")),
    ("customer_rfm", "recency_score", SCORES),
    ("customer_rfm", "frequency_score", SCORES),
    ("customer_rfm", "monetary_score", SCORES),
    (
        "customer_rfm",
        "rfm_segment",
        ("champions", "loyal", "promising", "at_risk", "developing"),
    ),
    (
        "repricing",
        "recommended_action",
        ("protect_margin", "accelerate_sell_through", "hold"),
    ),
)


def negative_stock(tables) -> DataFrame:
    return tables["available_to_promise"].filter("available_to_promise < 0")


def batch_stream_gaps(tables) -> DataFrame:
    """One row per disagreeing (batch, stream) pair, copies counted inside."""
    purchases = tables["fct_retail_event"].filter("event_type = 'purchase'")
    return quantity_mismatches(tables["fct_sales"], purchases)


def unresolved_identities(tables) -> DataFrame:
    resolved = tables["identity_bridge"].filter("customer_id is not null")
    return tables["stg_customer_identities"].join(
        resolved.select("source_customer_id"), "source_customer_id", "left_anti"
    )


def not_one_current_price(tables) -> DataFrame:
    current = F.sum(F.when(F.col("is_current"), 1).otherwise(0))
    return (
        tables["dim_product_price"]
        .groupBy("product_id")
        .agg(current.alias("current_versions"))
        .filter("current_versions <> 1")
    )


def unreconciled_payments(tables) -> DataFrame:
    return tables["payment_reconciliation"].filter(
        (F.col("reconciliation_status") != "reconciled")
        | (F.abs("amount_delta") > F.lit(HALF_CENT))
    )


def prices_out_of_range(tables) -> DataFrame:
    price, new = F.col("current_price"), F.col("recommended_price")
    return tables["repricing"].filter(
        ~new.between(F.round(price * F.lit(CUT), 2), F.round(price * F.lit(RAISE), 2))
    )


EXPRESSIONS = (
    FrameCheck("available_to_promise", "available_to_promise_not_negative", negative_stock),
    FrameCheck("fct_retail_event", "batch_and_stream_agree", batch_stream_gaps),
    FrameCheck("identity_bridge", "every_identity_resolved", unresolved_identities),
    FrameCheck("dim_product_price", "one_current_price", not_one_current_price),
    FrameCheck("payment_reconciliation", "payments_reconciled", unreconciled_payments),
    FrameCheck("repricing", "price_moves_in_range", prices_out_of_range),
)


def not_null_checks() -> list[Check]:
    return [not_null(t, c) for t, columns in NOT_NULL.items() for c in columns]


def unique_checks() -> list[Check]:
    return [UniqueCheck(t, c) for t, columns in UNIQUE.items() for c in columns]


def parent_checks() -> list[Check]:
    return [ParentCheck(t, c, parent, c) for t, c, parent in PARENTS]


def accepted_checks() -> list[Check]:
    return [accepted(t, c, values) for t, c, values in ACCEPTED]


def all_checks() -> list[Check]:
    return [
        *not_null_checks(),
        *unique_checks(),
        *parent_checks(),
        *accepted_checks(),
        *EXPRESSIONS,
    ]


def freshness(
    loaded: dict[str, DataFrame],
    time: str,
    as_of: datetime,
    warn_minutes: int = 30,
    error_minutes: int = 120,
) -> DataFrame:
    """Age of the newest row per source and its status: pass, warn or error."""
    parts = [
        df.agg(F.max(time).alias("latest")).select(F.lit(name).alias("source"), "latest")
        for name, df in loaded.items()
    ]
    ages = parts[0]
    for part in parts[1:]:
        ages = ages.unionByName(part)
    minutes = (F.unix_timestamp(moment(as_of)) - F.unix_timestamp("latest")) / 60.0
    status = (
        F.when(F.col("latest").isNull() | (minutes > error_minutes), "error")
        .when(minutes > warn_minutes, "warn")
        .otherwise("pass")
    )
    return ages.select("source", "latest", minutes.alias("age_minutes"), status.alias("status"))
