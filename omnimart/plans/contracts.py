"""The publication contracts over the raw sources."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from omnimart.functions.scalars import amounts_agree, is_email_hash, line_amount, moment
from omnimart.operators.dedup import keep_latest
from omnimart.session import pin

# Contract names.
CONTRACTS = (
    "contract.orders.order_id_unique",
    "contract.events.event_id_unique",
    "contract.payments.transaction_id_unique",
    "contract.identities.source_customer_id_unique",
    "integrity.orders_product_fk",
    "integrity.orders_identity_fk",
    "integrity.events_identity_fk",
    "integrity.identity_hash_fk",
    "integrity.payments_order_fk",
    "business.positive_quantities",
    "business.positive_sales_amount",
    "business.discount_rate_in_range",
    "stream.purchase_count_matches_batch",
    "stream.purchase_units_match_batch",
    "stream.purchase_order_ids_match_batch",
    "stream.partition_key_matches_customer",
    "payments.one_settlement_per_order",
    "payments.status_settled",
    "payments.amount_matches_sales",
    "privacy.email_hash_shape",
    "scd.one_current_version_per_product",
    "scd.current_version_is_open_ended",
    "scd.version_ranges_do_not_overlap",
    "freshness.latest_event_under_24h",
)

OPEN_END = "9999-12-31"

# Columns the contracts read of the large sources.
USED = {
    "orders": (
        "order_id",
        "source_customer_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_rate",
        "ordered_at",
    ),
    "retail_events": (
        "event_id",
        "event_type",
        "order_id",
        "source_customer_id",
        "quantity",
        "event_at",
        "partition_key",
    ),
    "payments": ("transaction_id", "order_id", "amount", "status", "paid_at"),
}


def stored(
    raw: Mapping[str, DataFrame], *names: str, more: Mapping[str, Sequence[str]] = {}
) -> dict[str, DataFrame]:
    """The sources with the named large ones stored once, in the columns used here and any more that a caller reads.

    Worth it for a source that is costly to produce (parsed text, a join), since
    several contracts read it. The writes run side by side.
    """
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        tables = pool.map(lambda n: pin(raw[n].select(*USED[n], *more.get(n, ())), n), names)
        return {**raw, **dict(zip(names, tables))}


def run_contracts(raw: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """One row per contract: violations, passed.

    Every source adds signed amounts under a contract name; a contract holds when
    its amounts sum to zero. Two sides of a comparison thus need no join: one adds,
    the other subtracts.
    """
    amounts = reduce(DataFrame.unionByName, _amounts(raw, as_of))
    names = amounts.sparkSession.createDataFrame([(n,) for n in CONTRACTS], "contract string")
    totals = amounts.groupBy("contract").agg(F.abs(F.sum("amount")).alias("violations"))
    return names.join(totals, "contract", "left").select(
        "contract",
        F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"),
        (F.coalesce("violations", F.lit(0)) == 0).alias("passed"),
    )


def as_check_results(contracts: DataFrame) -> DataFrame:
    """Contracts in the shape of table checks, for the common score."""
    return contracts.select(
        F.col("contract").alias("check"),
        F.split_part("contract", F.lit("."), F.lit(1)).alias("kind"),
        F.lit("sources").alias("table"),
        "violations",
        F.when(F.col("passed"), "pass").otherwise("fail").alias("status"),
    )


def _row(one_row: DataFrame, **amounts: Column) -> DataFrame:
    """Signed amounts of a one-row aggregate, keyed by contract position."""
    entries = [
        F.struct(
            F.lit(CONTRACTS[int(key[1:]) - 1]).alias("contract"),
            F.coalesce(value, F.lit(0)).cast("bigint").alias("amount"),
        )
        for key, value in amounts.items()
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _amounts(raw: Mapping[str, DataFrame], as_of: datetime) -> Iterator[DataFrame]:
    orders, events, payments = raw["orders"], raw["retail_events"], raw["payments"]
    identities, customers = raw["customer_identities"], raw["customers"]
    prices, products = raw["price_history"], raw["products"]
    purchases = events.filter("event_type = 'purchase'")

    yield _repeats(events, "event_id", 2)
    yield _repeats(payments, "transaction_id", 3)
    yield _orders_ledger(orders, payments, purchases)
    yield _identity_ledger(identities, orders, events)
    yield _orphans("product_id", products, orders, 5)
    yield _orphans("email_hash", customers, identities, 8)

    amount = line_amount("quantity", "unit_price")
    rate = F.col("discount_rate")
    yield _row(
        orders.agg(
            F.count_if(_not(F.col("quantity") > 0)).alias("q"),
            F.count_if(_not(amount > 0)).alias("a"),
            F.count_if(_not((rate >= 0) & (rate < 1))).alias("d"),
            F.count("*").alias("n"),
            F.sum("quantity").alias("units"),
        ),
        c10=F.col("q"),
        c11=F.col("a"),
        c12=F.col("d"),
        c13=-F.col("n"),
        c14=-F.col("units"),
    )
    bought = F.col("event_type") == "purchase"
    age = F.unix_timestamp(moment(as_of)) - F.unix_timestamp("latest")
    yield _row(
        events.agg(
            F.count_if(bought).alias("n"),
            F.sum(F.when(bought, F.col("quantity"))).alias("units"),
            F.count_if(~F.col("partition_key").eqNullSafe(F.col("source_customer_id"))).alias("k"),
            F.max("event_at").alias("latest"),
        ),
        c13=F.col("n"),
        c14=F.col("units"),
        c16=F.col("k"),
        # No event at all counts as stale.
        c24=F.when(age < 24 * 3600, 0).otherwise(1),
    )
    yield _row(
        payments.agg(F.count_if(_not(F.col("status") == "settled")).alias("n")), c18=F.col("n")
    )
    yield _row(_amount_gaps(orders, payments).agg(F.count("*").alias("n")), c19=F.col("n"))
    yield _row(
        customers.agg(F.count_if(~is_email_hash("email_hash")).alias("n")), c20=F.col("n")
    )
    current = F.count_if(F.col("is_current"))
    yield _row(
        prices.groupBy("product_id")
        .agg(current.alias("current"))
        .agg(F.count_if(F.col("current") != 1).alias("n")),
        c21=F.col("n"),
    )
    still_open = F.col("valid_to") == F.lit(OPEN_END).cast("date")
    yield _row(
        prices.agg(F.count_if(F.col("is_current") & _not(still_open)).alias("n")), c22=F.col("n")
    )
    yield _row(version_overlaps(prices).agg(F.sum("overlaps").alias("n")), c23=F.col("n"))


def _not(condition: Column) -> Column:
    """True when the condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def _repeats(df: DataFrame, key: str, contract: int) -> DataFrame:
    """Rows beyond the first of each key."""
    extra = df.groupBy(key).agg((F.count("*") - 1).alias("extra"))
    return _row(extra.agg(F.sum("extra").alias("n")), **{f"c{contract}": F.col("n")})


def _ledger(key: str, **sides: DataFrame) -> DataFrame:
    """Rows of each side per key, by one grouping that first adds up in every task."""
    entries = [
        df.select(key, *[F.lit(int(other == side)).alias(other) for other in sides])
        for side, df in sides.items()
    ]
    sums = [F.sum(side).alias(side) for side in sides]
    return reduce(DataFrame.unionByName, entries).groupBy(key).agg(*sums)


def _rows_without(side: str, parent: str) -> Column:
    """Rows of ``side`` whose key the parent lacks; a null key has no parent."""
    return F.sum(F.when(F.col(parent) == 0, F.col(side)))


def _extra(side: str) -> Column:
    return F.sum(F.greatest(F.col(side) - 1, F.lit(0)))


def _one_sided(a: str, b: str) -> Column:
    return F.count_if((F.col(a) > 0) != (F.col(b) > 0))


def _orders_ledger(orders: DataFrame, payments: DataFrame, purchases: DataFrame) -> DataFrame:
    ledger = _ledger("order_id", orders=orders, payments=payments, purchases=purchases)
    return _row(
        ledger.agg(
            _extra("orders").alias("repeated"),
            _rows_without("payments", "orders").alias("unknown"),
            _one_sided("purchases", "orders").alias("streamed"),
            _one_sided("payments", "orders").alias("settled"),
        ),
        c1=F.col("repeated"),
        c9=F.col("unknown"),
        c15=F.col("streamed"),
        c17=F.col("settled"),
    )


def _identity_ledger(identities: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    known = identities.filter(F.col("source_customer_id").isNotNull())
    ledger = _ledger("source_customer_id", identities=known, orders=orders, events=events)
    return _row(
        ledger.agg(
            _extra("identities").alias("repeated"),
            _rows_without("orders", "identities").alias("orders"),
            _rows_without("events", "identities").alias("events"),
        ),
        c4=F.col("repeated"),
        c6=F.col("orders"),
        c7=F.col("events"),
    )


def _orphans(key: str, parent: DataFrame, child: DataFrame, contract: int) -> DataFrame:
    ledger = _ledger(key, parent=parent.filter(F.col(key).isNotNull()), child=child)
    return _row(
        ledger.agg(_rows_without("child", "parent").alias("n")), **{f"c{contract}": F.col("n")}
    )


def _amount_gaps(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders whose latest payment differs from their latest amount; none counts as minus one."""
    due = keep_latest(
        orders.select("order_id", "ordered_at", line_amount("quantity", "unit_price").alias("due")),
        "order_id",
        "ordered_at",
    )
    paid = keep_latest(payments.select("order_id", "paid_at", "amount"), "order_id", "paid_at")
    agrees = amounts_agree(F.coalesce("amount", F.lit(-1)), F.col("due"))
    return due.join(paid, "order_id", "left").filter(_not(agrees))


def version_overlaps(prices: DataFrame) -> DataFrame:
    """Versions that reach into their successor, per product and start day.

    Versions are first reduced to one row per product and day, so the window of a
    product holds at most one row per calendar day however many versions it has.
    Among versions starting the same day, all but the last-ending one overlap the
    next if they are not empty.
    """
    per_day = prices.groupBy("product_id", "valid_from").agg(
        F.max("valid_to").alias("valid_to"),
        F.count_if(F.col("valid_to") >= F.col("valid_from")).alias("filled"),
    )
    successor = F.lead("valid_from").over(Window.partitionBy("product_id").orderBy("valid_from"))
    same_day = F.greatest(F.col("filled") - 1, F.lit(0))
    reaches = F.when(F.col("valid_to") >= F.col("next_from"), 1).otherwise(0)
    return (
        per_day.withColumn("next_from", successor)
        .withColumn("overlaps", same_day + reaches)
        .filter("overlaps > 0")
        .select("product_id", "valid_from", "valid_to", "next_from", "overlaps")
    )
