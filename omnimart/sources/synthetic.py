"""Deterministic synthetic sources of any size.

Every value is a hash of the row number, the seed and a column name, so a row is
the same whatever the partitioning, and generation needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from omnimart.functions.scalars import email_hash, moment
from omnimart.sources.schemas import EVENT_TIME, SOURCE_NAMES, file_of, schema_of

SPAN_DAYS = 29  # transactions are spread over this many days before the end

# Identity systems with their id prefixes, and weights of the choices.
SYSTEMS = (("crm", "CRM"), ("ecommerce", "WEB"), ("pos", "POS"), ("marketplace", "MKT"))
CHANNEL_WEIGHTS = (("web", 48), ("store", 44), ("marketplace", 8))
QUANTITY_WEIGHTS = ((1, 70), (2, 22), (3, 7), (4, 1))
COUNTRY_WEIGHTS = (("FR", 88), ("BE", 9), ("LU", 3))
WEB_EVENT_WEIGHTS = (("product_view", 78), ("add_to_cart", 22))
DISCOUNTS = ("0", "0", "0", "0.10", "0.15", "0.20")


@dataclass
class SyntheticSource:
    spark: SparkSession
    end: datetime
    products: int = 12
    customers: int = 160
    orders: int = 960
    web_events: int = 2200
    seed: int = 42
    _start: datetime = field(init=False)

    def __post_init__(self):
        self._start = self.end - timedelta(days=SPAN_DAYS)

    # -- random-like columns -----------------------------------------------

    def _draw(self, purpose: str, key: str = "id") -> Column:
        return F.xxhash64(F.col(key), F.lit(self.seed), F.lit(purpose))

    def _between(self, purpose: str, low: int, high: int, key: str = "id") -> Column:
        return (F.pmod(self._draw(purpose, key), F.lit(high - low + 1)) + low).cast("int")

    def _weighted(self, purpose: str, weights: Sequence[tuple], key: str = "id") -> Column:
        point = F.pmod(self._draw(purpose, key), F.lit(sum(w for _, w in weights)))
        upto, choice = 0, None
        for value, weight in weights:
            upto += weight
            if choice is None:
                choice = F.when(point < upto, F.lit(value))
            else:
                choice = choice.when(point < upto, F.lit(value))
        return choice

    def _time(self, purpose: str) -> Column:
        seconds = self._between(purpose, 0, SPAN_DAYS * 86400)
        start = int(self._start.replace(tzinfo=self._start.tzinfo or timezone.utc).timestamp())
        return F.timestamp_seconds(F.lit(start) + seconds)

    # -- sources -----------------------------------------------------------

    def table(self, name: str, since: datetime | None = None) -> DataFrame:
        df = getattr(self, f"_{name}")()
        if since is not None and name in EVENT_TIME:
            df = df.filter(F.col(EVENT_TIME[name]) >= moment(since))
        return df.select(schema_of(name).names)

    def _price(self, key: str = "id") -> Column:
        """Price of a product from 19.99 to 149.99."""
        return (self._between("price", 19, 149, key) + F.lit("0.99").cast("decimal(3,2)")).cast(
            "decimal(12,2)"
        )

    def _products(self) -> DataFrame:
        return self.spark.range(self.products).select(
            F.format_string("P%d", F.col("id") + 100).alias("product_id"),
            F.format_string("Article %d", F.col("id") + 1).alias("name"),
            F.format_string("Famille %d", F.col("id") % 9 + 1).alias("category"),
            F.element_at(
                F.array(*map(F.lit, ("Femme", "Homme", "Mixte"))), (F.col("id") % 3 + 1).cast("int")
            ).alias("department"),
            F.when(F.col("id") % 3 == 0, "Saison").otherwise("Essentiels").alias("collection"),
            self._price().alias("price"),
            F.lit("EUR").alias("currency"),
        )

    def _customer_rows(self) -> DataFrame:
        email = F.format_string("client%d@example.org", F.col("id"))
        return self.spark.range(1, self.customers + 1).select(
            "id",
            F.format_string("C%04d", F.col("id")).alias("customer_id"),
            email_hash(email).alias("email_hash"),
        )

    def _customers(self) -> DataFrame:
        acquisition = (("web", 1), ("store", 1), ("catalog", 1))
        return self._customer_rows().select(
            "customer_id",
            "email_hash",
            F.when(F.col("id") % 5 == 0, "")
            .otherwise(F.format_string("L%d", F.col("id") + 10000))
            .alias("loyalty_id"),
            self._weighted("country", COUNTRY_WEIGHTS).alias("country"),
            self._weighted("acquisition", acquisition).alias("acquisition_channel"),
            (F.col("id") % 4 != 0).alias("consent_marketing"),
        )

    def _customer_identities(self) -> DataFrame:
        systems = [
            F.struct(F.lit(s).alias("source_system"), F.lit(p).alias("prefix")) for s, p in SYSTEMS
        ]
        return (
            self._customer_rows()
            .select("*", F.explode(F.array(*systems)).alias("s"))
            .select(
                "s.source_system",
                F.concat_ws("-", "s.prefix", "customer_id").alias("source_customer_id"),
                "email_hash",
            )
        )

    def _inventory(self) -> DataFrame:
        # Stock covers the orders of the default size and grows with them.
        scale = max(1, self.orders * 12 // (960 * self.products))
        return self.spark.range(self.products).select(
            F.format_string("P%d", F.col("id") + 100).alias("product_id"),
            (self._between("store", 260, 680) * scale).alias("store_stock"),
            (self._between("warehouse", 500, 1250) * scale).alias("warehouse_stock"),
            self._between("reserved", 12, 65).alias("reserved"),
            self._between("incoming", 80, 300).alias("incoming"),
            self._between("safety", 65, 140).alias("safety_stock"),
        )

    def _order_rows(self) -> DataFrame:
        prefix = (
            F.when(F.col("channel") == "web", "WEB")
            .when(F.col("channel") == "store", "POS")
            .otherwise("MKT")
        )
        discount = F.element_at(F.array(*map(F.lit, DISCOUNTS)), self._between("discount", 1, 6))
        return (
            self.spark.range(1, self.orders + 1)
            .withColumn("product_no", self._between("product", 0, self.products - 1).cast("bigint"))
            .withColumn("customer_no", self._between("customer", 1, self.customers))
            .withColumn("channel", self._weighted("channel", CHANNEL_WEIGHTS))
            .withColumn("order_id", F.format_string("O%06d", F.col("id")))
            .withColumn("product_id", F.format_string("P%d", F.col("product_no") + 100))
            .withColumn(
                "source_customer_id",
                F.concat(prefix, F.format_string("-C%04d", F.col("customer_no"))),
            )
            .withColumn("quantity", self._weighted("quantity", QUANTITY_WEIGHTS))
            .withColumn("discount_rate", discount.cast("decimal(5,4)"))
            .withColumn(
                "unit_price",
                F.round(self._price("product_no") * (1 - F.col("discount_rate")), 2).cast(
                    "decimal(12,2)"
                ),
            )
            .withColumn("ordered_at", self._time("order time"))
        )

    def _orders(self) -> DataFrame:
        store = F.format_string("S%03d", self._between("store id", 1, 18))
        return self._order_rows().select(
            "*",
            F.when(F.col("channel") == "store", store).otherwise("ONLINE").alias("store_id"),
            F.lit("paid").alias("payment_status"),
        )

    def _payments(self) -> DataFrame:
        second = F.when(F.col("channel") == "store", "cash").otherwise("paypal")
        delay = F.make_dt_interval(secs=self._between("pay delay", 1, 90))
        return self._order_rows().select(
            F.format_string("T%06d", F.col("id")).alias("transaction_id"),
            "order_id",
            (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("amount"),
            F.lit("EUR").alias("currency"),
            F.lit("settled").alias("status"),
            F.when(self._between("method", 0, 1) == 0, "card").otherwise(second).alias(
                "payment_method"
            ),
            (F.col("ordered_at") + delay).alias("paid_at"),
        )

    def _retail_events(self) -> DataFrame:
        purchases = (
            self._order_rows()
            .withColumn("latency_ms", self._between("latency", 180, 2400))
            .select(
                F.format_string("E%07d", F.col("id")).alias("event_id"),
                F.lit("purchase").alias("event_type"),
                "order_id",
                "source_customer_id",
                "product_id",
                "channel",
                "quantity",
                F.timestamp_millis(F.unix_millis("ordered_at") + F.col("latency_ms")).alias(
                    "event_at"
                ),
                "latency_ms",
                F.col("source_customer_id").alias("partition_key"),
            )
        )
        customer = F.format_string("WEB-C%04d", self._between("web customer", 1, self.customers))
        product = self._between("web product", 100, 99 + self.products)
        web = self.spark.range(1, self.web_events + 1).select(
            F.format_string("W%07d", F.col("id")).alias("event_id"),
            self._weighted("web type", WEB_EVENT_WEIGHTS).alias("event_type"),
            F.lit("").alias("order_id"),
            customer.alias("source_customer_id"),
            F.format_string("P%d", product).alias("product_id"),
            F.lit("web").alias("channel"),
            F.lit(0).alias("quantity"),
            self._time("web time").alias("event_at"),
            self._between("web latency", 90, 900).alias("latency_ms"),
            customer.alias("partition_key"),
        )
        return purchases.unionByName(web)

    def _price_history(self) -> DataFrame:
        day = self._start.date()
        price = self._price()

        def version(amount: Column, start, end, current: bool) -> Column:
            return F.struct(
                amount.cast("decimal(12,2)").alias("price"),
                F.lit(str(start)).cast("date").alias("valid_from"),
                F.lit(str(end)).cast("date").alias("valid_to"),
                F.lit(current).alias("is_current"),
            )

        former = F.round(price * F.lit("1.08").cast("decimal(3,2)"), 2)
        versions = F.array(
            version(former, day - timedelta(days=90), day - timedelta(days=1), False),
            version(price, day, "9999-12-31", True),
        )
        return (
            self.spark.range(self.products)
            .select(
                F.format_string("P%d", F.col("id") + 100).alias("product_id"),
                F.explode(versions).alias("v"),
            )
            .select("product_id", "v.*")
        )

    def write_csv(self, folder: str) -> None:
        """Landing files in time order, timestamps as ISO text with an offset."""
        for name in SOURCE_NAMES:
            df = self.table(name)
            if name in EVENT_TIME:
                df = df.repartitionByRange(EVENT_TIME[name]).sortWithinPartitions(EVENT_TIME[name])
            (
                df.write.mode("overwrite")
                .option("header", True)
                .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
                .option("emptyValue", "")
                .csv(f"{folder.rstrip('/')}/{file_of(name)}")
            )
