"""The retail sources derived from an order/line/part/customer star schema.

Each function is a plain projection (plus one equi-join for orders), so a time
bound or a column list set downstream still reaches the Parquet scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from omnimart.functions.scalars import email_hash, moment

# Days by which the web events are moved back so that they end with the sales.
WEB_EVENT_SHIFT_DAYS = 8122

# Identity feed as (system name, id prefix).
IDENTITY_SYSTEMS = (("CRM", "CRM"), ("Ecommerce", "WEB"), ("POS", "POS"), ("Marketplace", "MKT"))


CHANNEL = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'WEB'
    WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Store'
    ELSE 'MarketPlace' END AS channel"""

LINE = (
    "concat_ws('-', l_orderkey, l_linenumber) AS order_id",
    "cast(l_partkey AS string) AS product_id",
    "cast(l_quantity AS int) AS quantity",
    "cast(l_extendedprice AS decimal(12,2)) AS unit_price",
    "cast(l_discount AS decimal(5,4)) AS discount_rate",
    "cast(l_shipdate AS timestamp) AS ordered_at",
)

ID_PREFIX = "CASE channel WHEN 'WEB' THEN 'WEB' WHEN 'Store' THEN 'POS' ELSE 'MKT' END"


class StarSource:
    """Serves the source tables by name from a folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}

    def _read(self, table: str) -> DataFrame:
        path = f"{self.folder}/{table}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def table(self, name: str, since: datetime | None = None) -> DataFrame:
        build = getattr(self, f"_{name}")
        return build(since) if name in ("orders", "payments", "retail_events") else build()

    # -- transactions ------------------------------------------------------

    def _line_columns(self, since: datetime | None) -> DataFrame:
        lines = self._read("lineitem")
        if since is not None:
            lines = lines.filter(F.col("l_shipdate") >= moment(since).cast("timestamp_ntz"))
        return lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
        )

    def _lines(self, since: datetime | None) -> DataFrame:
        return self._line_columns(since).selectExpr("l_orderkey", "l_linenumber", *LINE)

    def _order_lines(self, since: datetime | None) -> DataFrame:
        """Lines with the channel and customer of their order; texts are made after the shuffle, which moves keys and numbers only."""
        headers = self._read("orders").selectExpr("o_orderkey", "o_custkey", CHANNEL)
        return (
            self._line_columns(since)
            .join(headers, F.expr("l_orderkey = o_orderkey"))
            .selectExpr("l_orderkey", "l_linenumber", *LINE, "o_custkey", "channel")
            .selectExpr("*", f"concat_ws('-', {ID_PREFIX}, o_custkey) AS source_customer_id")
        )

    def _orders(self, since: datetime | None = None) -> DataFrame:
        return self._order_lines(since).selectExpr(
            "order_id",
            "source_customer_id",
            "product_id",
            "channel",
            """CASE WHEN channel = 'Store'
                THEN concat('S', lpad(cast(1 + l_orderkey % 18 AS string), 3, '0'))
                ELSE 'ONLINE' END AS store_id""",
            "quantity",
            "unit_price",
            "discount_rate",
            "ordered_at",
            "'Paid' AS payment_status",
        )

    def _payments(self, since: datetime | None = None) -> DataFrame:
        return (
            self._lines(since)
            .filter("l_orderkey % 97 <> 0")
            .selectExpr(
                "concat('T-', order_id) AS transaction_id",
                "order_id",
                """cast(quantity * unit_price + if(l_orderkey % 89 = 0, 1, 0) AS decimal(12,2))
                    AS amount""",
                "'EUR' AS currency",
                "if(l_orderkey % 83 = 0, 'Pending', 'Settled') AS status",
                """CASE l_linenumber % 3 WHEN 0 THEN 'Card' WHEN 1 THEN 'PayPal' ELSE 'Cash' END
                    AS payment_method""",
                "ordered_at AS paid_at",
            )
        )

    def _retail_events(self, since: datetime | None = None) -> DataFrame:
        return self.purchase_events(since).unionByName(self.web_events(since))

    def purchase_events(self, since: datetime | None = None) -> DataFrame:
        # An event follows its order by a few seconds at most, so orders up to a
        # minute before the bound may have an event after it.
        lines = self._order_lines(None if since is None else since - timedelta(minutes=1))
        events = (
            lines.filter("l_orderkey % 103 <> 0")
            .selectExpr(
                "*", "cast(180 + (l_orderkey * 31 + l_linenumber * 17) % 3400 AS int) AS latency_ms"
            )
            .selectExpr(
                "concat('E-', order_id) AS event_id",
                "'Purchase' AS event_type",
                "order_id",
                "source_customer_id",
                "product_id",
                "channel",
                "quantity + if(l_orderkey % 101 = 0, 1, 0) AS quantity",
                "timestamp_millis(unix_millis(ordered_at) + latency_ms) AS event_at",
                "latency_ms",
                "if(l_orderkey % 211 = 0, 'unknown', source_customer_id) AS partition_key",
            )
        )
        return events if since is None else events.filter(F.col("event_at") >= moment(since))

    def web_events(self, since: datetime | None = None) -> DataFrame:
        return map_web_events(self._read("events"), self.product_count(), since)

    def product_count(self) -> int:
        return self._read("part").count()

    # -- master data -------------------------------------------------------

    def _products(self) -> DataFrame:
        return self._read("part").selectExpr(
            "cast(p_partkey AS string) AS product_id",
            "p_name AS name",
            "p_type AS category",
            "p_brand AS department",
            "concat('Size ', p_size) AS collection",
            "cast(p_retailprice AS decimal(12,2)) AS price",
            "'EUR' AS currency",
        )

    def _customers(self) -> DataFrame:
        nations = self._read("nation").select("n_nationkey", "n_name")
        return (
            self._read("customer")
            .join(nations, F.expr("c_nationkey = n_nationkey"), "left")
            .withColumn("email_hash", email_hash("c_name"))
            .selectExpr(
                "cast(c_custkey AS string) AS customer_id",
                "email_hash",
                "if(c_custkey % 5 = 0, '', concat('L', c_custkey)) AS loyalty_id",
                "n_name AS country",
                "lower(c_mktsegment) AS acquisition_channel",
                "c_custkey % 4 <> 0 AS consent_marketing",
            )
        )

    def _customer_identities(self) -> DataFrame:
        """Four links per customer, some marketplace links missing, some POS links sent twice."""
        links = ", ".join(
            f"named_struct('source_system', '{system}', 'prefix', '{prefix}')"
            for system, prefix in (*IDENTITY_SYSTEMS, ("Partner", "POS"))
        )
        return (
            self._read("customer")
            .withColumn("email_hash", email_hash("c_name"))
            .selectExpr("c_custkey", "email_hash", f"inline(array({links}))")
            .filter("source_system <> 'Marketplace' OR c_custkey % 50 <> 7")
            .filter("source_system <> 'Partner' OR c_custkey % 40 = 3")
            .selectExpr(
                "source_system",
                "concat_ws('-', prefix, c_custkey) AS source_customer_id",
                "email_hash",
            )
        )

    def _inventory(self) -> DataFrame:
        return self._read("part").selectExpr(
            "cast(p_partkey AS string) AS product_id",
            "cast(p_partkey * 37 % 421 AS int) AS store_stock",
            "cast(p_partkey * 53 % 751 AS int) AS warehouse_stock",
            "cast(12 + p_partkey * 11 % 54 AS int) AS reserved",
            "cast(80 + p_partkey * 29 % 221 AS int) AS incoming",
            "cast(65 + p_partkey * 17 % 76 AS int) AS safety_stock",
        )

    def _price_history(self) -> DataFrame:
        """Two versions per product; every 500th has an overlap, every 700th no current price."""
        former = """named_struct('price', cast(round(price * 1.08BD, 2) AS decimal(12,2)),
            'valid_from', date'1995-01-01',
            'valid_to', if(p_partkey % 500 = 0, date'1998-01-01', date'1997-12-31'),
            'is_current', false)"""
        current = """named_struct('price', price, 'valid_from', date'1998-01-01',
            'valid_to', date'9999-12-31', 'is_current', p_partkey % 700 <> 0)"""
        return (
            self._read("part")
            .selectExpr("p_partkey", "cast(p_retailprice AS decimal(12,2)) AS price")
            .selectExpr(
                "cast(p_partkey AS string) AS product_id", f"inline(array({former}, {current}))"
            )
        )


def map_web_events(events: DataFrame, products: int, since: datetime | None = None) -> DataFrame:
    """Web events from the events table, spread over all products; for a batch and a stream."""
    shift = f"INTERVAL {WEB_EVENT_SHIFT_DAYS} DAY"
    if since is not None:
        bound = moment(since + timedelta(days=WEB_EVENT_SHIFT_DAYS)).cast("timestamp_ntz")
        events = events.filter(F.col("ts") >= bound)
    return events.selectExpr(
        "concat('W-', event_id) AS event_id",
        """CASE event_type WHEN 'view' THEN 'Product_View' WHEN 'click' THEN 'Add_To_Cart'
            WHEN 'purchase' THEN 'Checkout' ELSE event_type END AS event_type""",
        "'' AS order_id",
        "concat('WEB-', user_id) AS source_customer_id",
        f"cast(event_id % {max(products, 1)} AS string) AS product_id",
        "'web' AS channel",
        "0 AS quantity",
        f"cast(ts - {shift} AS timestamp) AS event_at",
        "90 + 25 * cast(get_json_object(props, '$.k') AS int) AS latency_ms",
        "concat('WEB-', user_id) AS partition_key",
    )
