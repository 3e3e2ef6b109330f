"""DuckDB statements that recompute the registered queries from the same tables.

Named blocks form a small dependency list; ``statement`` puts the blocks a
query needs in front of it. Thresholds, labels, segment and status names, and output column
names are fixed values of the models, written as text where they are used.
"""

from __future__ import annotations

import re

AS_OF = "2001-11-05 06:00:00"

BLOCKS: dict[str, str] = {
    "raw_orders": """
        SELECT l_orderkey, l_linenumber,
               l_orderkey || '-' || l_linenumber AS order_id,
               CASE channel WHEN 'WEB' THEN 'WEB' WHEN 'Store' THEN 'POS' ELSE 'MKT' END
                 || '-' || o_custkey AS source_customer_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               channel,
               CASE WHEN channel = 'Store'
                    THEN 'S' || lpad(CAST(1 + l_orderkey % 18 AS VARCHAR), 3, '0')
                    ELSE 'ONLINE' END AS store_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
               CAST(l_discount AS DECIMAL(5,4)) AS discount_rate,
               l_shipdate AS ordered_at,
               'Paid' AS payment_status
        FROM lineitem
        JOIN (SELECT o_orderkey, o_custkey,
                     CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'WEB'
                          WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Store'
                          ELSE 'MarketPlace' END AS channel
              FROM orders) ON l_orderkey = o_orderkey""",
    "typed_orders": """
        SELECT order_id, source_customer_id, product_id, lower(channel) AS channel, store_id,
               quantity, unit_price, discount_rate, ordered_at,
               lower(payment_status) AS payment_status,
               CAST(quantity * unit_price AS DECIMAL(18,2)) AS sales_amount
        FROM raw_orders""",
    "stg_orders": """
        SELECT * FROM typed_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ordered_at DESC,
            product_id DESC, quantity DESC, unit_price DESC, source_customer_id DESC,
            channel DESC, discount_rate DESC, store_id DESC) = 1""",
    "raw_payments": """
        SELECT 'T-' || l_orderkey || '-' || l_linenumber AS transaction_id,
               l_orderkey || '-' || l_linenumber AS order_id,
               CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(12,2))
                    + CASE WHEN l_orderkey % 89 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS amount,
               'EUR' AS currency,
               CASE WHEN l_orderkey % 83 = 0 THEN 'Pending' ELSE 'Settled' END AS status,
               CASE l_linenumber % 3 WHEN 0 THEN 'Card' WHEN 1 THEN 'PayPal' ELSE 'Cash' END
                 AS payment_method,
               l_shipdate AS paid_at
        FROM lineitem WHERE l_orderkey % 97 <> 0""",
    "stg_payments": """
        SELECT transaction_id, order_id, amount, currency, lower(status) AS status,
               lower(payment_method) AS payment_method, paid_at
        FROM raw_payments
        QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY paid_at DESC,
            order_id DESC, amount DESC, lower(status) DESC, lower(payment_method) DESC) = 1""",
    "web_events": """
        SELECT 'W-' || event_id AS event_id,
               CASE event_type WHEN 'view' THEN 'Product_View' WHEN 'click' THEN 'Add_To_Cart'
                    WHEN 'purchase' THEN 'Checkout' ELSE event_type END AS event_type,
               '' AS order_id, 'WEB-' || user_id AS source_customer_id,
               CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS product_id, 'web' AS channel, 0 AS quantity,
               ts - INTERVAL 8122 DAY AS event_at,
               CAST(90 + 25 * CAST(json_extract_string(props, '$.k') AS INTEGER) AS INTEGER)
                 AS latency_ms,
               'WEB-' || user_id AS partition_key
        FROM events""",
    "purchase_events": """
        SELECT 'E-' || order_id AS event_id, 'Purchase' AS event_type, order_id,
               source_customer_id, product_id, channel,
               quantity + CASE WHEN l_orderkey % 101 = 0 THEN 1 ELSE 0 END AS quantity,
               ordered_at + INTERVAL 1 MILLISECOND
                 * (180 + (l_orderkey * 31 + l_linenumber * 17) % 3400) AS event_at,
               CAST(180 + (l_orderkey * 31 + l_linenumber * 17) % 3400 AS INTEGER) AS latency_ms,
               CASE WHEN l_orderkey % 211 = 0 THEN 'unknown' ELSE source_customer_id END
                 AS partition_key
        FROM raw_orders WHERE l_orderkey % 103 <> 0""",
    "raw_events": """
        SELECT * FROM purchase_events UNION ALL BY NAME SELECT * FROM web_events""",
    "stg_events": """
        SELECT event_id, lower(event_type) AS event_type, nullif(order_id, '') AS order_id,
               source_customer_id, product_id, lower(channel) AS channel, quantity, event_at,
               latency_ms, partition_key
        FROM raw_events
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_at DESC,
            source_customer_id DESC, lower(event_type) DESC, order_id DESC, quantity DESC,
            lower(channel) DESC, latency_ms DESC, product_id DESC, partition_key DESC) = 1""",
    "stg_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               substr(sha256(lower(c_name)), 1, 16) AS email_hash,
               CASE WHEN c_custkey % 5 <> 0 THEN 'L' || c_custkey END AS loyalty_id,
               n_name AS country, lower(c_mktsegment) AS acquisition_channel,
               c_custkey % 4 <> 0 AS consent_marketing
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_identities": """
        SELECT source_system, prefix || '-' || c_custkey AS source_customer_id,
               substr(sha256(lower(c_name)), 1, 16) AS email_hash
        FROM customer, (VALUES ('CRM', 'CRM'), ('Ecommerce', 'WEB'), ('POS', 'POS'),
                               ('Marketplace', 'MKT'), ('Partner', 'POS')) f(source_system, prefix)
        WHERE NOT (source_system = 'Marketplace' AND c_custkey % 50 = 7)
          AND (source_system <> 'Partner' OR c_custkey % 40 = 3)""",
    "stg_identities": """
        SELECT lower(source_system) AS source_system, source_customer_id, email_hash
        FROM raw_identities
        QUALIFY row_number() OVER (PARTITION BY source_customer_id
            ORDER BY lower(source_system), email_hash DESC) = 1""",
    "bridge": """
        SELECT i.source_system, i.source_customer_id, i.email_hash, c.customer_id
        FROM stg_identities i JOIN stg_customers c ON c.email_hash = i.email_hash""",
    "dim_customer": """
        SELECT c.*, coalesce(k.links, 0) AS resolved_identity_count
        FROM stg_customers c
        LEFT JOIN (SELECT customer_id, count(*) AS links FROM bridge GROUP BY 1) k
          ON k.customer_id = c.customer_id""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_type AS category, p_brand AS department, 'Size ' || p_size AS collection_name,
               CAST(p_retailprice AS DECIMAL(12,2)) AS current_price, 'EUR' AS currency
        FROM part""",
    "inventory": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_partkey * 37 % 421 AS store_stock, p_partkey * 53 % 751 AS warehouse_stock,
               12 + p_partkey * 11 % 54 AS reserved, 80 + p_partkey * 29 % 221 AS incoming,
               65 + p_partkey * 17 % 76 AS safety_stock
        FROM part""",
    "prices": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * 1.08, 2) AS DECIMAL(12,2)) AS price,
               DATE '1995-01-01' AS valid_from,
               CASE WHEN p_partkey % 500 = 0 THEN DATE '1998-01-01' ELSE DATE '1997-12-31' END
                 AS valid_to,
               false AS is_current
        FROM part
        UNION ALL
        SELECT CAST(p_partkey AS VARCHAR), CAST(p_retailprice AS DECIMAL(12,2)),
               DATE '1998-01-01', DATE '9999-12-31', p_partkey % 700 <> 0
        FROM part""",
    "sales": """
        SELECT o.order_id, b.customer_id, o.source_customer_id, o.product_id, o.channel,
               o.store_id, o.quantity, o.unit_price, o.discount_rate, o.sales_amount, o.ordered_at
        FROM stg_orders o JOIN bridge b ON b.source_customer_id = o.source_customer_id""",
    "fct_events": """
        SELECT e.*, b.customer_id
        FROM stg_events e JOIN bridge b ON b.source_customer_id = e.source_customer_id""",
    "atp": """
        SELECT i.*, coalesce(u.units, 0) AS units_sold,
               store_stock + warehouse_stock + incoming - reserved - coalesce(u.units, 0)
                 AS available_to_promise,
               CASE WHEN store_stock + warehouse_stock + incoming - reserved
                         - coalesce(u.units, 0) < safety_stock THEN 'critical'
                    WHEN store_stock + warehouse_stock + incoming - reserved
                         - coalesce(u.units, 0) < 2 * safety_stock THEN 'watch'
                    ELSE 'healthy' END AS risk_level
        FROM inventory i
        LEFT JOIN (SELECT product_id, sum(quantity) AS units FROM sales GROUP BY 1) u
          ON u.product_id = i.product_id""",
    "reconciliation": """
        SELECT s.order_id, s.sales_amount, p.amount AS payment_amount,
               CAST(s.sales_amount - coalesce(p.amount, 0) AS DECIMAL(18,2)) AS amount_delta,
               CASE WHEN p.order_id IS NULL THEN 'missing_payment'
                    WHEN abs(s.sales_amount - p.amount) > 0.005 THEN 'amount_mismatch'
                    WHEN p.status <> 'settled' THEN 'not_settled'
                    ELSE 'reconciled' END AS reconciliation_status
        FROM sales s LEFT JOIN stg_payments p ON p.order_id = s.order_id""",
    "activity": """
        SELECT customer_id, max(CAST(ordered_at AS DATE)) AS last_order_date,
               count(DISTINCT order_id) AS frequency,
               CAST(sum(sales_amount) AS DECIMAL(18,2)) AS monetary,
               count(DISTINCT channel) AS active_channels
        FROM sales WHERE customer_id IN (SELECT customer_id FROM dim_customer) GROUP BY 1""",
    "rfm_scores": """
        SELECT *, date_diff('day', last_order_date,
                            (SELECT max(last_order_date) FROM activity)) AS recency_days,
               ntile(4) OVER (ORDER BY last_order_date, customer_id) AS recency_score,
               ntile(4) OVER (ORDER BY frequency, customer_id) AS frequency_score,
               ntile(4) OVER (ORDER BY monetary, customer_id) AS monetary_score
        FROM activity""",
    "rfm": """
        SELECT *,
               CASE WHEN recency_score + frequency_score + monetary_score >= 10 THEN 'champions'
                    WHEN recency_score + frequency_score + monetary_score >= 8 THEN 'loyal'
                    WHEN recency_score >= 3 AND frequency_score <= 2 THEN 'promising'
                    WHEN recency_score <= 2 AND monetary_score >= 3 THEN 'at_risk'
                    ELSE 'developing' END AS rfm_segment
        FROM rfm_scores""",
    "signals": """
        SELECT p.product_id, p.product_name, p.category, p.current_price,
               a.available_to_promise, a.risk_level, d.units AS units_sold,
               round(d.discounts / d.lines, 4) AS average_discount_rate,
               round(d.amount / nullif(CAST(d.units AS DOUBLE), 0), 2) AS realized_unit_price,
               round(d.units / nullif(avg(CAST(d.units AS DOUBLE)) OVER (), 0), 3) AS demand_index,
               round(a.available_to_promise / nullif(CAST(d.units AS DOUBLE), 0), 3)
                 AS stock_cover_ratio
        FROM products p
        JOIN atp a ON a.product_id = p.product_id
        JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units,
                     CAST(sum(discount_rate) AS DOUBLE) AS discounts, count(*) AS lines,
                     CAST(sum(sales_amount) AS DOUBLE) AS amount
              FROM sales GROUP BY 1) d ON d.product_id = p.product_id""",
    "repriced": """
        SELECT s.*,
               CAST(round(CASE action WHEN 'protect_margin' THEN current_price * 1.03
                                 WHEN 'accelerate_sell_through' THEN current_price * 0.95
                                 ELSE current_price END, 2) AS DECIMAL(18,2)) AS recommended_price,
               action AS recommended_action,
               CASE action WHEN 'protect_margin' THEN 'Demande élevée et ATP sous tension'
                    WHEN 'accelerate_sell_through'
                    THEN 'Couverture élevée et demande sous la moyenne'
                    ELSE 'Équilibre demande-stock, prix maintenu' END AS recommendation_reason
        FROM (SELECT *,
                     CASE WHEN risk_level = 'critical' AND demand_index >= 1.1
                          THEN 'protect_margin'
                          WHEN risk_level = 'healthy' AND stock_cover_ratio >= 2
                               AND demand_index < 0.9 THEN 'accelerate_sell_through'
                          ELSE 'hold' END AS action
              FROM signals) s""",
}


def _needs(text: str) -> set[str]:
    return {name for name in BLOCKS if re.search(rf"\b{name}\b", text)}


def statement(final: str) -> str:
    """``final`` preceded by every block it mentions, directly or through others."""
    wanted, queue = set(), list(_needs(final))
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue.extend(_needs(BLOCKS[name]) - {name})
    parts = [f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def _fact_columns(*, day: tuple[str, ...] = (), time: tuple[str, ...] = (), money=(), whole=()):
    """REPLACE list giving text dates, double amounts and bigint counts."""
    parts = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in day]
    parts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g') AS {c}" for c in time]
    parts += [f"CAST({c} AS DOUBLE) AS {c}" for c in money]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in whole]
    return "REPLACE (" + ", ".join(parts) + ")"


ORDER_CASTS = _fact_columns(
    time=("ordered_at",), money=("unit_price", "discount_rate", "sales_amount"), whole=("quantity",)
)
PAYMENT_CASTS = _fact_columns(time=("paid_at",), money=("amount",))
EVENT_CASTS = _fact_columns(time=("event_at",), whole=("quantity", "latency_ms"))
ATP_CASTS = _fact_columns(
    whole=(
        "store_stock", "warehouse_stock", "incoming", "reserved", "safety_stock", "units_sold",
        "available_to_promise",
    )
)
RECENT = f"ordered_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY"
RECENT_7 = f"ordered_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY"
RECENT_14 = f"ordered_at >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY"
RECENT_EVENT = f"event_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY"

KPI = """
    CAST(coalesce(sum(sales_amount), 0) AS DOUBLE) AS revenue, count(*) AS orders,
    count(DISTINCT customer_id) AS customers,
    CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units,
    coalesce(round(CAST(sum(sales_amount) AS DOUBLE) / nullif(count(*), 0), 2), 0) AS avg_basket
"""

DEMAND_ROWS = """
    SELECT a.*, p.product_name, p.category, coalesce(d.units, 0) AS selected_units_sold
    FROM atp a JOIN products p ON p.product_id = a.product_id
    LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units
               FROM sales WHERE {where} GROUP BY 1) d ON d.product_id = a.product_id"""

TOP_CUSTOMERS = f"""
    SELECT c.customer_id, c.country, c.acquisition_channel, c.consent_marketing, t.spend,
           t.order_count, t.last_order, t.channels,
           CASE WHEN t.spend >= 1200 OR t.order_count >= 14 THEN 'Champions'
                WHEN t.spend >= 650 OR t.order_count >= 8 THEN 'Fidèles'
                WHEN t.spend >= 300 THEN 'Prometteurs' ELSE 'Nouveaux' END AS segment
    FROM (SELECT customer_id, sum(sales_amount) AS spend, count(*) AS order_count,
                 max(ordered_at) AS last_order,
                 string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels
          FROM sales WHERE {RECENT} GROUP BY 1) t
    JOIN dim_customer c ON c.customer_id = t.customer_id
    ORDER BY t.spend DESC, c.customer_id LIMIT 20"""

DAY_SERIES = f"""
    SELECT g.channel, g.day, coalesce(s.revenue, 0) AS revenue, coalesce(s.orders, 0) AS orders
    FROM (SELECT channel, CAST(d AS DATE) AS day
          FROM (VALUES ('web'), ('store'), ('marketplace'), ('all')) c(channel),
               range(DATE '2001-10-08', DATE '2001-11-05', INTERVAL 1 DAY) r(d)) g
    LEFT JOIN (SELECT CASE WHEN x.wide THEN 'all' ELSE channel END AS channel,
                      CAST(ordered_at AS DATE) AS day, sum(sales_amount) AS revenue,
                      count(*) AS orders
               FROM sales, (VALUES (true), (false)) x(wide) WHERE {RECENT} GROUP BY 1, 2) s
      ON s.channel = g.channel AND s.day = g.day"""


def _flash(period: int) -> str:
    return f"""
    SELECT channel, day, greatest(day - {period - 1}, DATE '2001-10-08') AS from_day,
           revenue AS day_revenue,
           sum(revenue) OVER (w ROWS {period - 1} PRECEDING) AS revenue,
           sum(orders) OVER (w ROWS {period - 1} PRECEDING) AS orders,
           sum(revenue) OVER (w ROWS 6 PRECEDING) AS week_revenue,
           coalesce(sum(revenue) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING), 0)
             AS previous_week_revenue,
           coalesce(lag(revenue, 7) OVER w, 0) AS previous_day_revenue
    FROM ({DAY_SERIES}) WINDOW w AS (PARTITION BY channel ORDER BY day)"""


def _flash_out(period: int) -> str:
    def change(now: str, then: str) -> str:
        return (
            f"floor((CAST({now} AS DOUBLE) - CAST({then} AS DOUBLE))"
            f" / nullif(CAST({then} AS DOUBLE), 0) * 1000.0 + 0.5) / 10.0"
        )

    return f"""
    SELECT channel, strftime(day, '%Y-%m-%d') AS day, strftime(from_day, '%Y-%m-%d') AS from_day,
           CAST(day_revenue AS DOUBLE) AS day_revenue, CAST(revenue AS DOUBLE) AS revenue,
           CAST(orders AS BIGINT) AS orders, CAST(week_revenue AS DOUBLE) AS week_revenue,
           CAST(previous_week_revenue AS DOUBLE) AS previous_week_revenue,
           CAST(previous_day_revenue AS DOUBLE) AS previous_day_revenue,
           CAST(day - from_day + 1 AS BIGINT) AS days,
           from_day <> day - {period - 1} AS clipped,
           strftime(day - 7, '%Y-%m-%d') AS comparison_day,
           floor(CAST(revenue AS DOUBLE) / nullif(CAST(orders AS DOUBLE), 0) * 100.0 + 0.5)
             / 100.0 AS basket,
           {change('week_revenue', 'previous_week_revenue')} AS week_change,
           {change('day_revenue', 'previous_day_revenue')} AS day_change
    FROM ({_flash(period)})"""


FINALS: dict[str, str] = {
    "stg_orders_dedup": f"SELECT * {ORDER_CASTS} FROM stg_orders",
    "stg_payments_dedup": f"SELECT * {PAYMENT_CASTS} FROM stg_payments",
    "stg_events_dedup": f"SELECT * {EVENT_CASTS} FROM stg_events",
    "stg_identities_dedup": "SELECT * FROM stg_identities",
    "stg_customers": "SELECT * FROM stg_customers",
    "identity_bridge": "SELECT * FROM bridge",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": f"SELECT * {_fact_columns(money=('current_price',))} FROM products",
    "price_scd2": f"SELECT * {_fact_columns(day=('valid_from', 'valid_to'), money=('price',))}"
    " FROM prices",
    "fct_sales": f"SELECT * {ORDER_CASTS} FROM sales",
    "fct_retail_event": f"SELECT * {EVENT_CASTS} FROM fct_events",
    "unresolved_sales": """
        SELECT order_id, source_customer_id, channel, CAST(sales_amount AS DOUBLE) AS sales_amount
        FROM stg_orders
        WHERE source_customer_id NOT IN (SELECT source_customer_id FROM bridge)""",
    "atp_risk": f"SELECT * {ATP_CASTS} FROM atp",
    "atp_negative": f"SELECT * {ATP_CASTS} FROM atp WHERE available_to_promise < 0",
    "payment_reconciliation": f"""
        SELECT * {_fact_columns(money=('sales_amount', 'payment_amount', 'amount_delta'))}
        FROM reconciliation""",
    "recon_status_counts": """
        SELECT reconciliation_status, count(*) AS orders, CAST(sum(amount_delta) AS DOUBLE) AS gap
        FROM reconciliation GROUP BY 1""",
    "rfm_segments": f"""
        SELECT * {_fact_columns(day=('last_order_date',), money=('monetary',),
                                whole=('recency_days',))}
        FROM rfm""",
    "rfm_segment_counts": """
        SELECT rfm_segment, count(*) AS customers, CAST(sum(monetary) AS DOUBLE) AS spend
        FROM rfm GROUP BY 1""",
    "repricing": f"""
        SELECT * EXCLUDE (action) {_fact_columns(money=('current_price', 'recommended_price'),
                                                 whole=('available_to_promise',))}
        FROM repriced""",
    "repricing_guardrail": f"""
        SELECT * EXCLUDE (action) {_fact_columns(money=('current_price', 'recommended_price'),
                                                 whole=('available_to_promise',))}
        FROM repriced WHERE NOT recommended_price
            BETWEEN round(current_price * 0.95, 2) AND round(current_price * 1.03, 2)""",
    "repricing_actions": """
        SELECT recommended_action, count(*) AS products,
               CAST(sum(recommended_price - current_price) AS DOUBLE) AS price_change
        FROM repriced GROUP BY 1""",
    "atp_ratio_to_max": """
        SELECT product_id, CAST(available_to_promise AS BIGINT) AS available_to_promise,
               CAST(greatest(available_to_promise, 0) AS DOUBLE)
                 / greatest(max(available_to_promise) OVER (), 1) AS ratio_to_max
        FROM atp""",
    "kpi_block": f"SELECT {KPI} FROM sales WHERE {RECENT}",
    "kpi_block_web_7": f"SELECT {KPI} FROM sales WHERE {RECENT_7} AND channel = 'web'",
    "daily_series": f"""
        SELECT strftime(CAST(ordered_at AS DATE), '%Y-%m-%d') AS day,
               CAST(sum(sales_amount) AS DOUBLE) AS revenue, count(*) AS orders,
               CAST(sum(quantity) AS BIGINT) AS units
        FROM sales WHERE {RECENT} GROUP BY 1""",
    "channel_mix": f"""
        SELECT channel, CAST(sum(sales_amount) AS DOUBLE) AS revenue, count(*) AS orders
        FROM sales WHERE {RECENT} GROUP BY 1""",
    "top_categories": f"""
        SELECT category, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units,
               CAST(revenue AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0) AS share
        FROM (SELECT p.category, sum(s.sales_amount) AS revenue, sum(s.quantity) AS units,
                     (SELECT sum(sales_amount) FROM sales WHERE {RECENT}) AS total
              FROM sales s JOIN products p ON p.product_id = s.product_id
              WHERE {RECENT} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7)""",
    "inventory_demand": f"""
        SELECT * {ATP_CASTS} FROM ({DEMAND_ROWS.format(where=RECENT + " AND channel = 'store'")})""",
    "customer_360": f"""
        SELECT * {_fact_columns(time=('last_order',), money=('spend',))} FROM ({TOP_CUSTOMERS})""",
    "segment_distribution": f"""
        SELECT n.segment, count(t.segment) AS customers,
               count(*) FILTER (contains(t.channels, ',')) AS omnichannel,
               CAST(count(t.segment) AS DOUBLE)
                 / nullif(CAST(sum(count(t.segment)) OVER () AS DOUBLE), 0) AS share
        FROM (VALUES ('Champions'), ('Fidèles'), ('Prometteurs'), ('Nouveaux')) n(segment)
        LEFT JOIN ({TOP_CUSTOMERS}) t ON t.segment = n.segment GROUP BY 1""",
    "latency_p95": f"""
        SELECT count(*) AS events,
               CAST(coalesce(quantile_disc(latency_ms, 0.95), 0) AS BIGINT) AS latency_p95_ms
        FROM fct_events WHERE channel = 'web' AND {RECENT_EVENT}""",
    "latency_p95_by_type": """
        SELECT lower(event_type) AS event_type, lower(channel) AS channel, count(*) AS row_count,
               CAST(quantile_disc(latency_ms, 0.95) AS BIGINT) AS latency_p95_ms
        FROM raw_events GROUP BY 1, 2""",
    "selected_reconciliation": f"""
        SELECT batch_units, stream_units, CAST(sales_amount AS DOUBLE) AS sales_amount,
               CAST(payment_amount AS DOUBLE) AS payment_amount,
               batch_units - stream_units AS unit_delta,
               CAST(sales_amount - payment_amount AS DOUBLE) AS amount_delta,
               CASE WHEN batch_units = stream_units
                         AND abs(sales_amount - payment_amount) <= 0.005
                    THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT CAST(coalesce(sum(quantity), 0) AS BIGINT) AS batch_units,
                     coalesce(sum(sales_amount), 0) AS sales_amount
              FROM sales WHERE {RECENT}),
             (SELECT CAST(coalesce(sum(e.quantity), 0) AS BIGINT) AS stream_units
              FROM fct_events e JOIN sales s ON s.order_id = e.order_id
              WHERE e.event_type = 'purchase' AND {RECENT}),
             (SELECT coalesce(sum(p.amount), 0) AS payment_amount
              FROM stg_payments p JOIN sales s ON s.order_id = p.order_id
              WHERE p.status = 'settled' AND {RECENT})""",
    "stock_summary": f"""
        SELECT CAST(sum(available_to_promise) AS BIGINT) AS total_atp,
               CAST(sum(selected_units_sold) AS BIGINT) AS selected_units,
               CAST(count_if(risk_level = 'critical') AS BIGINT) AS critical,
               CAST(count_if(risk_level = 'watch') AS BIGINT) AS watch,
               CAST(floor(CAST(sum(available_to_promise) AS DOUBLE)
                 / nullif(CAST(sum(selected_units_sold) AS DOUBLE) / 30.0::DOUBLE, 0) + 0.5)
                 AS BIGINT) AS coverage_days
        FROM ({DEMAND_ROWS.format(where=RECENT)})""",
    "kpi_cube": f"""
        SELECT g.channel, CAST(g.period AS BIGINT) AS period,
               CAST(coalesce(sum(s.sales_amount), 0) AS DOUBLE) AS revenue,
               count(s.order_id) AS orders, count(DISTINCT s.customer_id) AS customers,
               CAST(coalesce(sum(s.quantity), 0) AS BIGINT) AS units,
               coalesce(round(CAST(sum(s.sales_amount) AS DOUBLE)
                 / nullif(count(s.order_id), 0), 2), 0) AS avg_basket
        FROM (SELECT channel, period
              FROM (VALUES ('web'), ('store'), ('marketplace'), ('all')) c(channel),
                   (VALUES (7), (14), (30)) p(period)) g
        LEFT JOIN sales s ON (g.channel = 'all' OR s.channel = g.channel)
             AND s.ordered_at >= TIMESTAMP '{AS_OF}' - g.period * INTERVAL 1 DAY
        GROUP BY 1, 2""",
    "cube_reconciliation": f"""
        SELECT channel, period, batch_units, stream_units,
               CAST(sold AS DOUBLE) AS sales_amount, CAST(paid AS DOUBLE) AS payment_amount,
               batch_units - stream_units AS unit_delta, CAST(sold - paid AS DOUBLE) AS amount_delta
        FROM (SELECT g.channel, CAST(g.period AS BIGINT) AS period,
                     CAST(coalesce(sum(s.quantity), 0) AS BIGINT) AS batch_units,
                     CAST(coalesce(sum(e.units), 0) AS BIGINT) AS stream_units,
                     coalesce(sum(s.sales_amount), 0) AS sold, coalesce(sum(p.paid), 0) AS paid
              FROM (SELECT channel, period
                    FROM (VALUES ('web'), ('store'), ('marketplace'), ('all')) c(channel),
                         (VALUES (7), (14), (30)) p(period)) g
              LEFT JOIN sales s ON (g.channel = 'all' OR s.channel = g.channel)
                   AND s.ordered_at >= TIMESTAMP '{AS_OF}' - g.period * INTERVAL 1 DAY
              LEFT JOIN (SELECT order_id, sum(quantity) AS units FROM fct_events
                         WHERE event_type = 'purchase' GROUP BY 1) e ON e.order_id = s.order_id
              LEFT JOIN (SELECT order_id, sum(amount) AS paid FROM stg_payments
                         WHERE status = 'settled' GROUP BY 1) p ON p.order_id = s.order_id
              GROUP BY 1, 2)""",
    "daily_pivot": f"""
        SELECT strftime(CAST(ordered_at AS DATE), '%Y-%m-%d') AS day,
               {', '.join(
                   f"CAST(coalesce(sum(sales_amount) FILTER (channel = '{c}'), 0) AS DOUBLE)"
                   f" AS {c}_revenue, count(*) FILTER (channel = '{c}') AS {c}_orders"
                   for c in ('web', 'store', 'marketplace'))}
        FROM sales WHERE {RECENT} GROUP BY 1""",
    "series_gapfill": f"""
        SELECT * {_fact_columns(day=('day',), money=('revenue',), whole=('orders',))}
        FROM ({DAY_SERIES})""",
    "flash_rows": _flash_out(14),
    "flash_table": f"""
        SELECT *, revenue / nullif(max(revenue) FILTER (channel = 'all') OVER (), 0) AS share
        FROM ({_flash_out(30)}) WHERE day = '2001-11-01'""",
    "sparkline_extremes": f"""
        SELECT channel,
               strftime(arg_min(day, (revenue, day)), '%Y-%m-%d') AS low_day,
               CAST(min(revenue) AS DOUBLE) AS low_revenue,
               strftime(arg_min(day, (-revenue, day)), '%Y-%m-%d') AS high_day,
               CAST(max(revenue) AS DOUBLE) AS high_revenue
        FROM ({DAY_SERIES}) GROUP BY 1""",
    "kpi_record": """
        SELECT s.*, p.*, e.*, a.* FROM
          (SELECT CAST(sum(sales_amount) AS DOUBLE) AS sales_amount, count(*) AS orders,
                  count(DISTINCT customer_id) AS customers FROM sales) s,
          (SELECT count(*) AS products FROM products) p,
          (SELECT count(*) AS events,
                  CAST(quantile_disc(latency_ms, 0.95) AS BIGINT) AS latency_p95_ms
           FROM fct_events) e,
          (SELECT CAST(sum(available_to_promise) AS BIGINT) AS total_atp FROM atp) a""",
    "batch_stream_full_outer": """
        SELECT coalesce(b.order_id, s.order_id) AS order_id,
               CAST(b.quantity AS DOUBLE) AS batch_quantity,
               CAST(s.quantity AS DOUBLE) AS stream_quantity, count(*) AS copies
        FROM sales b
        FULL JOIN (SELECT order_id, quantity FROM fct_events WHERE event_type = 'purchase') s
          ON b.order_id = s.order_id
        WHERE b.order_id IS NULL OR s.order_id IS NULL OR b.quantity <> s.quantity
        GROUP BY 1, 2, 3""",
    "key_set_difference": """
        SELECT coalesce(o.order_id, p.order_id) AS key,
               CASE WHEN p.order_id IS NULL THEN 'left' ELSE 'right' END AS side
        FROM (SELECT DISTINCT order_id FROM stg_orders) o
        FULL JOIN (SELECT DISTINCT order_id FROM stg_payments) p ON o.order_id = p.order_id
        WHERE o.order_id IS NULL OR p.order_id IS NULL""",
    "text_search_products": f"""
        SELECT product_name, category, product_id,
               CASE risk_level WHEN 'critical' THEN 'Sous le seuil'
                    WHEN 'watch' THEN 'À surveiller' ELSE 'Normal' END AS risk_label
        FROM ({DEMAND_ROWS.format(where=RECENT)})
        WHERE contains(lower(concat_ws(' ', product_name, category, product_id, risk_label)),
                       'sous le seuil')""",
    "text_search_customers": f"""
        SELECT customer_id, segment, country, channels FROM ({TOP_CUSTOMERS})
        WHERE contains(lower(concat_ws(' ', customer_id, segment, country, channels)),
                       'store,web')""",
}



# -- quality -----------------------------------------------------------------

# Model names of the check lists and the block that computes each.
MODEL_BLOCKS = {
    "stg_orders": "stg_orders",
    "stg_products": "products",
    "stg_customers": "stg_customers",
    "stg_customer_identities": "stg_identities",
    "stg_inventory": "inventory",
    "stg_payments": "stg_payments",
    "stg_retail_events": "stg_events",
    "stg_price_history": "prices",
    "identity_bridge": "bridge",
    "dim_product": "products",
    "dim_customer": "dim_customer",
    "dim_product_price": "prices",
    "fct_sales": "sales",
    "fct_retail_event": "fct_events",
    "fct_payments": "stg_payments",
    "payment_reconciliation": "reconciliation",
    "available_to_promise": "atp",
    "customer_rfm": "rfm",
    "repricing": "repriced",
}


def _check(kind: str, name: str, table: str, violations: str) -> str:
    return (
        f"SELECT '{kind}.{name}' AS \"check\", '{kind}' AS kind, '{table}' AS \"table\","
        f" CAST(({violations}) AS BIGINT) AS violations"
    )


def _check_rows() -> dict[str, str]:
    from omnimart.plans import quality

    block = MODEL_BLOCKS
    not_null = [
        _check("not_null", f"{t}.{c}", t, f"SELECT count(*) FROM {block[t]} WHERE {c} IS NULL")
        for t, columns in quality.NOT_NULL.items()
        for c in columns
    ]
    unique = [
        _check(
            "unique",
            f"{t}.{c}",
            t,
            f"SELECT count(*) FROM (SELECT {c} FROM {block[t]} WHERE {c} IS NOT NULL"
            f" GROUP BY 1 HAVING count(*) > 1)",
        )
        for t, columns in quality.UNIQUE.items()
        for c in columns
    ]
    parents = [
        _check(
            "relationships",
            f"{t}.{c}",
            t,
            f"SELECT count(*) FROM {block[t]} WHERE {c} IS NOT NULL"
            f" AND {c} NOT IN (SELECT {c} FROM {block[p]} WHERE {c} IS NOT NULL)",
        )
        for t, c, p in quality.PARENTS
    ]
    accepted = [
        _check(
            "accepted_values",
            f"{t}.{c}",
            t,
            f"SELECT count(*) FROM {block[t]} WHERE {c} NOT IN ({', '.join(map(repr, values))})",
        )
        for t, c, values in quality.ACCEPTED
    ]
    expressions = [
        _check("expression", name, table, f"SELECT count(*) FROM {query}")
        for name, table, query in (
            (
                "available_to_promise_not_negative",
                "available_to_promise",
                "atp WHERE available_to_promise < 0",
            ),
            ("batch_and_stream_agree", "fct_retail_event", f"({FINALS['batch_stream_full_outer']})"),
            (
                "every_identity_resolved",
                "identity_bridge",
                "stg_identities WHERE source_customer_id NOT IN"
                " (SELECT source_customer_id FROM bridge)",
            ),
            (
                "one_current_price",
                "dim_product_price",
                "(SELECT product_id FROM prices GROUP BY 1 HAVING count_if(is_current) <> 1)",
            ),
            (
                "payments_reconciled",
                "payment_reconciliation",
                "reconciliation WHERE reconciliation_status <> 'reconciled'"
                " OR abs(amount_delta) > 0.005",
            ),
            (
                "price_moves_in_range",
                "repricing",
                "repriced WHERE recommended_price < round(current_price * 0.95, 2)"
                " OR recommended_price > round(current_price * 1.03, 2)",
            ),
        )
    ]
    return {
        "not_null_report": "\nUNION ALL ".join(not_null),
        "unique_report": "\nUNION ALL ".join(unique),
        "fk_report": "\nUNION ALL ".join(parents),
        "accepted_values_report": "\nUNION ALL ".join(accepted),
        "expression_report": "\nUNION ALL ".join(expressions),
    }


_CHECK_ROWS = _check_rows()
_ALL_CHECKS = "\nUNION ALL ".join(f"({rows})" for rows in _CHECK_ROWS.values())


def _with_status(rows: str) -> str:
    return f"SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({rows})"


SCORE = """
    SELECT count(*) AS total, CAST(count_if({ok}) AS BIGINT) AS passed,
           CAST(count(*) - count_if({ok}) AS BIGINT) AS failed,
           round(100.0::DOUBLE * count_if({ok}) / count(*), 1) AS score,
           CASE WHEN count_if({ok}) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM ({rows})"""

OVERLAPS = """
    SELECT product_id, valid_from, max(valid_to) AS valid_to,
           lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS next_from,
           greatest(count_if(valid_to >= valid_from) - 1, 0) AS same_day
    FROM prices GROUP BY 1, 2"""

# What each contract counts; the raw blocks still hold duplicates.
CONTRACT_COUNTS = {
    "contract.orders.order_id_unique":
        "SELECT count(*) - count(DISTINCT order_id) FROM typed_orders",
    "contract.events.event_id_unique":
        "SELECT count(*) - count(DISTINCT event_id) FROM raw_events",
    "contract.payments.transaction_id_unique":
        "SELECT count(*) - count(DISTINCT transaction_id) FROM raw_payments",
    "contract.identities.source_customer_id_unique":
        "SELECT count(*) - count(DISTINCT source_customer_id) FROM raw_identities",
    "integrity.orders_product_fk":
        "SELECT count(*) FROM typed_orders WHERE product_id NOT IN (SELECT product_id FROM products)",
    "integrity.orders_identity_fk":
        "SELECT count(*) FROM typed_orders"
        " WHERE source_customer_id NOT IN (SELECT source_customer_id FROM raw_identities)",
    "integrity.events_identity_fk":
        "SELECT count(*) FROM raw_events"
        " WHERE source_customer_id NOT IN (SELECT source_customer_id FROM raw_identities)",
    "integrity.identity_hash_fk":
        "SELECT count(*) FROM raw_identities"
        " WHERE email_hash NOT IN (SELECT email_hash FROM stg_customers)",
    "integrity.payments_order_fk":
        "SELECT count(*) FROM raw_payments WHERE order_id NOT IN (SELECT order_id FROM typed_orders)",
    "business.positive_quantities": "SELECT count(*) FROM typed_orders WHERE quantity <= 0",
    "business.positive_sales_amount": "SELECT count(*) FROM typed_orders WHERE sales_amount <= 0",
    "business.discount_rate_in_range":
        "SELECT count(*) FROM typed_orders WHERE discount_rate < 0 OR discount_rate >= 1",
    "stream.purchase_count_matches_batch":
        "SELECT abs((SELECT count(*) FROM purchase_events) - (SELECT count(*) FROM typed_orders))",
    "stream.purchase_units_match_batch":
        "SELECT abs((SELECT sum(quantity) FROM purchase_events)"
        " - (SELECT sum(quantity) FROM typed_orders))",
    "stream.purchase_order_ids_match_batch":
        "SELECT count(*) FROM (SELECT DISTINCT order_id FROM purchase_events) a"
        " FULL JOIN (SELECT DISTINCT order_id FROM typed_orders) b ON a.order_id = b.order_id"
        " WHERE a.order_id IS NULL OR b.order_id IS NULL",
    "stream.partition_key_matches_customer":
        "SELECT count(*) FROM raw_events WHERE partition_key <> source_customer_id",
    "payments.one_settlement_per_order":
        "SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw_payments) a"
        " FULL JOIN (SELECT DISTINCT order_id FROM typed_orders) b ON a.order_id = b.order_id"
        " WHERE a.order_id IS NULL OR b.order_id IS NULL",
    "payments.status_settled": "SELECT count(*) FROM raw_payments WHERE lower(status) <> 'settled'",
    "payments.amount_matches_sales":
        "SELECT count(*) FROM"
        " (SELECT order_id, arg_max(sales_amount, (ordered_at, sales_amount)) AS due"
        "  FROM typed_orders GROUP BY 1) o"
        " LEFT JOIN (SELECT order_id, arg_max(amount, (paid_at, amount)) AS paid"
        "  FROM raw_payments GROUP BY 1) p ON p.order_id = o.order_id"
        " WHERE abs(coalesce(paid, -1) - due) > 0.005",
    "privacy.email_hash_shape":
        "SELECT count(*) FROM stg_customers WHERE NOT regexp_full_match(email_hash, '[0-9a-f]{16}')",
    "scd.one_current_version_per_product":
        "SELECT count(*) FROM (SELECT product_id FROM prices GROUP BY 1"
        " HAVING count_if(is_current) <> 1)",
    "scd.current_version_is_open_ended":
        "SELECT count(*) FROM prices WHERE is_current AND valid_to <> DATE '9999-12-31'",
    "scd.version_ranges_do_not_overlap":
        "SELECT count(*) FROM (SELECT valid_to, lead(valid_from) OVER"
        " (PARTITION BY product_id ORDER BY valid_from, valid_to) AS next_from FROM prices)"
        " WHERE valid_to >= next_from",
    "freshness.latest_event_under_24h":
        f"SELECT CASE WHEN epoch(TIMESTAMP '{AS_OF}') - epoch(date_trunc('second', max(event_at)))"
        " < 24 * 3600 THEN 0 ELSE 1 END FROM raw_events",
}

_CONTRACTS = "\nUNION ALL ".join(
    f"SELECT '{name}' AS contract, CAST(({sql}) AS BIGINT) AS violations"
    for name, sql in CONTRACT_COUNTS.items()
)

STOCK = "store_stock, warehouse_stock, reserved, incoming, safety_stock"
STOCK_BIGINT = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in STOCK.split(", "))


def _percent_text(now: str, then: str) -> str:
    """Signed French percentage at one decimal."""
    change = (
        f"floor((CAST({now} AS DOUBLE) - CAST({then} AS DOUBLE))"
        f" / nullif(CAST({then} AS DOUBLE), 0) * 1000.0 + 0.5) / 10.0"
    )
    digits = f"replace(replace(replace(format('{{:,.1f}}', abs({change})), ',', '~'), '.', ','), '~', '\u202f')"
    return (
        f"coalesce(CASE WHEN {change} > 0 THEN '+' WHEN {change} < 0 THEN '−' ELSE '' END"
        f" || {digits} || '\u202f%', 'n.d.')"
    )


WEB_WINDOWS = """
    SELECT time_bucket(INTERVAL 1 MINUTE, event_at) AS start, count(*) AS events,
           quantile_disc(latency_ms, 0.95) AS p95
    FROM {rows} GROUP BY 1"""

WINDOW_TEXT = """strftime(start, '%Y-%m-%d %H:%M:%S.%g') AS window_start,
               strftime(start + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S.%g') AS window_end,
               events, CAST(p95 AS BIGINT) AS latency_p95_ms"""

WEB_TYPED = """
    SELECT event_id, lower(event_type) AS event_type, nullif(order_id, '') AS order_id,
           source_customer_id, product_id, lower(channel) AS channel,
           CAST(quantity AS BIGINT) AS quantity,
           strftime(event_at, '%Y-%m-%d %H:%M:%S.%g') AS event_at,
           CAST(latency_ms AS BIGINT) AS latency_ms, partition_key
    FROM web_events"""

LINE_EVENTS = """
    SELECT 180 + (l_orderkey * 31 + l_linenumber * 17) % 3400 AS latency_ms,
           l_shipdate + INTERVAL 1 MILLISECOND
             * (180 + (l_orderkey * 31 + l_linenumber * 17) % 3400) AS event_at
    FROM lineitem"""

EXPORT_LINE = " || ';' || ".join(
    f"'\"' || replace(CAST({c} AS VARCHAR), '\"', '\"\"') || '\"'"
    for c in (
        "product_id", "product_name", "category", "store_stock", "warehouse_stock", "reserved",
        "incoming", "units_sold", "selected_units_sold", "safety_stock", "available_to_promise",
        "risk_level",
    )
)

VALID_RECORD = "event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0"

FINALS |= {
    "email_hash": "SELECT c_custkey, substr(sha256(lower(c_name)), 1, 16) AS email_hash FROM customer",
    "flash_percent_text": f"""
        SELECT channel, strftime(day, '%Y-%m-%d') AS day,
               {_percent_text('week_revenue', 'previous_week_revenue')} AS week_text,
               {_percent_text('day_revenue', 'previous_day_revenue')} AS day_text
        FROM ({_flash(7)})""",
    **{name: _with_status(rows) for name, rows in _CHECK_ROWS.items()},
    "check_summary": f"""
        SELECT kind, count(*) AS total, CAST(count_if(status = 'pass') AS BIGINT) AS passed,
               CAST(count_if(status = 'fail') AS BIGINT) AS failed,
               coalesce(string_agg("check", ',' ORDER BY "check") FILTER (status = 'fail'), '')
                 AS failed_checks
        FROM ({_with_status(_ALL_CHECKS)}) GROUP BY 1""",
    "check_score": SCORE.format(ok="violations = 0", rows=_ALL_CHECKS),
    "contracts_24": f"SELECT *, violations = 0 AS passed FROM ({_CONTRACTS})",
    "quality_score": SCORE.format(ok="violations = 0", rows=_CONTRACTS),
    "one_current_price": """
        SELECT product_id, CAST(count_if(is_current) AS BIGINT) AS current_versions
        FROM prices GROUP BY 1 HAVING count_if(is_current) <> 1""",
    "scd_overlap": f"""
        SELECT product_id, strftime(valid_from, '%Y-%m-%d') AS valid_from,
               strftime(valid_to, '%Y-%m-%d') AS valid_to,
               strftime(next_from, '%Y-%m-%d') AS next_from,
               CAST(same_day + CASE WHEN valid_to >= next_from THEN 1 ELSE 0 END AS BIGINT)
                 AS overlaps
        FROM ({OVERLAPS}) WHERE same_day > 0 OR valid_to >= next_from""",
    "total_reconciliation": """
        SELECT batch_units, stream_units, CAST(sales AS DOUBLE) AS sales_amount,
               CAST(paid AS DOUBLE) AS payment_amount, batch_units - stream_units AS unit_delta,
               CAST(sales - paid AS DOUBLE) AS amount_delta,
               CASE WHEN batch_units = stream_units AND abs(sales - paid) <= 0.005
                    THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT CAST(sum(quantity) AS BIGINT) AS batch_units, sum(sales_amount) AS sales
              FROM typed_orders),
             (SELECT CAST(sum(quantity) AS BIGINT) AS stream_units FROM purchase_events),
             (SELECT sum(amount) AS paid FROM raw_payments)""",
    "source_freshness": """
        SELECT source, strftime(latest, '%Y-%m-%d %H:%M:%S.%g') AS latest,
               (epoch(TIMESTAMP '2001-11-04 00:20:00') - floor(epoch(latest))) / 60.0 AS age_minutes,
               CASE WHEN (epoch(TIMESTAMP '2001-11-04 00:20:00') - floor(epoch(latest))) > 7200
                    THEN 'error'
                    WHEN (epoch(TIMESTAMP '2001-11-04 00:20:00') - floor(epoch(latest))) > 1800
                    THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT 'orders' AS source, max(ordered_at) AS latest FROM typed_orders
              UNION ALL SELECT 'payments', max(paid_at) FROM raw_payments
              UNION ALL SELECT 'retail_events', max(event_at) FROM raw_events)""",
    "source_counts": """
        SELECT 'products' AS source, count(*) AS records FROM products
        UNION ALL SELECT 'customers', count(*) FROM stg_customers
        UNION ALL SELECT 'customer_identities', count(*) FROM raw_identities
        UNION ALL SELECT 'inventory', count(*) FROM inventory
        UNION ALL SELECT 'orders', count(*) FROM raw_orders
        UNION ALL SELECT 'payments', count(*) FROM raw_payments
        UNION ALL SELECT 'retail_events', count(*) FROM raw_events
        UNION ALL SELECT 'price_history', count(*) FROM prices""",
    "incremental_merge": f"""
        SELECT * EXCLUDE (payment_status, sales_amount) {_fact_columns(
            time=('ordered_at',), money=('unit_price', 'discount_rate'), whole=('quantity',))}
        FROM stg_orders""",
    "corrections_out_of_order": f"""
        SELECT * EXCLUDE (payment_status, sales_amount) {_fact_columns(
            time=('ordered_at',), money=('unit_price', 'discount_rate'), whole=('quantity',))}
        FROM stg_orders""",
    "full_refresh": f"""
        SELECT * EXCLUDE (payment_status, sales_amount) {_fact_columns(
            time=('ordered_at',), money=('unit_price', 'discount_rate'), whole=('quantity',))}
        FROM stg_orders WHERE CAST(split_part(order_id, '-', 1) AS BIGINT) % 2 = 1""",
    "snapshot_two_states": f"""
        SELECT * FROM (WITH moments AS (SELECT TIMESTAMP '2001-11-04 06:00:00' AS t1, TIMESTAMP '2001-11-05 06:00:00' AS t2),
        stock AS (SELECT *, CAST(product_id AS BIGINT) AS n FROM inventory),
        versions AS (
          SELECT product_id, {STOCK}, t1 AS valid_from,
                 CASE WHEN n % 11 = 0 OR n % 7 = 0 THEN t2 END AS valid_to
          FROM stock, moments WHERE n % 13 <> 0
          UNION ALL
          SELECT product_id, store_stock + CASE WHEN n % 7 = 0 THEN 5 ELSE 0 END,
                 warehouse_stock, reserved, incoming, safety_stock, t2, NULL
          FROM stock, moments WHERE n % 11 <> 0 AND (n % 13 = 0 OR n % 7 = 0))
        SELECT product_id, {STOCK_BIGINT},
               strftime(valid_from, '%Y-%m-%d %H:%M:%S.%g') AS valid_from,
               strftime(valid_to, '%Y-%m-%d %H:%M:%S.%g') AS valid_to,
               strftime(coalesce(valid_to, valid_from), '%Y-%m-%d %H:%M:%S.%g') AS updated_at,
               md5(product_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id
        FROM versions)""",
    "raw_zone_audit": """
        SELECT 'products' AS source, count(*) AS rows FROM products
        UNION ALL SELECT 'customer_identities', count(*) FROM raw_identities
        UNION ALL SELECT 'payments', count(*) FROM raw_payments""",
    "csv_landing": f"SELECT * {PAYMENT_CASTS} FROM stg_payments",
    "csv_export": f"SELECT {EXPORT_LINE} AS line FROM ({DEMAND_ROWS.format(where=RECENT)})",
    "stored_cube": f"""
        SELECT {KPI}, 'store' AS channel, 14::BIGINT AS period
        FROM sales WHERE {RECENT_14} AND channel = 'store'""",
    "event_validation": f"""
        SELECT CASE WHEN event_id % 19 <> 0 THEN 'W-' || event_id ELSE 'unknown' END AS record_id,
               CASE WHEN {VALID_RECORD} THEN 'Ok' ELSE 'ProcessingFailed' END AS result,
               CASE WHEN {VALID_RECORD} THEN 'W-' || event_id END AS event_id,
               CASE WHEN {VALID_RECORD}
                    THEN CAST(90 + 25 * CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE)
                    END AS latency_ms,
               CASE WHEN {VALID_RECORD} THEN 'retail-event/2.1' END AS schema_version,
               CASE WHEN {VALID_RECORD} THEN 'W-' || event_id END AS idempotency_key
        FROM events""",
    "event_routing": f"""
        SELECT CASE WHEN {VALID_RECORD} THEN 'good' ELSE 'failed' END AS route,
               CASE WHEN {VALID_RECORD} THEN 'Ok' ELSE 'ProcessingFailed' END AS result,
               count(*) AS records
        FROM events GROUP BY 1, 2""",
    "stream_dedup": WEB_TYPED,
    "stream_enriched": f"""
        SELECT e.*, b.customer_id FROM ({WEB_TYPED}) e
        JOIN bridge b ON b.source_customer_id = e.source_customer_id""",
    "stream_fact_merge": f"""
        SELECT e.*, b.customer_id FROM ({WEB_TYPED}) e
        JOIN bridge b ON b.source_customer_id = e.source_customer_id""",
    "stream_latency_windows": f"""
        SELECT {WINDOW_TEXT} FROM ({WEB_WINDOWS.format(rows='web_events')})""",
    "stream_latency_alarm": f"""
        SELECT {WINDOW_TEXT} FROM ({WEB_WINDOWS.format(rows=f'({LINE_EVENTS})')}) WHERE p95 > 3000""",
    "latency_late_marker": f"""
        SELECT {WINDOW_TEXT}, p95 >= 3000 AS late
        FROM (SELECT time_bucket(INTERVAL 1 MINUTE, event_at) AS start,
                     count(*) AS events, quantile_disc(latency_ms, 0.95) AS p95
              FROM raw_events GROUP BY 1)""",
    "event_lines": """
        SELECT partition_key, 'retail-event/2.1' AS schema_version, count(*) AS records,
               CAST(sum(latency_ms) AS BIGINT) AS latency_ms
        FROM web_events GROUP BY 1""",
}

#: Both halves of the events, and all eight sources.
RETAIL_TYPED = WEB_TYPED.replace("FROM web_events", "FROM raw_events")
RETAIL_NUMBER = "(SELECT *, CAST(split_part(event_id, '-', 2) AS BIGINT) AS n FROM raw_events)"
VALID_RETAIL = VALID_RECORD.replace("event_id", "n")
SOURCE_TABLES = {
    "products": "products", "customers": "stg_customers", "customer_identities": "raw_identities", "inventory": "inventory",
    "orders": "raw_orders", "payments": "raw_payments", "retail_events": "raw_events", "price_history": "prices",
}


def _all_sources(columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS source, {columns} FROM {table}" for name, table in SOURCE_TABLES.items())


FINALS |= {
    "retail_event_validation": f"""
        SELECT CASE WHEN n % 19 <> 0 THEN event_id ELSE 'unknown' END AS record_id,
               CASE WHEN {VALID_RETAIL} THEN 'Ok' ELSE 'ProcessingFailed' END AS result,
               CASE WHEN {VALID_RETAIL} THEN event_id END AS event_id,
               CASE WHEN {VALID_RETAIL} THEN CAST(latency_ms AS DOUBLE) END AS latency_ms,
               CASE WHEN {VALID_RETAIL} THEN 'retail-event/2.1' END AS schema_version,
               CASE WHEN {VALID_RETAIL} THEN event_id END AS idempotency_key
        FROM {RETAIL_NUMBER}""",
    "retail_event_routing": f"""
        SELECT CASE WHEN {VALID_RETAIL} THEN 'good' ELSE 'failed' END AS route,
               CASE WHEN {VALID_RETAIL} THEN 'Ok' ELSE 'ProcessingFailed' END AS result,
               count(*) AS records
        FROM {RETAIL_NUMBER} GROUP BY 1, 2""",
    "retail_stream_dedup": "SELECT DISTINCT event_id FROM raw_events",
    "retail_stream_enriched": f"""
        SELECT e.*, b.customer_id FROM ({RETAIL_TYPED}) e
        JOIN bridge b ON b.source_customer_id = e.source_customer_id""",
    "retail_stream_fact_merge": f"""
        SELECT * FROM (SELECT e.*, b.customer_id FROM ({RETAIL_TYPED}) e
            JOIN bridge b ON b.source_customer_id = e.source_customer_id)
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_at DESC, source_customer_id DESC,
            event_type DESC, order_id DESC, product_id DESC, channel DESC, quantity DESC, latency_ms DESC,
            partition_key DESC) = 1""",
    "retail_stream_latency_windows": f"""
        SELECT {WINDOW_TEXT} FROM ({WEB_WINDOWS.format(rows='raw_events')})""",
    "retail_event_lines": """
        SELECT partition_key, 'retail-event/2.1' AS schema_version, count(*) AS records,
               CAST(sum(latency_ms) AS BIGINT) AS latency_ms
        FROM raw_events GROUP BY 1""",
    "raw_zone_all_sources": f"""
        SELECT source, day, rows FROM ({_all_sources('count(*) AS rows')}),
               (VALUES ('2001-11-04'), ('2001-11-05')) AS days(day)""",
    "csv_landing_all_sources": _all_sources("count(*) AS rows, CAST(1 AS BIGINT) AS damaged"),
    "freshness_all_sources": f"""
        SELECT source, CASE WHEN source = 'price_history' THEN '2001-11-05 03:00:00.000'
                            WHEN source IN ('orders', 'payments', 'retail_events') THEN '2001-11-05 05:50:00.000'
                            ELSE '2001-11-05 05:00:00.000' END AS latest,
               CAST(CASE WHEN source = 'price_history' THEN 180 WHEN source IN ('orders', 'payments', 'retail_events') THEN 10 ELSE 60 END AS DOUBLE) AS age_minutes,
               CASE WHEN source = 'price_history' THEN 'error'
                    WHEN source IN ('orders', 'payments', 'retail_events') THEN 'pass' ELSE 'warn' END AS status
        FROM ({_all_sources('count(*) AS rows')}) WHERE rows > 0""",
}

#: Key of a row of each source as the samples name it.
SAMPLE_KEYS = {
    "products": "product_id", "customers": "customer_id", "customer_identities": "source_system || '|' || source_customer_id",
    "inventory": "product_id", "orders": "order_id", "payments": "transaction_id", "retail_events": "event_id",
    "price_history": "product_id || '|' || strftime(valid_from, '%Y-%m-%d')",
}
LANDED_TIMES = {"orders": "ordered_at", "payments": "paid_at", "retail_events": "event_at"}
SEARCHED = (" Size 1", "small", "LARGE ANODIZED", "zz", "7", "ck", "brushed tin", "%")


def _sample(name: str, table: str) -> str:
    key = SAMPLE_KEYS[name]
    return f"""SELECT '{name}' AS source, row_number() OVER (ORDER BY md5(k)) AS sample_rank, k AS sample_key, md5(k) AS sample_hash
        FROM (SELECT {key} AS k FROM {table}) QUALIFY sample_rank <= 10"""


def _landing(name: str, table: str) -> str:
    time = LANDED_TIMES.get(name)
    first, last = (f"strftime({f}({time}), '%Y-%m-%d %H:%M:%S.%g')" if time else "CAST(NULL AS VARCHAR)" for f in ("min", "max"))
    p95 = "CAST(quantile_disc(latency_ms, 0.95) AS BIGINT)" if name == "retail_events" else "CAST(NULL AS BIGINT)"
    return f"SELECT '{name}' AS source, count(*) AS rows, {first} AS first_at, {last} AS last_at, {p95} AS latency_p95_ms FROM {table}"


FINALS |= {
    "stream_full_outer": FINALS["batch_stream_full_outer"],
    "stream_windows_settled": FINALS["retail_stream_latency_windows"],
    "stream_rows_accounted": """
        SELECT strftime(date_trunc('hour', event_at), '%Y-%m-%d %H:%M:%S.%g') AS hour, count(*) AS events,
               CAST(sum(latency_ms) AS BIGINT) AS latency_ms
        FROM raw_events GROUP BY 1""",
    "retail_stream_alarm": f"""
        SELECT {WINDOW_TEXT} FROM ({WEB_WINDOWS.format(rows='raw_events')}) WHERE p95 > 3000""",
    "stream_dedup_ever": FINALS["stg_events_dedup"],
    "customers_by_sketch": f"""
        SELECT channel, period, revenue, orders, units, customers, true AS within FROM ({FINALS['kpi_cube']})""",
    "latency_p95_by_sketch": """
        SELECT lower(event_type) AS event_type, count(*) AS row_count, count(*) AS sketched,
               CAST(quantile_disc(latency_ms, 0.95) AS BIGINT) AS latency_p95_ms, true AS within
        FROM raw_events WHERE latency_ms IS NOT NULL GROUP BY 1""",
    "cube_advanced": FINALS["kpi_cube"],
    "key_difference_by_digest": FINALS["key_set_difference"],
    "text_search_indexed": " UNION ALL ".join(
        f"SELECT '{t}' AS text, product_id FROM products"
        f" WHERE contains(lower(concat_ws(' ', product_name, category, collection_name)), lower(trim('{t}')))"
        for t in SEARCHED
    ),
    "clustered_days": """
        SELECT strftime(day, '%Y-%m-%d') AS day, count(order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units, true AS few_files
        FROM (VALUES (DATE '1999-03-04'), (DATE '2000-02-29'), (DATE '2001-11-01')) AS days(day)
        LEFT JOIN typed_orders ON CAST(ordered_at AS DATE) = day GROUP BY day""",
    "drift_merge": """
        SELECT "column", stored_type, incoming_type, change, true AS accepted,
               (SELECT count(*) FROM stg_payments WHERE "column" NOT IN ('currency', 'terminal')
                  OR CAST(split_part(transaction_id, '-', 2) AS BIGINT) % 2 = CASE "column" WHEN 'terminal' THEN 1 ELSE 0 END) AS values
        FROM (VALUES ('transaction_id', 'string', 'string', 'same'), ('order_id', 'string', 'string', 'same'),
                     ('amount', 'decimal(12,2)', 'decimal(20,2)', 'widened'), ('currency', 'string', NULL, 'removed'),
                     ('status', 'string', 'string', 'same'), ('payment_method', 'string', 'string', 'same'),
                     ('paid_at', 'timestamp', 'timestamp', 'same'), ('attempts', 'int', 'bigint', 'widened'),
                     ('terminal', NULL, 'string', 'added')) AS c("column", stored_type, incoming_type, change)""",
    "landing_samples": " UNION ALL ".join(f"SELECT * FROM ({_sample(n, t)})" for n, t in SOURCE_TABLES.items()),
    "landing_reports": " UNION ALL ".join(_landing(n, t) for n, t in SOURCE_TABLES.items()),
}

EXPORT_HEADING = "product_id;name;category;store_stock;warehouse_stock;reserved;incoming;units_sold;selected_units_sold;safety_stock;atp;risk_level"

FINALS |= {
    "csv_landing_quoted": """
        SELECT product_id, split_part(product_name, ' ', 1) || chr(10) || '"' || product_id || '", two' AS name, category,
               CAST(current_price AS DOUBLE) AS price, CAST(0 AS BIGINT) AS damaged
        FROM products""",
    "freshness_stored": FINALS["freshness_all_sources"],
    "csv_export_files": f"""
        SELECT (row_number() OVER (ORDER BY product_id) - 1) // 100 AS file, {EXPORT_LINE} AS line
        FROM ({DEMAND_ROWS.format(where=RECENT)})
        UNION ALL SELECT f AS file, '{EXPORT_HEADING}' FROM (SELECT unnest(range((count(*) + 99) // 100)) AS f FROM products)""",
    "kpi_record_scored": f"""
        SELECT k.*, q.score AS quality_score FROM ({FINALS['kpi_record']}) k, ({FINALS['quality_score']}) q""",
    "top_departments": FINALS["top_categories"].replace("p.category,", "p.department AS category,"),
    "lost_fact_rows": """
        SELECT fact, count(*) FILTER (source_customer_id NOT IN (SELECT source_customer_id FROM bridge)) AS lost,
               count(*) FILTER (source_customer_id NOT IN (SELECT source_customer_id FROM bridge)) > 0 AS refused
        FROM (SELECT 'fct_sales' AS fact, source_customer_id FROM stg_orders
              UNION ALL SELECT 'fct_retail_event', source_customer_id FROM stg_events) GROUP BY 1""",
    "stream_strict_merge": f"""
        SELECT * {EVENT_CASTS} FROM stg_events
        WHERE event_at >= TIMESTAMP '2000-01-01' OR CAST(split_part(event_id, '-', 2) AS BIGINT) % 20 <> 0""",
    "gate_table": f"""
        SELECT *, abs(value) <= "limit" AS passed, 'FAIL' AS status FROM (
            SELECT 'extract' AS stage, 'damaged lines' AS finding, 0.0::DOUBLE AS value, 0.0::DOUBLE AS "limit"
            UNION ALL SELECT 'control', 'failed contracts', CAST(count(*) FILTER (violations > 0) AS DOUBLE), 0.0 FROM ({_CONTRACTS})
            UNION ALL SELECT 'control', 'unit delta', CAST(unit_delta AS DOUBLE), 0.0 FROM ({FINALS['total_reconciliation']})
            UNION ALL SELECT 'control', 'payment delta', amount_delta, 0.005 FROM ({FINALS['total_reconciliation']}))""",
    "run_evidence_steps": f"""
        SELECT step, CASE step WHEN 'sources' THEN 'executed' ELSE 'not run' END AS state,
               (SELECT CAST(sum(rows) AS BIGINT) FROM ({_all_sources('count(*) AS rows')})) AS source_records, false AS publishable
        FROM (VALUES ('sources'), ('landing'), ('quality'), ('marts'), ('gates'), ('publication')) AS s(step)""",
}

ORACLES = {name: statement(final) for name, final in FINALS.items()}
