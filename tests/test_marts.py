import math
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from omnimart.functions import scalars
from omnimart.operators import dedup, keysets
from omnimart.operators.cube import sales_cube
from omnimart.operators.quantiles import nearest_rank
from omnimart.operators.ranking import tile_scores
from omnimart.plans import core, marts, reports

STOCK = "product_id string, store_stock int, warehouse_stock int, incoming int, reserved int, safety_stock int"


def test_available_to_promise_formula(spark, rows):
    stock = spark.createDataFrame([("P", 20, 40, 10, 5, 15), ("Q", 1, 0, 0, 5, 3)], STOCK)
    sales = spark.createDataFrame([("P", 30), ("P", 5)], "product_id string, quantity int")
    p, q = rows(marts.available_to_promise(stock, sales), "product_id")
    assert (p["units_sold"], p["available_to_promise"], p["risk_level"]) == (35, 30, "healthy")
    assert (q["units_sold"], q["available_to_promise"], q["risk_level"]) == (0, -4, "critical")


@pytest.mark.parametrize(
    "available, level", [(14, "critical"), (15, "watch"), (29, "watch"), (30, "healthy")]
)
def test_risk_bounds(spark, available, level):
    df = spark.range(1).select(marts.risk_level(F.lit(available), F.lit(15)))
    assert df.first()[0] == level


def test_payment_reconciliation(spark, rows):
    sales = spark.createDataFrame(
        [(k, Decimal("10.00")) for k in "abcdef"], "order_id string, sales_amount decimal(18,2)"
    )
    payments = spark.createDataFrame(
        [
            ("a", Decimal("10.00"), "settled"),
            ("b", Decimal("10.01"), "settled"),
            ("c", Decimal("10.00"), "pending"),
            ("d", None, "settled"),
            ("f", Decimal("10.00"), "settled"),
            ("f", Decimal("9.00"), "settled"),
            ("x", Decimal("1.00"), "settled"),
        ],
        "order_id string, amount decimal(12,2), status string",
    )
    found = rows(marts.payment_reconciliation(sales, payments), "order_id", "payment_amount")
    assert [(r["order_id"], r["reconciliation_status"], str(r["amount_delta"])) for r in found] == [
        ("a", "reconciled", "0.00"),
        ("b", "amount_mismatch", "-0.01"),
        ("c", "not_settled", "0.00"),
        ("d", "reconciled", "10.00"),  # no amount: passes the tests, keeps its delta
        ("e", "missing_payment", "10.00"),
        ("f", "reconciled", "0.00"),
        ("f", "amount_mismatch", "1.00"),
    ]


def test_identity_is_resolved_by_hash_and_the_rest_is_reported(spark, rows):
    identities = spark.createDataFrame(
        [("crm", "CRM-1", "h1"), ("pos", "POS-1", "h1"), ("pos", "POS-9", "none")],
        "source_system string, source_customer_id string, email_hash string",
    )
    customers = spark.createDataFrame(
        [("C1", "h1"), ("C2", "h2")], "customer_id string, email_hash string"
    )
    bridge = core.identity_bridge(identities, customers)
    facts = spark.createDataFrame(
        [("o1", "POS-1"), ("o2", "POS-9"), ("o3", "WEB-7")],
        "order_id string, source_customer_id string",
    )
    assert [r["order_id"] for r in rows(core.fct_sales(facts, bridge))] == ["o1"]
    assert [r["order_id"] for r in rows(core.unresolved(facts, bridge), "order_id")] == ["o2", "o3"]
    counts = rows(core.dim_customer(customers, bridge), "customer_id")
    assert [r["resolved_identity_count"] for r in counts] == [2, 0]


def test_strict_resolution_names_the_unknown_ids(spark):
    bridge = spark.createDataFrame([("A", "C1")], "source_customer_id string, customer_id string")
    facts = spark.createDataFrame([("A",), ("B",)], "source_customer_id string")
    core.require_resolved(facts.filter("source_customer_id = 'A'"), bridge)
    with pytest.raises(LookupError, match="'B'"):
        core.require_resolved(facts, bridge)


def test_tie_breaking_prefix_agrees_with_the_full_result(spark):
    random.seed(3)
    data = [
        (f"k{random.randint(0, 5)}", random.randint(0, 2), random.randint(0, 2), random.choice("xyz"))
        for _ in range(200)
    ]
    df = spark.createDataFrame(data, "k string, t int, a int, b string")
    full = dedup.keep_latest_part(df, "k", "t", ("a", "b"))
    part = dedup.keep_latest_part(df, "k", "t", ("a", "b"), wanted=("a",))
    assert part.columns == ["k", "t", "a"]
    assert sorted(full.select("k", "t", "a").collect()) == sorted(part.collect())
    best = {}
    for k, t, a, b in data:
        best[k] = max(best.get(k, (t, a, b)), (t, a, b))
    assert sorted(map(tuple, full.collect())) == sorted((k, *v) for k, v in best.items())


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 7, 8, 9, 257, 1000])
def test_tiles_equal_ntile(spark, size):
    random.seed(size)
    # One value is shared by a third of the rows.
    data = [
        (f"c{i}", 7 if random.random() < 0.4 else random.randint(0, 50), Decimal(random.randint(0, 9)))
        for i in range(size)
    ]
    df = spark.createDataFrame(data, "id string, a int, b decimal(18,2)")
    scored = tile_scores(df, "id", {"sa": F.col("a"), "sb": F.col("b")})
    expected = df.select(
        "id",
        F.ntile(4).over(Window.orderBy("a", "id")).alias("sa"),
        F.ntile(4).over(Window.orderBy("b", "id")).alias("sb"),
    )
    assert sorted(scored.select("id", "sa", "sb").collect()) == sorted(expected.collect())


@pytest.mark.parametrize("size", [1, 2, 3, 8, 9, 100])
@pytest.mark.parametrize("share", [0.25, 0.9, 1.0])
def test_tiles_equal_ntile_with_nulls(spark, size, share):
    """Nulls stand last, as one more value; also when they reach a tile's boundary."""
    random.seed(size)
    data = [(f"c{i}", None if random.random() < share else random.randint(0, 5)) for i in range(size)]
    df = spark.createDataFrame(data, "id string, a int")
    scored = tile_scores(df, "id", {"s": F.col("a")})
    order = Window.orderBy(F.col("a").asc_nulls_last(), "id")
    expected = df.select("id", F.ntile(4).over(order).alias("s"))
    assert sorted(scored.select("id", "s").collect()) == sorted(expected.collect())


def test_events_without_latency_count_as_events(spark):
    kind = "event_at timestamp, latency_ms int"
    df = spark.createDataFrame([(datetime(2026, 1, 1), 5), (datetime(2026, 1, 1), None), (None, 7)], kind)
    assert tuple(reports.event_metrics(df).first()) == (3, 7)
    assert tuple(reports.event_metrics(df.limit(0)).first()) == (0, 0)


def test_rfm_segments(spark, rows):
    day = datetime(2026, 1, 1)
    sales = spark.createDataFrame(
        [
            (f"C{c}", f"o{c}-{i}", "web" if i % 2 else "store", Decimal(c), day.replace(day=c + 1))
            for c in range(1, 9)
            for i in range(c)
        ],
        "customer_id string, order_id string, channel string, sales_amount decimal(18,2), ordered_at timestamp",
    )
    customers = sales.select("customer_id").distinct()
    found = rows(marts.customer_rfm(sales, customers), "customer_id")
    assert [r["recency_days"] for r in found] == [7, 6, 5, 4, 3, 2, 1, 0]
    assert [r["recency_score"] for r in found] == [1, 1, 2, 2, 3, 3, 4, 4]
    assert [r["active_channels"] for r in found] == [1] + [2] * 7
    assert [r["rfm_segment"] for r in found] == ["developing"] * 4 + ["loyal"] * 2 + ["champions"] * 2


@pytest.mark.parametrize("size", [0, 1, 2, 19, 20, 21, 100, 311])
def test_nearest_rank(spark, size):
    random.seed(size)
    values = [random.choice([random.randint(-5, 300_000), 2_000_000_000, 42]) for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    found = nearest_rank(df, "v", 0.95).first()
    ranked = sorted(values)
    expected = ranked[max(1, math.ceil(0.95 * size)) - 1] if values else 0
    assert (found["row_count"], found["percentile"]) == (size, expected)


def test_nearest_rank_by_group(spark):
    random.seed(1)
    groups = ["a", "b", None]
    data = [(random.choice(groups), random.randint(0, 10**6)) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, v int")
    found = {r["g"]: r["percentile"] for r in nearest_rank(df, "v", 0.5, by=["g"]).collect()}
    for group in groups:
        values = sorted(v for g, v in data if g == group)
        assert found[group] == values[math.ceil(0.5 * len(values)) - 1]


def test_quantity_mismatches_count_copies(spark, rows):
    kind = "order_id string, quantity int"
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("n", None)], kind)
    stream = spark.createDataFrame([("a", 1), ("b", 5), ("b", 5), ("b", 2), ("d", 4), ("n", 1)], kind)
    found = rows(keysets.quantity_mismatches(batch, stream), "order_id")
    assert [tuple(r.values()) for r in found] == [
        ("b", 2, 5, 2),
        ("c", 3, None, 1),
        ("d", None, 4, 1),
    ]


def test_cube_cells_equal_single_selections(spark):
    random.seed(5)
    now = datetime(2026, 3, 31, 12)
    data = [
        (
            f"C{random.randint(1, 9)}",
            random.choice(["web", "store"]),
            random.randint(1, 4),
            Decimal(random.randint(100, 9999)) / 100,
            datetime(2026, 3, random.randint(1, 31), random.randint(0, 11)),
        )
        for _ in range(300)
    ]
    sales = spark.createDataFrame(
        data,
        "customer_id string, channel string, quantity int, sales_amount decimal(18,2), ordered_at timestamp",
    )
    cells = {(r["channel"], r["period"]): r.asDict() for r in sales_cube(sales, now).collect()}
    assert len(cells) == 12
    for (channel, period), cell in cells.items():
        chosen = reports.Selection(now, channel, period).sales(sales)
        block = reports.kpi_block(chosen).first().asDict()
        assert {k: cell[k] for k in block} == block
    assert cells[("marketplace", 7)]["orders"] == 0


def test_reports_add_up(spark):
    random.seed(6)
    now = datetime(2026, 3, 31, 12)
    sales = spark.createDataFrame(
        [
            (
                f"C{random.randint(1, 40)}",
                f"P{random.randint(1, 6)}",
                random.choice(["web", "store", "marketplace"]),
                random.randint(1, 4),
                Decimal(random.randint(100, 9999)) / 100,
                datetime(2026, 3, random.randint(1, 31), random.randint(0, 11)),
            )
            for _ in range(200)
        ],
        "customer_id string, product_id string, channel string, quantity int, sales_amount decimal(18,2), ordered_at timestamp",
    )
    chosen = reports.Selection(now).sales(sales)
    kpi = reports.kpi_block(chosen).first()
    series = reports.daily_series(chosen).agg(F.sum("revenue"), F.sum("orders"), F.sum("units")).first()
    mix = reports.channel_mix(chosen).agg(F.sum("revenue"), F.sum("orders")).first()
    assert tuple(series) == (kpi["revenue"], kpi["orders"], kpi["units"])
    assert tuple(mix) == (kpi["revenue"], kpi["orders"])
    pivot = reports.daily_pivot(chosen).collect()
    assert [r["day"] for r in pivot] == sorted((r["day"] for r in pivot), reverse=True)
    assert sum(r[f"{c}_revenue"] for r in pivot for c in ("web", "store", "marketplace")) == kpi["revenue"]


def test_empty_selection_reports_zeros(spark):
    sales = spark.createDataFrame(
        [], "customer_id string, channel string, quantity int, sales_amount decimal(18,2), ordered_at timestamp"
    )
    block = reports.kpi_block(sales).first().asDict()
    assert block == {"revenue": 0, "orders": 0, "customers": 0, "units": 0, "avg_basket": 0.0}


def test_selection_is_sanitised():
    now = datetime(2026, 1, 31)
    assert (reports.Selection(now, "phone", 90).channel, reports.Selection(now, "phone", 90).period) == ("all", 30)
    assert reports.Selection(now, "web", 1).period == 7


def test_stock_summary_without_demand_has_no_cover(spark):
    stock = spark.createDataFrame(
        [("P", 10, "watch", 0), ("Q", -3, "critical", 0)],
        "product_id string, available_to_promise bigint, risk_level string, selected_units_sold bigint",
    )
    found = reports.stock_summary(stock, 30).first()
    assert (found["total_atp"], found["critical"], found["watch"], found["coverage_days"]) == (7, 1, 1, None)
    sold = stock.withColumn("selected_units_sold", F.lit(15).cast("bigint"))
    assert reports.stock_summary(sold, 30).first()["coverage_days"] == 7  # 7 units at one a day


@pytest.mark.parametrize(
    "spend, orders, segment",
    [
        (1200, 1, "Champions"),
        (10, 14, "Champions"),
        (650, 1, "Fidèles"),
        (10, 8, "Fidèles"),
        (300, 7, "Prometteurs"),
        (299.99, 7, "Nouveaux"),
    ],
)
def test_spend_segments(spark, spend, orders, segment):
    df = spark.range(1).select(reports.spend_segment(F.lit(spend), F.lit(orders)))
    assert df.first()[0] == segment


def test_repricing_bounds(spark, rows):
    stock = spark.createDataFrame(
        [("P1", 60, 0, 0, 0, 100), ("P2", 900, 0, 0, 0, 10), ("P3", 100, 0, 0, 0, 10)], STOCK
    )
    products = spark.createDataFrame(
        [(f"P{i}", "n", "c", Decimal("10.05")) for i in (1, 2, 3)],
        "product_id string, product_name string, category string, current_price decimal(12,2)",
    )
    sales = spark.createDataFrame(
        [("P1", 55, Decimal("0.1")), ("P2", 44, Decimal("0")), ("P3", 51, None)],
        "product_id string, quantity int, discount_rate decimal(5,4)",
    ).withColumn("sales_amount", (F.col("quantity") * 2).cast("decimal(18,2)"))
    found = rows(marts.repricing(products, stock, sales), "product_id")
    assert [r["demand_index"] for r in found] == [1.1, 0.88, 1.02]
    assert [r["recommended_action"] for r in found] == [
        "protect_margin",
        "accelerate_sell_through",
        "hold",
    ]
    assert [str(r["recommended_price"]) for r in found] == ["10.35", "9.55", "10.05"]
    assert [r["average_discount_rate"] for r in found] == [0.1, 0.0, None]


def test_ratio_to_max(spark, rows):
    df = spark.createDataFrame([("a", 4), ("b", -2), ("c", 1)], "k string, v int")
    assert [r["ratio_to_max"] for r in rows(marts.ratio_to_max(df, "v"), "k")] == [1.0, 0.0, 0.25]
    low = spark.createDataFrame([("a", -4)], "k string, v int")
    assert rows(marts.ratio_to_max(low, "v"))[0]["ratio_to_max"] == 0.0


def test_scalars(spark):
    texts = ["0123456789abcdef", "0123456789abcdef\n", "0123456789ABCDEF", "abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "h string")
    assert [r[0] for r in df.select(scalars.is_email_hash("h")).collect()] == [True] + [False] * 4
    moments = ["2026-09-02T08:00:00Z", "2026-09-02", "2026", "junk", None]
    df = spark.createDataFrame([(t,) for t in moments], "t string")
    found = [r[0] for r in df.select(scalars.iso_timestamp("t").isNotNull()).collect()]
    assert found == [True, True, False, False, False]
    percent = [
        spark.range(1).select(scalars.signed_percent_text(scalars.signed_percent(F.lit(a), F.lit(b)))).first()[0]
        for a, b in ((103.2, 100), (98.6, 100), (100, 100), (5, 0), (112345, 1000))
    ]
    assert percent == ["+3,2 %", "−1,4 %", "0,0 %", "n.d.", "+11 134,5 %"]


def test_search(spark, rows):
    df = spark.createDataFrame([("Red Bolt", "P1"), ("Blue gear", "P2")], "name string, id string")
    assert [r["id"] for r in rows(keysets.search_rows(df, ["name", "id"], "  bolt p1 "))] == ["P1"]
    assert len(rows(keysets.search_rows(df, ["name", "id"], ""))) == 2


def test_extremes_take_the_first_day(spark):
    df = spark.createDataFrame(
        [("web", date(2026, 1, d), Decimal(v)) for d, v in ((1, 5), (2, 1), (3, 5), (4, 1))],
        "channel string, day date, revenue decimal(18,2)",
    )
    found = reports.extremes(df, "channel").first()
    assert (found["low_day"], found["high_day"]) == (date(2026, 1, 2), date(2026, 1, 1))
