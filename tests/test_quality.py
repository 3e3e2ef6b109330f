from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from omnimart.operators import checks
from omnimart.plans import contracts, quality, staging
from omnimart.sources.synthetic import SyntheticSource

NOW = datetime(2026, 9, 8, 19)


@pytest.fixture(scope="module")
def sources(spark):
    return staging.typed_sources(SyntheticSource(spark, NOW, orders=120, web_events=80))


def failed(raw, as_of=NOW):
    return {r["contract"]: r["violations"] for r in contracts.run_contracts(raw, as_of).collect() if not r["passed"]}


def test_all_contracts_hold_on_clean_sources(sources):
    results = contracts.run_contracts(sources, NOW)
    assert results.count() == 24
    score = checks.score(contracts.as_check_results(results)).first()
    assert (score["total"], score["passed"], score["score"], score["status"]) == (24, 24, 100.0, "PASS")


def set_where(df, column, key, value, new):
    return df.withColumn(column, F.when(F.col(key) == value, new).otherwise(F.col(column)))


def twice(df, key, value):
    return df.unionByName(df.filter(F.col(key) == value))


def test_an_order_without_amount_disagrees_with_its_payment(sources):
    raw = {**sources, "orders": set_where(sources["orders"], "unit_price", "order_id", "O000001", F.lit(None).cast("decimal(12,2)"))}
    assert contracts._amount_gaps(raw["orders"], raw["payments"]).count() == 1


CASES = [
    ("orders", lambda d: twice(d, "order_id", "O000001"), {"contract.orders.order_id_unique": 1, "stream.purchase_count_matches_batch": 1}),
    ("retail_events", lambda d: twice(d, "event_id", "W0000001"), {"contract.events.event_id_unique": 1}),
    ("payments", lambda d: twice(d, "transaction_id", "T000001"), {"contract.payments.transaction_id_unique": 1}),
    ("customer_identities", lambda d: twice(d, "source_customer_id", "CRM-C0001"), {"contract.identities.source_customer_id_unique": 1}),
    ("orders", lambda d: set_where(d, "product_id", "order_id", "O000002", F.lit("P999")), {"integrity.orders_product_fk": 1}),
    ("orders", lambda d: set_where(d, "source_customer_id", "order_id", "O000002", F.lit(None)), {"integrity.orders_identity_fk": 1}),
    ("customer_identities", lambda d: set_where(d, "email_hash", "source_customer_id", "CRM-C0001", F.lit("x")), {"integrity.identity_hash_fk": 1}),
    ("payments", lambda d: set_where(d, "order_id", "transaction_id", "T000003", F.lit("O9")), {"integrity.payments_order_fk": 1, "payments.one_settlement_per_order": 2, "payments.amount_matches_sales": 1}),
    ("orders", lambda d: set_where(d, "discount_rate", "order_id", "O000002", F.lit(Decimal("1.0"))), {"business.discount_rate_in_range": 1}),
    ("retail_events", lambda d: set_where(d, "partition_key", "event_id", "W0000002", F.lit("x")), {"stream.partition_key_matches_customer": 1}),
    ("retail_events", lambda d: d.filter("event_id <> 'E0000001'"), {"stream.purchase_count_matches_batch": 1, "stream.purchase_order_ids_match_batch": 1}),
    ("payments", lambda d: set_where(d, "status", "transaction_id", "T000003", F.lit("open")), {"payments.status_settled": 1}),
    ("payments", lambda d: set_where(d, "amount", "transaction_id", "T000003", F.col("amount") + 1), {"payments.amount_matches_sales": 1}),
    ("customers", lambda d: set_where(d, "email_hash", "customer_id", "C0009", F.lit("nope")), {"privacy.email_hash_shape": 1, "integrity.identity_hash_fk": 4}),
    ("price_history", lambda d: set_where(d, "is_current", "product_id", "P100", F.lit(True)), {"scd.one_current_version_per_product": 1, "scd.current_version_is_open_ended": 1}),
    ("price_history", lambda d: set_where(d, "valid_to", "product_id", "P100", F.lit("9999-12-31").cast("date")), {"scd.version_ranges_do_not_overlap": 1}),
]


@pytest.mark.parametrize("table, change, expected", CASES)
def test_each_contract_detects_its_defect(sources, table, change, expected):
    found = failed({**sources, table: change(sources[table])})
    # A removed or repeated order also moves the unit totals by its quantity.
    found.pop("stream.purchase_units_match_batch", None)
    assert found == expected


def test_quantities_and_amounts_must_be_positive(sources):
    orders = set_where(sources["orders"], "quantity", "order_id", "O000004", F.lit(0))
    found = failed({**sources, "orders": orders})
    assert found["business.positive_quantities"] == found["business.positive_sales_amount"] == 1
    assert "stream.purchase_units_match_batch" in found


def test_stale_or_absent_events_fail_freshness(sources):
    assert failed(sources, NOW + timedelta(days=2)) == {"freshness.latest_event_under_24h": 1}
    none = failed({**sources, "retail_events": sources["retail_events"].filter("false")})
    assert none["freshness.latest_event_under_24h"] == 1


def test_version_overlaps_on_equal_starts(spark):
    versions = spark.createDataFrame(
        [
            ("P", date(2026, 1, 1), date(2026, 1, 5)),
            ("P", date(2026, 1, 1), date(2026, 1, 9)),
            ("P", date(2026, 1, 9), date(2026, 1, 10)),
            ("P", date(2026, 1, 11), date(2026, 2, 1)),
        ],
        "product_id string, valid_from date, valid_to date",
    )
    found = contracts.version_overlaps(versions).collect()
    assert [(r["valid_from"], r["overlaps"]) for r in found] == [(date(2026, 1, 1), 2)]


def test_generic_checks(spark):
    tables = {
        "child": spark.createDataFrame(
            [(1, "a", 1), (1, "b", 2), (None, "c", 9), (3, None, None)], "id int, kind string, ref int"
        ),
        "parent": spark.createDataFrame([(1,), (2,)], "ref int"),
    }
    found = {
        r["check"]: r["violations"]
        for r in checks.run_checks(
            tables,
            [
                checks.not_null("child", "id"),
                checks.accepted("child", "kind", ("a", "b")),
                checks.UniqueCheck("child", "id"),
                checks.ParentCheck("child", "ref", "parent", "ref"),
                checks.FrameCheck("child", "big", lambda t: t["child"].filter("id > 2")),
            ],
        ).collect()
    }
    assert found == {
        "not_null.child.id": 1,
        "accepted_values.child.kind": 1,
        "unique.child.id": 1,
        "relationships.child.ref": 1,
        "expression.big": 1,
    }


def test_check_lists_have_their_sizes():
    assert len(quality.not_null_checks()) == 35
    assert len(quality.unique_checks()) == 18
    assert len(quality.parent_checks()) == 9
    assert len(quality.accepted_checks()) == 9
    assert len(quality.EXPRESSIONS) == 6


def test_freshness_levels(spark):
    frames = {
        name: spark.createDataFrame([(NOW - timedelta(minutes=age),)], "at timestamp")
        for name, age in (("new", 30), ("older", 31), ("stale", 121))
    }
    frames["empty"] = spark.createDataFrame([], "at timestamp")
    found = {r["source"]: r["status"] for r in quality.freshness(frames, "at", NOW).collect()}
    assert found == {"new": "pass", "older": "warn", "stale": "error", "empty": "error"}
