from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from omnimart.operators.calendar import fill_days
from omnimart.plans.flash import Bounds, filled_series, flash_rows, flash_table

BOUNDS = Bounds(date(2026, 9, 8))
KIND = "channel string, day date, revenue decimal(18,2), orders bigint"


@pytest.fixture(scope="module")
def series(spark):
    """Thirty days from 10 August, without a sale on 4 September."""
    days = [date(2026, 8, 10) + timedelta(days=i) for i in range(30)]
    return spark.createDataFrame(
        [
            (channel, day, Decimal(100 + i) * share, 1 + i % 3)
            for i, day in enumerate(days)
            if day != date(2026, 9, 4)
            for channel, share in (("web", 1), ("store", 2), ("all", 3))
        ],
        KIND,
    )


def value(day):
    return 0 if day == date(2026, 9, 4) else 100 + (day - date(2026, 8, 10)).days


def total(start, end):
    return sum(value(start + timedelta(days=i)) for i in range((end - start).days + 1))


def row(series, day, period, channel="web"):
    rows = flash_rows(filled_series(series, BOUNDS), BOUNDS, period)
    return rows.filter((F.col("channel") == channel) & (F.col("day") == F.lit(day))).first()


def test_bounds():
    assert BOUNDS.first_full == date(2026, 8, 11)
    assert BOUNDS.last_full == date(2026, 9, 7)
    assert BOUNDS.first_snapshot == date(2026, 8, 24)
    assert BOUNDS.snapshots == 15


def test_missing_days_are_zero(series):
    filled = fill_days(series, "channel", ["web"], date(2026, 9, 3), date(2026, 9, 5))
    assert [r["revenue"] for r in filled.orderBy("day").collect()] == [124, 0, 126]
    assert fill_days(series, "channel", ["web"], date(2026, 9, 5), date(2026, 9, 3)).count() == 0


def test_week_and_same_day(series):
    found = row(series, date(2026, 8, 30), 7)
    assert found["from_day"] == date(2026, 8, 24)
    assert found["revenue"] == found["week_revenue"] == total(date(2026, 8, 24), date(2026, 8, 30))
    assert found["previous_week_revenue"] == total(date(2026, 8, 17), date(2026, 8, 23))
    assert found["day_revenue"] == value(date(2026, 8, 30))
    assert found["previous_day_revenue"] == value(date(2026, 8, 23))
    assert found["comparison_day"] == date(2026, 8, 23)


def test_period_is_cut_at_the_first_full_day(series):
    found = row(series, date(2026, 9, 7), 30)
    assert (found["from_day"], found["days"], found["clipped"]) == (date(2026, 8, 11), 28, True)
    assert found["revenue"] == total(date(2026, 8, 11), date(2026, 9, 7))
    assert row(series, date(2026, 9, 7), 14)["clipped"] is False


def test_basket(series, spark):
    found = row(series, date(2026, 9, 7), 7)
    assert found["basket"] == round(float(found["revenue"]) / found["orders"], 2)
    empty = row(series, date(2026, 9, 7), 7, "marketplace")
    assert (empty["orders"], empty["basket"], empty["week_change"]) == (0, None, None)


def test_channels_add_up_to_the_total(series):
    rows = flash_rows(filled_series(series, BOUNDS), BOUNDS, 14)
    table = {r["channel"]: r for r in flash_table(rows, date(2026, 9, 1), BOUNDS).collect()}
    assert table["web"]["revenue"] + table["store"]["revenue"] == table["all"]["revenue"]
    assert table["all"]["share"] == 1.0
    assert round(table["web"]["share"] + table["store"]["share"], 9) == 1.0


def test_snapshot_outside_its_range_falls_back(series):
    rows = flash_rows(filled_series(series, BOUNDS), BOUNDS, 14)
    table = flash_table(rows, date(2026, 8, 1), BOUNDS, "web").collect()
    assert [(r["channel"], r["day"]) for r in table] == [("web", date(2026, 9, 7))]
