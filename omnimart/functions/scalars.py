"""Column helpers: money, hashes, checks on text, rounding and ratios."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"

# Half a cent, the tolerance of every amount comparison.
HALF_CENT = Decimal("0.005")

# Characters and text of a signed percentage.
MINUS_SIGN = "−"
NARROW_SPACE = " "
NOT_AVAILABLE = "n.d."


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(at: datetime) -> Column:
    """Timestamp literal; a moment without an offset is wall-clock time of the session."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def line_amount(quantity: Column | str, unit_price: Column | str) -> Column:
    """Quantity times unit price, to the cent."""
    return F.round(_col(quantity) * _col(unit_price), 2).cast(MONEY)


def email_hash(email: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of the lower-cased address."""
    return F.substring(F.sha2(F.lower(_col(email)), 256), 1, 16)


def is_email_hash(c: Column | str) -> Column:
    """True when the whole text is 16 lower-case hex digits; \\z also rejects a final newline."""
    return F.coalesce(_col(c).rlike(r"^[0-9a-f]{16}\z"), F.lit(False))


def iso_timestamp(c: Column | str) -> Column:
    """Timestamp of ISO-8601 text with a full date, else null; never raises."""
    text = _col(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def amounts_agree(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(HALF_CENT)


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient, null when the divisor is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def round_half_up(x: Column, digits: int) -> Column:
    """Rounding with ties toward plus infinity, on doubles."""
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def signed_percent(current: Column, reference: Column) -> Column:
    """Relative change in percent at one decimal; null without a usable reference."""
    base = reference.cast("double")
    change = (current.cast("double") - base) / F.nullif(base, F.lit(0.0))
    return F.floor(change * 1000.0 + 0.5).cast("double") / 10.0


def signed_percent_text(value: Column) -> Column:
    """French text of a signed percentage, e.g. plus three point two."""
    digits = F.translate(F.format_number(F.abs(value), 1), ",.", f"{NARROW_SPACE},")
    sign = F.when(value > 0, "+").when(value < 0, MINUS_SIGN).otherwise("")
    return F.coalesce(
        F.concat(sign, digits, F.lit(f"{NARROW_SPACE}%")), F.lit(NOT_AVAILABLE)
    )
