"""Event-list and product-list parsing, money rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import PURCHASE_EVENT
from .text import _col, strip_text

# Per-hit revenue type: exact decimal with 10 fractional digits.  Sums widen to
# DECIMAL(38,10); results are rounded once, half-even, to cents.
REVENUE_TYPE = "decimal(28,10)"
SUM_TYPE = "decimal(38,10)"
MONEY_TYPE = "decimal(38,2)"


def event_codes(c) -> Column:
    """Comma-separated event list as an array of stripped codes."""
    return F.transform(F.split(_col(c), ","), lambda e: strip_text(e))


def is_purchase(c) -> Column:
    """True when the event list holds the purchase code exactly."""
    e = _col(c)
    return F.coalesce(
        F.when(
            F.instr(e, PURCHASE_EVENT) > 0,
            F.array_contains(event_codes(e), F.lit(PURCHASE_EVENT)),
        ),
        F.lit(False),
    )


def product_revenue(c) -> Column:
    """Sum of field 4 (revenue) over comma-separated products.

    Short products, blank and non-numeric revenue fields are skipped; negative
    values count.  Exact decimal arithmetic, no float drift.
    """
    amounts = F.transform(
        F.split(_col(c), ","),
        lambda p: F.coalesce(
            strip_text(F.get(F.split(p, ";"), 3)).try_cast(REVENUE_TYPE).cast(SUM_TYPE),
            F.lit(0).cast(SUM_TYPE),
        ),
    )
    return F.coalesce(
        F.aggregate(amounts, F.lit(0).cast(SUM_TYPE), lambda acc, x: (acc + x).cast(SUM_TYPE)),
        F.lit(0).cast(SUM_TYPE),
    )


def to_cents(c) -> Column:
    """Half-even rounding to 0.01 (F10), as DECIMAL(38,2)."""
    return F.bround(_col(c), 2).cast(MONEY_TYPE)


def money_text(c) -> Column:
    """Decimal as plain text with two decimals, no exponent."""
    return to_cents(c).cast("string")
