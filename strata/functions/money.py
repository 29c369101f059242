"""Cent-exact money arithmetic.

Prices are DOUBLE at the edges, but a DOUBLE sum depends on the order the
rows arrive in, so two runs (or two engines) can disagree in the second
decimal.  Line amounts are therefore computed in DECIMAL, summed exactly,
and rounded once, half-up, to cents.

A line amount is kept "times 100", ``price * qty * (100 - discount_pct)``,
which is exact at the inputs' own scales: nothing is rounded before the sum.
Inputs that no DECIMAL of these widths holds give a NULL amount instead of an
error, so that the range checks can report the row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Widths: the product of the three has 36 digits, 10 of them decimals.
PRICE_T = "decimal(16,6)"
QTY_T = "decimal(10,0)"
PCT_T = "decimal(7,4)"
SUM_T = "decimal(38,10)"
# For means: what a DOUBLE division starts from.
MEAN_T = "decimal(34,4)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def line_net_x100(price, qty, discount_pct) -> Column:
    """100 x price * qty * (1 - discount/100), exact."""
    return (_c(price).try_cast(PRICE_T) * _c(qty).try_cast(QTY_T)
            * (F.lit(Decimal(100)) - _c(discount_pct).try_cast(PCT_T)).cast("decimal(8,4)"))


def line_discount_x100(price, qty, discount_pct) -> Column:
    """100 x discount/100 * price * qty, exact."""
    return _c(discount_pct).try_cast(PCT_T) * _c(price).try_cast(PRICE_T) * _c(qty).try_cast(QTY_T)


def cents(amount_x100_sum) -> Column:
    """Exact x100 sum -> DOUBLE amount rounded half-up to cents."""
    return F.round(_c(amount_x100_sum).cast(SUM_T), 0).cast("double") / F.lit(100.0)


def mean_cents_from_x100(amount_x100_sum, n) -> Column:
    """Mean amount per row, rounded half-up to cents (NULL when n = 0)."""
    return F.round(_c(amount_x100_sum).cast(MEAN_T).cast("double") / _c(n), 0) / F.lit(100.0)


def price_sum(price) -> Column:
    return F.sum(_c(price).try_cast(PRICE_T))


def mean_price(price_exact_sum, n) -> Column:
    """Mean of prices given their exact sum, rounded half-up to cents."""
    return F.round((_c(price_exact_sum).cast(MEAN_T) * F.lit(100)).cast("double") / _c(n), 0) / F.lit(100.0)


def line_net(price, qty, discount_pct) -> Column:
    """Per-line net amount in cents (DOUBLE)."""
    return cents(line_net_x100(price, qty, discount_pct))


def line_discount(price, qty, discount_pct) -> Column:
    return cents(line_discount_x100(price, qty, discount_pct))
