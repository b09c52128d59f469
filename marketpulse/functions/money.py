"""Money arithmetic that gives the same digits on every engine.

Half-cent ties and float sums depend on evaluation order, so amounts are
rounded and summed as decimals and turned back into doubles at the output.
Prices and notionals carry whole cents; ``CENTS`` holds them exactly.

No amount stops a job: one that no decimal holds (NaN, or beyond 10^26) keeps
its row and its plain double product, and is left out of exact sums and means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = "decimal(28,2)"        # one price or notional
FINE = "decimal(28,6)"         # a price that may carry sub-cent digits
WIDE = "decimal(38,10)"        # a double, held while it is rounded


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int) -> Column:
    """``round(x, scale)`` of a double, half away from zero, returned as double.

    The value goes through a wide decimal so ties are decided on decimal
    digits, not on the binary value a multiplication happens to produce.
    """
    return F.round(_col(c).try_cast(WIDE), scale).cast("double")


def money_sum(c) -> Column:
    """Exact sum of whole-cent amounts, as double."""
    return F.sum(_col(c).try_cast(CENTS)).cast("double")


def money_sum_dec(c) -> Column:
    """Exact sum of whole-cent amounts, kept decimal for later arithmetic."""
    return F.sum(_col(c).try_cast(CENTS))


def exact_avg(c, as_type: str = CENTS) -> Column:
    """Mean as ``double(exact sum) / count`` — one rounding, engine independent."""
    x = _col(c).try_cast(as_type)
    return F.sum(x).cast("double") / F.count(x)


def notional(price, quantity) -> Column:
    """``round(price * quantity, 2)`` with the product formed in decimals
    (prices keep sub-cent digits until the product is rounded), or as doubles
    where the decimals do not fit."""
    exact = F.round(F.try_multiply(_col(price).try_cast(FINE), _col(quantity).cast("decimal(10,0)")), 2)
    return F.coalesce(exact.cast("double"), _col(price) * _col(quantity))
