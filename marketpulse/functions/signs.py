"""Side conventions. They differ per table on purpose (missing side rows
arrive, since side is only a warning rule):

* positions (PRJ-7): BUY is +, anything else −
* cash flow (PRJ-8): SELL is +, anything else −
* exposure:  BUY is long, SELL is short, anything else neither
* position side (PRJ-9): LONG / SHORT / FLAT by the sign of the net quantity
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def position_signed(value, side="side") -> Column:
    return F.when(_col(side) == "BUY", _col(value)).otherwise(-_col(value))


def cashflow_signed(value, side="side") -> Column:
    return F.when(_col(side) == "SELL", _col(value)).otherwise(-_col(value))


def long_part(value, side="side") -> Column:
    return F.when(_col(side) == "BUY", _col(value)).otherwise(F.lit(0))


def short_part(value, side="side") -> Column:
    return F.when(_col(side) == "SELL", _col(value)).otherwise(F.lit(0))


def position_side(net_quantity="net_quantity") -> Column:
    q = _col(net_quantity)
    return F.when(q > 0, "LONG").when(q < 0, "SHORT").otherwise("FLAT")
