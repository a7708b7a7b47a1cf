"""Business measures as Column expressions.

Money is decimal so that sums do not depend on the order in which partitions are added up:
a line amount is ``decimal(18,4)`` and a total is ``decimal(28,4)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"   # one line's money
MONEY = "decimal(28,4)"    # a total of lines
QTY = "decimal(18,4)"      # one line's units
UNITS = "decimal(28,4)"    # a total of units
# A product's units and its unit cost multiply exactly: 24 + 13 + 1 digits are the 38 that a
# decimal holds, so neither factor's scale is cut.
FACTOR_UNITS = "decimal(24,4)"
FACTOR_COST = "decimal(13,4)"

DEFAULT_COST_RATIO = Decimal("0.6")


def exact(value: Column, kind: str) -> Column:
    """``value`` as decimal ``kind``; a value that does not fit fails the query in either ANSI mode
    instead of turning into null."""
    cast = value.try_cast(kind)
    return F.when(value.isNotNull() & cast.isNull(),
                  F.raise_error(F.lit(f"a value does not fit {kind}")).cast(kind)).otherwise(cast)


def net_revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Revenue of a line: net of discount, before tax, returned lines included."""
    return exact(F.col(price) * (F.lit(1) - F.col(discount)), AMOUNT)


def unit_cost(list_price: str = "p_retailprice", cost_ratio: Decimal | float = DEFAULT_COST_RATIO
              ) -> Column:
    """Cost of one unit of a product.

    The data carry no cost, so cost is a stand-in: ``cost_ratio`` of the list price.  Profit
    figures built on it are illustrative, not business fact.
    """
    return exact(F.col(list_price) * F.lit(float(cost_ratio)), FACTOR_COST)


def line_qty(quantity: str = "l_quantity") -> Column:
    return exact(F.col(quantity), QTY)


def line_cost(qty: str = "qty", unit: str = "unit_cost") -> Column:
    """Variable cost of summed units of one product: units times unit cost, exact (no rounding),
    so lines can be totalled per product before the product table is joined.  Null where the
    product, and so its cost, is unknown."""
    return exact(F.col(qty), FACTOR_UNITS) * F.col(unit)


def returned(flag: str = "l_returnflag") -> Column:
    return F.col(flag) == F.lit("R")
