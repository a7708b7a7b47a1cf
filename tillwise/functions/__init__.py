"""Column expressions shared by the questions: measures, date parts and safe ratios."""

from tillwise.functions.measures import (
    AMOUNT, MONEY, QTY, UNITS, exact, line_cost, line_qty, net_revenue, returned, unit_cost,
)
from tillwise.functions.dates import (
    as_date, day_diff, first_complete_year, last_complete_year, month_part, month_start, quarter_part, year_part,
)
from tillwise.functions.ratios import growth, ratio

__all__ = [
    "AMOUNT", "MONEY", "QTY", "UNITS", "exact", "line_cost", "line_qty", "net_revenue", "returned", "unit_cost",
    "as_date", "day_diff", "first_complete_year", "last_complete_year", "month_part", "month_start", "quarter_part",
    "year_part", "growth", "ratio",
]
