"""Line pricing (G1/X6/X7) in exact decimal arithmetic.

Money is computed in ``decimal`` so that rounding half-up gives the same cents
in every engine, then exposed as ``double`` at the table surface (the
reference's float columns). Sums of money are taken over the decimal cast of
the stored doubles, never over doubles, so they do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(14, 2)       # one line's amount
PERCENT = DecimalType(5, 2)      # 0.00 .. 100.00
MONEY_SUM = DecimalType(24, 2)   # a sum of line amounts


def as_money(c: Column | str) -> Column:
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def fraction_to_percent(c: Column | str) -> Column:
    """0.07 -> 7.00 exactly (a double fraction with two decimals to a percent)."""
    col = F.col(c) if isinstance(c, str) else c
    return (col.cast(DecimalType(6, 4)) * F.lit(100)).cast(PERCENT)


def line_total(unit_price: Column, quantity: Column) -> Column:
    """round(price * qty, 2)."""
    return F.round(unit_price.cast(MONEY) * quantity.cast("int"), 2).cast(MONEY)


def discounted_total(total: Column, percent: Column) -> Column:
    """round(total * (1 - pct / 100), 2), written as a product so it stays exact."""
    factor = F.lit(1) - percent.cast(PERCENT) * F.lit(0.01).cast(DecimalType(2, 2))
    return F.round(total.cast(MONEY) * factor, 2).cast(MONEY)


def price_lines(df: DataFrame, unit_price: str = "unit_price", quantity: str = "quantity",
                percent: str = "discount_percentage") -> DataFrame:
    """Add ``line_total`` and ``line_discounted_total`` (decimal) to priced lines."""
    total = line_total(F.col(unit_price), F.col(quantity))
    return (df.withColumn("line_total", total)
              .withColumn("line_discounted_total",
                          discounted_total(F.col("line_total"), F.col(percent))))


def money_sum(c: Column | str) -> Column:
    """Exact sum of a money column stored as double, rounded to cents."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(F.sum(col.cast(MONEY)).cast(MONEY_SUM), 2)


def to_double(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("double")
