"""Numeric coercion, exact ratios and means."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from .dates import WHITESPACE

# Money and rates read from text keep eight decimals: sums stay exact and
# independent of partition order, and no digit of a usual file is rounded.
MONEY_TYPE = "decimal(28,8)"
SUM_TYPE = "decimal(38,8)"
RATIO_TYPE = "decimal(18,4)"


def _text(col: Column) -> Column:
    t = F.btrim(col.cast(StringType()), F.lit(WHITESPACE))
    return F.when(t != "", t)


def to_decimal(col: Column, dtype, target: str = MONEY_TYPE) -> Column:
    """Numeric text or floating point → DECIMAL; anything that is no such
    number ('abc', 'NaN', infinite, too large) → NULL. Other numbers stay."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return col.cast(StringType()).try_cast(target)  # by their shortest digits: 0.1 is 0.1
    if isinstance(dtype, NumericType):
        return col
    return _text(col).try_cast(target)


def to_count(col: Column, dtype) -> Column:
    """Quantity: number or numeric text → BIGINT truncated toward zero;
    unparseable or missing → 0."""
    if isinstance(dtype, NumericType):
        val = col.try_cast("double")
    else:
        val = _text(col).try_cast("double")
    val = F.when(~F.isnan(val), val)
    return F.coalesce(val.try_cast("bigint"), F.lit(0).cast("bigint"))


def ratio(num: Column, den: Column) -> Column:
    """num / den as DECIMAL(18,4); NULL when den is 0 or NULL.

    Both operands become integers of 1e-8 units and are divided once as
    integers, rounding half away from zero, so there is one rounding step."""
    units = lambda c: (c.cast(SUM_TYPE) * F.lit(Decimal(10 ** 8))).cast("decimal(38,0)")
    n, d = units(num), units(den)
    d = F.nullif(d, F.lit(0).cast("decimal(38,0)"))
    size = F.call_function("div", F.abs(n) * F.lit(Decimal(20_000)) + F.abs(d), F.abs(d) * F.lit(Decimal(2)))
    signed = F.when((n < 0) != (d < 0), -size).otherwise(size)
    return (signed.cast("decimal(19,0)") * F.lit(Decimal("0.0001"))).cast(RATIO_TYPE)


def times(col: Column, factor: int) -> Column:
    """A money value times a small whole number, with every digit kept."""
    return col.cast("decimal(30,8)") * F.lit(Decimal(factor))


def exact_margin(profit: Column, sales: Column) -> Column:
    """profit / sales with 14 decimals, for comparisons; NULL when sales is 0."""
    d = sales.cast("decimal(24,8)")
    return profit.cast("decimal(24,8)") / F.nullif(d, F.lit(0).cast("decimal(24,8)"))


def mean(col: Column) -> Column:
    """Unweighted mean as DOUBLE: exact decimal sum, then one division."""
    return F.sum(col).cast("double") / F.nullif(F.count(col), F.lit(0))


def mean_truncated(name: str) -> Column:
    """Integer mean truncated toward zero, as an integer AVG does."""
    return F.expr(f"CAST(sum(`{name}`) AS BIGINT) div nullif(count(`{name}`), 0)")
