"""The shared aggregate block of the views and the DAX-style measures.

Every function returns aggregate Column expressions for ``groupBy(...).agg``;
a filter context is simply a filtered fact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import SUM_TYPE, mean, ratio

SALES_TYPE = PROFIT_TYPE = SUM_TYPE


def total_orders() -> Column:
    return F.count_distinct("order_id").alias("total_orders")


def total_order_lines() -> Column:
    return F.count(F.lit(1)).alias("total_order_lines")


def total_sales() -> Column:
    return F.sum("sales").cast(SALES_TYPE).alias("total_sales")


def total_profit() -> Column:
    return F.sum("profit").cast(PROFIT_TYPE).alias("total_profit")


def total_quantity() -> Column:
    return F.sum("quantity").cast("bigint").alias("total_quantity")


def avg_discount() -> Column:
    return mean(F.col("discount")).alias("avg_discount")


def profit_margin() -> Column:
    return ratio(F.sum("profit"), F.sum("sales")).alias("profit_margin")


def avg_order_value() -> Column:
    return ratio(F.sum("sales"), F.count_distinct("order_id")).alias("avg_order_value")


def block(lines: bool = True, aov: bool = False) -> list[Column]:
    """Orders, lines, sales, profit, quantity, mean discount, margin (+ AOV)."""
    cols = [total_orders()]
    if lines:
        cols.append(total_order_lines())
    cols += [total_sales(), total_profit(), total_quantity(), avg_discount(), profit_margin()]
    if aov:
        cols.append(avg_order_value())
    return cols


def loss_profit() -> Column:
    return F.sum(F.when(F.col("profit") < 0, F.col("profit"))).cast(PROFIT_TYPE)


def loss_lines() -> Column:
    return F.count_if(F.col("profit") < 0)


def discounted_sales() -> Column:
    return F.sum(F.when(F.col("discount") > 0, F.col("sales"))).cast(SALES_TYPE)
