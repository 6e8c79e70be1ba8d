"""Measures that roll up, distinct orders among them.

Sums of finer groups add up, distinct counts do not: an order with lines in
two categories would count twice. The cells kept here carry the set of their
orders as bitmaps over dense order numbers, so that a union (``bitmap_or_agg``)
gives exact counts at every coarser grain without the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from ..functions import measures as M
from ..functions.numeric import ratio
from ..operators.ordered import ordered_index
from ..session import materialize
from .star import Star

# attribute -> dimension that has it
ATTRIBUTES = {"region": "geography", "category": "product", "segment": "customer"}
SUMS = ("lines", "sales", "profit", "quantity", "discount", "discounts")
# Rows of a dimension that Spark broadcasts anyway, and the most whose packed codes (a byte a row) are broadcast.
SMALL, LARGEST = 20_000, 1 << 25
BLOCK_BITS, CODES = 16, 100


def _packed(dim: DataFrame, key: str, attributes: Sequence[str]) -> tuple[DataFrame, DataFrame] | None:
    """A dimension as ``(_block, _first, _codes)``, a byte for each key in
    arrays of 65,536, and ``(_code, attributes)``. None unless its keys are
    whole numbers without gaps or repeats, and few values of the attributes
    and rows between :data:`SMALL` and :data:`LARGEST` make that a gain."""
    if not isinstance(dim.schema[key].dataType, (IntegerType, LongType)):
        return None
    dim = dim.select(F.col(key).cast("long").alias("_key"), *attributes).filter("_key IS NOT NULL")
    if not SMALL < dim.count() <= LARGEST:
        return None
    values = dim.select(*attributes).distinct().limit(CODES + 1)
    values = materialize(values.withColumn("_code", F.row_number().over(Window.orderBy(*attributes)).cast("tinyint")), "codes")
    if values.count() > CODES:
        return None
    known = values.toDF(*(f"_{a}" for a in attributes), "_code")
    coded = dim.join(F.broadcast(known), reduce(Column.__and__, (F.col(a).eqNullSafe(F.col(f"_{a}")) for a in attributes)))
    mask = (1 << BLOCK_BITS) - 1
    each = F.array_sort(F.collect_list(F.struct(F.col("_key").bitwiseAND(mask).cast("int").alias("at"), F.col("_code").alias("code"))))
    blocks = coded.groupBy(F.shiftright("_key", BLOCK_BITS).alias("_block")).agg(each.alias("l")).select(
        "_block", F.col("l")[0]["at"].alias("_first"), F.transform("l", lambda x: x["code"]).alias("_codes"),
        F.forall(F.transform("l", lambda x, i: x["at"] - i), lambda d: d == F.col("l")[0]["at"]).alias("_dense"))
    blocks = materialize(blocks, "packed")
    return (blocks.drop("_dense"), values) if not blocks.filter("NOT _dense").limit(1).count() else None


def with_attributes(lines: DataFrame, dim: DataFrame, key: str, attributes: Sequence[str], found: str) -> DataFrame:
    """The lines with the attributes of the dimension's row, and whether there
    is one (``found``). A dimension that is large only in rows is broadcast as
    packed codes, so the lines do not move; others are joined."""
    packed = _packed(dim, key, attributes)
    if packed is None:
        return lines.join(dim.select(key, *attributes, F.lit(True).alias(found)), key, "left") \
            .withColumn(found, F.coalesce(found, F.lit(False)))
    blocks, values = packed
    at = F.col(key).cast("long").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int") - F.col("_first")
    return lines.join(F.broadcast(blocks), F.shiftright(F.col(key).cast("long"), BLOCK_BITS) == F.col("_block"), "left") \
        .withColumn("_code", F.get("_codes", at)).drop("_block", "_first", "_codes") \
        .withColumn(found, F.col("_code").isNotNull()).join(F.broadcast(values), "_code", "left").drop("_code")


def sales_cells(star: Star, by: Sequence[str] = tuple(ATTRIBUTES)) -> DataFrame:
    """One row per combination of the attributes ``by`` and block of 32,768
    order numbers: the bitmap of its orders and sums of its lines.

    ``in_<dimension>`` says whether the lines have a row in that dimension
    (a NULL attribute of a row there is a value like any other). Lines without
    order id count in the sums and add no order. The dimensions' keys must be
    unique (``quality.pk_violations``, ``load.load_star``), as a repeated key
    would repeat its lines at every grain. The order numbers take one
    range exchange of the distinct ids, the fact one exchange on the order id;
    the cells of a hot combination are combined before they are shuffled. The
    bitmaps take at most 4 KB a row, one bit an order where all orders are."""
    numbers = ordered_index(star.fact.select("order_id").where("order_id IS NOT NULL").distinct(), ["order_id"], "_order")
    lines = star.fact.join(numbers, "order_id", "left")
    keys = []
    for dim in dict.fromkeys(ATTRIBUTES[a] for a in by):
        own = [a for a in by if ATTRIBUTES[a] == dim]
        lines = with_attributes(lines, star.tables()[f"dim_{dim}"], f"{dim}_key", own, f"in_{dim}")
        keys += [f"in_{dim}", *own]
    return lines.groupBy(*keys, F.bitmap_bucket_number("_order").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_order")).alias("orders"),
        F.count(F.lit(1)).alias("lines"), F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
        F.sum("quantity").alias("quantity"), F.sum("discount").alias("discount"), F.count("discount").alias("discounts"))


def written_cells(star: Star, by: Sequence[str] = tuple(ATTRIBUTES)) -> DataFrame:
    """``sales_cells``, written once for many roll-ups."""
    return materialize(sales_cells(star, by), "sales-cells")


def roll_up(cells: DataFrame, *by: str, aov: bool = False) -> DataFrame:
    """The aggregate block at the grain of ``by`` (none: one row over all),
    over the lines that have a row in the dimensions of ``by``; equal to
    grouping the fact itself. No cells give no rows, or one row of zero orders."""
    for dim in {ATTRIBUTES[a] for a in by}:
        cells = cells.where(f"in_{dim}")
    sums = [F.sum(c).alias(c) for c in SUMS]
    blocks = cells.groupBy(*by, "block").agg(F.bitmap_count(F.bitmap_or_agg("orders")).alias("orders"), *sums)
    whole = blocks.groupBy(*by).agg(F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"), *sums)
    sales, profit, orders = F.col("sales").cast(M.SALES_TYPE), F.col("profit").cast(M.PROFIT_TYPE), F.col("orders")
    value = [ratio(sales, orders).alias("avg_order_value")] if aov else []
    return whole.select(
        *by, orders.alias("total_orders"), F.coalesce("lines", F.lit(0)).alias("total_order_lines"), sales.alias("total_sales"),
        profit.alias("total_profit"), F.col("quantity").cast("bigint").alias("total_quantity"),
        (F.col("discount").cast("double") / F.nullif("discounts", F.lit(0))).alias("avg_discount"),
        ratio(profit, sales).alias("profit_margin"), *value)
