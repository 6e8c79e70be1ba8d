"""Product-identifier conflict reports (Q1-Q10).

A product_id "conflicts" when it carries more than one name, category or
sub-category. The reports read the lines as they come: values are neither
trimmed nor are repeated lines dropped, dates are read month first. The lines
are aggregated once, to one row per id and attribute variant, and every
report is derived from that much smaller table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTH_FIRST
from ..functions.numeric import SUM_TYPE, to_decimal
from ..operators.clean import existing, normalize_columns, parse_dates

AMOUNT_TYPE = SUM_TYPE

ATTRS = ("product_name", "category", "sub_category")

# Columns of the published conflict list.
LIST_COLUMNS = ("product_id", "product_name", "category")


def conflict_input(raw: DataFrame) -> DataFrame:
    """Raw lines with normalised names, order dates parsed month first (C3),
    and sales and profit numeric, bad or missing as 0 (C8). Kept DECIMAL so
    totals do not depend on the order rows are summed in."""
    out = parse_dates(normalize_columns(raw), ("order_date",), MONTH_FIRST)
    types = {f.name: f.dataType for f in out.schema.fields}
    for c in existing(out, ("sales", "profit")):
        out = out.withColumn(c, F.coalesce(to_decimal(F.col(c), types[c]), F.lit(0)))
    return out


def variants(lines: DataFrame) -> DataFrame:
    """One row per product_id and attribute variant: lines, sales, profit,
    first and last order date; NULL for columns the lines lack. Lines with a
    NULL product_id are left out. A table of variants comes back as it is."""
    if "number_of_rows" in lines.columns:
        return lines
    src = conflict_input(lines)
    cols = existing(src, ATTRS)
    if "product_id" not in src.columns or not cols:
        return lines.sparkSession.createDataFrame([], "product_id string, number_of_rows bigint")
    total = lambda c: (F.sum(c) if c in src.columns else F.lit(None)).cast(AMOUNT_TYPE)
    day = lambda agg: agg("order_date") if "order_date" in src.columns else F.lit(None).cast("date")
    return src.where(F.col("product_id").isNotNull()).groupBy("product_id", *cols).agg(
        F.count(F.lit(1)).alias("number_of_rows"), total("sales").alias("total_sales"),
        total("profit").alias("total_profit"), day(F.min).alias("first_date"), day(F.max).alias("last_date"),
        F.lit("order_date" in src.columns).alias("dated"))


def attribute_counts(lines: DataFrame) -> DataFrame:
    """Q1: distinct non-NULL names, categories, sub-categories per product_id."""
    v = variants(lines)
    cols = existing(v, ATTRS)
    return v.groupBy("product_id").agg(*[F.count_distinct(c).alias(c) for c in cols]) if cols else v.select("product_id")


def conflicts(lines: DataFrame) -> DataFrame:
    """Q2: product_ids with more than one value in any checked column."""
    counts = attribute_counts(lines)
    cols = existing(counts, ATTRS)
    return counts.where(reduce(Column.__or__, (F.col(c) > 1 for c in cols))) if cols else counts


def conflict_list(lines: DataFrame) -> DataFrame:
    """Q3: the conflicts as published: id, names, categories."""
    return conflicts(lines).select(*LIST_COLUMNS)


def top_conflict_ids(lines: DataFrame, n: int = 10) -> DataFrame:
    """Q4: the n conflicted ids with the most lines (ties by id)."""
    v = variants(lines)
    rows = v.groupBy("product_id").agg(F.sum("number_of_rows").alias("total_rows"))
    return (rows.join(conflicts(v).select("product_id"), "product_id", "left_semi")
            .orderBy(F.col("total_rows").desc(), "product_id").limit(n))


def conflict_details(lines: DataFrame, n: int = 10) -> DataFrame:
    """Q5/Q6: per top-n id and attribute variant: lines, sales, profit, first
    and last order date as yyyy-MM-dd ('' when unknown). Variants with a
    missing attribute are left out, as a group-by on them would."""
    v = variants(lines)
    cols = existing(v, ATTRS)
    out = v.join(top_conflict_ids(v, n).select("product_id"), "product_id", "left_semi").na.drop(subset=cols)
    day = lambda c: F.when(F.col("dated"), F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("")))
    return out.select("product_id", *cols, "number_of_rows", "total_sales", "total_profit",
                      day("first_date").alias("first_order_date"), day("last_date").alias("last_order_date")) \
        .orderBy("product_id", F.col("number_of_rows").desc(), *cols)


# Columns of the conflict details, in order.
DETAIL_COLUMNS = ("product_id", "product_name", "category", "sub_category", "number_of_rows",
                  "total_sales", "total_profit", "first_order_date", "last_order_date")


def details_from_text(text: DataFrame) -> DataFrame:
    """Conflict details read back from CSV (all text) with their types:
    counts and amounts parsed (bad → NULL), dates kept as yyyy-MM-dd text."""
    return text.select(
        "product_id", F.col("number_of_rows").try_cast("bigint").alias("number_of_rows"),
        F.col("total_sales").try_cast(AMOUNT_TYPE).alias("total_sales"),
        F.col("total_profit").try_cast(AMOUNT_TYPE).alias("total_profit"),
        F.coalesce("first_order_date", F.lit("")).alias("first_order_date"),
        F.coalesce("last_order_date", F.lit("")).alias("last_order_date"))


def conflict_summary(details: DataFrame) -> DataFrame:
    """Q8: per id: lines, sales, profit, first and last date, |profit|."""
    d = details.select(
        "product_id", "number_of_rows", "total_sales", "total_profit",
        F.try_to_date(F.when(F.col("first_order_date") != "", F.col("first_order_date")), "yyyy-MM-dd").alias("f"),
        F.try_to_date(F.when(F.col("last_order_date") != "", F.col("last_order_date")), "yyyy-MM-dd").alias("l"))
    return (d.groupBy("product_id").agg(
        F.sum("number_of_rows").cast("bigint").alias("total_rows"),
        F.sum("total_sales").cast(AMOUNT_TYPE).alias("total_sales"),
        F.sum("total_profit").cast(AMOUNT_TYPE).alias("total_profit"),
        F.min("f").alias("first_order_date"), F.max("l").alias("last_order_date"))
        .withColumn("profit_abs", F.abs("total_profit")))


def top_conflicts_by_rows(summary: DataFrame, n: int = 10) -> DataFrame:
    """Q9."""
    return summary.orderBy(F.col("total_rows").desc(), "product_id").limit(n)


def top_conflicts_by_profit(summary: DataFrame, n: int = 10) -> DataFrame:
    """Q10."""
    return summary.orderBy(F.col("profit_abs").desc(), "product_id").limit(n)
