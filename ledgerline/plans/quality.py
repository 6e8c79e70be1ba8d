"""Load checks on a star (G1-G11). Constraints cannot be enforced in Spark,
so each check is a job that reports violations as rows."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import views as V
from .star import Star

# Table names as the load checks print them, with each
# table's primary key.
TABLE_KEYS = (("dim.date", "date", "date_key"), ("dim.customer", "customer", "customer_key"),
              ("dim.product", "product", "product_key"), ("dim.geography", "geography", "geography_key"),
              ("dim.ship_mode", "ship_mode", "ship_mode_key"), ("fact.sales", "fact", "sales_key"))

# Fact → dimension relationships (foreign key, dimension, dimension key).
RELATIONSHIPS = (("order_date", "order_date_key", "date", "date_key"),
                 ("ship_date", "ship_date_key", "date", "date_key"),
                 ("customer", "customer_key", "customer", "customer_key"),
                 ("product", "product_key", "product", "product_key"),
                 ("geography", "geography_key", "geography", "geography_key"),
                 ("ship_mode", "ship_mode_key", "ship_mode", "ship_mode_key"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_row_counts(star: Star) -> DataFrame:
    """(table_name, row_count) for the six tables."""
    return _union([getattr(star, attr).agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(name).alias("table_name"), "row_count")
                   for name, attr, _ in TABLE_KEYS if getattr(star, attr) is not None])


def pk_violations(star: Star) -> DataFrame:
    """G1: per table, NULL keys and key values held by more than one row.

    One aggregate per table: per-key counts (map-side combined), then a
    global roll-up of those counts."""
    out = []
    for name, attr, key in TABLE_KEYS:
        if getattr(star, attr) is None:
            continue
        per_key = getattr(star, attr).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        out.append(per_key.agg(
            F.sum("n").cast("bigint").alias("row_count"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
            F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("duplicated_keys"))
            .select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"),
                    "row_count", "null_keys", "duplicated_keys"))
    return _union(out)


def _relationships(star: Star) -> list[tuple[str, str, str, str]]:
    """The relationships whose key and dimension the star has."""
    return [r for r in RELATIONSHIPS if r[1] in star.fact.columns and getattr(star, r[2]) is not None]


def orphan_counts(star: Star) -> DataFrame:
    """One row of orphan counts, the fact rows with a non-NULL key that
    no dimension row carries. The fact is read once: it is joined to the
    distinct keys of every dimension and the misses are counted together."""
    joined, counts = star.fact, []
    for rel, fk, dim, key in _relationships(star):
        keys = getattr(star, dim).select(F.col(key).alias(f"_{rel}")).where(F.col(f"_{rel}").isNotNull()).distinct()
        joined = joined.join(keys, F.col(fk) == F.col(f"_{rel}"), "left")
        counts.append(F.count_if(F.col(fk).isNotNull() & F.col(f"_{rel}").isNull()).alias(f"orphan_{rel}_rows"))
    return joined.agg(*counts)


def fk_violations(star: Star) -> DataFrame:
    """(relationship, orphan_rows) for the foreign keys: G7 as rows."""
    names = [r[0] for r in _relationships(star)]
    pairs = F.array(*[F.struct(F.lit(n).alias("relationship"), F.col(f"orphan_{n}_rows").alias("orphan_rows")) for n in names])
    return orphan_counts(star).select(F.explode(pairs).alias("r")).select("r.*")


def missing_key_counts(star: Star) -> DataFrame:
    """One row, NULL count per fact key (NULL over an empty fact)."""
    f = star.fact
    return f.agg(*[F.sum(F.when(F.col(k).isNull(), F.lit(1)).otherwise(F.lit(0))).alias(f"missing_{k}")
                   for k in ("order_date_key", "ship_date_key", "customer_key", "product_key",
                             "geography_key", "ship_mode_key") if k in f.columns])


def control_totals(star: Star) -> DataFrame:
    """Fact rows and measure totals."""
    from ..functions import measures as M
    return star.fact.agg(F.count(F.lit(1)).alias("fact_rows"), M.total_sales(), M.total_profit(),
                         M.total_quantity(), M.avg_discount())


# Columns of the join sample, in order.
JOIN_SAMPLE_COLUMNS = ("sales_key", "order_id", "order_date", "ship_date", "customer_name", "segment",
                       "product_name", "category", "sub_category", "country", "region", "state", "city",
                       "ship_mode", "sales", "quantity", "discount", "profit")


def join_sample(star: Star, n: int = 20) -> DataFrame:
    """First n rows of the seven-table LEFT join, by sales_key. The joins
    are left joins on unique keys, so the n fact rows are taken first."""
    some = replace(star, fact=star.fact.orderBy("sales_key").limit(n))
    return V.sales_detail(some).orderBy("sales_key").limit(n).select(*JOIN_SAMPLE_COLUMNS)


def view_row_counts(star: Star) -> DataFrame:
    """(view_name, row_count) for the twelve views. Counting prunes sums
    and ratios from their plans; the Pareto view has a row for each product
    sold, so its running total is not computed."""
    counted = {"vw_product_pareto": V.product_totals}
    return _union([counted.get(name, fn)(star).agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(name).alias("view_name"), "row_count")
                   for name, fn in V.available(star).items()])


def sales_detail_top(star: Star, n: int = 20) -> DataFrame:
    """First n detail rows by order date (NULL dates first), then
    sales_key. A calendar key orders like its date, so the n fact rows are
    taken before the joins."""
    some = replace(star, fact=star.fact.orderBy(F.col("order_date_key").asc_nulls_first(), "sales_key").limit(n))
    return V.sales_detail(some).orderBy(F.col("order_date").asc_nulls_first(), "sales_key").limit(n)
