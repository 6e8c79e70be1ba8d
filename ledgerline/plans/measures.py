"""Measures (X1-X14) and report-page queries.

A measure is an aggregate expression; its filter context is a filtered or
grouped fact. Whole-frame ranks and running totals use the distributed
operators of ``operators.ordered``, medians those of ``operators.medians``; grand totals enter as scalar
subqueries (one value computed once, not a join). Where a query reads the
same product- or customer-level aggregate several times (medians, totals,
rank passes), that aggregate is written once so the fact is scanned once."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.numeric import exact_margin, mean, ratio, times
from ..operators.medians import with_middles
from ..operators.ordered import rank_by, running_sum
from ..session import materialize
from . import views as V
from .star import Star

# Portfolio segment labels, in the order they are tested.
LOSS_MAKER, STAR_PRODUCT, REVENUE_TRAP, NICHE, LOW = (
    "Loss Maker", "Star Product", "Revenue Trap", "Niche Profitable", "Low Performer")


def _order_year(star: Star) -> DataFrame:
    cal = star.date.select(F.col("date_key").alias("order_date_key"),
                           F.col("year").alias("order_year"), F.col("month").alias("order_month"))
    return star.fact.join(cal, "order_date_key", "inner")


def core_measures(star: Star) -> DataFrame:
    """X1-X5 per order year: sales, profit, margin %, order value, orders, lines."""
    return _order_year(star).groupBy("order_year").agg(
        M.total_sales(), M.total_profit(),
        ratio(F.sum("profit"), F.sum("sales")).alias("profit_margin_pct"),
        ratio(F.sum("sales"), F.count_distinct("order_id")).alias("average_order_value"),
        M.total_orders(), M.total_order_lines())


def loss_measures(star: Star) -> DataFrame:
    """Profit of loss-making lines, their count and share of lines."""
    return star.fact.agg(
        M.loss_profit().alias("loss_making_profit"),
        M.loss_lines().alias("loss_making_order_lines"),
        M.total_order_lines(),
        ratio(M.loss_lines(), F.count(F.lit(1))).alias("loss_making_lines_pct"))


def discount_measures(star: Star) -> DataFrame:
    """Sales on discounted lines and their share of sales."""
    return star.fact.agg(
        M.discounted_sales().alias("discounted_sales"), M.total_sales(),
        ratio(M.discounted_sales(), F.sum("sales")).alias("discounted_sales_pct"))


def _yoy(per: DataFrame, keys: list[str]) -> DataFrame:
    """Previous-year value by self-join on year − 1 (a gap year gives NULL,
    where a LAG would silently take an older year)."""
    prev = per.select(*[(F.col(k) + 1).alias(k) if k == "order_year" else F.col(k) for k in keys],
                      F.col("sales").alias("sales_previous_year"))
    j = per.join(prev, keys, "left")
    change = F.col("sales") - F.col("sales_previous_year")
    return j.select(*keys, F.col("sales").alias("total_sales"), "sales_previous_year",
                    change.cast(M.SALES_TYPE).alias("sales_yoy_change"),
                    ratio(change, F.col("sales_previous_year")).alias("sales_yoy_change_pct"))


def yoy_sales(star: Star) -> DataFrame:
    """X9 per order year: sales, previous year, change, change %."""
    per = _order_year(star).groupBy("order_year").agg(F.sum("sales").cast(M.SALES_TYPE).alias("sales"))
    return _yoy(per, ["order_year"])


def yoy_sales_monthly(star: Star) -> DataFrame:
    """X9 per order year and month against the same month a year before."""
    per = (_order_year(star).groupBy("order_year", "order_month")
           .agg(F.sum("sales").cast(M.SALES_TYPE).alias("sales")))
    return _yoy(per, ["order_year", "order_month"])


def in_context(star: Star, order_year: int | None = None, **equal: str) -> Star:
    """The star under filters, as a report page sets them: the order year
    and any dimension column, e.g. ``in_context(star, order_year=2014,
    region="West")``. Every measure and report takes the result."""
    fact = star.fact
    if order_year is not None:
        fact = fact.filter(F.floor(F.col("order_date_key") / 10000) == order_year)
    dims = {"customer_key": star.customer, "product_key": star.product, "geography_key": star.geography, "ship_mode_key": star.ship_mode}
    for column, value in equal.items():
        key, dim = next(((k, d) for k, d in dims.items() if d is not None and column in d.columns), (None, None))
        if key is None:
            raise ValueError(f"no dimension has a column {column}")
        fact = fact.join(dim.filter(F.col(column) == value).select(key), key, "left_semi")
    return replace(star, fact=fact.select(*star.fact.columns))


def _lines_by(star: Star, by: str | None) -> tuple[DataFrame, list[str]]:
    """The fact with the column that sets the filter context."""
    if by is None:
        return star.fact, []
    if by == "order_year":
        return star.fact.withColumn(by, F.floor(F.col("order_date_key") / 10000).cast("int")), [by]
    if star.geography is not None and by in star.geography.columns:
        return V._inner(star.fact, star.geography, "geography_key", [by]), [by]
    if star.customer is not None and by in star.customer.columns:
        return V._inner(star.fact, star.customer, "customer_key", [by]), [by]
    raise ValueError(f"cannot set a context by {by}")


def portfolio_segments(star: Star, by: str | None = None) -> DataFrame:
    """X10 per product name: sales, profit, margin and portfolio segment.

    Medians of per-name sales and margin over all names (names with no
    margin, i.e. zero sales, are left out of the margin median); a missing
    margin counts as 0 in the tests. Medians are exact and distributed, and
    margins are compared unrounded; only the margin shown is rounded. With
    ``by`` (order_year or a column of geography or customer) each of its
    values is a filter context with medians of its own."""
    lines, context = _lines_by(star, by)
    per = V._inner(lines, star.product, "product_key", ["product_name"]) \
        .groupBy(*context, "product_name").agg(M.total_sales(), M.total_profit(), M.profit_margin())
    per = materialize(per.withColumn("_exact", exact_margin(F.col("total_profit"), F.col("total_sales"))),
                      "per-product-name")
    per = with_middles(per, {"_s": "total_sales", "_m": "_exact"}, context)
    margin = F.coalesce("_exact", F.lit(0).cast(per.schema["_exact"].dataType))
    big = times(F.col("total_sales"), 2) >= F.col("_s.lo") + F.col("_s.hi")
    good = margin + margin >= F.col("_m.lo") + F.col("_m.hi")
    seg = (F.when(F.col("total_profit") < 0, LOSS_MAKER)
           .when(big & good, STAR_PRODUCT).when(big & ~good, REVENUE_TRAP)
           .when(~big & good, NICHE).otherwise(LOW))
    return per.select(*context, "product_name", "total_sales", "total_profit", "profit_margin",
                      seg.alias("portfolio_segment"))


def portfolio_segment_counts(star: Star) -> DataFrame:
    return (portfolio_segments(star).groupBy("portfolio_segment")
            .agg(F.count(F.lit(1)).alias("products"),
                 F.sum("total_sales").cast(M.SALES_TYPE).alias("total_sales")))


def _ranked(per: DataFrame) -> DataFrame:
    per = materialize(per, "ranked-input")
    return rank_by(rank_by(per, "total_sales", "sales_rank"), "total_profit", "profit_rank", counted=per)


def rank_customers(star: Star) -> DataFrame:
    """X11: customers ranked by sales and by profit (RANK, ties share)."""
    per = star.fact.groupBy("customer_key").agg(M.total_sales(), M.total_profit())
    per = star.customer.select("customer_key", *V.CUSTOMER_ATTRS).join(per, "customer_key")
    return _ranked(per)


def rank_products(star: Star) -> DataFrame:
    """X11: products ranked by sales and by profit."""
    return _ranked(V.product_totals(star))


def rank_regions(star: Star) -> DataFrame:
    """X11: (country, region) ranked by sales and by profit."""
    per = (V._inner(star.fact, star.geography, "geography_key", ["country", "region"])
           .groupBy("country", "region").agg(M.total_sales(), M.total_profit()))
    return _ranked(per)


def loss_concentration(star: Star) -> DataFrame:
    """Loss-making products, worst first, with share of total loss and
    cumulative share (running total per range partition)."""
    per = materialize(V.product_totals(star).where(F.col("total_profit") < 0)
                      .withColumn("loss", (-F.col("total_profit")).cast(M.PROFIT_TYPE)), "loss-products")
    total = per.select(F.sum("loss")).scalar()
    run = running_sum(per, [F.col("loss").desc(), F.col("product_key")], "loss", "cumulative_loss")
    return run.select("product_key", *V.PRODUCT_ATTRS, "total_sales", "total_profit", "loss",
                      ratio(F.col("loss"), total).alias("loss_share"), "cumulative_loss",
                      ratio(F.col("cumulative_loss"), total).alias("cumulative_loss_pct"))


def loss_by_subcategory(star: Star) -> DataFrame:
    """X12 by sub-category: what the loss-making lines of each sub-category
    lose, and its share of all such losses."""
    loss = star.fact.where(F.col("profit") < 0)
    per = (V._inner(loss, star.product, "product_key", ["category", "sub_category"])
           .groupBy("category", "sub_category").agg((-F.sum("profit")).cast(M.PROFIT_TYPE).alias("loss")))
    return _shares(per, ["loss"])


def efficiency_measures(star: Star) -> DataFrame:
    """X13 per segment: sales and profit per customer and per shipping day."""
    j = V._inner(V.shipping_days(star), star.customer, "customer_key", ["customer_id", "segment"])
    days = F.sum("shipping_days")
    return j.groupBy("segment").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        ratio(F.sum("sales"), F.count_distinct("customer_id")).alias("sales_per_customer"),
        ratio(F.sum("profit"), F.count_distinct("customer_id")).alias("profit_per_customer"),
        days.cast("bigint").alias("total_shipping_days"),
        ratio(F.sum("sales"), days).alias("sales_per_shipping_day"),
        ratio(F.sum("profit"), days).alias("profit_per_shipping_day"))


def discounted_vs_full_price(star: Star) -> DataFrame:
    """The aggregate block for discounted and full-price lines."""
    flag = F.when(F.col("discount") > 0, F.lit("Discounted")).otherwise(F.lit("Full Price"))
    return star.fact.withColumn("price_type", flag).groupBy("price_type").agg(*M.block())


# ---- report pages ------------------------------------------------------

def by_region(star: Star) -> DataFrame:
    """Aggregate block by region (re-aggregated from the fact; distinct
    counts do not add up from finer grains)."""
    return (V._inner(star.fact, star.geography, "geography_key", ["region"])
            .groupBy("region").agg(*M.block()))


def by_category(star: Star) -> DataFrame:
    """Aggregate block by category."""
    return (V._inner(star.fact, star.product, "product_key", ["category"])
            .groupBy("category").agg(*M.block()))


def loss_lines_by_subcategory(star: Star) -> DataFrame:
    """R2: loss-making lines by category and sub-category."""
    loss = star.fact.where(F.col("profit") < 0)
    return (V._inner(loss, star.product, "product_key", ["category", "sub_category"])
            .groupBy("category", "sub_category")
            .agg(F.count(F.lit(1)).alias("loss_lines"), M.total_sales(), M.total_profit()))


def top_bottom_customers(star: Star, n: int = 10) -> DataFrame:
    """The n most and n least profitable customers (ties by key)."""
    per = V.customer_profitability(star).select("customer_key", *V.CUSTOMER_ATTRS,
                                                "total_sales", "total_profit")
    top = per.orderBy(F.col("total_profit").desc(), "customer_key").limit(n)
    bottom = per.orderBy(F.col("total_profit").asc(), "customer_key").limit(n)
    return top.withColumn("position", F.lit("Top")).unionByName(bottom.withColumn("position", F.lit("Bottom")))


def _shares(per: DataFrame, cols: list[str]) -> DataFrame:
    out = per
    for c in cols:
        total = per.select(F.sum(c)).scalar()
        out = out.withColumn(f"{c}_share", ratio(F.col(c), total))
    return out


def segment_contribution(star: Star) -> DataFrame:
    """Each segment's sales and profit and their share of the total."""
    per = (V._inner(star.fact, star.customer, "customer_key", ["segment"])
           .groupBy("segment").agg(M.total_sales(), M.total_profit()))
    return _shares(per, ["total_sales", "total_profit"])


def ship_mode_mix(star: Star) -> DataFrame:
    """Lines and sales per ship mode and their shares."""
    per = (V._inner(star.fact, star.ship_mode, "ship_mode_key", ["ship_mode"])
           .groupBy("ship_mode").agg(M.total_order_lines(), M.total_sales()))
    return _shares(per, ["total_order_lines", "total_sales"])


def shipping_day_distribution(star: Star) -> DataFrame:
    """Lines and orders per number of shipping days."""
    return (V.shipping_days(star).groupBy("shipping_days")
            .agg(M.total_order_lines(), M.total_orders(), M.total_sales()))


def delivery_by_geography(star: Star) -> DataFrame:
    """Orders, sales and mean shipping days per country and region."""
    j = V._inner(V.shipping_days(star), star.geography, "geography_key", ["country", "region"])
    return j.groupBy("country", "region").agg(
        M.total_orders(), M.total_sales(), mean(F.col("shipping_days")).alias("avg_shipping_days"))


def high_sales_low_profit(star: Star, by: str | None = None) -> DataFrame:
    """Products selling at or above the median whose profit is negative
    or whose margin is below the median margin, compared unrounded; with
    ``by``, within each context (see :func:`portfolio_segments`)."""
    lines, context = _lines_by(star, by)
    totals = star.product.select("product_key", *V.PRODUCT_ATTRS).join(
        lines.groupBy(*context, "product_key").agg(M.total_sales(), M.total_profit()), "product_key")
    per = materialize(totals.withColumn("profit_margin", ratio(F.col("total_profit"), F.col("total_sales")))
                      .withColumn("_exact", exact_margin(F.col("total_profit"), F.col("total_sales"))),
                      "product-margins")
    columns = [c for c in per.columns if c != "_exact"]
    per = with_middles(per, {"_s": "total_sales", "_m": "_exact"}, context)
    big = times(F.col("total_sales"), 2) >= F.col("_s.lo") + F.col("_s.hi")
    good = F.col("_exact") + F.col("_exact") >= F.col("_m.lo") + F.col("_m.hi")
    return per.where(big & ((F.col("total_profit") < 0) | ~F.coalesce(good, F.lit(False)))).select(*columns)


def margin_by_discount(star: Star) -> DataFrame:
    """Lines, sales, profit and margin per discount level."""
    return star.fact.groupBy("discount").agg(
        M.total_order_lines(), M.total_sales(), M.total_profit(), M.profit_margin())
