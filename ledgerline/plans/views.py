"""The twelve analytics views (V1-V12) as functions of a Star.

Join rules follow the view definitions: V2-V7, V10 and V11 INNER-join their
dimension (NULL or orphan keys drop out), V9 mixes INNER and LEFT, V12 is
all LEFT, V1 and V8 read the fact alone.

Where a view groups by a dimension's primary key (product, customer), the
fact is aggregated on the integer key first and the dimension joined to the
much smaller result ("aggregate before join"): one shuffle of fact rows on
an integer key instead of a join of every fact row with wide attributes.
The key is the dimension's primary key, so this is the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.numeric import mean_truncated, ratio, times
from ..operators.ordered import running_sum
from ..session import materialize
from .star import Star

# Discount bands, upper-inclusive, first match wins; anything
# else (above 0.50, negative, NULL) is '50%+'.
DISCOUNT_BANDS = (("No Discount", None, 0.0), ("0-10%", 0.0, 0.10), ("10-20%", 0.10, 0.20),
                  ("20-30%", 0.20, 0.30), ("30-50%", 0.30, 0.50))
OTHER_BAND = "50%+"
# Labels of the two Pareto groups.
PARETO_TOP = "Top 80% Sales Contributors"
PARETO_REST = "Remaining Products"


def discount_band(col: Column) -> Column:
    band = None
    for label, lo, hi in DISCOUNT_BANDS:
        cond = (col == F.lit(hi)) if lo is None else ((col > F.lit(lo)) & (col <= F.lit(hi)))
        band = F.when(cond, F.lit(label)) if band is None else band.when(cond, F.lit(label))
    return band.otherwise(F.lit(OTHER_BAND))


def _inner(fact: DataFrame, dim: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return fact.join(dim.select(key, *cols), key, "inner")


def executive_kpis(star: Star) -> DataFrame:
    """V1: one row of top-line KPIs."""
    return star.fact.agg(*M.block(lines=True, aov=True))


def monthly_sales_profit(star: Star) -> DataFrame:
    """V2: monthly trend by order month with the month's first day."""
    cal = star.date.select(F.col("date_key").alias("order_date_key"), "year", "month", "month_name")
    return (star.fact.join(cal, "order_date_key", "inner")
            .groupBy("year", "month", "month_name")
            .agg(*M.block(lines=False))
            .select("year", "month", "month_name",
                    F.make_date("year", "month", F.lit(1)).alias("month_start_date"),
                    *[c for c in ("total_orders", "total_sales", "total_profit", "total_quantity",
                                  "avg_discount", "profit_margin")]))


def category_profitability(star: Star) -> DataFrame:
    """V3: by category and sub-category."""
    return (_inner(star.fact, star.product, "product_key", ["category", "sub_category"])
            .groupBy("category", "sub_category").agg(*M.block()))


PRODUCT_ATTRS = ["product_id", "product_name", "category", "sub_category"]
CUSTOMER_ATTRS = ["customer_id", "customer_name", "segment"]


def product_profitability(star: Star) -> DataFrame:
    """V4: one row per product key."""
    per_key = star.fact.groupBy("product_key").agg(*M.block())
    return star.product.select("product_key", *PRODUCT_ATTRS).join(per_key, "product_key", "inner")


def region_performance(star: Star) -> DataFrame:
    """V5: by country, region, state, city (postal codes merge)."""
    geo_cols = [c for c in ("country", "region", "state", "city") if c in star.geography.columns]
    return (_inner(star.fact, star.geography, "geography_key", geo_cols)
            .groupBy(*geo_cols).agg(*M.block()))


def customer_profitability(star: Star) -> DataFrame:
    """V6: one row per customer key, with average order value."""
    per_key = star.fact.groupBy("customer_key").agg(*M.block(aov=True))
    return star.customer.select("customer_key", *CUSTOMER_ATTRS).join(per_key, "customer_key", "inner")


def segment_profitability(star: Star) -> DataFrame:
    """V7: by segment, with distinct customers and average order value."""
    # Two distinct counts in one aggregate would copy every fact row, so the
    # customers are counted from the distinct keys and joined on the segment.
    block = _inner(star.fact, star.customer, "customer_key", ["segment"]).groupBy("segment").agg(*M.block(aov=True))
    buyers = (_inner(star.fact.select("customer_key").distinct(), star.customer, "customer_key",
                     ["customer_id", "segment"])
              .groupBy(F.col("segment").alias("_segment")).agg(F.count_distinct("customer_id").alias("total_customers")))
    return block.join(buyers, block.segment.eqNullSafe(buyers._segment)).drop("_segment")


def discount_impact(star: Star) -> DataFrame:
    """V8: by discount band."""
    return (star.fact.withColumn("discount_band", discount_band(F.col("discount")))
            .groupBy("discount_band").agg(*M.block()))


def shipping_days(star: Star) -> DataFrame:
    """Fact rows with order and ship dates from the calendar (LEFT) and
    shipping_days = ship date − order date (negative when shipped 'before')."""
    od = star.date.select(F.col("date_key").alias("order_date_key"), F.col("date").alias("order_date"))
    sd = star.date.select(F.col("date_key").alias("ship_date_key"), F.col("date").alias("ship_date"))
    return (star.fact.join(od, "order_date_key", "left").join(sd, "ship_date_key", "left")
            .withColumn("shipping_days", F.datediff("ship_date", "order_date")))


def shipping_performance(star: Star) -> DataFrame:
    """V9: by ship mode; mean shipping days truncated toward zero."""
    j = _inner(shipping_days(star), star.ship_mode, "ship_mode_key", ["ship_mode"])
    return j.groupBy("ship_mode").agg(
        M.total_orders(), M.total_order_lines(), M.total_sales(), M.total_profit(),
        M.total_quantity(), mean_truncated("shipping_days").alias("avg_shipping_days"),
        M.profit_margin())


def product_totals(star: Star) -> DataFrame:
    per_key = star.fact.groupBy("product_key").agg(M.total_sales(), M.total_profit())
    return star.product.select("product_key", *PRODUCT_ATTRS).join(per_key, "product_key", "inner")


def product_pareto(star: Star) -> DataFrame:
    """Cumulative share of sales, largest products first.

    The running total is computed per range partition plus partition
    offsets (no single-partition window); the grand total is a scalar
    subquery. Ties in sales are broken by product_key. A product is in the
    top group while cumulative / grand <= 0.80, tested exactly as
    5 * cumulative <= 4 * grand (grand > 0)."""
    # Written once: the grand total and the running total both read this
    # product-level table instead of aggregating the fact twice.
    totals = materialize(product_totals(star), "product-totals")
    grand = totals.select(F.sum("total_sales")).scalar()
    run = running_sum(totals, [F.col("total_sales").desc_nulls_last(), F.col("product_key")],
                      "total_sales", "cumulative_sales")
    cum = F.col("cumulative_sales")
    top = (((grand > 0) & (times(cum, 5) <= times(grand, 4)))
           | ((grand < 0) & (times(cum, 5) >= times(grand, 4))))
    return run.select(
        "product_key", *PRODUCT_ATTRS, "total_sales", "total_profit",
        ratio(F.col("total_profit"), F.col("total_sales")).alias("profit_margin"),
        ratio(cum, grand).alias("cumulative_sales_pct"),
        F.when(top, F.lit(PARETO_TOP)).otherwise(F.lit(PARETO_REST)).alias("pareto_group"))


def loss_making_products(star: Star) -> DataFrame:
    """Products whose total profit is negative."""
    per_key = (star.fact.groupBy("product_key")
               .agg(M.total_orders(), M.total_sales(), M.total_profit(), M.total_quantity(),
                    M.avg_discount(), M.profit_margin())
               .where(F.col("total_profit") < 0))
    return star.product.select("product_key", *PRODUCT_ATTRS).join(per_key, "product_key", "inner")


# Columns of the detail view, in order.
SALES_DETAIL_COLUMNS = (
    "sales_key", "order_id", "order_date", "order_year", "order_quarter", "order_month",
    "order_month_name", "ship_date", "shipping_days", "customer_id", "customer_name", "segment",
    "product_id", "product_name", "category", "sub_category", "country", "region", "state",
    "city", "ship_mode", "sales", "quantity", "discount", "profit", "profit_margin")


def sales_detail(star: Star) -> DataFrame:
    """The fact with every dimension attribute (all LEFT joins)."""
    od = star.date.select(F.col("date_key").alias("order_date_key"), F.col("date").alias("order_date"),
                          F.col("year").alias("order_year"), F.col("quarter").alias("order_quarter"),
                          F.col("month").alias("order_month"), F.col("month_name").alias("order_month_name"))
    sd = star.date.select(F.col("date_key").alias("ship_date_key"), F.col("date").alias("ship_date"))
    f = star.fact.join(od, "order_date_key", "left").join(sd, "ship_date_key", "left")
    for dim, key, attrs in ((star.customer, "customer_key", CUSTOMER_ATTRS), (star.product, "product_key", PRODUCT_ATTRS),
                            (star.geography, "geography_key", None), (star.ship_mode, "ship_mode_key", None)):
        if dim is not None and key in f.columns:
            f = f.join(dim.select(key, *[c for c in attrs if c in dim.columns]) if attrs else dim, key, "left")
    cols = []
    for c in SALES_DETAIL_COLUMNS:
        if c == "shipping_days":
            cols.append(F.datediff("ship_date", "order_date").alias(c))
        elif c == "profit_margin":
            cols.append(ratio(F.col("profit"), F.col("sales")).alias(c))
        elif c in f.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))  # absent optional column
    return f.select(*cols)


VIEWS = {
    "vw_executive_kpis": executive_kpis,
    "vw_monthly_sales_profit": monthly_sales_profit,
    "vw_category_profitability": category_profitability,
    "vw_product_profitability": product_profitability,
    "vw_region_performance": region_performance,
    "vw_customer_profitability": customer_profitability,
    "vw_segment_profitability": segment_profitability,
    "vw_discount_impact": discount_impact,
    "vw_shipping_performance": shipping_performance,
    "vw_product_pareto": product_pareto,
    "vw_loss_making_products": loss_making_products,
    "vw_sales_detail": sales_detail,
}


# The dimension that a view cannot do without.
NEEDS = {
    "vw_category_profitability": "product", "vw_product_profitability": "product",
    "vw_region_performance": "geography", "vw_customer_profitability": "customer",
    "vw_segment_profitability": "customer", "vw_shipping_performance": "ship_mode",
    "vw_product_pareto": "product", "vw_loss_making_products": "product",
}


def available(star: Star) -> dict:
    """The views whose dimension the star has."""
    return {name: fn for name, fn in VIEWS.items() if getattr(star, NEEDS.get(name, "fact")) is not None}


def register_views(star: Star) -> None:
    """createOrReplaceTempView for the star tables and the views whose
    dimension is there. All but the Pareto view are lazy; that one is
    computed now, as its running total is written in range partitions."""
    star.register_views()
    for name, fn in available(star).items():
        fn(star).createOrReplaceTempView(name)
