import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean as C
from ledgerline.plans import conflicts as Q
from ledgerline.plans import star as K
from ledgerline.plans import views as V

D = dt.date
COLS = ("order_id string, order_date date, ship_date date, ship_mode string, customer_id string, "
        "customer_name string, segment string, country string, region string, postal_code string, "
        "product_id string, product_name string, category string, sub_category string, "
        "sales decimal(18,2), quantity bigint, discount decimal(4,2), profit decimal(22,4)")


def _lines(spark):
    rows = [
        ("o1", D(2012, 1, 5), D(2012, 1, 9), "Second", "c2", "Bo", "Corp", "US", "East", None,
         "p1", "Chair", "Furniture", "Chairs", Decimal("100.00"), 2, Decimal("0.00"), Decimal("20.0000")),
        ("o1", D(2012, 1, 5), D(2012, 1, 3), "Second", "c1", "Al", "Home", "US", "East", "10001",
         "p2", "Desk", "Furniture", "Tables", Decimal("50.00"), 1, Decimal("0.30"), Decimal("-5.0000")),
        ("o2", D(2012, 1, 7), None, None, None, "Nobody", "Home", "US", "East", None,
         "p1", "Chair v2", "Furniture", "Chairs", Decimal("0.00"), 1, None, Decimal("0.0000")),
    ]
    return spark.createDataFrame(rows, COLS)


def test_star_keys_follow_first_appearance_and_match_nulls(spark):
    star = K.build_star(_lines(spark))
    cust = {r.customer_id: r.customer_key for r in star.customer.collect()}
    # first appearance under the default row order (all columns, NULLs first): o1/c1 row, o1/c2 row, o2
    assert cust == {"c1": 1, "c2": 2, None: 3}
    fact = star.fact.orderBy("sales_key").collect()
    assert [r.sales_key for r in fact] == [1, 2, 3]
    assert all(r.customer_key is not None for r in fact)       # NULL id matched its own dim row
    assert all(r.geography_key is not None for r in fact)      # NULL postal code matched (null-safe)
    assert fact[2].ship_mode_key is None                        # NULL ship mode has no dim row
    assert star.product.count() == 3                           # p1 owns two keys (name conflict)
    assert star.date.count() == 7 and star.date.agg(F.min("date")).first()[0] == D(2012, 1, 3)


def test_calendar_columns(spark):
    star = K.build_star(_lines(spark), write=False)
    r = star.date.where(F.col("date") == D(2012, 1, 5)).first()
    assert (r.date_key, r.year, r.quarter, r.month, r.month_name, r.day, r.weekday) == \
        (20120105, 2012, "2012Q1", 1, "January", 5, "Thursday")


def test_calendar_needs_dates(spark):
    no_dates = _lines(spark).drop("order_date", "ship_date")
    with pytest.raises(ValueError):
        K.dim_date(no_dates)
    all_null = _lines(spark).withColumn("order_date", F.lit(None).cast("date")).withColumn(
        "ship_date", F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        K.dim_date(all_null)


def test_views_on_tiny_star(spark):
    star = K.build_star(_lines(spark))
    kpi = V.executive_kpis(star).first()
    assert (kpi.total_orders, kpi.total_order_lines, kpi.total_sales) == (2, 3, Decimal("150.00"))
    assert kpi.profit_margin == Decimal("0.1000")
    ship = {r.ship_mode: r.avg_shipping_days for r in V.shipping_performance(star).collect()}
    assert ship == {"Second": 1}                 # (4 + -2) div 2; NULL ship mode drops out
    pareto = V.product_pareto(star).orderBy("cumulative_sales_pct").collect()
    assert pareto[-1].cumulative_sales_pct == Decimal("1.0000")
    groups = [r.pareto_group for r in pareto]
    assert groups == ["Top 80% Sales Contributors", "Remaining Products", "Remaining Products"]  # 100/150, then 1
    loss = V.loss_making_products(star).collect()
    assert [r.product_id for r in loss] == ["p2"]


def test_cleaning_steps(spark):
    raw = spark.createDataFrame(
        [(" o1 ", "05-01-2012", "\tChair ", "12.50", "2.7", "0.1"),
         (" o1 ", "05-01-2012", "\tChair ", "12.50", "2.7", "0.1"),
         (None, None, None, None, None, None),
         ("o2", "bad", "Desk", "abc", "x", "NaN")],
        "`Order ID` string, `Order Date` string, `Product Name` string, Sales string, Quantity string, `Discount` string")
    got = C.clean_order_lines(raw).orderBy("order_id").collect()
    assert len(got) == 2
    assert got[0].order_id == "o1" and got[0].order_date == D(2012, 1, 5) and got[0].product_name == "Chair"
    assert got[0].sales == Decimal("12.5000") and got[0].quantity == 2
    assert got[1].order_date is None and got[1].sales is None and got[1].quantity == 0 and got[1].discount is None


def test_conflict_reports(spark):
    rows = [("P1", "A", "x", "s", 1.0, 1.0, D(2012, 1, 1)), ("P1", "B", "x", "s", 2.0, -3.0, D(2012, 2, 1)),
            ("P1", "B", "x", "s", 2.0, -3.0, D(2012, 3, 1)), ("P2", "C", "x", "s", 5.0, 1.0, None),
            ("P3", "D", "x", "s", 1.0, 1.0, D(2012, 1, 1)), ("P3", "D", "y", "s", 1.0, 1.0, None)]
    lines = spark.createDataFrame(rows, "product_id string, product_name string, category string, "
                                        "sub_category string, sales double, profit double, order_date date")
    assert {r.product_id for r in Q.conflicts(lines).collect()} == {"P1", "P3"}
    top = Q.top_conflict_ids(lines).collect()
    assert [(r.product_id, r.total_rows) for r in top] == [("P1", 3), ("P3", 2)]
    details = Q.conflict_details(lines)
    p3 = {r.category: r.last_order_date for r in details.where("product_id = 'P3'").collect()}
    assert p3 == {"x": "2012-01-01", "y": ""}
    summary = {r.product_id: r for r in Q.conflict_summary(details).collect()}
    assert summary["P1"].total_rows == 3 and summary["P1"].profit_abs == Decimal("5.0000")
    assert summary["P1"].last_order_date == D(2012, 3, 1)


def test_optional_columns_and_fallbacks(spark):
    # no geography, no customer, no ship mode: those keys are simply absent
    lines = _lines(spark).drop("country", "region", "postal_code", "customer_id", "customer_name",
                               "segment", "ship_mode")
    star = K.build_star(lines, write=False)
    assert star.customer is None and star.geography is None and star.ship_mode is None
    assert star.fact.columns == ["sales_key", "order_id", "order_date_key", "ship_date_key",
                                 "product_key", "sales", "quantity", "discount", "profit"]
    # no key and no measure column at all: the fact keeps every column
    bare = spark.createDataFrame([(1, "x")], "_row bigint, note string")
    fact = K.fact_sales(bare, None, None, None, None)
    assert fact.columns == ["sales_key", "note"]


def test_conflict_report_guards(spark):
    # no product attribute columns: an empty result, not an error (C14)
    no_attrs = spark.createDataFrame([("P1", 1.0)], "product_id string, sales double")
    assert Q.conflicts(no_attrs).count() == 0
    # no sales/profit/date: NULL totals and NULL dates, never a row count in their place (Q7)
    lines = spark.createDataFrame([("P1", "A"), ("P1", "B")], "product_id string, product_name string")
    d = Q.conflict_details(lines).collect()
    assert len(d) == 2 and all(r.total_sales is None and r.first_order_date is None for r in d)
