"""Cross-checks between tables and views of one star (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline import registry as R
from ledgerline.plans import views as V

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_view_totals_reconcile_with_kpis(spark):
    star = R.star(spark, SF)
    total = V.executive_kpis(star).first().total_sales
    for fn in (V.category_profitability, V.product_profitability, V.region_performance,
               V.customer_profitability, V.segment_profitability, V.discount_impact,
               V.shipping_performance, V.monthly_sales_profit):
        assert fn(star).agg(F.sum("total_sales")).first()[0] == total, fn.__name__
    pareto = V.product_pareto(star)
    assert pareto.agg(F.max("cumulative_sales_pct")).first()[0] == 1


def test_keys_dense_and_counts_consistent(spark):
    star = R.star(spark, SF)
    assert star.fact.count() == R.order_lines(spark, SF).count()
    for df, key in ((star.fact, "sales_key"), (star.customer, "customer_key"),
                    (star.product, "product_key"), (star.geography, "geography_key"),
                    (star.ship_mode, "ship_mode_key")):
        n = df.count()
        assert df.agg(F.min(key), F.max(key), F.count_distinct(key)).first() == (1, n, n), key
    span = star.date.agg(F.datediff(F.max("date"), F.min("date")) + 1).first()[0]
    assert star.date.count() == span
