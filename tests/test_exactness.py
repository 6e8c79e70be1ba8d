"""Digits kept, dates read, faults found, stars saved."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline import registry as R
from ledgerline.functions.dates import DAY_FIRST, MONTH_FIRST, failed_date, parse_date
from ledgerline.functions.numeric import ratio
from ledgerline.operators.clean import clean_order_lines
from ledgerline.operators.ordered import running_sum
from ledgerline.plans import conflicts as Q
from ledgerline.plans import quality as G
from ledgerline.plans import star as K
from ledgerline.plans import views as V
from ledgerline.plans.star import Star

SF = "/root/testdata/sf0.001"


def test_sales_keep_their_digits(spark):
    raw = spark.createDataFrame(
        [("o1", "1728.122", "0.1"), ("o2", "0.0049", "0.100004"), ("o3", "0.0049", "1e-7"), ("o4", "1e15", "0")],
        "`Order ID` string, Sales string, Discount string")
    lines = clean_order_lines(raw.withColumn("Quantity", F.lit("1")).withColumn("Profit", F.lit("0.00000001")))
    fact = lines.where("order_id <> 'o4'")
    kpi = V.executive_kpis(Star(None, None, None, None, None, fact)).first()
    assert kpi.total_sales == Decimal("1728.1318") and kpi.total_profit == Decimal("0.00000003")
    bands = {r.discount_band: r.total_order_lines for r in V.discount_impact(Star(None, None, None, None, None, lines)).collect()}
    assert bands == {"0-10%": 2, "10-20%": 1, "No Discount": 1}


def test_floating_point_input_is_summed_exactly(spark):
    raw = spark.createDataFrame([("o1", 0.1, 1), ("o2", 0.2, 1), ("o3", 1728.122, 1), ("o4", float("nan"), 1), ("o5", float("inf"), 1)],
                                "order_id string, sales double, quantity int")
    lines = clean_order_lines(raw.withColumns({"profit": F.col("sales").cast("float"), "discount": F.lit(0.1)}))
    assert lines.agg(F.sum("sales")).first()[0] == Decimal("1728.422")
    assert lines.agg(F.sum("profit")).first()[0] == Decimal("1728.422")
    assert lines.where("discount = 0.1").count() == 5 and lines.where("sales is null").count() == 2


def test_running_totals_keep_the_last_digit(spark):
    df = spark.range(40).select("id", F.lit(Decimal("0.00000001")).cast("decimal(38,8)").alias("v"))
    got = {r.id: r.total for r in running_sum(df, ["id"], "v", "total", partitions=4).collect()}
    assert got == {i: Decimal("0.00000001") * (i + 1) for i in range(40)}


def test_ratio_rounds_once(spark):
    cases = [("49999.9999", "1000000000", "0.0000"), ("0.00005", "1", "0.0001"), ("-0.00005", "1", "-0.0001"),
             ("1", "-3", "-0.3333"), ("123456789012.12345678", "3", "41152263004.0412")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b, _ in cases], "n decimal(28,8), d decimal(28,8)")
    assert [r[0] for r in df.select(ratio(F.col("n"), F.col("d"))).collect()] == [Decimal(c) for _, _, c in cases]


def test_date_layouts(spark):
    day = dt.date(2012, 1, 5)
    texts = ["05-01-2012 00:00:00", "5 Jan 2012", "5 January 2012", "2012-01-05T10:20:30", "Jan 5, 2012", "20120105",
             "05/01/2012 1:02:03", "5-Jan-2012", "2012-01-05 10:20"]
    df = spark.createDataFrame([(t,) for t in [*texts, "01/05/2012 3:04:05", "soon", "", None]], "t string")
    got = [r[0] for r in df.select(parse_date(F.col("t"), StringType(), DAY_FIRST)).collect()]
    assert got[:len(texts)] == [day] * len(texts) and got[-3:] == [None, None, None]
    month = [r[0] for r in df.select(parse_date(F.col("t"), StringType(), MONTH_FIRST)).collect()]
    assert month[len(texts)] == day
    assert df.agg(F.count_if(failed_date(F.col("t"), StringType()))).first()[0] == 1


def test_conflicts_read_lines_as_they_come(spark):
    rows = [("P1", "A", "x", "s", "1.5", "1", "02/03/2012")] * 2 + [("P1", "A ", "x", "s", "abc", None, "bad")] \
        + [("P2", "B", "x", "s", "2", "1", "02/03/2012")] * 5 + [(None, "C", "x", "s", "2", "1", None)]
    raw = spark.createDataFrame(rows, "`Product ID` string, `Product Name` string, Category string, `Sub-Category` string, "
                                      "Sales string, Profit string, `Order Date` string")
    assert [tuple(r) for r in Q.conflict_list(raw).collect()] == [("P1", 2, 1)]
    details = {r.product_name: r for r in Q.conflict_details(raw).collect()}
    assert details["A"].number_of_rows == 2 and details["A"].total_sales == 3
    assert details["A"].first_order_date == "2012-02-03"
    assert details["A "].number_of_rows == 1 and details["A "].total_sales == 0 and details["A "].last_order_date == ""


def test_conflict_reports_read_the_lines_once(spark):
    v = Q.variants(R.FX.conflict_order_lines(spark, SF))
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert Q.variants(v) is v


def test_checks_find_faults(spark):
    dirty = R.dirty_star(spark, SF)
    pk = {r.table_name: r for r in G.pk_violations(dirty).collect()}
    assert pk["fact.sales"].duplicated_keys > 0 and pk["dim.customer"].duplicated_keys > 0 and pk["dim.customer"].null_keys > 0
    fk = {r.relationship: r.orphan_rows for r in G.fk_violations(dirty).collect()}
    assert fk["product"] > 0 and fk["customer"] > 0 and fk["geography"] == 0
    assert G.missing_key_counts(dirty).first().missing_customer_key > 0
    plan = G.orphan_counts(dirty)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sales_key") == 0 or plan.count("FileScan parquet") <= 9


def test_samples_take_rows_before_the_joins(spark):
    for fn in (G.join_sample, G.sales_detail_top):
        df = fn(R.star(spark, SF))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        depth = [len(line) - len(line.lstrip(" :+-")) for line in plan.split("\n") if "GlobalLimit" in line]
        assert len(depth) == 2 and "Join" in plan.split("GlobalLimit")[1] and "Join" not in plan.split("GlobalLimit")[2]


def test_segments_do_not_expand(spark):
    plan = V.segment_profitability(R.star(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_star_saved_and_reopened(spark, tmp_path, file_format):
    star = R.star(spark, SF)
    K.write_star(star, str(tmp_path), file_format)
    back = K.read_star(spark, str(tmp_path), star, file_format)
    for name, df in star.tables().items():
        assert back.tables()[name].exceptAll(df).count() == 0 and back.tables()[name].count() == df.count()


def test_views_without_some_dimensions(spark):
    star = replace(R.star(spark, SF), ship_mode=None, geography=None)
    V.register_views(star)
    assert "vw_shipping_performance" not in V.available(star)
    assert star.fact.sparkSession.sql("SELECT * FROM vw_sales_detail").count() == star.fact.count()
    assert {r.relationship for r in G.fk_violations(star).collect()} == {"order_date", "ship_date", "customer", "product"}
    assert G.table_row_counts(star).count() == 4 and G.view_row_counts(star).count() == 10


def test_forgotten_star_is_built_anew(spark):
    from ledgerline.session import materialize
    path = materialize(spark.range(3), "gone").inputFiles()[0]
    old = R.star(spark, SF)
    R.forget(spark)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    assert R.star(spark, SF) is not old and R.star(spark, SF).fact.count() > 0
