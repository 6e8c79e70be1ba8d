import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions.dates import DAY_FIRST, MONTH_FIRST, parse_date
from ledgerline.functions.names import snake_case
from ledgerline.functions.numeric import ratio
from ledgerline.plans.views import discount_band


def test_snake_case_rule():
    assert snake_case(" Order ID ") == "order_id"
    assert snake_case("Sub-Category") == "sub_category"
    assert snake_case("a - b") == "a__b"          # one non-overlapping pass of "__" → "_"
    assert snake_case("Margin %") == "margin__pct"  # "%" replaced after the "__" pass
    assert snake_case("Ship  Mode") == "ship_mode"


def test_day_first_and_month_first_differ(spark):
    df = spark.createDataFrame([("03-04-2012",), (" 13/02/2013 ",), ("bad",), (None,), ("",)], "t string")
    got = df.select(parse_date(F.col("t"), StringType(), DAY_FIRST).alias("d"),
                    parse_date(F.col("t"), StringType(), MONTH_FIRST).alias("m")).collect()
    assert got[0] == (dt.date(2012, 4, 3), dt.date(2012, 3, 4))
    assert got[1].d == dt.date(2013, 2, 13) and got[1].m is None
    assert [r.d for r in got[2:]] == [None, None, None]


def test_ratio_rounds_half_away_from_zero_and_guards_zero(spark):
    df = spark.createDataFrame([(Decimal("1.00005"), Decimal("1")), (Decimal("-1.00005"), Decimal("1")),
                                (Decimal("5"), Decimal("0")), (Decimal("1"), None)],
                               "n decimal(10,5), d decimal(10,0)")
    got = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("1.0001"), Decimal("-1.0001"), None, None]


def test_discount_bands_edges(spark):
    vals = [0.0, 0.05, 0.10, 0.1000001, 0.30, 0.50, 0.51, -0.05, None]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(discount_band(F.col("d"))).collect()]
    assert got == ["No Discount", "0-10%", "0-10%", "10-20%", "20-30%", "30-50%", "50%+", "50%+", "50%+"]
