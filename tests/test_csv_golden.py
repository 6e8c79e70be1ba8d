"""CSV hazards and the conflict summary on values copied from the sample
outputs of the original report (golden shape)."""

import datetime as dt
from decimal import Decimal

from ledgerline.plans import conflicts as Q
from ledgerline.sources.tables import read_csv

# Sample conflict-detail rows of the original report (CRLF,
# quoted commas, a doubled quote inside a quoted name).
DETAILS_CSV = "\r\n".join([
    "product_id,product_name,category,sub_category,number_of_rows,total_sales,total_profit,first_order_date,last_order_date",
    'FUR-CH-10003354,"Harbour Creations Swivel Stool, Red",Furniture,Chairs,17,6340.224,1309.884,2011-02-26,2014-10-22',
    'FUR-CH-10003354,"Novimex Bag Chairs, Black",Furniture,Chairs,11,1844.3661,-181.8039,2011-02-10,2014-11-26',
    'OFF-AR-10003651,"Sanford Pencil Sharpener, Easy-Erase",Office Supplies,Art,19,2289.105,1028.025,2011-06-22,2014-12-03',
    'OFF-AR-10003651,"Sanford Pens, Easy-Erase",Office Supplies,Art,10,528.705,90.705,2011-03-31,2014-10-24',
    "OFF-AR-10003651,Newell 350,Office Supplies,Art,6,62.32,15.744000000000002,2011-05-05,2014-11-01",
    'OFF-BI-10002799,"SlimView Poly Binder, 3/8""",Office Supplies,Binders,7,117.586,5.697999999999999,2011-08-24,2014-10-22',
]) + "\r\n"


def test_csv_quotes_and_crlf(spark, tmp_path):
    path = tmp_path / "details.csv"
    path.write_bytes(DETAILS_CSV.encode("utf-8"))
    df = read_csv(spark, str(path), list(Q.DETAIL_COLUMNS))
    names = {r.product_name for r in df.collect()}
    assert "Harbour Creations Swivel Stool, Red" in names
    assert 'SlimView Poly Binder, 3/8"' in names
    assert all(not r.last_order_date.endswith("\r") for r in df.collect())


def test_conflict_summary_matches_sample_totals(spark, tmp_path):
    path = tmp_path / "details.csv"
    path.write_bytes(DETAILS_CSV.encode("utf-8"))
    details = Q.details_from_text(read_csv(spark, str(path), list(Q.DETAIL_COLUMNS)))
    got = {r.product_id: r for r in Q.conflict_summary(details).collect()}
    a = got["OFF-AR-10003651"]
    assert (a.total_rows, a.total_sales, a.total_profit) == (35, Decimal("2880.13"), Decimal("1134.474"))
    assert (a.first_order_date, a.last_order_date) == (dt.date(2011, 3, 31), dt.date(2014, 12, 3))
    f = got["FUR-CH-10003354"]
    assert (f.total_rows, f.total_sales, f.profit_abs) == (28, Decimal("8184.5901"), Decimal("1128.0801"))
    assert (f.first_order_date, f.last_order_date) == (dt.date(2011, 2, 10), dt.date(2014, 11, 26))
    by_rows = [r.product_id for r in Q.top_conflicts_by_rows(Q.conflict_summary(details)).collect()]
    assert by_rows == ["OFF-AR-10003651", "FUR-CH-10003354", "OFF-BI-10002799"]
