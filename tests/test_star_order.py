"""Repeated lines, file order and the single full-width exchange of the star build."""

from pyspark.sql import functions as F

from ledgerline.operators.clean import clean_order_lines, first_rows
from ledgerline.plans.star import build_star, dimensions
from ledgerline.sources.csv_records import POSITION, read_csv_table


def _hot(spark, path):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("x")).cast("string").alias("a"),
        F.lit("y").alias("b"), F.col("id").alias("at"))
    rows.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def test_of_hot_copies_the_first_stays_and_few_rows_are_exchanged(spark, tmp_path):
    df = _hot(spark, str(tmp_path / "t"))
    kept = first_rows(df, ["at"])
    got = kept.collect()
    assert len(got) == 6001 and [r["at"] for r in got if r["k"] == -1] == [0]
    # the rows themselves are not shuffled: their marks were, combined in the map tasks
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_null_and_value_do_not_change_places(spark):
    rows = [("a", None), (None, "a"), ("a", None), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert sorted(map(str, first_rows(df).collect())) == sorted(map(str, df.distinct().collect()))


def test_one_full_width_exchange_in_the_build(spark, tmp_path):
    df = _hot(spark, str(tmp_path / "t")).drop("at")
    plan = first_rows(df).repartitionByRange(4, "k", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan


def test_keys_follow_the_file_not_the_sort_order(spark, tmp_path):
    lines = ["Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,Region,Product ID,Product Name,Category,Sub-Category,Sales,Quantity,Discount,Profit"]
    modes = ["Second Class", "Standard Class", "", "First Class", "Same Day", "Second Class"]
    for i, mode in enumerate(modes * 4):
        lines.append(f'O{99 - i % 6},0{1 + i % 6}-01-2014,05-02-2014,{mode},C{9 - i % 3},"Name\n{i % 3}",S{i % 2},Z,R,P{7 - i % 4},p,c,s,1.5,2,0,0.5')
    (tmp_path / "l.csv").write_text("\n".join(lines) + "\n")
    rows = read_csv_table(spark, str(tmp_path / "l.csv"), positions=True).rows
    star = build_star(clean_order_lines(rows, position=POSITION, dedupe=False), POSITION, dedupe=True)
    by = lambda df, key, col: [r[col] for r in df.orderBy(key).collect()]
    assert by(star.ship_mode, "ship_mode_key", "ship_mode") == ["Second Class", "Standard Class", "First Class", "Same Day"]
    assert by(star.customer, "customer_key", "customer_id") == ["C9", "C8", "C7"]
    assert by(star.customer, "customer_key", "customer_name")[0] == "Name\n0"
    assert by(star.product, "product_key", "product_id") == ["P7", "P6", "P5", "P4"]
    assert by(star.fact, "sales_key", "sales_key") == list(range(1, star.fact.count() + 1))
    assert star.fact.columns[0] == "sales_key" and not set(POSITION) & set(star.fact.columns)
    assert by(star.fact, "sales_key", "order_id")[:6] == ["O99", "O98", "O97", "O96", "O95", "O94"]


def test_dimensions_that_the_lines_do_not_allow_are_left_out(spark):
    lines = spark.createDataFrame([(1, "a", None), (2, "a", "m"), (3, None, "m")], "_row long, product_id string, ship_mode string")
    dims = dimensions(lines)
    assert sorted(dims) == ["product", "ship_mode"]
    assert [tuple(r) for r in dims["product"].orderBy("product_key").collect()] == [("a", 1), (None, 2)]
    assert [tuple(r) for r in dims["ship_mode"].collect()] == [("m", 1)]
    assert dimensions(lines.select("_row")) == {}
    assert dimensions(lines.filter("_row = 1").select("_row", "ship_mode"))["ship_mode"].count() == 0
