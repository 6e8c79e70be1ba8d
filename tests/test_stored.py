"""Stored tables and views, and measures that roll up."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerline import registry as R
from ledgerline.plans import measures as X
from ledgerline.plans import rollup as U
from ledgerline.plans import stored as D
from ledgerline.plans import views as V
from ledgerline.session import scratch_path

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def shop(spark):
    """A small star with faults: NULL and orphan keys, zero and negative sales, equal sales."""
    st = R.dirty_star(spark, SF)
    fact = st.fact.where("product_key < 60 OR product_key IS NULL OR product_key > 1000000000")
    even = F.when(F.col("product_key") % 7 == 0, F.col("product_key") * 0 + 5).when(F.col("product_key") % 11 == 0, -F.col("sales"))
    return replace(st, fact=fact.withColumn("sales", F.coalesce(even.cast(fact.schema["sales"].dataType), "sales")))


@pytest.fixture(scope="module")
def stored_names(spark, shop):
    return D.store_star(shop, "stored_test", scratch_path(spark, "stored-test"), buckets=4)


def test_another_session_opens_every_view(spark, shop, stored_names):
    other = spark.newSession()
    for name, view in V.VIEWS.items():
        got, want = other.table(f"stored_test.{name}"), view(shop)
        assert sorted(got.columns) == sorted(want.columns), name
        assert rows(got) == rows(want), name
    again = D.stored_star(other, "stored_test")
    assert rows(again.fact) == rows(shop.fact) and rows(again.product) == rows(shop.product)


def test_no_exchange_of_the_fact_by_product_key(spark, stored_names):
    view = spark.table("stored_test.vw_loss_making_products")
    view.collect()
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
    per = spark.table("stored_test.fact_sales").groupBy("product_key").agg(F.sum("sales"))
    per.collect()
    assert "Exchange" not in per._jdf.queryExecution().executedPlan().toString()


def test_a_hot_product_is_written_in_ranges(spark, shop):
    hot = replace(shop, fact=spark.range(4000).select(
        F.col("id").alias("sales_key"), F.col("id").alias("order_id"), F.lit(20200101).alias("order_date_key"), F.lit(20200101).alias("ship_date_key"),
        F.lit(1).alias("customer_key"), F.when(F.col("id") % 8 > 0, 7).otherwise(F.col("id")).alias("product_key"), F.lit(1).alias("geography_key"),
        F.lit(1).alias("ship_mode_key"), *(F.lit(1).cast("decimal(12,2)").alias(c) for c in ("sales", "quantity", "discount", "profit"))))
    assert D.largest_bucket(hot.fact, "product_key", 8) > 4 and D.largest_bucket(hot.fact.limit(0), "product_key", 8) == 0
    names = D.store_star(hot, "stored_hot", scratch_path(spark, "stored-hot"), buckets=8)
    fact = spark.table(names["fact_sales"])
    assert "Bucketed: true" not in fact._jdf.queryExecution().executedPlan().toString()
    sizes = [r[0] for r in fact.groupBy(F.input_file_name()).count().select("count").collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1000
    assert rows(spark.table("stored_hot.vw_product_profitability")) == rows(V.product_profitability(hot))


def test_a_new_load_replaces_the_views(spark, shop):
    first = D.store_star(shop, "stored_twice", scratch_path(spark, "stored-twice"), buckets=2)
    began = spark.table("stored_twice.vw_executive_kpis")
    before = rows(began)
    less = replace(shop, fact=shop.fact.limit(0), ship_mode=None)
    second = D.store_star(less, "stored_twice", scratch_path(spark, "stored-twice"), buckets=2)
    assert rows(began) == before                                 # a reader that has begun keeps its load
    assert spark.table("stored_twice.vw_executive_kpis").first().total_order_lines == 0
    assert not spark.catalog.tableExists("stored_twice.vw_shipping_performance")
    assert spark.table("stored_twice.vw_product_pareto").count() == 0
    D.drop_old_loads(spark, "stored_twice", second)
    assert not spark.catalog.tableExists(first["fact_sales"]) and spark.catalog.tableExists(second["fact_sales"])


def test_distinct_orders_roll_up(spark, shop):
    shop = replace(shop, customer=shop.customer.dropDuplicates(["customer_key"]), fact=shop.fact.withColumn("order_id", F.when(F.col("sales_key") % 5 > 0, F.col("order_id"))))
    cells = U.written_cells(shop)
    assert rows(U.roll_up(cells, "region")) == rows(X.by_region(shop))
    assert rows(U.roll_up(cells, "category")) == rows(X.by_category(shop))
    assert rows(U.roll_up(cells, aov=True)) == rows(V.executive_kpis(shop))
    by_segment = V.segment_profitability(shop).drop("total_customers")
    assert rows(U.roll_up(cells, "segment", aov=True)) == rows(by_segment)
    both = U.roll_up(cells, "region", "segment")
    assert {r.total_orders for r in both.collect()} != {0} and both.agg(F.sum("total_orders")).first()[0] >= 1
    empty = U.sales_cells(replace(shop, fact=shop.fact.limit(0)))
    assert U.roll_up(empty, "region").count() == 0 and U.roll_up(empty).first().total_orders == 0


def test_many_orders_cross_bitmap_blocks(spark, shop):
    fact = spark.range(200_000).select(
        F.concat(F.lit("o"), F.col("id") % 70_000).alias("order_id"), F.lit(1).cast("bigint").alias("geography_key"),
        *(F.lit(1).cast("decimal(12,2)").alias(c) for c in ("sales", "quantity", "discount", "profit")))
    cells = U.sales_cells(replace(shop, fact=fact), by=["region"])
    assert U.roll_up(cells).first().total_orders == 70_000


def test_packed_attributes_equal_a_join(spark, monkeypatch):
    monkeypatch.setattr(U, "SMALL", 0)
    dim = spark.range(1, 140_001).select(F.col("id").alias("k"), F.expr("nullif(concat('a', id % 5), 'a4')").alias("a"), F.expr("id % 3").alias("b"))
    lines = spark.range(0, 150_000, 7).select(F.expr("CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN -id WHEN id % 17 = 0 THEN id + 1000000000 ELSE id END").alias("k"), "id")
    odd = {"whole": dim, "gap": dim.where("k <> 70000"), "repeat": dim.union(dim.where("k = 65536")), "gap and repeat": dim.withColumn("k", F.expr("CASE WHEN k = 9 THEN 8 ELSE k END")),
           "no key": dim.union(dim.limit(1).withColumn("k", F.lit(None).cast("long"))), "ints": dim.withColumn("k", F.col("k").cast("int")),
           "texts": dim.withColumn("k", F.col("k").cast("string")), "many values": dim.withColumn("a", F.expr("concat('a', k % 200)")), "empty": dim.limit(0)}
    for name, d in odd.items():
        plain = lines.join(d.select("k", "a", "b", F.lit(True).alias("f")), "k", "left").withColumn("f", F.coalesce("f", F.lit(False)))
        got = U.with_attributes(lines, d, "k", ["a", "b"], "f")
        assert got.exceptAll(plain.select(got.columns)).count() == 0 and got.count() == plain.count(), name
        assert (U._packed(d, "k", ["a", "b"]) is not None) == (name in ("whole", "no key", "ints")), name


def test_roll_ups_with_packed_dimensions_do_not_move_the_lines_for_them(spark, shop, monkeypatch):
    shop = replace(shop, customer=R.star(spark, SF).customer, product=R.star(spark, SF).product)
    monkeypatch.setattr(U, "SMALL", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = U.sales_cells(shop)
        plan = cells._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [product_key" not in plan and "SortMergeJoin [customer_key" not in plan
        packed = rows(U.roll_up(cells, "region")), rows(U.roll_up(cells, "category")), rows(U.roll_up(cells, "segment", aov=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert packed == (rows(X.by_region(shop)), rows(X.by_category(shop)), rows(V.segment_profitability(shop).drop("total_customers")))


def test_the_detail_view_moves_the_fact_for_customers_only(spark, stored_names):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = spark.table("stored_test.vw_sales_detail")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = re.findall(r"SortMergeJoin \[(\w+)#", text)
    assert joins[-2:] == ["customer_key", "product_key"]  # the lowest come last: the stored layout serves products
