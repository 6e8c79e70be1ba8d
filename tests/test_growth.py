"""What keeps time, shuffles and spills of the star build in proportion to its input."""

import datetime
import re

from pyspark.sql import functions as F

from ledgerline import registry, session
from ledgerline.functions.dates import DAY_FIRST, MONTH_FIRST, parse_date, shape
from ledgerline.operators import clean
from ledgerline.plans import star as K
from ledgerline.sources import csv_records, fixtures
from ledgerline.sources.tables import read_csv, write_csv

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _with_conf(spark, name, value, made):
    old = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        return made()
    finally:
        spark.conf.set(name, old)


def test_records_do_not_move_to_meet_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    plan = _with_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1", lambda: _plan(csv_records.read_csv_table(spark, str(tmp_path)).rows))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_marks_are_hashed_and_given_positions_decide(spark, tmp_path, monkeypatch):
    spark.createDataFrame([("a", "f2", 1), ("a", "f10", 7), ("b", "f1", 0), ("a", "f10", 9), (None, "f1", 3)], "v string, file string, line long") \
        .write.parquet(str(tmp_path / "t"))
    plans, write = [], clean.materialize
    monkeypatch.setattr(clean, "materialize", lambda df, label, *how: (plans.append((label, _plan(df))), write(df, label, *how))[1])
    kept = clean.first_rows(spark.read.parquet(str(tmp_path / "t")), ["file", "line"])
    assert sorted(map(tuple, kept.collect()), key=str) == [("a", "f10", 7), ("b", "f1", 0), (None, "f1", 3)]
    assert [label for label, _ in plans] == ["lines", "repeated-rows", "repeated-rows"]  # rows are made once
    assert "SortAggregate" not in plans[1][1]                                            # all rows: by hashing


def test_first_lines_of_keys_are_hashed(spark):
    rows = [(1, "c2", "n1", "s", "m"), (2, "c1", "n2", "s", None), (3, "c2", "n0", "t", "m"), (4, None, "n3", "t", "k"), (5, "c1", None, "s", "k")]
    lines = spark.createDataFrame(rows, "_row long, customer_id string, customer_name string, segment string, ship_mode string")
    first = K._first_lines(lines, K._dimensions(lines))
    above = re.findall(r"(\w+Aggregate)", _plan(first).split("Expand")[0])
    assert above[-2:] == ["HashAggregate", "HashAggregate"]  # those that read the lines; the last two stand nearest to them
    dims = K.dimensions(lines)
    assert [tuple(r) for r in dims["customer"].orderBy("customer_key").collect()] == [("c2", "n1", "s", 1), ("c1", "n2", "s", 2), (None, "n3", "t", 3)]
    assert [tuple(r) for r in dims["ship_mode"].orderBy("ship_mode_key").collect()] == [("m", 1), ("k", 2)]


def test_small_dimensions_are_looked_up_first(spark, monkeypatch):
    asked, look = [], K.lookup_key
    monkeypatch.setattr(K, "lookup_key", lambda f, dim, on, key, null_safe: (asked.append(key), look(f, dim, on, key, null_safe))[1])
    lines = spark.createDataFrame([(1, "c", "p", "z", "r", "m", 1.0)], "_row long, customer_id string, product_id string, country string, region string, ship_mode string, sales double")
    K.fact_sales(lines, *(K.dimensions(lines)[d] for d in ("customer", "product", "geography", "ship_mode")))
    assert asked == ["ship_mode_key", "geography_key", "product_key", "customer_key"]


def test_line_items_meet_their_parts_before_the_wide_orders(spark):
    plan = _with_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1", lambda: _plan(fixtures.joined_tables(spark, SF)))
    assert plan.index("SortMergeJoin [l_orderkey") < plan.index("SortMergeJoin [l_partkey")


def test_file_order_is_written_by_as_many_tasks_as_the_session_has(spark):
    plan = _with_conf(spark, "spark.sql.shuffle.partitions", "37", lambda: _plan(fixtures.order_lines_latest_first(spark, SF)))
    assert re.search(r"rangepartitioning\(.*, 37\)", plan)


def test_date_span_reads_the_lines_once(spark, tmp_path):
    spark.sql("SELECT DATE'2014-01-02' AS order_date, CAST(NULL AS DATE) AS ship_date UNION ALL SELECT DATE'2014-01-02', DATE'2014-01-05' "
              "UNION ALL SELECT NULL, NULL").write.parquet(str(tmp_path / "t"))
    span = K.date_span(spark.read.parquet(str(tmp_path / "t")))
    assert _plan(span).count("FileScan") == 1
    assert [tuple(map(str, r)) for r in span.collect()] == [("2014-01-02", "2014-01-05", "2", "4")]


def test_shapes_refuse_no_text_that_a_layout_takes(spark):
    parts = ["5", "05", "12", "31", "2014", "0005", "-3", "+12014", "Mar", "MARCH", "march", "x", ""]
    texts = [f"{a}{s}{b}{s}{c}" for a in parts for b in parts for c in parts for s in ("-", "/", " ")]
    texts += [f"{d}{t}{h}" for d in ("2014-1-5", "5-1-2014", "5/1/2014", "1/5/2014") for t in (" ", "T", "t", "  ") for h in ("1:2", "01:02:03", "24:00", "1:2:61", "+1:2")]
    texts += ["Mar 5, 2014", "march 05, 2014", "20140105", "020140105", "+20140105", "2014010", "5.1.2014", "2014-1-5 ", "2014-1-5x", "٢٠١٤-١-٥"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    trimmed = F.nullif(F.btrim("t", F.lit(" \t\n\r\x0b\x0c")), F.lit(""))
    for layouts in (DAY_FIRST, MONTH_FIRST):
        plain = F.coalesce(*(F.try_to_date(trimmed, layout) for layout in layouts))
        got = df.select("t", plain.alias("plain"), parse_date(F.col("t"), df.schema["t"].dataType, layouts).alias("guarded"))
        assert got.filter("NOT (plain <=> guarded)").collect() == []
        assert got.filter("plain IS NOT NULL").count() > 50
    assert re.match(shape("yyyy-M-d"), "2014-01-05") and not re.match(shape("d-M-yyyy"), "2014-01-05")


def test_compressed_csv_comes_back_whole(spark, tmp_path):
    df = spark.createDataFrame([("a,\"b\"", "line\nbreak"), (" pad ", None)], "x string, y string").repartition(2)
    write_csv(df, str(tmp_path / "z"), "gzip")
    assert [p.name for p in (tmp_path / "z").glob("*.csv")] == []
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "z")).collect())) == [(" pad ", None), ("a,\"b\"", "line\nbreak")]


LINES = [(2, "c1", "p1", 1.0), (2, "c1", "p1", 1.0), (2, "c2", "p2", 1.0), (1, "c2", "p1", 3.0), (1, "c2", "p1", None), (None, "c3", "p2", 2.0),
         (None, None, "p1", 2.0), (None, "c3", "p2", 2.0), (7, None, "p3", 0.0), (7, "c1", None, 0.0), (7, "c1", None, 0.0), (7, "c1", "p1", 5.0)]


F_DATE = datetime.date(2014, 1, 2)


def _grouped(spark, rows):
    return spark.createDataFrame([(o, c, f"n{c}", p, f"n{p}", F_DATE, s) for o, c, p, s in rows],
                                 "order_id long, customer_id string, customer_name string, product_id string, product_name string, order_date date, sales double")


def test_lines_numbered_in_groups_make_the_same_star(spark):
    lines = _grouped(spark, LINES)
    plain, grouped = K.build_star(lines, dedupe=True), K.build_star(lines, dedupe=True, groups="order_id")
    for name, table in plain.tables().items():
        assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, grouped.tables()[name].select(table.columns).collect()), key=str), name
    assert sorted(r["sales_key"] for r in grouped.fact.collect()) == list(range(1, 10))


def test_products_with_a_repeated_id_are_looked_up_by_all_columns(spark):
    rows = [(1, "c", "n", "p", "x", F_DATE, 1.0), (2, "c", "n", "p", "y", F_DATE, 1.0)]
    star = K.build_star(spark.createDataFrame(rows, _grouped(spark, LINES).schema), dedupe=True, groups="order_id")
    assert sorted((r["order_id"], r["product_key"]) for r in star.fact.collect()) == [(1, 1), (2, 2)]
    assert K._by_id(star.product).columns == star.product.columns
    assert K._by_id(star.product.limit(1)).columns == ["product_id", "product_key"]


def test_wide_lines_do_not_move_after_the_joins(spark, monkeypatch):
    plans, write = [], K.materialize_bucketed
    monkeypatch.setattr(K, "materialize_bucketed", lambda df, *how: (plans.append(_plan(df)), write(df, *how))[1])
    lines = clean.clean_order_lines(fixtures.order_lines(spark, SF), dedupe=False)
    numbered, _ = K.number_groups(lines, "order_id")
    assert len(re.findall(r"Exchange hashpartitioning\((?:l|o)_orderkey", plans[0])) == 2
    assert "Exchange hashpartitioning(order_id" not in plans[0] and "rangepartitioning" not in plans[0]
    assert not re.search(r"Exchange hashpartitioning\(order_id", _plan(numbered))  # the bucketed lines are read in place


def test_an_order_with_very_many_lines_is_seen(spark):
    counts = fixtures.read_table(spark, SF, "lineitem").groupBy("l_orderkey").count().agg({"count": "max"}).first()[0]
    assert counts <= fixtures.largest_order(spark, SF) < 100 * counts


def test_bucketed_rows_leave_no_table_behind(spark):
    before = len(spark.catalog.listTables())
    kept = session.materialize_bucketed(spark.range(100).withColumn("v", F.col("id") % 7), "id", "some-rows", "zstd")
    assert len(spark.catalog.listTables()) == before
    assert kept.groupBy("v").count().count() == 7 and "Exchange" not in _plan(kept.groupBy("id").count())


def _hash_exchanges(plan) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^\n]*)", plan)


def test_raw_lines_stay_where_the_join_has_placed_them(spark):
    for name in ("clean_order_lines", "dedupe_rows", "discount_bands_from_text"):
        for keys in _hash_exchanges(_plan(registry.QUERIES[name](spark, SF))):
            assert "_orderkey" in keys or re.match(r"discount_band#\d+, \d", keys), (name, keys)


def test_rows_without_values_count_once(spark):
    rows = [(None, None), ("a", None), (None, 1), (None, None), ("a", None), ("a", 1)]
    for some in (rows, rows[1:3], rows[:1], []):
        got = clean.dedupe_rows(spark.createDataFrame(some, "v string, n long").toDF("x", "x"))
        assert got.columns == ["x", "x"] and sorted(map(tuple, got.collect()), key=str) == sorted(set(some), key=str)


def test_an_order_with_very_many_raw_lines_is_not_kept_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(registry, "LARGE_ORDER", 1)
    keys = _hash_exchanges(_plan(registry.QUERIES["clean_order_lines"](spark, SF)))
    assert any(k.count("#") >= 20 for k in keys) and not any("cast(o_orderkey" in k for k in keys)  # whole lines are dealt
