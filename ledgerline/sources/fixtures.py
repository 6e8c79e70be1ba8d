"""Order lines derived from the driver tables (the input of the pipeline).

The driver ships TPC-H-like tables, not the flat order-line file the
pipeline is meant for. These functions derive one deterministically: every
line item becomes one order line, with its order, customer, nation, region
and part. Column expressions are plain SQL, identical in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# The flat order-line columns and their SQL expressions over
# the joined driver tables, in file order.
ORDER_LINE_COLUMNS = (
    ("order_id", "o_orderkey"),
    ("order_date", "CAST(o_orderdate AS DATE)"),
    ("ship_date", "CAST(l_shipdate AS DATE)"),
    ("ship_mode", "o_orderpriority"),
    ("customer_id", "c_custkey"),
    ("customer_name", "c_name"),
    ("segment", "c_mktsegment"),
    ("country", "n_name"),
    ("region", "r_name"),
    ("postal_code", "CASE WHEN n_regionkey = 1 THEN c_custkey % 100 END"),
    ("product_id", "p_partkey"),
    ("product_name", "p_name"),
    ("category", "p_type"),
    ("sub_category", "p_brand"),
    ("sales", "CAST(l_extendedprice AS DECIMAL(18,2))"),
    ("quantity", "CAST(l_quantity AS BIGINT)"),
    ("discount", "CAST(CAST(l_discount AS DECIMAL(4,2))*6 AS DECIMAL(4,2))"),
    ("profit", "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(CAST(0.3 AS DECIMAL(4,2)) "
               "+ CAST((p_size % 4) AS DECIMAL(4,2))*CAST(0.1 AS DECIMAL(4,2)) "
               "- CAST(l_discount AS DECIMAL(4,2))*6 AS DECIMAL(4,2)) AS DECIMAL(22,4))"),
)

# A product code shared by several parts: the input of the identifier-conflict reports.
PRODUCT_CODE = "p_brand || '-' || CAST(p_size AS VARCHAR(10))"

ORDER_LINE_NAMES = tuple(name for name, _ in ORDER_LINE_COLUMNS)


def joined_tables(spark: SparkSession, sf_dir: str, order: Callable[[Column], Column] = lambda key: key) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part (inner).

    Line items and orders are both fact-sized, so they are joined by a
    shuffle on the order key (the ``merge`` hint), never broadcast; AQE
    splits a skewed order key. The other joins are left to Spark's size
    check: nation and region broadcast, customer and part broadcast while
    their files are small and sort-merge join beyond that. The orders meet
    their customers and the bare line items their parts first, so the columns
    of orders and customers cross no exchange once for each line.

    ``order`` is the form of the order key, one to one, in which the lines
    show it: the join places them by that, so that what groups lines by a set
    of columns with this one need not move them again."""
    t = lambda n: read_table(spark, sf_dir, n)
    buyers = (t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return (t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(buyers.hint("merge"), order(F.col("l_orderkey")) == order(F.col("o_orderkey"))))


def order_lines(spark: SparkSession, sf_dir: str, product_id: str = "p_partkey") -> DataFrame:
    """Flat, typed order lines (one per line item)."""
    exprs = [f"{product_id if name == 'product_id' else expr} AS {name}"
             for name, expr in ORDER_LINE_COLUMNS]
    return joined_tables(spark, sf_dir).selectExpr(*exprs)


def largest_order(spark: SparkSession, sf_dir: str, slots: int = 1 << 16) -> int:
    """No order has more line items than this: those of the fullest of the
    slots that the order keys hash to. At most ``slots`` rows a task move."""
    slot = F.pmod(F.hash("l_orderkey"), F.lit(slots)).alias("slot")
    counts = read_table(spark, sf_dir, "lineitem").groupBy(slot).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def conflict_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text lines keyed by a product code that several parts share: dates
    month first with every 50th 'bad', names of second lines padded by a
    space, every 40th sales value 'abc', and a second copy of every line
    whose order key ends in 0."""
    expr = dict(ORDER_LINE_COLUMNS)
    lines = joined_tables(spark, sf_dir).selectExpr(
        "explode(CASE WHEN l_orderkey % 10 = 0 THEN array(1, 2) ELSE array(1) END) AS copy", f"{PRODUCT_CODE} AS `Product ID`",
        "CASE WHEN l_linenumber = 2 THEN p_name || ' ' ELSE p_name END AS `Product Name`",
        "p_type AS `Category`", "p_brand AS `Sub-Category`",
        "CASE WHEN o_orderkey % 50 = 0 THEN 'bad' ELSE date_format(o_orderdate, 'MM/dd/yyyy') END AS `Order Date`",
        f"CASE WHEN (l_orderkey + l_linenumber) % 40 = 0 THEN 'abc' ELSE CAST({expr['sales']} AS STRING) END AS `Sales`",
        f"CAST({expr['profit']} AS STRING) AS `Profit`")
    return lines.drop("copy")


def raw_order_lines(spark: SparkSession, sf_dir: str, order: Callable[[Column], Column] = lambda key: key) -> DataFrame:
    """Order lines as raw text, the way a CSV export delivers them.

    Dirt, all deterministic: day-first date text with every 50th order date
    'bad'; product names padded with a tab and spaces; every 40th sales value
    'abc', every seventh with five decimals; every eleventh discount just over
    a band's end; every third quantity with a '.7' fraction; all-NULL rows (one per
    100 orders); a second copy of every line whose order key ends in 0. For
    ``order`` see :func:`joined_tables`."""
    j = joined_tables(spark, sf_dir, order)
    s = lambda c: F.col(c).cast("string")
    day_first = lambda c: F.date_format(F.col(c), "dd-MM-yyyy")
    line = F.col("l_orderkey") + F.col("l_linenumber")
    price = F.expr("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)")
    sales = F.when(line % 7 == 0, F.concat(price, F.lit("049"))).otherwise(price)
    rate = F.expr("CAST(CAST(CAST(l_discount AS DECIMAL(4,2))*6 AS DECIMAL(4,2)) AS STRING)")
    cols = {
        "Order ID": s("o_orderkey"),
        "Order Date": F.when(F.col("o_orderkey") % 50 == 0, F.lit("bad")).otherwise(day_first("o_orderdate")),
        "Ship Date": day_first("l_shipdate"),
        "Ship Mode": F.col("o_orderpriority"),
        "Customer ID": s("c_custkey"),
        "Customer Name": F.col("c_name"),
        "Segment": F.col("c_mktsegment"),
        "Country": F.col("n_name"),
        "Region": F.col("r_name"),
        "Postal Code": F.expr("CAST(CASE WHEN n_regionkey = 1 THEN c_custkey % 100 END AS STRING)"),
        "Product ID": s("p_partkey"),
        "Product Name": F.concat(F.lit("\t "), F.col("p_name"), F.lit("  ")),
        "Category": F.col("p_type"),
        "Sub-Category": F.col("p_brand"),
        "Sales": F.when(line % 40 == 0, F.lit("abc")).otherwise(sales),
        "Quantity": F.when(F.col("l_linenumber") % 3 == 0,
                           F.concat(F.expr("CAST(CAST(l_quantity AS BIGINT) AS STRING)"), F.lit(".7")))
                     .otherwise(F.expr("CAST(CAST(l_quantity AS BIGINT) AS STRING)")),
        "Discount": F.when(line % 11 == 0, F.lit("0.100004")).otherwise(rate),
        "Profit": F.expr("CAST(" + dict(ORDER_LINE_COLUMNS)["profit"] + " AS STRING)"),
        "a - b": s("l_linenumber"),
        "Margin %": F.expr("CAST(CAST(l_tax AS DECIMAL(4,2)) AS STRING)"),
    }
    # One join for the lines and their copies.
    lines = j.select(F.expr("explode(CASE WHEN l_orderkey % 10 = 0 THEN array(1, 2) ELSE array(1) END)").alias("copy"),
                     *[c.alias(n) for n, c in cols.items()]).drop("copy")
    empty = (read_table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 100 == 0)
             .select(*[F.lit(None).cast("string").alias(n) for n in cols]))
    return lines.unionByName(empty)


# Lines of the order notes file, as SQL over orders. By the order's key some records are short,
# some long, some have a note over two lines with doubled quotes, and some a quote inside a plain field.
ORDER_NOTE_HEADER = "order_id,priority,note"
ORDER_NOTE_LINE = """CAST(o_orderkey AS VARCHAR(20)) || ',' || CASE WHEN o_orderkey % 11 = 5 THEN '5" ' || o_orderpriority ELSE o_orderpriority END
    || CASE WHEN o_orderkey % 50 = 1 THEN '' WHEN o_orderkey % 7 = 3 THEN ',"one, ""two""' || chr(10) || 'three, ' || CAST(o_orderkey AS VARCHAR(20)) || '"' ELSE ',note' END
    || CASE WHEN o_orderkey % 50 = 2 THEN ',more' ELSE '' END"""


def order_note_files(spark: SparkSession, sf_dir: str, path: str, files: int = 16) -> None:
    """Writes the order notes as text, a folder a file, each with a header."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(ORDER_NOTE_LINE.replace("VARCHAR(20)", "STRING")).alias("value"),
        (F.col("o_orderkey") % files).alias("file"))
    heads = spark.range(files).select(F.lit(-1).cast("long").alias("o_orderkey"), F.lit(ORDER_NOTE_HEADER).alias("value"),
                                      F.col("id").alias("file"))
    orders.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "value", F.col("file").cast("long").alias("file")) \
        .union(heads).repartition(files, "file").sortWithinPartitions("file", "o_orderkey") \
        .select("file", "value").write.partitionBy("file").text(path)


#: By these, descending, the lines of the file stand.
FILE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def order_lines_latest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in an order that is not their own: latest order key and
    line first, as a file would hold them; every tenth order's lines twice."""
    exprs = [f"{expr} AS {name}" for name, expr in ORDER_LINE_COLUMNS]
    lines = joined_tables(spark, sf_dir).selectExpr(
        "explode(CASE WHEN l_orderkey % 10 = 0 THEN array(1, 2) ELSE array(1) END) AS copy", *FILE_ORDER, *exprs)
    order = [*map(F.desc, FILE_ORDER), "copy"]
    return lines.repartitionByRange(*order).sortWithinPartitions(*order).select(*ORDER_LINE_NAMES)
