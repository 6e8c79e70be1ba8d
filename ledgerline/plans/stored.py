"""The star and its twelve views in the session's catalog (S4, S5), so that
another session finds them by name.

Each load writes its tables to a folder of its own and under names of its
own; then every view is replaced, one catalog call each. A view names the
tables of one load only, so a reader never sees two loads mixed, and a load
that fails midway changes no view. With a metastore the tables and views
outlive the application; the in-memory catalog keeps them for all sessions
of one.

The fact is bucketed by product key, one file a bucket, so that aggregates by
that key and joins on it read it without an exchange. A bucket is read by one
task: when one would hold more than ``skew`` times its share (a hot product),
the fact is written in key ranges instead, which split a hot key, and file
statistics prune. The layout changes no result.

All views are lazy, the Pareto view too: products fall into value buckets of
1/256 of a power of two, which follow the order of sales; a running total
inside each bucket and the totals of the buckets above give the cumulative
sales. Sales of 38 digits make under 70,000 buckets, whatever the data. Many
products with nearly the same sales share a bucket, which one task sorts (and
spills); ``views.product_pareto`` splits those too, at the price of a write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import views as V
from .star import Star

FACT_BUCKET_KEY = "product_key"


def _ratio(num: str, den: str) -> str:
    """SQL text of ``functions.numeric.ratio``."""
    def units(c: str) -> str:
        return f"CAST(CAST({c} AS DECIMAL(38,8)) * 100000000BD AS DECIMAL(38,0))"
    n, d = units(num), f"nullif({units(den)}, CAST(0 AS DECIMAL(38,0)))"
    size = f"((abs({n}) * 20000BD + abs({d})) div (abs({d}) * 2BD))"
    signed = f"CASE WHEN ({n} < 0) != ({d} < 0) THEN -{size} ELSE {size} END"
    return f"CAST(CAST({signed} AS DECIMAL(19,0)) * 0.0001BD AS DECIMAL(18,4))"


ORDERS = "count(DISTINCT order_id) AS total_orders"
LINES = "count(1) AS total_order_lines"
SALES = "CAST(sum(sales) AS DECIMAL(38,8)) AS total_sales"
PROFIT = "CAST(sum(profit) AS DECIMAL(38,8)) AS total_profit"
QUANTITY = "CAST(sum(quantity) AS BIGINT) AS total_quantity"
DISCOUNT = "CAST(sum(discount) AS DOUBLE) / nullif(count(discount), 0) AS avg_discount"
MARGIN = f"{_ratio('total_profit', 'total_sales')} AS profit_margin"
ORDER_VALUE = f"{_ratio('total_sales', 'total_orders')} AS avg_order_value"


def _block(source: str, by: str = "", sums: tuple = (ORDERS, LINES, SALES, PROFIT, QUANTITY, DISCOUNT),
           ratios: tuple = (MARGIN,)) -> str:
    """The shared aggregate block over ``source``, grouped by the columns ``by``."""
    keys = f"{by}, " if by else ""
    grouped = f"SELECT {keys}{', '.join(sums)} FROM {source}{f' GROUP BY {by}' if by else ''}"
    return f"SELECT *, {', '.join(ratios)} FROM ({grouped})"


def _per_key(fact: str, dim: str, key: str, attrs: list[str], where: str = "", **block) -> str:
    """Aggregate on the key first, then join the dimension."""
    return f"SELECT d.{key}, {', '.join(f'd.{a}' for a in attrs)}, a.* EXCEPT ({key}) " \
           f"FROM ({_block(fact, key, **block)}) a JOIN {dim} d ON d.{key} = a.{key}{where}"


def _discount_band() -> str:
    cases = [f"WHEN discount = {hi}D THEN '{label}'" if lo is None else f"WHEN discount > {lo}D AND discount <= {hi}D THEN '{label}'"
             for label, lo, hi in V.DISCOUNT_BANDS]
    return f"CASE {' '.join(cases)} ELSE '{V.OTHER_BAND}' END"


def _pareto(fact: str, product: str) -> str:
    power = "CAST(floor(256 * log2(abs(CAST(total_sales AS DOUBLE)))) AS INT) + 100000"
    return f"""
WITH totals AS (SELECT product_key, CAST(sum(sales) AS DECIMAL(37,8)) AS total_sales, {PROFIT} FROM {fact} GROUP BY product_key),
named AS (
  SELECT d.product_key, {', '.join(f'd.{a}' for a in V.PRODUCT_ATTRS)}, total_sales, total_profit,
    CASE WHEN total_sales > 0 THEN {power} WHEN total_sales = 0 THEN 0 WHEN total_sales < 0 THEN -({power}) ELSE -1000000 END AS bucket
  FROM totals t JOIN {product} d ON d.product_key = t.product_key),
buckets AS (
  SELECT bucket,
    CAST(sum(bucket_sales) OVER (ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DECIMAL(37,8)) AS above,
    CAST(sum(bucket_sales) OVER (ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS DECIMAL(38,8)) AS grand
  FROM (SELECT bucket, sum(total_sales) AS bucket_sales FROM named GROUP BY bucket)),
placed AS (
  SELECT bucket, product_key, {', '.join(V.PRODUCT_ATTRS)}, total_sales, total_profit,
    CAST(sum(total_sales) OVER (PARTITION BY bucket ORDER BY total_sales DESC NULLS LAST, product_key ROWS UNBOUNDED PRECEDING) AS DECIMAL(37,8)) AS inside
  FROM named),
summed AS (
  SELECT /*+ BROADCAST(b) */ p.*, grand,
    CASE WHEN above IS NULL THEN CAST(inside AS DECIMAL(38,8)) ELSE above + coalesce(inside, CAST(0 AS DECIMAL(37,8))) END AS cumulative
  FROM placed p JOIN buckets b ON b.bucket = p.bucket)
SELECT product_key, {', '.join(V.PRODUCT_ATTRS)}, CAST(total_sales AS DECIMAL(38,8)) AS total_sales, total_profit, {MARGIN},
  {_ratio('cumulative', 'grand')} AS cumulative_sales_pct,
  CASE WHEN (grand > 0 AND CAST(cumulative AS DECIMAL(30,8)) * 5BD <= CAST(grand AS DECIMAL(30,8)) * 4BD)
    OR (grand < 0 AND CAST(cumulative AS DECIMAL(30,8)) * 5BD >= CAST(grand AS DECIMAL(30,8)) * 4BD)
    THEN '{V.PARETO_TOP}' ELSE '{V.PARETO_REST}' END AS pareto_group
FROM summed"""


def view_texts(star: Star, names: dict[str, str]) -> dict[str, str]:
    """SQL of the views that the star's dimensions allow; ``names`` has the
    catalog name of each table."""
    fact, date = names["fact_sales"], names["dim_date"]
    customer, product, geography, ship_mode = (names.get(f"dim_{d}") for d in ("customer", "product", "geography", "ship_mode"))

    def joined(dim: str | None, key: str, attrs: list[str]) -> str:
        return f"(SELECT f.*, {', '.join(f'd.{a}' for a in attrs)} FROM {fact} f JOIN {dim} d ON d.{key} = f.{key})"

    places = [c for c in ("country", "region", "state", "city") if star.geography is not None and c in star.geography.columns]
    days = f"(SELECT f.*, s.ship_mode, datediff(sd.date, od.date) AS days FROM {fact} f JOIN {ship_mode} s ON s.ship_mode_key = f.ship_mode_key " \
           f"LEFT JOIN {date} od ON od.date_key = f.order_date_key LEFT JOIN {date} sd ON sd.date_key = f.ship_date_key)"
    months = f"(SELECT f.*, d.year, d.month, d.month_name FROM {fact} f JOIN {date} d ON d.date_key = f.order_date_key)"
    buyers = f"SELECT segment AS buyers_segment, count(DISTINCT customer_id) AS total_customers FROM " \
             f"(SELECT DISTINCT customer_key FROM {fact}) f JOIN {customer} c ON c.customer_key = f.customer_key GROUP BY segment"
    texts = {
        "vw_executive_kpis": lambda: _block(fact, ratios=(MARGIN, ORDER_VALUE)),
        "vw_monthly_sales_profit": lambda: "SELECT year, month, month_name, make_date(year, month, 1) AS month_start_date, "
            f"* EXCEPT (year, month, month_name) FROM ({_block(months, 'year, month, month_name', (ORDERS, SALES, PROFIT, QUANTITY, DISCOUNT))})",
        "vw_category_profitability": lambda: _block(joined(product, "product_key", ["category", "sub_category"]), "category, sub_category"),
        "vw_product_profitability": lambda: _per_key(fact, product, "product_key", V.PRODUCT_ATTRS),
        "vw_region_performance": lambda: _block(joined(geography, "geography_key", places), ", ".join(places)),
        "vw_customer_profitability": lambda: _per_key(fact, customer, "customer_key", V.CUSTOMER_ATTRS, ratios=(MARGIN, ORDER_VALUE)),
        "vw_segment_profitability": lambda: f"SELECT a.*, total_customers FROM "
            f"({_block(joined(customer, 'customer_key', ['segment']), 'segment', ratios=(MARGIN, ORDER_VALUE))}) a "
            f"JOIN ({buyers}) b ON a.segment <=> b.buyers_segment",
        "vw_discount_impact": lambda: _block(f"(SELECT *, {_discount_band()} AS discount_band FROM {fact})", "discount_band"),
        "vw_shipping_performance": lambda: _block(days, "ship_mode", (ORDERS, LINES, SALES, PROFIT, QUANTITY,
            "CAST(sum(days) AS BIGINT) div nullif(count(days), 0) AS avg_shipping_days")),
        "vw_product_pareto": lambda: _pareto(fact, product),
        "vw_loss_making_products": lambda: _per_key(fact, product, "product_key", V.PRODUCT_ATTRS, " WHERE a.total_profit < 0",
            sums=(ORDERS, SALES, PROFIT, QUANTITY, DISCOUNT)),
        "vw_sales_detail": lambda: _detail(star, names),
    }
    return {name: texts[name]() for name in V.available(star)}


def _detail(star: Star, names: dict[str, str]) -> str:
    has, joins = {c: f"f.{c}" for c in star.fact.columns}, {}
    for role in ("order", "ship"):
        if f"{role}_date_key" in has:
            joins[role] = f"{names['dim_date']} {role}_day ON {role}_day.date_key = f.{role}_date_key"
            has[f"{role}_date"] = f"{role}_day.date"
            has |= {f"{role}_{c}": f"{role}_day.{c}" for c in ("year", "quarter", "month", "month_name")}
    if "order_date" in has and "ship_date" in has:
        has["shipping_days"] = "datediff(ship_day.date, order_day.date)"
    for dim in ("customer", "product", "geography", "ship_mode"):
        table = star.tables().get(f"dim_{dim}")
        if table is not None and f"{dim}_key" in star.fact.columns:
            joins[dim] = f"{names[f'dim_{dim}']} {dim} ON {dim}.{dim}_key = f.{dim}_key"
            has |= {c: f"{dim}.{c}" for c in table.columns if c not in has}
    if "sales" in has and "profit" in has:
        has["profit_margin"] = _ratio("f.profit", "f.sales")
    # The fact lies by product key; customers, the other large table, meet it before columns of small ones make it wider.
    in_order = [joins[x] for x in ("product", "customer", "order", "ship", "geography", "ship_mode") if x in joins]
    return f"SELECT {', '.join(f'{has.get(c, 'CAST(NULL AS STRING)')} AS {c}' for c in V.SALES_DETAIL_COLUMNS)} " \
           f"FROM {' LEFT JOIN '.join([names['fact_sales'] + ' f', *in_order])}"


def largest_bucket(fact: DataFrame, key: str, buckets: int) -> float:
    """Rows of the fullest bucket over the mean of all; 0 for no rows. One
    aggregate, at most ``buckets`` rows a task are shuffled."""
    per = fact.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    top, rows = per.agg(F.max("n"), F.sum("n")).first()
    return top * buckets / rows if rows else 0.0


def store_star(star: Star, database: str, folder: str, buckets: int | None = None, skew: float = 4.0) -> dict[str, str]:
    """Write the star as catalog tables of ``database`` under ``folder`` and
    replace its views: ``dim_…`` and ``fact_sales`` over the tables, and the
    analytics views. Returns the catalog name of each table of this load.

    ``folder`` must be shared by all executors. ``buckets`` defaults to the
    session's shuffle partitions. Tables of earlier loads stay for readers
    that have begun; ``drop_old_loads`` removes them from the catalog. An
    empty star is stored as empty tables; dimensions that the star lacks have
    no table, and views that need them are dropped."""
    spark = star.fact.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    load, folder = f"load_{uuid.uuid4().hex[:12]}", folder.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder}'")
    names = {}
    for table, df in star.tables().items():
        names[table] = f"`{database}`.`{table}_{load}`"
        if table != "fact_sales" or FACT_BUCKET_KEY not in df.columns:
            writer = df.write
        elif largest_bucket(df, FACT_BUCKET_KEY, buckets) <= skew:
            writer = df.repartition(buckets, FACT_BUCKET_KEY).write.bucketBy(buckets, FACT_BUCKET_KEY).sortBy(FACT_BUCKET_KEY)
        else:
            ranges = [FACT_BUCKET_KEY, "sales_key"]
            writer = df.repartitionByRange(buckets, *ranges).sortWithinPartitions(*ranges).write
        if table == "fact_sales":  # as large as the input
            writer = writer.option("compression", "zstd")
        writer.format("parquet").option("path", f"{folder}/{load}/{table}").saveAsTable(names[table])
    views = {t: f"SELECT * FROM {n}" for t, n in names.items()} | view_texts(star, names)
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text}")
    for name in {*Star.__dataclass_fields__, *V.VIEWS}:
        name = name if name in V.VIEWS else "fact_sales" if name == "fact" else f"dim_{name}"
        if name not in views:
            spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{name}`")
    return names


def stored_star(spark: SparkSession, database: str) -> Star:
    """The star of a database, from any session on the same catalog."""
    def find(name: str) -> DataFrame | None:
        full = f"`{database}`.`{name}`"
        return spark.table(full) if spark.catalog.tableExists(full) else None
    return Star(*map(find, ("dim_date", "dim_customer", "dim_product", "dim_geography", "dim_ship_mode", "fact_sales")))


def drop_old_loads(spark: SparkSession, database: str, keep: dict[str, str]) -> None:
    """Drop the tables of loads other than ``keep`` (what ``store_star``
    returned) from the catalog. Their files stay."""
    kept = {n.split(".")[-1].strip("`") for n in keep.values()}
    for t in spark.catalog.listTables(f"`{database}`"):
        if t.tableType != "VIEW" and not t.isTemporary and "_load_" in t.name and t.name not in kept:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t.name}`")
