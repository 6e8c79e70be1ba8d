"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL rebuilds the star with window functions and plain joins, the simple
single-node way, from the same driver tables. Conventions shared with the
Spark side (output types, exact ratios) are stated in ``_ratio`` and the
casts; nothing here runs on Spark.
"""

from __future__ import annotations

from .sources.fixtures import FILE_ORDER, ORDER_LINE_COLUMNS, ORDER_LINE_NAMES, ORDER_NOTE_LINE, PRODUCT_CODE

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
STRING_COLS = ("ship_mode", "customer_name", "segment", "country", "region",
               "product_name", "category", "sub_category")


def _ratio(num: str, den: str) -> str:
    """num / den rounded half away from zero to 4 decimals, DECIMAL(18,4),
    computed on exact integers (both inputs have at most 8 decimals)."""
    n = f"CAST(ROUND(CAST({num} AS DECIMAL(38,8)) * 100000000) AS HUGEINT)"
    d = f"CAST(ROUND(CAST({den} AS DECIMAL(38,8)) * 100000000) AS HUGEINT)"
    return (f"CAST(CAST(sign({n}) * sign({d}) * ((2 * abs({n}) * 10000 + abs({d})) "
            f"// NULLIF(2 * abs({d}), 0)) AS DECIMAL(38,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4))")


def _mean(col: str) -> str:
    return f"CAST(SUM({col}) AS DOUBLE) / NULLIF(COUNT({col}), 0)"


def _block(lines: bool = True, aov: bool = False, prefix: str = "f.") -> str:
    p = prefix
    cols = [f"COUNT(DISTINCT {p}order_id) AS total_orders"]
    if lines:
        cols.append("COUNT(*) AS total_order_lines")
    cols += [f"CAST(SUM({p}sales) AS DECIMAL(38,8)) AS total_sales",
             f"CAST(SUM({p}profit) AS DECIMAL(38,8)) AS total_profit",
             f"CAST(SUM({p}quantity) AS BIGINT) AS total_quantity",
             f"{_mean(p + 'discount')} AS avg_discount",
             f"{_ratio(f'SUM({p}profit)', f'SUM({p}sales)')} AS profit_margin"]
    if aov:
        cols.append(f"{_ratio(f'SUM({p}sales)', f'COUNT(DISTINCT {p}order_id)')} AS avg_order_value")
    return ",\n  ".join(cols)


JOINED = """lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey"""


def _lines_sql(product_id: str = "p_partkey") -> str:
    exprs = ",\n    ".join(f"{product_id if n == 'product_id' else e} AS {n}" for n, e in ORDER_LINE_COLUMNS)
    return f"SELECT\n    {exprs}\n  FROM {JOINED}"


def _clean_sql(src: str) -> str:
    cols = ", ".join(f"trim({c}, {WS}) AS {c}" if c in STRING_COLS else c for c in ORDER_LINE_NAMES)
    return f"SELECT DISTINCT {cols} FROM {src}"


ORDER_BY_ROW = ", ".join(f"{c} NULLS FIRST" for c in ORDER_LINE_NAMES)
DATE_KEY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def star_ctes(product_id: str = "p_partkey") -> str:
    """WITH-clause building lines, numbered lines, the five dimensions and the fact."""
    return f"""WITH lines AS (
  {_lines_sql(product_id)}
),
clean AS ({_clean_sql('lines')}),
numbered AS (SELECT *, row_number() OVER (ORDER BY {ORDER_BY_ROW}) AS _row FROM clean),
span AS (
  SELECT least(min(order_date), min(ship_date)) AS lo, greatest(max(order_date), max(ship_date)) AS hi
  FROM numbered
),
days AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM span
),
dim_date AS (
  SELECT d AS date, {DATE_KEY.format(d='d')} AS date_key, CAST(year(d) AS INTEGER) AS year,
         CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day, dayname(d) AS weekday
  FROM days
),
dim_customer AS (
  SELECT customer_id, customer_name, segment, row_number() OVER (ORDER BY _first) AS customer_key
  FROM (SELECT customer_id, arg_min(customer_name, _row) AS customer_name,
               arg_min(segment, _row) AS segment, min(_row) AS _first
        FROM numbered GROUP BY customer_id)
),
dim_product AS (
  SELECT product_id, product_name, category, sub_category,
         row_number() OVER (ORDER BY _first) AS product_key
  FROM (SELECT product_id, product_name, category, sub_category, min(_row) AS _first
        FROM numbered GROUP BY product_id, product_name, category, sub_category)
),
dim_geography AS (
  SELECT country, region, postal_code, row_number() OVER (ORDER BY _first) AS geography_key
  FROM (SELECT country, region, postal_code, min(_row) AS _first
        FROM numbered GROUP BY country, region, postal_code)
),
dim_ship_mode AS (
  SELECT ship_mode, row_number() OVER (ORDER BY _first) AS ship_mode_key
  FROM (SELECT ship_mode, min(_row) AS _first FROM numbered
        WHERE ship_mode IS NOT NULL GROUP BY ship_mode)
),
fact_sales AS (
  SELECT n._row AS sales_key, n.order_id,
         {DATE_KEY.format(d='n.order_date')} AS order_date_key,
         {DATE_KEY.format(d='n.ship_date')} AS ship_date_key,
         c.customer_key, p.product_key, g.geography_key, s.ship_mode_key,
         n.sales, n.quantity, n.discount, n.profit
  FROM numbered n
  LEFT JOIN dim_customer c ON n.customer_id IS NOT DISTINCT FROM c.customer_id
  LEFT JOIN dim_product p ON n.product_id IS NOT DISTINCT FROM p.product_id
       AND n.product_name IS NOT DISTINCT FROM p.product_name
       AND n.category IS NOT DISTINCT FROM p.category
       AND n.sub_category IS NOT DISTINCT FROM p.sub_category
  LEFT JOIN dim_geography g ON n.country IS NOT DISTINCT FROM g.country
       AND n.region IS NOT DISTINCT FROM g.region
       AND n.postal_code IS NOT DISTINCT FROM g.postal_code
  LEFT JOIN dim_ship_mode s ON n.ship_mode = s.ship_mode
),
shipped AS (
  SELECT f.*, od.date AS order_date, sd.date AS ship_date,
         CAST(sd.date - od.date AS INTEGER) AS shipping_days
  FROM fact_sales f
  LEFT JOIN dim_date od ON f.order_date_key = od.date_key
  LEFT JOIN dim_date sd ON f.ship_date_key = sd.date_key
)"""


STAR = star_ctes()


def _file_order_star() -> str:
    """The star of a file that holds the latest order and line first: equal
    lines keep the first, rows are numbered as they stand."""
    lines, clean = _lines_sql(), _clean_sql("lines")
    first = clean.replace("SELECT DISTINCT", "SELECT").replace(" FROM lines", f", max(row({', '.join(FILE_ORDER)})) AS place FROM lines GROUP BY ALL")
    return STAR.replace(lines, lines.replace("SELECT", f"SELECT {', '.join(FILE_ORDER)},", 1)).replace(clean, first) \
        .replace(f"SELECT *, row_number() OVER (ORDER BY {ORDER_BY_ROW}) AS _row FROM clean",
                 "SELECT * EXCLUDE (place), row_number() OVER (ORDER BY place DESC) AS _row FROM clean")

BAND = """CASE WHEN f.discount = 0 THEN 'No Discount'
       WHEN f.discount > 0 AND f.discount <= 0.10 THEN '0-10%'
       WHEN f.discount > 0.10 AND f.discount <= 0.20 THEN '10-20%'
       WHEN f.discount > 0.20 AND f.discount <= 0.30 THEN '20-30%'
       WHEN f.discount > 0.30 AND f.discount <= 0.50 THEN '30-50%'
       ELSE '50%+' END"""

SALES_DETAIL = f"""SELECT f.sales_key, f.order_id, od.date AS order_date, od.year AS order_year,
  od.quarter AS order_quarter, od.month AS order_month, od.month_name AS order_month_name,
  sd.date AS ship_date, CAST(sd.date - od.date AS INTEGER) AS shipping_days,
  c.customer_id, c.customer_name, c.segment,
  p.product_id, p.product_name, p.category, p.sub_category,
  g.country, g.region, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS city,
  s.ship_mode, f.sales, f.quantity, f.discount, f.profit,
  {_ratio('f.profit', 'f.sales')} AS profit_margin
FROM fact_sales f
LEFT JOIN dim_date od ON f.order_date_key = od.date_key
LEFT JOIN dim_date sd ON f.ship_date_key = sd.date_key
LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
LEFT JOIN dim_product p ON f.product_key = p.product_key
LEFT JOIN dim_geography g ON f.geography_key = g.geography_key
LEFT JOIN dim_ship_mode s ON f.ship_mode_key = s.ship_mode_key"""

PRODUCT_TOTALS = """SELECT p.product_key, p.product_id, p.product_name, p.category, p.sub_category,
    CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales, CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit
  FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
  GROUP BY p.product_key, p.product_id, p.product_name, p.category, p.sub_category"""


PARETO_CTES = f"""pareto_ps AS ({PRODUCT_TOTALS}),
pareto_ranked AS (
  SELECT *, SUM(total_sales) OVER () AS grand,
         SUM(total_sales) OVER (ORDER BY total_sales DESC NULLS LAST, product_key
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM pareto_ps
)"""

PARETO_SELECT = f"""SELECT product_key, product_id, product_name, category, sub_category, total_sales, total_profit,
  {_ratio('total_profit', 'total_sales')} AS profit_margin,
  {_ratio('cum', 'grand')} AS cumulative_sales_pct,
  CASE WHEN (grand > 0 AND cum * 5 <= grand * 4) OR (grand < 0 AND cum * 5 >= grand * 4)
       THEN 'Top 80% Sales Contributors' ELSE 'Remaining Products' END AS pareto_group
FROM pareto_ranked"""


def _views() -> dict[str, str]:
    v = {}
    v["vw_executive_kpis"] = f"{STAR}\nSELECT {_block(aov=True)} FROM fact_sales f"
    v["vw_monthly_sales_profit"] = f"""{STAR}
SELECT d.year, d.month, d.month_name, make_date(d.year, d.month, 1) AS month_start_date,
  {_block(lines=False)}
FROM fact_sales f JOIN dim_date d ON f.order_date_key = d.date_key
GROUP BY d.year, d.month, d.month_name"""
    v["vw_category_profitability"] = f"""{STAR}
SELECT p.category, p.sub_category, {_block()}
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.category, p.sub_category"""
    v["vw_product_profitability"] = f"""{STAR}
SELECT p.product_key, p.product_id, p.product_name, p.category, p.sub_category, {_block()}
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.product_key, p.product_id, p.product_name, p.category, p.sub_category"""
    v["vw_region_performance"] = f"""{STAR}
SELECT g.country, g.region, {_block()}
FROM fact_sales f JOIN dim_geography g ON f.geography_key = g.geography_key
GROUP BY g.country, g.region"""
    v["vw_customer_profitability"] = f"""{STAR}
SELECT c.customer_key, c.customer_id, c.customer_name, c.segment, {_block(aov=True)}
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY c.customer_key, c.customer_id, c.customer_name, c.segment"""
    v["vw_segment_profitability"] = f"""{STAR}
SELECT c.segment, COUNT(DISTINCT c.customer_id) AS total_customers, {_block(aov=True)}
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY c.segment"""
    v["vw_discount_impact"] = f"""{STAR}
SELECT {BAND} AS discount_band, {_block()}
FROM fact_sales f GROUP BY 1"""
    v["vw_shipping_performance"] = f"""{STAR}
SELECT s.ship_mode, COUNT(DISTINCT f.order_id) AS total_orders, COUNT(*) AS total_order_lines,
  CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales, CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit,
  CAST(SUM(f.quantity) AS BIGINT) AS total_quantity,
  CAST(SUM(f.shipping_days) AS BIGINT) // NULLIF(COUNT(f.shipping_days), 0) AS avg_shipping_days,
  {_ratio('SUM(f.profit)', 'SUM(f.sales)')} AS profit_margin
FROM shipped f JOIN dim_ship_mode s ON f.ship_mode_key = s.ship_mode_key
GROUP BY s.ship_mode"""
    v["vw_product_pareto"] = f"""{STAR},\n{PARETO_CTES}\n{PARETO_SELECT}"""
    v["vw_loss_making_products"] = f"""{STAR}
SELECT p.product_key, p.product_id, p.product_name, p.category, p.sub_category,
  COUNT(DISTINCT f.order_id) AS total_orders, CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales,
  CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit, CAST(SUM(f.quantity) AS BIGINT) AS total_quantity,
  {_mean('f.discount')} AS avg_discount, {_ratio('SUM(f.profit)', 'SUM(f.sales)')} AS profit_margin
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.product_key, p.product_id, p.product_name, p.category, p.sub_category
HAVING SUM(f.profit) < 0"""
    v["vw_sales_detail"] = f"{STAR}\n{SALES_DETAIL}"
    return v


def _quality() -> dict[str, str]:
    q = {}
    tables = (("dim.date", "dim_date", "date_key"), ("dim.customer", "dim_customer", "customer_key"),
              ("dim.product", "dim_product", "product_key"), ("dim.geography", "dim_geography", "geography_key"),
              ("dim.ship_mode", "dim_ship_mode", "ship_mode_key"), ("fact.sales", "fact_sales", "sales_key"))
    q["table_row_counts"] = STAR + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {t}" for n, t, _ in tables)
    q["pk_violations"] = STAR + "\n" + "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS table_name, '{k}' AS key_column, CAST(SUM(c) AS BIGINT) AS row_count,
  CAST(COALESCE(SUM(CASE WHEN {k} IS NULL THEN c END), 0) AS BIGINT) AS null_keys,
  COUNT(*) FILTER (WHERE {k} IS NOT NULL AND c > 1) AS duplicated_keys
FROM (SELECT {k}, COUNT(*) AS c FROM {t} GROUP BY {k})""" for n, t, k in tables)
    rels = (("order_date", "order_date_key", "dim_date", "date_key"),
            ("ship_date", "ship_date_key", "dim_date", "date_key"),
            ("customer", "customer_key", "dim_customer", "customer_key"),
            ("product", "product_key", "dim_product", "product_key"),
            ("geography", "geography_key", "dim_geography", "geography_key"),
            ("ship_mode", "ship_mode_key", "dim_ship_mode", "ship_mode_key"))
    orphan = lambda fk, t, k: (f"SELECT COUNT(*) FROM fact_sales f LEFT JOIN {t} d ON f.{fk} = d.{k} "
                               f"WHERE f.{fk} IS NOT NULL AND d.{k} IS NULL")
    q["fk_violations"] = STAR + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{r}' AS relationship, ({orphan(fk, t, k)}) AS orphan_rows" for r, fk, t, k in rels)
    q["orphan_counts"] = STAR + "\nSELECT " + ", ".join(
        f"({orphan(fk, t, k)}) AS orphan_{r}_rows" for r, fk, t, k in rels)
    q["missing_key_counts"] = STAR + "\nSELECT " + ", ".join(
        f"CAST(SUM(CASE WHEN {k} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_{k}"
        for k in ("order_date_key", "ship_date_key", "customer_key", "product_key",
                  "geography_key", "ship_mode_key")) + " FROM fact_sales"
    q["control_totals"] = f"""{STAR}
SELECT COUNT(*) AS fact_rows, CAST(SUM(sales) AS DECIMAL(38,8)) AS total_sales,
  CAST(SUM(profit) AS DECIMAL(38,8)) AS total_profit, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
  {_mean('discount')} AS avg_discount
FROM fact_sales"""
    q["join_sample"] = f"""{STAR}
SELECT sales_key, order_id, order_date, ship_date, customer_name, segment, product_name, category,
  sub_category, country, region, state, city, ship_mode, sales, quantity, discount, profit
FROM ({SALES_DETAIL}) ORDER BY sales_key LIMIT 20"""
    views = _views()
    bodies = []
    for name, sql in views.items():
        body = sql[len(STAR):]
        if name == "vw_product_pareto":
            body = PARETO_SELECT
        bodies.append(f"SELECT '{name}' AS view_name, COUNT(*) AS row_count FROM ({body.strip()})")
    q["view_row_counts"] = f"{STAR},\n{PARETO_CTES}\n" + "\nUNION ALL\n".join(bodies)
    q["star_csv_roundtrip"] = q["table_row_counts"]
    kpi = _views()["vw_executive_kpis"][len(STAR):]
    band = _views()["vw_discount_impact"][len(STAR):]
    q["sql_over_views"] = (f"{STAR}\nSELECT d.discount_band, d.total_order_lines, d.profit_margin, "
                           f"(SELECT k.total_order_lines FROM ({kpi}) k) AS all_lines FROM ({band}) d")
    q["sales_detail_top20"] = f"{STAR}\nSELECT * FROM ({SALES_DETAIL}) ORDER BY order_date NULLS FIRST, sales_key LIMIT 20"
    return q


def _measures() -> dict[str, str]:
    m = {}
    oy = ("fact_sales f JOIN (SELECT date_key, year AS order_year, month AS order_month FROM dim_date) d "
          "ON f.order_date_key = d.date_key")
    m["core_measures"] = f"""{STAR}
SELECT order_year, CAST(SUM(sales) AS DECIMAL(38,8)) AS total_sales,
  CAST(SUM(profit) AS DECIMAL(38,8)) AS total_profit,
  {_ratio('SUM(profit)', 'SUM(sales)')} AS profit_margin_pct,
  {_ratio('SUM(sales)', 'COUNT(DISTINCT order_id)')} AS average_order_value,
  COUNT(DISTINCT order_id) AS total_orders, COUNT(*) AS total_order_lines
FROM {oy} GROUP BY order_year"""
    m["loss_measures"] = f"""{STAR}
SELECT CAST(SUM(CASE WHEN profit < 0 THEN profit END) AS DECIMAL(38,8)) AS loss_making_profit,
  COUNT(*) FILTER (WHERE profit < 0) AS loss_making_order_lines, COUNT(*) AS total_order_lines,
  {_ratio('COUNT(*) FILTER (WHERE profit < 0)', 'COUNT(*)')} AS loss_making_lines_pct
FROM fact_sales"""
    m["discount_measures"] = f"""{STAR}
SELECT CAST(SUM(CASE WHEN discount > 0 THEN sales END) AS DECIMAL(38,8)) AS discounted_sales,
  CAST(SUM(sales) AS DECIMAL(38,8)) AS total_sales,
  {_ratio('SUM(CASE WHEN discount > 0 THEN sales END)', 'SUM(sales)')} AS discounted_sales_pct
FROM fact_sales"""
    for name, keys in (("yoy_sales", ["order_year"]), ("yoy_sales_monthly", ["order_year", "order_month"])):
        k = ", ".join(keys)
        on = " AND ".join(["a.order_year = b.order_year + 1"] + [f"a.{c} = b.{c}" for c in keys[1:]])
        m[name] = f"""{STAR},
per AS (SELECT {k}, CAST(SUM(sales) AS DECIMAL(38,8)) AS sales FROM {oy} GROUP BY {k})
SELECT {", ".join("a." + c for c in keys)}, a.sales AS total_sales, b.sales AS sales_previous_year,
  CAST(a.sales - b.sales AS DECIMAL(38,8)) AS sales_yoy_change,
  {_ratio('a.sales - b.sales', 'b.sales')} AS sales_yoy_change_pct
FROM per a LEFT JOIN per b ON {on}"""
    per_name = f"""per AS (
  SELECT p.product_name, CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales,
    CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit,
    {_ratio('SUM(f.profit)', 'SUM(f.sales)')} AS profit_margin,
    CAST(SUM(f.profit) AS DOUBLE) / NULLIF(CAST(SUM(f.sales) AS DOUBLE), 0) AS margin
  FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key GROUP BY p.product_name
)"""
    seg = f"""{STAR},
{per_name},
ms AS (SELECT min(v) AS lo, max(v) AS hi FROM (
  SELECT total_sales AS v, row_number() OVER (ORDER BY total_sales, product_name) AS i,
         COUNT(*) OVER () AS n FROM per) WHERE i IN ((n + 1) // 2, (n + 2) // 2)),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM (
  SELECT margin AS v, row_number() OVER (ORDER BY margin, product_name) AS i,
         COUNT(*) OVER () AS n FROM per WHERE margin IS NOT NULL) WHERE i IN ((n + 1) // 2, (n + 2) // 2)),
seg AS (
  SELECT per.*, CASE
    WHEN total_profit < 0 THEN 'Loss Maker'
    WHEN total_sales * 2 >= ms.lo + ms.hi AND COALESCE(margin, 0) * 2 >= mm.lo + mm.hi THEN 'Star Product'
    WHEN total_sales * 2 >= ms.lo + ms.hi AND NOT (COALESCE(margin, 0) * 2 >= mm.lo + mm.hi) THEN 'Revenue Trap'
    WHEN NOT (total_sales * 2 >= ms.lo + ms.hi) AND COALESCE(margin, 0) * 2 >= mm.lo + mm.hi THEN 'Niche Profitable'
    ELSE 'Low Performer' END AS portfolio_segment
  FROM per, ms, mm
)"""
    m["portfolio_segments"] = seg + "\nSELECT product_name, total_sales, total_profit, profit_margin, portfolio_segment FROM seg"
    m["portfolio_segment_counts"] = seg + """
SELECT portfolio_segment, COUNT(*) AS products, CAST(SUM(total_sales) AS DECIMAL(38,8)) AS total_sales
FROM seg GROUP BY portfolio_segment"""

    def in_contexts(per: str, key: str, by: str) -> str:
        """Middle values of sales and margin within each context."""
        def middle(v: str) -> str:
            return f"""SELECT {by}, min(v) AS lo, max(v) AS hi FROM (
  SELECT {by}, {v} AS v, row_number() OVER (PARTITION BY {by} ORDER BY {v}, {key}) AS i, COUNT(*) OVER (PARTITION BY {by}) AS n
  FROM per WHERE {v} IS NOT NULL) WHERE i IN ((n + 1) // 2, (n + 2) // 2) GROUP BY {by}"""
        return f"""{STAR},
per AS (SELECT *, {_ratio('total_profit', 'total_sales')} AS profit_margin,
  CAST(total_profit AS DOUBLE) / NULLIF(CAST(total_sales AS DOUBLE), 0) AS margin FROM ({per})),
ms AS ({middle('total_sales')}),
mm AS ({middle('margin')}),
j AS (SELECT per.*, total_sales * 2 >= ms.lo + ms.hi AS big, margin * 2 >= mm.lo + mm.hi AS good,
  COALESCE(margin, 0) * 2 >= mm.lo + mm.hi AS good_or_zero FROM per LEFT JOIN ms USING ({by}) LEFT JOIN mm USING ({by}))"""

    sums = "CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales, CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit"
    segment = """CASE WHEN total_profit < 0 THEN 'Loss Maker' WHEN big AND good_or_zero THEN 'Star Product'
    WHEN big AND NOT good_or_zero THEN 'Revenue Trap' WHEN NOT big AND good_or_zero THEN 'Niche Profitable'
    ELSE 'Low Performer' END AS portfolio_segment"""
    named = "FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_geography g ON f.geography_key = g.geography_key JOIN dim_customer c ON f.customer_key = c.customer_key"
    for name, by, context in (("by_year", "order_year", "CAST(f.order_date_key // 10000 AS INTEGER)"), ("by_region", "region", "g.region")):
        per = f"SELECT {context} AS {by}, p.product_name, {sums} {named} GROUP BY 1, 2"
        m[f"portfolio_segments_{name}"] = in_contexts(per, "product_name", by) + f"""
SELECT {by}, product_name, total_sales, total_profit, profit_margin, {segment} FROM j"""
    per = f"SELECT 1 AS one, p.product_name, {sums} {named} WHERE g.region = 'EUROPE' AND c.segment = 'BUILDING' GROUP BY 1, 2"
    m["portfolio_segments_in_context"] = in_contexts(per, "product_name", "one") + f"""
SELECT product_name, total_sales, total_profit, profit_margin, {segment} FROM j"""
    per = f"SELECT c.segment, p.product_key, p.product_id, p.product_name, p.category, p.sub_category, {sums} {named} GROUP BY ALL"
    m["high_sales_low_profit_by_segment"] = in_contexts(per, "product_key", "segment") + """
SELECT * EXCLUDE (margin, big, good, good_or_zero) FROM j WHERE big AND (total_profit < 0 OR NOT COALESCE(good, FALSE))"""
    rank = "RANK() OVER (ORDER BY total_sales DESC NULLS LAST) AS sales_rank, RANK() OVER (ORDER BY total_profit DESC NULLS LAST) AS profit_rank"
    m["rank_customers"] = f"""{STAR}
SELECT *, {rank} FROM (
  SELECT c.customer_key, c.customer_id, c.customer_name, c.segment,
    CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales, CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit
  FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
  GROUP BY c.customer_key, c.customer_id, c.customer_name, c.segment)"""
    m["rank_products"] = f"{STAR}\nSELECT *, {rank} FROM ({PRODUCT_TOTALS})"
    m["rank_regions"] = f"""{STAR}
SELECT *, {rank} FROM (
  SELECT g.country, g.region, CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales,
    CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit
  FROM fact_sales f JOIN dim_geography g ON f.geography_key = g.geography_key GROUP BY g.country, g.region)"""
    m["loss_concentration"] = f"""{STAR},
lp AS (SELECT *, CAST(-total_profit AS DECIMAL(38,8)) AS loss FROM ({PRODUCT_TOTALS}) WHERE total_profit < 0),
r AS (SELECT *, SUM(loss) OVER () AS total_loss,
        SUM(loss) OVER (ORDER BY loss DESC, product_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_loss
      FROM lp)
SELECT product_key, product_id, product_name, category, sub_category, total_sales, total_profit, loss,
  {_ratio('loss', 'total_loss')} AS loss_share, CAST(cumulative_loss AS DECIMAL(38,8)) AS cumulative_loss,
  {_ratio('cumulative_loss', 'total_loss')} AS cumulative_loss_pct
FROM r"""
    m["loss_by_subcategory"] = f"""{STAR},
ps AS (SELECT p.category, p.sub_category, CAST(-SUM(f.profit) AS DECIMAL(38,8)) AS loss
       FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key WHERE f.profit < 0
       GROUP BY p.category, p.sub_category)
SELECT *, {_ratio('loss', '(SELECT SUM(loss) FROM ps)')} AS loss_share FROM ps"""
    m["efficiency_measures"] = f"""{STAR}
SELECT c.segment, COUNT(DISTINCT c.customer_id) AS total_customers,
  {_ratio('SUM(f.sales)', 'COUNT(DISTINCT c.customer_id)')} AS sales_per_customer,
  {_ratio('SUM(f.profit)', 'COUNT(DISTINCT c.customer_id)')} AS profit_per_customer,
  CAST(SUM(f.shipping_days) AS BIGINT) AS total_shipping_days,
  {_ratio('SUM(f.sales)', 'SUM(f.shipping_days)')} AS sales_per_shipping_day,
  {_ratio('SUM(f.profit)', 'SUM(f.shipping_days)')} AS profit_per_shipping_day
FROM shipped f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY c.segment"""
    m["discounted_vs_full_price"] = f"""{STAR}
SELECT CASE WHEN f.discount > 0 THEN 'Discounted' ELSE 'Full Price' END AS price_type, {_block()}
FROM fact_sales f GROUP BY 1"""
    # report pages
    m["by_region"] = f"""{STAR}
SELECT g.region, {_block()} FROM fact_sales f JOIN dim_geography g ON f.geography_key = g.geography_key
GROUP BY g.region"""
    m["by_category"] = f"""{STAR}
SELECT p.category, {_block()} FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.category"""
    m["loss_lines_by_subcategory"] = f"""{STAR}
SELECT p.category, p.sub_category, COUNT(*) AS loss_lines, CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales,
  CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
WHERE f.profit < 0 GROUP BY p.category, p.sub_category"""
    cust = """SELECT c.customer_key, c.customer_id, c.customer_name, c.segment,
    CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales, CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit
  FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
  GROUP BY c.customer_key, c.customer_id, c.customer_name, c.segment"""
    m["top_bottom_customers"] = f"""{STAR},
pc AS ({cust})
(SELECT *, 'Top' AS position FROM pc ORDER BY total_profit DESC, customer_key LIMIT 10)
UNION ALL
(SELECT *, 'Bottom' AS position FROM pc ORDER BY total_profit ASC, customer_key LIMIT 10)"""
    m["segment_contribution"] = f"""{STAR},
ps AS (SELECT c.segment, CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales,
         CAST(SUM(f.profit) AS DECIMAL(38,8)) AS total_profit
       FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY c.segment)
SELECT *, {_ratio('total_sales', '(SELECT SUM(total_sales) FROM ps)')} AS total_sales_share,
  {_ratio('total_profit', '(SELECT SUM(total_profit) FROM ps)')} AS total_profit_share
FROM ps"""
    m["ship_mode_mix"] = f"""{STAR},
ps AS (SELECT s.ship_mode, COUNT(*) AS total_order_lines, CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales
       FROM fact_sales f JOIN dim_ship_mode s ON f.ship_mode_key = s.ship_mode_key GROUP BY s.ship_mode)
SELECT *, {_ratio('total_order_lines', '(SELECT SUM(total_order_lines) FROM ps)')} AS total_order_lines_share,
  {_ratio('total_sales', '(SELECT SUM(total_sales) FROM ps)')} AS total_sales_share
FROM ps"""
    m["shipping_day_distribution"] = f"""{STAR}
SELECT shipping_days, COUNT(*) AS total_order_lines, COUNT(DISTINCT order_id) AS total_orders,
  CAST(SUM(sales) AS DECIMAL(38,8)) AS total_sales
FROM shipped GROUP BY shipping_days"""
    m["delivery_by_geography"] = f"""{STAR}
SELECT g.country, g.region, COUNT(DISTINCT f.order_id) AS total_orders,
  CAST(SUM(f.sales) AS DECIMAL(38,8)) AS total_sales, {_mean('f.shipping_days')} AS avg_shipping_days
FROM shipped f JOIN dim_geography g ON f.geography_key = g.geography_key GROUP BY g.country, g.region"""
    m["high_sales_low_profit"] = f"""{STAR},
per AS (SELECT *, {_ratio('total_profit', 'total_sales')} AS profit_margin,
  CAST(total_profit AS DOUBLE) / NULLIF(CAST(total_sales AS DOUBLE), 0) AS margin FROM ({PRODUCT_TOTALS})),
ms AS (SELECT min(v) AS lo, max(v) AS hi FROM (
  SELECT total_sales AS v, row_number() OVER (ORDER BY total_sales, product_key) AS i, COUNT(*) OVER () AS n
  FROM per) WHERE i IN ((n + 1) // 2, (n + 2) // 2)),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM (
  SELECT margin AS v, row_number() OVER (ORDER BY margin, product_key) AS i, COUNT(*) OVER () AS n
  FROM per WHERE margin IS NOT NULL) WHERE i IN ((n + 1) // 2, (n + 2) // 2))
SELECT per.* EXCLUDE (margin) FROM per, ms, mm
WHERE total_sales * 2 >= ms.lo + ms.hi
  AND (total_profit < 0 OR NOT COALESCE(margin * 2 >= mm.lo + mm.hi, FALSE))"""
    m["margin_by_discount"] = f"""{STAR}
SELECT discount, COUNT(*) AS total_order_lines, CAST(SUM(sales) AS DECIMAL(38,8)) AS total_sales,
  CAST(SUM(profit) AS DECIMAL(38,8)) AS total_profit, {_ratio('SUM(profit)', 'SUM(sales)')} AS profit_margin
FROM fact_sales GROUP BY discount"""
    return m


def _star_tables() -> dict[str, str]:
    s = {}
    s["date_span"] = f"""{STAR},
dd AS (SELECT order_date AS d FROM numbered WHERE order_date IS NOT NULL
       UNION ALL SELECT ship_date FROM numbered WHERE ship_date IS NOT NULL)
SELECT min(d) AS start_date, max(d) AS end_date, COUNT(DISTINCT d) AS distinct_dates,
  CAST(max(d) - min(d) + 1 AS BIGINT) AS calendar_days FROM dd"""
    for t in ("dim_date", "dim_customer", "dim_product", "dim_geography", "dim_ship_mode", "fact_sales"):
        s[t] = f"{STAR}\nSELECT * FROM {t}"
        if t != "dim_date":
            s[f"{t}_file_order"] = f"{_file_order_star()}\nSELECT * FROM {t}"
    return s


RAW_NAMES = ("order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
             "segment", "country", "region", "postal_code", "product_id", "product_name", "category",
             "sub_category", "sales", "quantity", "discount", "profit", "a__b", "margin__pct")
_EXPR = dict(ORDER_LINE_COLUMNS)
QTY_TEXT = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"

RAW = f"""WITH raw_rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 50 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%d-%m-%Y') END AS order_date,
    strftime(l_shipdate, '%d-%m-%Y') AS ship_date,
    o_orderpriority AS ship_mode, CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
    c_mktsegment AS segment, n_name AS country, r_name AS region,
    CAST({_EXPR['postal_code']} AS VARCHAR) AS postal_code,
    CAST(p_partkey AS VARCHAR) AS product_id, chr(9) || ' ' || p_name || '  ' AS product_name,
    p_type AS category, p_brand AS sub_category,
    CASE WHEN (l_orderkey + l_linenumber) % 40 = 0 THEN 'abc'
         WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '049'
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS sales,
    CASE WHEN l_linenumber % 3 = 0 THEN {QTY_TEXT} || '.7' ELSE {QTY_TEXT} END AS quantity,
    CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN '0.100004' ELSE CAST({_EXPR['discount']} AS VARCHAR) END AS discount,
    CAST({_EXPR['profit']} AS VARCHAR) AS profit,
    CAST(l_linenumber AS VARCHAR) AS a__b, CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS margin__pct,
    l_orderkey AS _ok
  FROM {JOINED}
),
raw AS (
  SELECT * EXCLUDE (_ok) FROM raw_rows
  UNION ALL SELECT * EXCLUDE (_ok) FROM raw_rows WHERE _ok % 10 = 0
  UNION ALL SELECT {", ".join("CAST(NULL AS VARCHAR)" for _ in RAW_NAMES)} FROM orders WHERE o_orderkey % 100 = 0
)"""


def _txt(c: str) -> str:
    return f"NULLIF(trim({c}, {WS}), '')"


TYPED = {
    "order_date": f"CAST(try_strptime({_txt('order_date')}, '%d-%m-%Y') AS DATE)",
    "ship_date": f"CAST(try_strptime({_txt('ship_date')}, '%d-%m-%Y') AS DATE)",
    "sales": f"TRY_CAST({_txt('sales')} AS DECIMAL(28,8))",
    "profit": f"TRY_CAST({_txt('profit')} AS DECIMAL(28,8))",
    "discount": f"TRY_CAST({_txt('discount')} AS DECIMAL(28,8))",
    "quantity": f"COALESCE(TRY_CAST(trunc(TRY_CAST({_txt('quantity')} AS DOUBLE)) AS BIGINT), 0)",
}


def _cleaning() -> dict[str, str]:
    c = {}
    not_empty = "COALESCE(" + ", ".join(RAW_NAMES) + ") IS NOT NULL"
    trimmed = ", ".join(f"trim({n}, {WS}) AS {n}" for n in RAW_NAMES)
    c["normalize_columns"] = f"{RAW}\nSELECT * FROM raw"
    c["drop_empty_rows"] = f"{RAW}\nSELECT * FROM raw WHERE {not_empty}"
    c["clean_strings"] = f"{RAW}\nSELECT {trimmed} FROM raw"
    c["parse_dates_dayfirst"] = f"{RAW}\nSELECT order_id, {TYPED['order_date']} AS order_date, {TYPED['ship_date']} AS ship_date FROM raw"
    text = "CASE WHEN o_orderkey % 50 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%m/%d/%Y') END"
    c["parse_dates_monthfirst"] = (f"SELECT o_orderkey AS order_id, {text} AS order_date_text, "
                                   f"CAST(try_strptime({text}, '%m/%d/%Y') AS DATE) AS order_date FROM orders")
    c["coerce_numeric"] = (f"{RAW}\nSELECT trim(order_id, {WS}) AS order_id, {TYPED['sales']} AS sales, "
                           f"{TYPED['quantity']} AS quantity, {TYPED['discount']} AS discount, "
                           f"{TYPED['profit']} AS profit FROM raw")
    c["dedupe_rows"] = f"{RAW}\nSELECT DISTINCT * FROM raw"
    full = ", ".join(f"{TYPED[n]} AS {n}" if n in TYPED else f"trim({n}, {WS}) AS {n}" for n in RAW_NAMES)
    c["clean_order_lines"] = f"{RAW}\nSELECT DISTINCT {full} FROM raw WHERE {not_empty}"
    as_text = {"order_id", "customer_id", "postal_code", "product_id"}
    cols = []
    for n in ORDER_LINE_NAMES:
        if n in as_text:
            cols.append(f"CAST({n} AS VARCHAR) AS {n}")
        elif n in ("sales", "profit"):
            cols.append(f"CAST({n} AS DECIMAL(28,8)) AS {n}")
        elif n == "discount":
            cols.append(f"CAST({n} AS DECIMAL(28,8)) AS {n}")
        else:
            cols.append(n)
    c["date_parse_failures"] = f"""{RAW}
SELECT COUNT(*) FILTER (WHERE {_txt('order_date')} IS NOT NULL AND {TYPED['order_date']} IS NULL) AS failed_order_dates,
  COUNT(*) FILTER (WHERE {_txt('ship_date')} IS NOT NULL AND {TYPED['ship_date']} IS NULL) AS failed_ship_dates
FROM raw"""
    c["discount_bands_from_text"] = f"""{RAW},
cleaned AS (SELECT DISTINCT {full} FROM raw WHERE {not_empty})
SELECT {BAND} AS discount_band, {_block()} FROM cleaned f GROUP BY 1"""
    c["csv_multiline_roundtrip"] = "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, nullif(source, '') AS source FROM documents"
    notes = f"WITH notes AS (SELECT o_orderkey, o_orderpriority, {ORDER_NOTE_LINE} AS record FROM orders)"
    c["csv_multiline_notes"] = f"""{notes}
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 11 = 5 THEN '5" ' ELSE '' END || o_orderpriority AS priority,
  CASE WHEN o_orderkey % 7 = 3 THEN 'one, "two"' || chr(10) || 'three, ' || o_orderkey ELSE 'note' END AS note
FROM notes WHERE o_orderkey % 50 NOT IN (1, 2)"""
    c["csv_rejected_records"] = f"""{notes}
SELECT CASE o_orderkey % 50 WHEN 1 THEN 'too few fields' ELSE 'too many fields' END AS reason, COUNT(*) AS records,
  min(o_orderkey) AS first_order, CAST(sum(o_orderkey) AS BIGINT) AS order_sum
FROM notes WHERE o_orderkey % 50 IN (1, 2) GROUP BY 1"""
    c["csv_roundtrip"] = f"WITH lines AS ({_lines_sql()}),\nclean AS ({_clean_sql('lines')})\nSELECT DISTINCT {', '.join(cols)} FROM clean"
    return c


CONFLICT_CTES = f"""WITH once AS (
  SELECT l_orderkey, {PRODUCT_CODE} AS product_id,
    CASE WHEN l_linenumber = 2 THEN p_name || ' ' ELSE p_name END AS product_name,
    p_type AS category, p_brand AS sub_category,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
    CASE WHEN (l_orderkey + l_linenumber) % 40 = 0 THEN NULL ELSE {dict(ORDER_LINE_COLUMNS)['sales']} END AS sales,
    {dict(ORDER_LINE_COLUMNS)['profit']} AS profit
  FROM {JOINED}
),
clean AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE l_orderkey % 10 = 0),
counts AS (
  SELECT product_id, COUNT(DISTINCT product_name) AS product_name, COUNT(DISTINCT category) AS category,
    COUNT(DISTINCT sub_category) AS sub_category
  FROM clean WHERE product_id IS NOT NULL GROUP BY product_id
),
conf AS (SELECT * FROM counts WHERE product_name > 1 OR category > 1 OR sub_category > 1),
per_id AS (SELECT product_id, COUNT(*) AS total_rows FROM clean WHERE product_id IS NOT NULL GROUP BY product_id),
top_ids AS (
  SELECT * FROM per_id WHERE product_id IN (SELECT product_id FROM conf)
  ORDER BY total_rows DESC, product_id LIMIT 10
),
details AS (
  SELECT product_id, product_name, category, sub_category, COUNT(*) AS number_of_rows,
    CAST(SUM(COALESCE(sales, 0)) AS DECIMAL(38,8)) AS total_sales,
    CAST(SUM(COALESCE(profit, 0)) AS DECIMAL(38,8)) AS total_profit,
    COALESCE(strftime(min(order_date), '%Y-%m-%d'), '') AS first_order_date,
    COALESCE(strftime(max(order_date), '%Y-%m-%d'), '') AS last_order_date
  FROM clean
  WHERE product_id IN (SELECT product_id FROM top_ids)
    AND product_name IS NOT NULL AND category IS NOT NULL AND sub_category IS NOT NULL
  GROUP BY product_id, product_name, category, sub_category
),
summary AS (
  SELECT product_id, CAST(SUM(number_of_rows) AS BIGINT) AS total_rows,
    CAST(SUM(total_sales) AS DECIMAL(38,8)) AS total_sales,
    CAST(SUM(total_profit) AS DECIMAL(38,8)) AS total_profit,
    min(CAST(NULLIF(first_order_date, '') AS DATE)) AS first_order_date,
    max(CAST(NULLIF(last_order_date, '') AS DATE)) AS last_order_date,
    abs(CAST(SUM(total_profit) AS DECIMAL(38,8))) AS profit_abs
  FROM details GROUP BY product_id
)"""


def _conflicts() -> dict[str, str]:
    return {
        "product_id_attribute_counts": f"{CONFLICT_CTES}\nSELECT * FROM counts",
        "product_id_conflicts": f"{CONFLICT_CTES}\nSELECT product_id, product_name, category FROM conf",
        "top_conflict_ids": f"{CONFLICT_CTES}\nSELECT * FROM top_ids",
        "conflict_details": f"{CONFLICT_CTES}\nSELECT * FROM details",
        "conflict_summary": f"{CONFLICT_CTES}\nSELECT * FROM summary",
        "conflict_summary_from_csv": f"{CONFLICT_CTES}\nSELECT * FROM summary",
        "top_conflicts_by_rows": f"{CONFLICT_CTES}\nSELECT * FROM summary ORDER BY total_rows DESC, product_id LIMIT 10",
        "top_conflicts_by_profit": f"{CONFLICT_CTES}\nSELECT * FROM summary ORDER BY profit_abs DESC, product_id LIMIT 10",
    }


DIRTY_CTES = """dirty_fact AS (
  SELECT * REPLACE (CASE WHEN sales_key % 97 <> 0 THEN customer_key END AS customer_key,
    CASE WHEN sales_key % 101 = 0 THEN product_key + 1000000000 ELSE product_key END AS product_key,
    CASE WHEN sales_key % 19 = 0 THEN 0 ELSE sales END AS sales,
    CASE WHEN sales_key % 17 = 0 THEN -0.10 WHEN sales_key % 13 <> 0 THEN discount END AS discount)
  FROM (SELECT * FROM fact_sales UNION ALL SELECT * FROM fact_sales WHERE sales_key % 103 = 0)
),
dirty_customer AS (
  SELECT * REPLACE (CASE WHEN customer_key % 77 <> 0 THEN customer_key END AS customer_key)
  FROM (SELECT * FROM dim_customer UNION ALL SELECT * FROM dim_customer WHERE customer_key % 50 = 0)
)"""


def _dirty(sql: dict[str, str]) -> dict[str, str]:
    """The same checks and views read from a star with faults. A left join to
    repeated dimension keys counts a fact row once per match, so orphans are
    looked for in the distinct keys."""
    out = {}
    for name in ("pk_violations", "fk_violations", "orphan_counts", "missing_key_counts", "control_totals",
                 "vw_executive_kpis", "vw_discount_impact", "vw_product_pareto", "vw_segment_profitability"):
        tail = sql[name][len(STAR):].replace("fact_sales", "dirty_fact").replace("dim_customer", "dirty_customer")
        out[f"{name}_dirty"] = f"{STAR},\n{DIRTY_CTES}{tail}"
    bad = """customers AS (SELECT *, concat_ws(', ', CASE WHEN customer_key IS NULL THEN 'null key' END,
    CASE WHEN customer_key IS NOT NULL AND COUNT(*) OVER (PARTITION BY customer_key) > 1 THEN 'repeated key' END) AS reason FROM dirty_customer),
good AS (SELECT customer_key FROM customers WHERE reason = ''),
facts AS (SELECT *, concat_ws(', ', CASE WHEN COUNT(*) OVER (PARTITION BY sales_key) > 1 THEN 'repeated key' END,
    CASE WHEN customer_key IS NOT NULL AND customer_key NOT IN (SELECT customer_key FROM good) THEN 'orphan customer' END,
    CASE WHEN product_key IS NOT NULL AND product_key NOT IN (SELECT product_key FROM dim_product) THEN 'orphan product' END) AS reason
  FROM dirty_fact)"""
    out["load_quarantine_dirty"] = f"""{STAR},\n{DIRTY_CTES},\n{bad}
SELECT 'dim.customer' AS table_name, CAST(customer_key AS BIGINT) AS row_key, reason FROM customers WHERE reason <> ''
UNION ALL SELECT 'fact.sales', CAST(sales_key AS BIGINT), reason FROM facts WHERE reason <> ''"""
    out["load_accepted_dirty"] = f"""{STAR},\n{DIRTY_CTES},\n{bad}
SELECT *, CAST(0 AS BIGINT) AS orphans_left FROM (
  SELECT 'dim.date' AS table_name, COUNT(*) AS row_count FROM dim_date UNION ALL SELECT 'dim.customer', COUNT(*) FROM good
  UNION ALL SELECT 'dim.product', COUNT(*) FROM dim_product UNION ALL SELECT 'dim.geography', COUNT(*) FROM dim_geography
  UNION ALL SELECT 'dim.ship_mode', COUNT(*) FROM dim_ship_mode UNION ALL SELECT 'fact.sales', COUNT(*) FROM facts WHERE reason = '')"""
    return out


STORED_VIEWS = ("vw_executive_kpis", "vw_product_profitability", "vw_segment_profitability", "vw_shipping_performance",
                "vw_product_pareto", "vw_sales_detail")


def all_sql() -> dict[str, str]:
    out = {}
    out.update(_star_tables())
    out["star_reopened_fact"] = out["fact_sales"]
    out["star_reopened_products_csv"] = out["dim_product"]
    out.update(_views())
    out.update(_quality())
    out.update(_measures())
    out.update({f"stored_{name}": out[name] for name in STORED_VIEWS})
    out.update({"rollup_by_region": out["by_region"], "rollup_by_category": out["by_category"],
                "rollup_executive_kpis": out["vw_executive_kpis"]})
    out.update(_cleaning())
    out.update(_conflicts())
    out.update(_dirty(out))
    return out
