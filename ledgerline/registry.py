"""The query registry: every operator of the pipeline as a function
``(spark, sf_dir) -> DataFrame`` over the driver tables.

The star for a (session, scale) is built once, written to the session's
checkpoint folder, and shared by every query that reads it."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .functions.dates import MONTH_FIRST, WHITESPACE, failed_date, parse_date
from .operators import clean as C
from .plans import conflicts as Q
from .plans import load as L
from .plans import measures as X
from .plans import quality as G
from .plans import rollup as U
from .plans import star as K
from .plans import stored as D
from .plans import views as V
from .plans.star import Star
from .session import ensure_checkpoint_dir, materialize, release_scratch, scratch_path
from .sources import fixtures as FX
from .sources.csv_records import POSITION, CsvTable, read_csv_table
from .sources.tables import read_csv, read_table, write_csv

_LOCK = threading.Lock()
_STARS: dict[tuple, Star] = {}
_VARIANTS: dict[tuple, DataFrame] = {}
_CELLS: dict[tuple, DataFrame] = {}
_STORED: dict[tuple, str] = {}
LARGE_ORDER = 100_000  # line items that one task sorts with ease


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned order lines from the driver tables."""
    return C.clean_order_lines(FX.order_lines(spark, sf_dir))


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star for this session and scale, built and written once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _STARS:
            ensure_checkpoint_dir(spark)
            lines = C.clean_order_lines(FX.order_lines(spark, sf_dir), dedupe=False)
            # The lines come placed by order, and are numbered there unless one order has very many.
            groups = "order_id" if FX.largest_order(spark, sf_dir) <= LARGE_ORDER else None
            _STARS[key] = K.build_star(lines, dedupe=True, groups=groups)
        return _STARS[key]


def forget(spark: SparkSession) -> None:
    """Drop the stars and variants kept for this session, for when their
    input has changed, and delete all written intermediates."""
    with _LOCK:
        for kept in (_STARS, _VARIANTS, _CELLS, _STORED):
            for key in [k for k in kept if k[0] == spark.sparkContext.applicationId]:
                del kept[key]
        release_scratch(spark)


def _on_star(fn: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _as_text(key: Column) -> Column:
    return key.cast("string")


def _as_clean_text(key: Column) -> Column:
    return F.btrim(key.cast("string"), F.lit(WHITESPACE))


def _raw_lines(spark: SparkSession, sf_dir: str, order: Callable[[Column], Column]) -> DataFrame:
    """Raw lines, placed by that form of their order unless one order has very many."""
    small = FX.largest_order(spark, sf_dir) <= LARGE_ORDER
    return FX.raw_order_lines(spark, sf_dir, order) if small else FX.raw_order_lines(spark, sf_dir)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.normalize_columns(FX.raw_order_lines(spark, sf_dir))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write order lines as CSV to a fresh shared folder, read them back as
    text and clean them (S1-S3)."""
    path = scratch_path(spark, "order-lines-csv")
    write_csv(FX.order_lines(spark, sf_dir), path, "gzip")
    return C.clean_order_lines(read_csv(spark, path, list(FX.ORDER_LINE_NAMES)))


def _csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, with line breaks, commas and quotes, written as
    CSV and read again by records (S1, S3)."""
    path = scratch_path(spark, "documents-csv")
    write_csv(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), path)
    return read_csv(spark, path).withColumn("doc_id", F.col("doc_id").cast("long"))


def _order_notes(spark: SparkSession, sf_dir: str) -> CsvTable:
    path = scratch_path(spark, "order-notes")
    FX.order_note_files(spark, sf_dir, path)
    return read_csv_table(spark, path)


def _csv_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the header's number of fields, some over two lines."""
    return _order_notes(spark, sf_dir).rows.withColumn("order_id", F.col("order_id").cast("long"))


def _csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records refused for their number of fields, by reason."""
    order = F.substring_index("record", ",", 1).cast("long")
    return _order_notes(spark, sf_dir).rejected.groupBy("reason").agg(
        F.count(F.lit(1)).alias("records"), F.min(order).alias("first_order"), F.sum(order).alias("order_sum"))


def file_order_star(spark: SparkSession, sf_dir: str) -> Star:
    """A star from CSV files whose lines are not in sort order: keys follow
    the order of the files, equal lines keep the first (C10, K7, K10)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "file order")
    with _LOCK:
        if key not in _STARS:
            path = scratch_path(spark, "latest-first-csv")
            write_csv(FX.order_lines_latest_first(spark, sf_dir), path, "gzip")
            raw = read_csv_table(spark, path, positions=True).rows
            _STARS[key] = K.build_star(C.clean_order_lines(raw, position=POSITION, dedupe=False), POSITION, dedupe=True)
        return _STARS[key]


def _in_file_order(dim: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = file_order_star(spark, sf_dir).tables()[dim]
        return df.withColumns({c: F.col(c).cast("long") for c in ("customer_id", "product_id", "postal_code", "order_id") if c in df.columns})
    return run


def _month_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-first date text (every 50th 'bad') parsed with month-first layouts."""
    o = read_table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 50 == 0, F.lit("bad")).otherwise(
        F.date_format("o_orderdate", "MM/dd/yyyy"))
    out = o.select(F.col("o_orderkey").alias("order_id"), text.alias("order_date_text"))
    return out.withColumn("order_date", parse_date(F.col("order_date_text"), StringType(), MONTH_FIRST))


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute variants per product code, aggregated once from the raw
    lines and written once per session and scale; all reports read them."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _VARIANTS:
            ensure_checkpoint_dir(spark)
            _VARIANTS[key] = materialize(Q.variants(FX.conflict_order_lines(spark, sf_dir)), "variants")
        return _VARIANTS[key]


def _reopened_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of a star saved to a folder and opened again."""
    folder = scratch_path(spark, "saved-star")
    K.write_star(star(spark, sf_dir), folder)
    return K.read_star(spark, folder).fact


def _reopened_products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension of a star saved as CSV and opened again."""
    st, folder = star(spark, sf_dir), scratch_path(spark, "saved-star-csv")
    K.write_star(st, folder, "csv")
    return K.read_star(spark, folder, st, "csv").product


def _failed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many non-empty date texts of the raw lines are no date."""
    raw = C.clean_strings(_raw(spark, sf_dir))
    return raw.agg(*[F.count_if(failed_date(F.col(c), StringType())).alias(f"failed_{c}s") for c in C.DATE_COLUMNS])


def dirty_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star with faults put in by rule: NULL and orphan keys, repeated
    fact rows and customers, a customer without key, zero sales, and NULL and
    negative discounts."""
    st, k = star(spark, sf_dir), F.col("sales_key")
    fact = st.fact.unionByName(st.fact.where(k % 103 == 0)).withColumns({
        "customer_key": F.when(k % 97 != 0, F.col("customer_key")),
        "product_key": F.when(k % 101 == 0, F.col("product_key") + 1_000_000_000).otherwise(F.col("product_key")),
        "sales": F.when(k % 19 == 0, F.lit(0)).otherwise(F.col("sales")).cast(st.fact.schema["sales"].dataType),
        "discount": F.when(k % 17 == 0, F.lit("-0.10").cast(st.fact.schema["discount"].dataType))
                     .when(k % 13 != 0, F.col("discount"))})
    c = st.customer.unionByName(st.customer.where(F.col("customer_key") % 50 == 0)) \
        .withColumn("customer_key", F.when(F.col("customer_key") % 77 != 0, F.col("customer_key")))
    return replace(st, fact=fact, customer=c)


def _on_dirty(fn: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(dirty_star(spark, sf_dir))


def _loaded(spark: SparkSession, sf_dir: str) -> L.Load:
    """The star with faults, loaded with its constraints kept."""
    return L.load_star(dirty_star(spark, sf_dir), scratch_path(spark, "loads"))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).quarantine.drop("row")


def _loaded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the loaded tables, and the violations left in them (none)."""
    loaded = _loaded(spark, sf_dir).star
    return G.table_row_counts(loaded).withColumn(
        "orphans_left", G.fk_violations(loaded).agg(F.sum("orphan_rows")).scalar())


def _bands_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount bands over cleaned text lines, sales with five decimals and
    discounts just over a band's end among them (C6, V8)."""
    lines = C.clean_order_lines(_raw_lines(spark, sf_dir, _as_clean_text))
    return V.discount_impact(Star(None, None, None, None, None, lines))


def _details(spark, sf_dir):
    return Q.conflict_details(_variants(spark, sf_dir))


def _summary_via_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-step report hand-off: conflict details are written as CSV,
    read back as text with typed columns (dates parsed), then summarised
    (S1-S3 with named date columns)."""
    path = scratch_path(spark, "conflict-details-csv")
    write_csv(_details(spark, sf_dir), path)
    text = read_csv(spark, path, list(Q.DETAIL_COLUMNS))
    return Q.conflict_summary(Q.details_from_text(text))


def _star_csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every star table as CSV, read each back and count its rows (S3)."""
    from functools import reduce
    base = scratch_path(spark, "star-csv")
    names = dict(zip(("dim_date", "dim_customer", "dim_product", "dim_geography", "dim_ship_mode",
                      "fact_sales"), (n for n, _, _ in G.TABLE_KEYS)))
    counts = []
    for table, df in star(spark, sf_dir).tables().items():
        write_csv(df, f"{base}/{table}", "gzip")
        back = read_csv(spark, f"{base}/{table}", df.columns)
        counts.append(back.agg(F.count(F.lit(1)).alias("row_count"))
                      .select(F.lit(names[table]).alias("table_name"), "row_count"))
    return reduce(lambda a, b: a.unionByName(b), counts)


def _sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register the star and the twelve views as temp views and query them
    with SQL (S4, S5)."""
    st = star(spark, sf_dir)
    V.register_views(st)
    # temp views live in the session that owns the star's DataFrames
    return st.fact.sparkSession.sql("""
        SELECT d.discount_band, d.total_order_lines, d.profit_margin,
               (SELECT k.total_order_lines FROM vw_executive_kpis k) AS all_lines
        FROM vw_discount_impact d""")


def stored(spark: SparkSession, sf_dir: str) -> str:
    """The catalog database that has this scale's star and views, stored once."""
    st = star(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _STORED:
            name = f"ledgerline_{uuid.uuid4().hex[:12]}"
            D.store_star(st, name, scratch_path(spark, "stored-star"))
            _STORED[key] = name
        return _STORED[key]


def _stored_view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A stored view, opened by name in a session of its own."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.newSession().table(f"{stored(spark, sf_dir)}.{name}")
    return run


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of region, category and segment with order bitmaps, written once."""
    st = star(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _CELLS:
            _CELLS[key] = U.written_cells(st)
        return _CELLS[key]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and cleaning
    "csv_roundtrip": _csv_roundtrip,
    "csv_multiline_roundtrip": _csv_multiline,
    "csv_multiline_notes": _csv_notes,
    "csv_rejected_records": _csv_rejected,
    "star_csv_roundtrip": _star_csv_counts,
    "star_reopened_fact": _reopened_fact,
    "star_reopened_products_csv": _reopened_products_csv,
    "sql_over_views": _sql_over_views,
    "date_parse_failures": _failed_dates,
    "discount_bands_from_text": _bands_from_text,
    "normalize_columns": _raw,
    "drop_empty_rows": lambda s, d: C.drop_empty_rows(_raw(s, d)),
    "clean_strings": lambda s, d: C.clean_strings(_raw(s, d)),
    "parse_dates_dayfirst": lambda s, d: C.parse_dates(_raw(s, d)).select("order_id", "order_date", "ship_date"),
    "parse_dates_monthfirst": _month_first,
    "coerce_numeric": lambda s, d: C.coerce_numeric(C.clean_strings(_raw(s, d))).select(
        "order_id", "sales", "quantity", "discount", "profit"),
    "dedupe_rows": lambda s, d: C.dedupe_rows(C.normalize_columns(_raw_lines(s, d, _as_text))),
    "clean_order_lines": lambda s, d: C.clean_order_lines(_raw_lines(s, d, _as_clean_text)),
    # star
    "date_span": lambda s, d: K.date_span(order_lines(s, d)),
    "dim_date": _on_star(lambda st: st.date),
    "dim_customer": _on_star(lambda st: st.customer),
    "dim_product": _on_star(lambda st: st.product),
    "dim_geography": _on_star(lambda st: st.geography),
    "dim_ship_mode": _on_star(lambda st: st.ship_mode),
    "fact_sales": _on_star(lambda st: st.fact),
    "dim_customer_file_order": _in_file_order("dim_customer"),
    "dim_product_file_order": _in_file_order("dim_product"),
    "dim_geography_file_order": _in_file_order("dim_geography"),
    "dim_ship_mode_file_order": _in_file_order("dim_ship_mode"),
    "fact_sales_file_order": _in_file_order("fact_sales"),
    # load checks
    "pk_violations": _on_star(G.pk_violations),
    "fk_violations": _on_star(G.fk_violations),
    "table_row_counts": _on_star(G.table_row_counts),
    "missing_key_counts": _on_star(G.missing_key_counts),
    "control_totals": _on_star(G.control_totals),
    "join_sample": _on_star(G.join_sample),
    "orphan_counts": _on_star(G.orphan_counts),
    "view_row_counts": _on_star(G.view_row_counts),
    "sales_detail_top20": _on_star(G.sales_detail_top),
    "load_quarantine_dirty": _quarantine,
    "load_accepted_dirty": _loaded_counts,
}
QUERIES.update({name: _on_star(fn) for name, fn in V.VIEWS.items()})
#: Views read from the catalog by another session.
STORED = ("vw_executive_kpis", "vw_product_profitability", "vw_segment_profitability", "vw_shipping_performance",
          "vw_product_pareto", "vw_sales_detail")
QUERIES.update({f"stored_{name}": _stored_view(name) for name in STORED})
#: Checks and views on a star with faults.
DIRTY = {"pk_violations": G.pk_violations, "fk_violations": G.fk_violations, "orphan_counts": G.orphan_counts,
         "missing_key_counts": G.missing_key_counts, "control_totals": G.control_totals,
         "vw_executive_kpis": V.executive_kpis, "vw_discount_impact": V.discount_impact,
         "vw_product_pareto": V.product_pareto, "vw_segment_profitability": V.segment_profitability}
QUERIES.update({f"{name}_dirty": _on_dirty(fn) for name, fn in DIRTY.items()})
QUERIES.update({
    # measures
    "core_measures": _on_star(X.core_measures),
    "loss_measures": _on_star(X.loss_measures),
    "discount_measures": _on_star(X.discount_measures),
    "yoy_sales": _on_star(X.yoy_sales),
    "yoy_sales_monthly": _on_star(X.yoy_sales_monthly),
    "portfolio_segments": _on_star(X.portfolio_segments),
    "portfolio_segments_by_year": _on_star(lambda st: X.portfolio_segments(st, "order_year")),
    "portfolio_segments_by_region": _on_star(lambda st: X.portfolio_segments(st, "region")),
    "portfolio_segments_in_context": _on_star(lambda st: X.portfolio_segments(X.in_context(st, region="EUROPE", segment="BUILDING"))),
    "high_sales_low_profit_by_segment": _on_star(lambda st: X.high_sales_low_profit(st, "segment")),
    "portfolio_segment_counts": _on_star(X.portfolio_segment_counts),
    "rank_customers": _on_star(X.rank_customers),
    "rank_products": _on_star(X.rank_products),
    "rank_regions": _on_star(X.rank_regions),
    "loss_concentration": _on_star(X.loss_concentration),
    "loss_by_subcategory": _on_star(X.loss_by_subcategory),
    "efficiency_measures": _on_star(X.efficiency_measures),
    "discounted_vs_full_price": _on_star(X.discounted_vs_full_price),
    # report pages
    "by_region": _on_star(X.by_region),
    "by_category": _on_star(X.by_category),
    "rollup_by_region": lambda s, d: U.roll_up(cells(s, d), "region"),
    "rollup_by_category": lambda s, d: U.roll_up(cells(s, d), "category"),
    "rollup_executive_kpis": lambda s, d: U.roll_up(cells(s, d), aov=True),
    "loss_lines_by_subcategory": _on_star(X.loss_lines_by_subcategory),
    "top_bottom_customers": _on_star(X.top_bottom_customers),
    "segment_contribution": _on_star(X.segment_contribution),
    "ship_mode_mix": _on_star(X.ship_mode_mix),
    "shipping_day_distribution": _on_star(X.shipping_day_distribution),
    "delivery_by_geography": _on_star(X.delivery_by_geography),
    "high_sales_low_profit": _on_star(X.high_sales_low_profit),
    "margin_by_discount": _on_star(X.margin_by_discount),
    # identifier conflicts
    "product_id_attribute_counts": lambda s, d: Q.attribute_counts(_variants(s, d)),
    "product_id_conflicts": lambda s, d: Q.conflict_list(_variants(s, d)),
    "top_conflict_ids": lambda s, d: Q.top_conflict_ids(_variants(s, d)),
    "conflict_details": _details,
    "conflict_summary": lambda s, d: Q.conflict_summary(_details(s, d)),
    "conflict_summary_from_csv": _summary_via_csv,
    "top_conflicts_by_rows": lambda s, d: Q.top_conflicts_by_rows(Q.conflict_summary(_details(s, d))),
    "top_conflicts_by_profit": lambda s, d: Q.top_conflicts_by_profit(Q.conflict_summary(_details(s, d))),
})
