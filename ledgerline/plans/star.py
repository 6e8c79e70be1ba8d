"""Star schema: one sales fact, a role-playing calendar, customer, product,
geography and ship-mode dimensions with surrogate keys (K1-K10).

Spark has no row order, so "order of first appearance" needs an explicit
order: ``row_order``. For files read with positions it is file order; the
default is every column of the cleaned lines, in column order, which is
total because the lines are de-duplicated. The lines are numbered once
(``_row``), written once, and all dimensions come from one aggregate over
that written copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.clean import existing, first_rows
from ..operators.lookup import lookup_key
from ..operators.ordered import ordered_index, running_sum
from ..session import materialize, materialize_bucketed, scratch_path
from ..sources.csv_records import POSITION
from ..sources.tables import write_csv

# Natural columns of the dimensions, keys and measures of the fact.
CUSTOMER_COLS = ("customer_id", "customer_name", "segment")
PRODUCT_COLS = ("product_id", "product_name", "category", "sub_category")
GEOGRAPHY_COLS = ("country", "region", "state", "city", "postal_code")
FACT_KEYS = ("order_id", "order_date_key", "ship_date_key", "customer_key",
             "product_key", "geography_key", "ship_mode_key")
MEASURES = ("sales", "quantity", "discount", "profit")
DATE_COLS = ("order_date", "ship_date")


@dataclass
class Star:
    date: DataFrame
    customer: DataFrame | None
    product: DataFrame | None
    geography: DataFrame | None
    ship_mode: DataFrame | None
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        named = {"dim_date": self.date, "dim_customer": self.customer, "dim_product": self.product,
                 "dim_geography": self.geography, "dim_ship_mode": self.ship_mode,
                 "fact_sales": self.fact}
        return {k: v for k, v in named.items() if v is not None}

    def register_views(self) -> None:
        """Expose the tables as temp views (dim_date, ..., fact_sales)."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def number_lines(lines: DataFrame, row_order: Sequence[str] | None = None) -> DataFrame:
    """Add ``_row``: 1..n in ``row_order`` (default: all columns)."""
    order = list(row_order or lines.columns)
    return ordered_index(lines, order, "_row")


def number_groups(lines: DataFrame, lead: str) -> tuple[DataFrame, DataFrame]:
    """The distinct lines with ``_row`` as :func:`number_lines` gives it for
    all columns, ``lead`` first; and the written lines below them, bucketed by
    ``lead``. Lines are ranked within their value of ``lead``, where equal
    lines stand side by side and the first stays; the running total over the
    values gives the place of each value's first line. Lines that a join on
    ``lead`` has placed stay where they are, one number a value is shuffled."""
    rank = Window.partitionBy(lead).orderBy(*(c for c in lines.columns if c != lead))
    ranked = lines.withColumns({"_n": F.row_number().over(rank), "_rank": F.rank().over(rank), "_row": F.dense_rank().over(rank)}) \
        .filter("_n = _rank").drop("_n", "_rank")
    written = materialize_bucketed(ranked, lead, "lines", "zstd")
    counts = written.groupBy(lead).agg(F.max("_row").cast("long").alias("_lines"))
    before = running_sum(counts, [lead], "_lines", "_upto").select(
        F.col(lead).alias("_lead"), (F.col("_upto") - F.col("_lines")).alias("_before"))
    # NULL comes first in the order, so nothing stands before it.
    numbered = written.join(before.hint("merge"), F.col(lead) == F.col("_lead"), "left") \
        .withColumn("_row", F.coalesce("_before", F.lit(0)) + F.col("_row")).drop("_lead", "_before")
    return numbered, written.drop("_row")


def _with_customer_key(numbered: DataFrame, lines: DataFrame, lead: str, customer: DataFrame) -> DataFrame:
    """``customer_key`` for lines that are bucketed by ``lead``: the distinct
    pairs of ``lead`` and customer meet the dimension, and go back as one row
    a value of ``lead``, so the lines themselves do not move."""
    pairs = lookup_key(lines.select(lead, "customer_id").distinct(), customer, ["customer_id"], "customer_key")
    found = F.collect_list(F.struct(F.col("customer_id").alias("id"), F.col("customer_key").alias("key")))
    known = pairs.filter(F.col(lead).isNotNull()).groupBy(F.col(lead).alias("_lead")).agg(found.alias("_known"))
    of_null = pairs.filter(F.col(lead).isNull()).select(
        F.col("customer_id").alias("_id"), F.col("customer_key").alias("_key"))
    own = F.filter("_known", lambda k: k["id"].eqNullSafe(F.col("customer_id")))
    keyed = numbered.join(known.hint("merge"), F.col(lead) == F.col("_lead"), "left") \
        .withColumn("customer_key", F.get(own, F.lit(0))["key"])
    # The lines without a value of lead are a group like the others, so few.
    return keyed.join(F.broadcast(of_null), F.col(lead).isNull() & F.col("customer_id").eqNullSafe(F.col("_id")), "left") \
        .withColumn("customer_key", F.coalesce("customer_key", "_key")).drop("_lead", "_known", "_id", "_key")


def _by_id(product: DataFrame | None) -> DataFrame | None:
    """Where each id has one product, the id is enough to find its key, and
    the other columns of the lines need not cross the exchange of the lookup."""
    if product is None or "product_id" not in product.columns:
        return product
    repeated = product.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    return product if repeated else product.select("product_id", "product_key")


def date_span(lines: DataFrame) -> DataFrame:
    """One row: earliest and latest order/ship date, distinct dates, calendar days (K1)."""
    cols = existing(lines, DATE_COLS)
    if not cols:
        raise ValueError("no order_date or ship_date column: cannot build the calendar")
    # Both dates of a line leave one pass over the lines; NULLs count in no aggregate.
    dates = lines.select(F.explode(F.array(*cols)).alias("d"))
    return dates.agg(F.min("d").alias("start_date"), F.max("d").alias("end_date"),
                     F.count_distinct("d").alias("distinct_dates"),
                     (F.datediff(F.max("d"), F.min("d")) + 1).cast("bigint").alias("calendar_days"))


def dim_date(lines: DataFrame) -> DataFrame:
    """Continuous calendar from the earliest to the latest date (K2).

    The span is one bounded aggregate; the calendar is generated from it, so
    its size depends on the number of days, not on the data volume."""
    cols = existing(lines, DATE_COLS)
    if not cols:
        raise ValueError("no order_date or ship_date column: cannot build the calendar")
    lo = [F.min(c) for c in cols]
    hi = [F.max(c) for c in cols]
    span = lines.agg((F.least(*lo) if len(lo) > 1 else lo[0]).alias("lo"),
                     (F.greatest(*hi) if len(hi) > 1 else hi[0]).alias("hi"))
    lo_hi = span.first()
    if lo_hi is None or lo_hi["lo"] is None:
        raise ValueError("every order_date and ship_date is NULL: check date parsing")
    # The span is two bounded control values; the days are generated by a
    # distributed range rather than by exploding one row inside one task.
    n_days = (lo_hi["hi"] - lo_hi["lo"]).days + 1
    days = lines.sparkSession.range(n_days).select(
        F.date_add(F.lit(lo_hi["lo"]), F.col("id").cast("int")).alias("date"))
    d = F.col("date")
    return days.select(
        d, D.date_key(d).alias("date_key"), F.year(d).alias("year"),
        D.quarter_label(d).alias("quarter"), F.month(d).alias("month"),
        D.month_name(d).alias("month_name"), F.dayofmonth(d).alias("day"),
        D.weekday_name(d).alias("weekday"))


def _dimensions(lines: DataFrame) -> dict[str, tuple[list[str], list[str]]]:
    """Of each dimension that the lines allow: the columns that make its key
    (K3-K6) and those that come from the first line."""
    found: dict[str, tuple[list[str], list[str]]] = {}
    customer = existing(lines, CUSTOMER_COLS)
    if "customer_id" in customer:
        found["customer"] = (["customer_id"], [c for c in customer if c != "customer_id"])
    for name, columns in (("product", PRODUCT_COLS), ("geography", GEOGRAPHY_COLS), ("ship_mode", ("ship_mode",))):
        if cols := existing(lines, columns):
            found[name] = (cols, [])
    return found


def _first_lines(numbered: DataFrame, found: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    """``dim``, key columns, first line and its other columns (``_attrs``) of
    every natural key of every dimension."""
    keys = list(dict.fromkeys(c for own, _ in found.values() for c in own))
    rest = list(dict.fromkeys(c for _, extra in found.values() for c in extra))
    every = list(dict.fromkeys(keys + rest))
    # grouping_id has a bit for each column, the first the highest, set where it is not grouped by.
    code = {name: sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in {*own, *extra})
            for name, (own, extra) in found.items()}
    first = numbered.select("_row", *every) \
        .groupingSets([[F.col(c) for c in dict.fromkeys(own + extra)] for own, extra in found.values()], *every) \
        .agg(F.grouping_id().alias("_set"), F.min("_row").alias("_first"))
    if rest:
        first = first.groupBy("_set", *keys).agg(F.min("_first").alias("_first"), F.min_by(F.struct(*rest), F.col("_first")).alias("_attrs"))
    if "ship_mode" in found:
        first = first.filter((F.col("_set") != code["ship_mode"]) | F.col("ship_mode").isNotNull())
    name = F.coalesce(*(F.when(F.col("_set") == c, F.lit(n)) for n, c in code.items()))
    return first.withColumn("dim", name).drop("_set")


def dimensions(numbered: DataFrame) -> dict[str, DataFrame]:
    """Customer, product, geography and ship-mode dimensions with dense keys
    1..n by first appearance (K3-K7).

    One aggregate over grouping sets takes the first line of every distinct
    tuple of every dimension, a long, so Spark hashes and need not sort the
    lines; the attributes of a key's first line come from its tuples. One range index over (dimension, first line)
    numbers them all; one write, a folder a dimension, holds them. A customer
    id has the attributes of its first line; products are distinct tuples, so
    an id with conflicting attributes has several keys; locations may hold
    NULLs; a missing ship mode is no row."""
    found = _dimensions(numbered)
    if not found:
        return {}
    indexed = ordered_index(_first_lines(numbered, found), ["dim", "_first"], "_key")
    path = scratch_path(numbered.sparkSession, "dimensions")
    indexed.write.partitionBy("dim").parquet(path)
    written = numbered.sparkSession.read.schema(indexed.schema).parquet(path)
    # A dimension's keys follow those of the dimensions before it: a row a dimension.
    before = {r["dim"]: r["least"] - 1 for r in written.groupBy("dim").agg(F.min("_key").alias("least")).collect()}
    out = {}
    for dim, (own, extra) in found.items():
        columns = [f.name for f in numbered.schema.fields if f.name in {*own, *extra}]
        own_rows = numbered.sparkSession.read.schema(indexed.drop("dim").schema).parquet(f"{path}/dim={dim}") \
            if dim in before else written.filter(F.lit(False))
        out[dim] = own_rows.select(
            *(F.col(c) if c in own else F.col(f"_attrs.{c}").alias(c) for c in _in_order(columns, dim)),
            (F.col("_key") - before.get(dim, 0)).alias(f"{dim}_key"))
    return out


def _in_order(columns: list[str], dim: str) -> list[str]:
    order = {"customer": CUSTOMER_COLS, "product": PRODUCT_COLS, "geography": GEOGRAPHY_COLS, "ship_mode": ("ship_mode",)}[dim]
    return [c for c in order if c in columns]


def dim_customer(numbered: DataFrame) -> DataFrame | None:
    """One row per customer_id with the attributes of its first line (K3)."""
    return dimensions(numbered.select("_row", *existing(numbered, CUSTOMER_COLS))).get("customer")


def dim_product(numbered: DataFrame) -> DataFrame | None:
    """Distinct (id, name, category, sub-category) tuples (K4)."""
    return dimensions(numbered.select("_row", *existing(numbered, PRODUCT_COLS))).get("product")


def dim_geography(numbered: DataFrame) -> DataFrame | None:
    """Distinct location tuples, NULLs included (K5)."""
    return dimensions(numbered.select("_row", *existing(numbered, GEOGRAPHY_COLS))).get("geography")


def dim_ship_mode(numbered: DataFrame) -> DataFrame | None:
    """Distinct non-NULL ship modes (K6)."""
    return dimensions(numbered.select("_row", *existing(numbered, ["ship_mode"]))).get("ship_mode")


def fact_sales(numbered: DataFrame, customer: DataFrame | None, product: DataFrame | None,
               geography: DataFrame | None, ship_mode: DataFrame | None) -> DataFrame:
    """Fact rows: surrogate keys and measures.

    Calendar keys are yyyyMMdd of the date itself. The calendar spans every
    non-NULL date, so a lookup would return exactly this value; computing it
    saves two joins. The other dimensions are LEFT-joined on their natural
    keys, NULL matching NULL; those that are small come first, so the exchanges
    for the large ones carry their keys in place of their columns."""
    f = numbered.withColumns({f"{c}_key": D.date_key(F.col(c)) for c in existing(numbered, DATE_COLS)})
    # dimension, key, columns matched, columns without which there is no lookup, NULL matches NULL
    lookups = ((ship_mode, "ship_mode_key", ("ship_mode",), ("ship_mode",), False),
               (geography, "geography_key", GEOGRAPHY_COLS, GEOGRAPHY_COLS[:2], True),
               (product, "product_key", PRODUCT_COLS, PRODUCT_COLS[:1], True),
               (customer, "customer_key", CUSTOMER_COLS[:1], CUSTOMER_COLS[:1], True))
    for dim, key, match, needed, null_safe in lookups:
        if dim is not None and set(needed) <= set(f.columns):
            f = lookup_key(f, dim, [c for c in existing(f, match) if c in dim.columns], key, null_safe)
    kept = existing(f, FACT_KEYS + MEASURES)
    # Lines with neither a key nor a measure pass through whole.
    return f.select(F.col("_row").alias("sales_key"), *(kept or [c for c in f.columns if c != "_row"]))


def build_star(lines: DataFrame, row_order: Sequence[str] | None = None,
               write: bool = True, dedupe: bool = False, groups: str | None = None) -> Star:
    """Cleaned order lines → star. Each table is written once (parquet in the
    shared checkpoint folder) so views read short, fixed lineages with file
    statistics, column pruning and pushdown.

    ``row_order`` names the columns of a total order, such as the positions
    that the CSV reader adds; ``dedupe`` drops repeated lines first, the first
    in that order stays. Full lines then cross one exchange, the range
    partitioning that numbers them. None at all if ``groups`` names their
    first column, by which a join has placed them; no value of it may have
    more lines than a task can sort (:func:`number_groups`)."""
    keep = (lambda df: materialize(df, "star", "zstd")) if write else (lambda df: df)
    if groups:
        if row_order or not dedupe or groups != lines.columns[0]:
            raise ValueError("groups must be the first column of lines without row_order, repeated lines are dropped")
        numbered, lines = number_groups(lines, groups)
    else:
        if dedupe:
            lines = first_rows(lines, row_order or ())
        numbered = lines = number_lines(lines, row_order).drop(*(c for c in row_order or () if c in POSITION))
    calendar = keep(dim_date(lines))
    dims = dimensions(numbered)
    customer, product, geography, ship_mode = (dims.get(d) for d in ("customer", "product", "geography", "ship_mode"))
    if groups and customer is not None:
        facts = fact_sales(_with_customer_key(numbered, lines, groups, customer), None, _by_id(product), geography, ship_mode)
    else:
        facts = fact_sales(numbered, customer, _by_id(product), geography, ship_mode)
    return Star(calendar, customer, product, geography, ship_mode, keep(facts))


def write_star(star: Star, folder: str, file_format: str = "parquet") -> None:
    """Save the star's tables in a folder of the caller's choice, one
    subfolder per table, as parquet or as CSV with a header."""
    for name, df in star.tables().items():
        path = f"{folder.rstrip('/')}/{name}"
        write_csv(df, path) if file_format == "csv" else df.write.mode("overwrite").format(file_format).save(path)


def read_star(spark: SparkSession, folder: str, like: Star | None = None, file_format: str = "parquet") -> Star:
    """Open a saved star. Files without types (CSV) take them from ``like``,
    a star of the same shape; so do the tables expected, else all six are."""
    def open_table(name: str) -> DataFrame | None:
        shape = like.tables().get(name) if like else None
        if like and shape is None:
            return None
        reader = spark.read.schema(shape.schema) if shape is not None else spark.read
        if file_format == "csv":
            reader = reader.options(header=True, quote='"', escape='"', dateFormat="yyyy-MM-dd")
        return reader.format(file_format).load(f"{folder.rstrip('/')}/{name}")
    return Star(*map(open_table, ("dim_date", "dim_customer", "dim_product", "dim_geography", "dim_ship_mode", "fact_sales")))
