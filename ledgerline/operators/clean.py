"""Cleaning of flat order lines: names, dates, strings, numbers, empty and
duplicate rows, optional columns. Every step is a narrow projection except
``dedupe_rows`` (one shuffle, with map-side de-duplication first)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.dates import DAY_FIRST, WHITESPACE, parse_date
from ..functions.names import snake_case
from ..functions.numeric import to_count, to_decimal
from ..session import materialize

DATE_COLUMNS = ("order_date", "ship_date")
MONEY_COLUMNS = ("sales", "profit")
RATE_COLUMNS = ("discount",)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake case."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def existing(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that exist, in wanted order (C11)."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def parse_dates(df: DataFrame, cols: Sequence[str] = DATE_COLUMNS, formats=DAY_FIRST) -> DataFrame:
    """Parse date text in place; bad text → NULL; absent columns skipped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for c in existing(df, cols):
        out = out.withColumn(c, parse_date(F.col(c), types[c], formats))
    return out


def clean_strings(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every string column."""
    return df.select(*[
        F.btrim(F.col(f.name), F.lit(WHITESPACE)).alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f.name) for f in df.schema.fields])


def coerce_numeric(df: DataFrame) -> DataFrame:
    """sales, profit, discount → DECIMAL or NULL; quantity → BIGINT or 0."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for c in existing(df, MONEY_COLUMNS):
        out = out.withColumn(c, to_decimal(F.col(c), types[c]))
    for c in existing(df, RATE_COLUMNS):
        out = out.withColumn(c, to_decimal(F.col(c), types[c]))
    if "quantity" in types:
        out = out.withColumn("quantity", to_count(F.col("quantity"), types["quantity"]))
    return out


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose every column is NULL."""
    return df.na.drop(how="all")


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (C10). Spark de-duplicates map-side before
    the shuffle, so even a row repeated across a third of the input ships
    at most once per map task; rows that a join has placed by one of their
    columns need no shuffle. Rows without any value are all equal and are
    taken apart, so that the others stay where they have been placed."""
    if not df.columns:
        return df.dropDuplicates()
    rows = df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # names may repeat or be odd
    some = reduce(Column.__or__, (F.col(c).isNotNull() for c in rows.columns))
    return rows.filter(some).dropDuplicates().union(rows.filter(~some).limit(1)).toDF(*df.columns)


def row_mark(cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a whole row. A hash skips NULLs, so each value is
    followed by whether it is one."""
    each = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*each), F.xxhash64(F.lit("2"), *reversed(each))]


def first_rows(df: DataFrame, position: Sequence[str] = ()) -> DataFrame:
    """Of equal rows the first by ``position`` (columns that do not count in
    comparing; without them, any one). C10 with one narrow exchange: just
    marks of 128 bits and positions are shuffled, combined in the map tasks,
    so a row that a third of the input repeats is one entry a task. Repeated
    marks are written, and the rows meet them in a join that needs no shuffle
    as long as they pass Spark's broadcast size check.

    The rows are written once, numbered by task and place: parsing and joins
    before them run once, and marks are aggregated with the number, a long,
    which Spark does by hashing. Given positions (text among them, which it
    would sort) are compared for the rows of repeated marks only."""
    cols = [c for c in df.columns if c not in position]
    df = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "lines", "zstd")
    a, b = row_mark(cols)
    marked = df.withColumns({"_a": a, "_b": b})
    repeated = materialize(
        marked.groupBy("_a", "_b").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").drop("_n"), "repeated-rows")
    if position:
        copies = marked.select("_a", "_b", "_at", *position).join(repeated.drop("_first"), ["_a", "_b"])
        repeated = materialize(copies.groupBy("_a", "_b").agg(F.min_by("_at", F.struct(*position)).alias("_first")), "repeated-rows")
    kept = marked.join(repeated, ["_a", "_b"], "left").filter(F.col("_first").isNull() | (F.col("_at") == F.col("_first")))
    return kept.select(*cols, *position)


def clean_order_lines(raw: DataFrame, date_formats=DAY_FIRST, position: Sequence[str] = (),
                      dedupe: bool = True) -> DataFrame:
    """The full cleaning pass. Unlike a row-by-row script, empty rows are
    dropped first (before any text conversion could make them non-empty),
    and strings are trimmed before dates are parsed. Columns named in
    ``position`` (file order) pass through, and equal lines keep the first.
    ``dedupe=False`` leaves the duplicates to :func:`build_star`."""
    data = [c for c in raw.columns if c not in position]
    df = raw.na.drop(how="all", subset=data).toDF(*[c if c in position else snake_case(c) for c in raw.columns])
    df = clean_strings(df)
    df = parse_dates(df, DATE_COLUMNS, date_formats)
    df = coerce_numeric(df)
    if not dedupe:
        return df
    return first_rows(df, position) if position else dedupe_rows(df)
