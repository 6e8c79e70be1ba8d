"""Lenient date parsing and calendar attributes as Spark column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

# Accepted text layouts, tried in order. Day-first is the
# default for order and ship dates; month-first is the default of the
# product-conflict report, which parses dates without a day-first hint.
DAY_FIRST = ("d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "yyyy-M-d", "yyyy/M/d",
             "d-M-yyyy H:m", "d/M/yyyy H:m", "yyyy-M-d H:m:s",
             "d-M-yyyy H:m:s", "d/M/yyyy H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m",
             "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd")
MONTH_FIRST = ("M/d/yyyy", "M-d-yyyy", "M.d.yyyy", "yyyy-M-d", "yyyy/M/d",
               "M/d/yyyy H:m", "M-d-yyyy H:m", "yyyy-M-d H:m:s",
               "M/d/yyyy H:m:s", "M-d-yyyy H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m",
               "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd")
WHITESPACE = " \t\n\r\x0b\x0c"


# What each part of a layout can match at most (a number may have a sign and zeros before it).
_SHAPES = {"yyyyMMdd": r"[-+]?\d{8,}", "yyyy": r"[-+]?\d{4,}", "MMMM": ".+", "MMM": ".+", "'T'": "[Tt]", **dict.fromkeys("MdHms", r"[-+]?\d+")}


def shape(layout: str) -> str:
    """A regular expression that every text in this layout matches, and few
    others: far cheaper than an attempt to parse."""
    parts = re.findall(r"yyyyMMdd|yyyy|M+|'T'|.", layout)
    return f"^{''.join(_SHAPES.get(p, re.escape(p)) for p in parts)}$"


def parse_date(col: Column, dtype, formats=DAY_FIRST) -> Column:
    """Text → DATE trying each layout; unparseable text becomes NULL.

    Dates pass through, timestamps are truncated to midnight."""
    if isinstance(dtype, DateType):
        return col
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return col.cast("date")
    text = F.btrim(col.cast(StringType()), F.lit(WHITESPACE))
    text = F.when(text != "", text)
    tries = [F.when(text.rlike(shape(fmt)), F.try_to_date(text, fmt)) for fmt in formats]
    return F.coalesce(*tries) if len(tries) > 1 else tries[0]


def failed_date(col: Column, dtype, formats=DAY_FIRST) -> Column:
    """True where a non-empty text is no date in any layout."""
    text = F.btrim(col.cast(StringType()), F.lit(WHITESPACE))
    return (text != "") & parse_date(col, dtype, formats).isNull()


def date_key(col: Column) -> Column:
    """yyyyMMdd as INT, the key of the calendar dimension."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def quarter_label(col: Column) -> Column:
    """Quarter as a period label, e.g. 2011Q1."""
    return F.concat(F.year(col).cast("string"), F.lit("Q"), F.quarter(col).cast("string"))


def month_name(col: Column) -> Column:
    return F.date_format(col, "MMMM")


def weekday_name(col: Column) -> Column:
    return F.date_format(col, "EEEE")
