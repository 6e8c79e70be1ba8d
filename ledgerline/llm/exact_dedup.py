"""Exact duplicates by distributed MSD radix partitioning.

Documents are strings of bytes led by their length. A round splits every
open group by its next digit: the length and the first bytes at the start,
then runs of following bytes, each run ``growth`` times as wide as the one
before, so that very long texts need few rounds. A group is closed when it
has one member or its bytes have ended; members of an ended group have met
equal digits all along, hence are equal, and no digest decides anything.

Per round the digits are counted with map-side aggregation and written; the
open documents then join the counts on (group, digit). A digit that a third
of the rows share is one row on the counted side, and Spark may split the
other side. Only documents of groups still open carry their remaining bytes
to the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, ascii_lower_bytes, long_id, materialize, rows_kept, text_mark, text_or_empty


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 first: int = 64, growth: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only. NULL text
    counts as empty. keep_id is the largest id of the group; NULL ids are
    smaller than any other, and keep_id is NULL if the group has no id. Rows
    that repeat the largest id of their group are all ``kept`` (see
    :func:`drop_exact_duplicates`, which leaves one of them). Other columns
    are ignored, an empty table gives an empty result. text_sha256 (of the
    normalised text in UTF-8) is output only, nothing compares it."""
    return _groups(docs, id_col, text_col, first, growth).select(
        F.expr(f"nullif(id, {NO_ID})").alias("doc_id"), F.expr(f"nullif(keep.id, {NO_ID})").alias("keep_id"),
        F.col("n").alias("group_size"), (F.col("id") == F.col("keep.id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def _groups(docs: DataFrame, id_col: str, text_col: str, first: int, growth: int) -> DataFrame:
    """``(id, mark, keep, n, sha)``; keep is the (id, mark) that stays."""
    body = docs.select(long_id(id_col).alias("id"), text_mark(text_col).alias("mark"),
                       ascii_lower_bytes(text_or_empty(text_col)).alias("t"))
    open_ = body.select(
        "id", "mark", F.sha2("t", 256).alias("sha"), F.lit(0).cast("long").alias("g"),
        F.octet_length("t").alias("left"), F.substring("t", 1, first).alias("digit"),
        F.expr(f"substring(t, {first + 1})").alias("rest"))
    closed, width = [], first
    while True:
        groups = materialize(
            open_.groupBy("g", "left", "digit")
            .agg(F.max(F.struct("id", "mark")).alias("keep"), F.count(F.lit(1)).alias("n"))
            .withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        going = (F.col("n") > 1) & (F.col("left") > width)
        more = groups.filter(going).limit(1).count()
        split = open_.join(groups, ["g", "left", "digit"]).select(
            "id", "mark", "sha", "keep", "n", going.alias("going"), F.col("next").alias("g"),
            (F.col("left") - width).alias("left"), F.when(going, F.col("rest")).alias("rest"))
        split = materialize(split, "radix-split") if more else split
        closed.append(split.filter(~F.col("going")) if more else split)
        if not more:
            return reduce(DataFrame.union, (c.select("id", "mark", "keep", "n", "sha") for c in closed))
        width *= growth
        open_ = split.filter("going").select(
            "id", "mark", "sha", "g", "left", F.substring("rest", 1, width).alias("digit"),
            F.expr(f"substring(rest, {width + 1})").alias("rest"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they
    were: the row with the largest id, any one of them if rows repeat it."""
    kept = _groups(docs, id_col, text_col, 64, 8).filter("id = keep.id and mark = keep.mark").select("id", "mark")
    return rows_kept(docs, kept, id_col, text_col)
