"""Exact medians by selection, per group, without sorting or copying the rows.

The middle values of a group are found by narrowing a bracket around their
ranks: quantile sketches (combined in the map tasks) propose the ends, exact
counts of what is below and inside accept them. Once a bracket holds few rows
or one value, the values left are counted by value and ranked. A group of any
size, or a value that a third of the rows share, thus never meets in a task:
tasks exchange sketches, counts and at most ``limit`` values a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

STEPS = 256


def _ranks(n: str) -> tuple[Column, Column]:
    """1-based ranks of the one or two middle rows of n."""
    return F.expr(f"({n} + 1) div 2"), F.expr(f"({n} + 2) div 2")


def _same(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> Column:
    return reduce(Column.__and__, (left[g].eqNullSafe(right[f"_{g}"]) for g in groups), F.lit(True))


def _with_state(rows: DataFrame, state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows with the columns of their group's state (one row without groups)."""
    if not groups:
        one = state.select(F.struct(*state.columns).alias("s")).scalar()
        return rows.withColumn("_s", one).select(*rows.columns, *[F.col(f"_s.{c}").alias(c) for c in state.columns])
    named = state.select(*[F.col(c).alias(f"_{c}") if c in groups else F.col(c) for c in state.columns])
    return rows.join(named, _same(rows, named, groups)).drop(*[f"_{g}" for g in groups])


def _narrowed(rows: DataFrame, state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """State (n, low, high, below, inside) with tighter brackets where the
    proposed ones hold the middle ranks, as it was elsewhere."""
    inside = _with_state(rows, state, groups).filter("_v BETWEEN low AND high")
    grid = F.array(*(F.lit(i / STEPS) for i in range(STEPS + 1)))
    keep = [F.first(c).alias(c) for c in ("n", "low", "high", "below", "inside")]
    quantiles = inside.groupBy(*groups).agg(*keep, F.percentile_approx("_v", grid, F.lit(4 * STEPS)).alias("q"))
    first, last = _ranks("n")
    lower = F.floor((first - F.col("below")) * STEPS / F.col("inside")).cast("int")  # 0-based is a step lower
    upper = F.ceil((last - F.col("below")) * STEPS / F.col("inside")).cast("int") + 2
    low, high = F.element_at("q", F.greatest(lower, F.lit(1))), F.element_at("q", F.least(upper, F.lit(STEPS + 1)))
    kind = rows.schema["_v"].dataType
    proposed = materialize(quantiles.select(*groups, "n", "low", "high", "below", "inside",
                                            low.cast(kind).alias("_low"), high.cast(kind).alias("_high")), "median-brackets")
    known = ["n", "low", "high", "below", "inside"]
    counts = _with_state(rows, proposed, groups).groupBy(*groups).agg(
        *[F.first(c).alias(c) for c in (*known, "_low", "_high")],
        F.count_if(F.col("_v") < F.col("_low")).alias("_below"),
        F.count_if(F.col("_v").between(F.col("_low"), F.col("_high"))).alias("_inside"))
    holds = (F.col("_below") < first) & (last <= F.col("_below") + F.col("_inside"))
    return materialize(counts.select(*groups, "n", *[F.when(holds, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in known[1:]],
                                     (holds & (F.col("_inside") < F.col("inside"))).alias("moved")), "median-state")


def group_middles(df: DataFrame, value: str, groups: Sequence[str] = (), limit: int = 100_000) -> DataFrame:
    """``(*groups, lo, hi)``: the middle value(s) of the non-NULL values of
    each group; lo = hi for an odd number, and the median is (lo + hi) / 2.
    Groups without a value have no row (without groups: NULLs). ``df`` is read
    several times, so pass a written table. NULL is a group like any other."""
    groups = list(groups)
    rows = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"))
    left = rows
    state = None
    if rows.count() > limit:
        state = materialize(rows.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"), F.lit(0).cast("long").alias("below"),
            F.count(F.lit(1)).alias("inside"), F.lit(True).alias("moved")), "median-state")
        while state.filter((F.col("inside") > limit) & (F.col("low") < F.col("high")) & F.col("moved")).limit(1).count():
            state = _narrowed(rows, state.drop("moved"), groups)
        left = _with_state(rows, state.select(*groups, "n", "low", "high", "below"), groups).filter("_v BETWEEN low AND high")
    known = [F.first("n").alias("n"), F.first("below").alias("below")] if state is not None else []
    values = left.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c"), *known)
    mine = Window.partitionBy(*groups)
    ranked = values.withColumn("_upto", F.sum("_c").over(mine.orderBy("_v")))
    if state is None:
        ranked = ranked.withColumns({"n": F.sum("_c").over(mine), "below": F.lit(0)})
    first, last = _ranks("n")
    upto = F.col("_upto") + F.col("below")
    return ranked.groupBy(*groups).agg(F.min(F.when(upto >= first, F.col("_v"))).alias("lo"),
                                       F.min(F.when(upto >= last, F.col("_v"))).alias("hi"))


def with_middles(df: DataFrame, values: dict[str, str], groups: Sequence[str] = (), limit: int = 100_000) -> DataFrame:
    """``df`` with a struct (lo, hi) of the middle values of its group for
    each column named in ``values`` (new name to column). One row a group is
    joined, or without groups one scalar is read."""
    for name, value in values.items():
        mid = group_middles(df, value, groups, limit).select(*groups, F.struct("lo", "hi").alias(name))
        df_columns = df.columns
        if not groups:
            df = df.withColumn(name, mid.select(name).scalar())
        else:
            named = mid.select(*[F.col(g).alias(f"_{g}") for g in groups], name)
            df = df.join(named, _same(df, named, groups), "left").select(*df_columns, name)
    return df
