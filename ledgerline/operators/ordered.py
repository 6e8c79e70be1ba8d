"""Order-dependent operators that do not funnel data through one task.

Spark's ``Window.orderBy`` without ``partitionBy`` moves every row into a
single partition. The operators here keep the work spread out:

* rows are range-partitioned on the full, total sort order (ties in the
  leading column are split by the later ones, so a value shared by a third
  of the rows still spreads over many partitions);
* each partition does its local work (positions or a running sum);
* a table with one row per partition carries the partition offsets and is
  broadcast back. Its size is bounded by the partition count, not the data.

The sort order must be total (unique) for results to be deterministic;
callers append key columns to make it so. Partition stamps are written once
to the shared checkpoint folder (see ``tag_ranges``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from ..session import materialize

_POS_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id = row within partition


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def tag_ranges(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None,
               positions: bool = True) -> DataFrame:
    """Range-partition on ``order`` and stamp each row with its partition id
    (``_part``) and, if asked, its position inside the sorted partition
    (``_pos``), then write the result once (parquet in the shared
    checkpoint folder).

    Writing it once is what makes the stamps trustworthy: range bounds are
    sampled from the input, and an input whose row order is not fixed (any
    shuffle output) could be split differently if the plan ran twice. Every
    later step reads the written stamps, also after an executor is lost."""
    ranged = (df.repartitionByRange(partitions, *_cols(order)) if partitions
              else df.repartitionByRange(*_cols(order)))
    if positions:
        ranged = ranged.sortWithinPartitions(*_cols(order))
        tagged = ranged.select(
            "*", F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)).alias("_pos"))
    else:
        tagged = ranged.select("*", F.spark_partition_id().alias("_part"))
    return materialize(tagged, "ranges", "zstd")


def _offsets(per_part: DataFrame, value: str) -> DataFrame:
    """Exclusive prefix sum over the per-partition table (one row per partition)."""
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part", F.coalesce(F.sum(value).over(w), F.lit(0)).cast(per_part.schema[value].dataType).alias("_offset"))


def index_from_tags(tagged: DataFrame, name: str) -> DataFrame:
    """Dense 1..n index from a frame stamped by tag_ranges(positions=True)."""
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = materialize(_offsets(counts, "_n"), "offsets")  # a row per partition, read by every later use
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_pos") + F.lit(1))
            .drop("_part", "_pos", "_offset"))


def ordered_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_index",
                  partitions: int | None = None) -> DataFrame:
    """Dense 1..n position of every row under ``order`` (ROW_NUMBER over the
    whole frame). One range shuffle; positions inside a partition come from
    the sorted scan itself; the offsets table has one row per partition and
    is broadcast."""
    return index_from_tags(tag_ranges(df, order, partitions, positions=True), name)


def _added(a: str, b: str, kind: DataType) -> Column:
    """a + b; a decimal of full precision would lose its last digit to the carry."""
    if isinstance(kind, DecimalType) and kind.precision == 38:
        return F.col(a).cast(DecimalType(37, kind.scale)) + F.col(b).cast(DecimalType(37, kind.scale))
    return (F.col(a) + F.col(b)).cast(kind)


def running_sum(df: DataFrame, order: Sequence[Column | str], value: str, name: str,
                partitions: int | None = None) -> DataFrame:
    """Cumulative sum of ``value`` from the first row through the current row
    under ``order`` (ROWS frame): a window inside each range partition plus
    a broadcast table of partition offsets."""
    tagged = tag_ranges(df, order, partitions, positions=False)
    local = Window.partitionBy("_part").orderBy(*_cols(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    with_local = tagged.withColumn("_local", F.sum(value).over(local))
    totals = tagged.groupBy("_part").agg(F.sum(value).alias("_tot"))
    offsets = _offsets(totals, "_tot")
    return (with_local.join(F.broadcast(offsets), "_part")
            .withColumn(name, _added("_offset", "_local", with_local.schema["_local"].dataType))
            .drop("_part", "_local", "_offset"))


def rank_table(df: DataFrame, value: str, name: str, descending: bool = True,
               dense: bool = False, partitions: int | None = None) -> DataFrame:
    """``(value, name)``: SQL RANK (or DENSE_RANK) of each distinct value.

    rank(v) = 1 + number of rows ordered strictly before v, from the distinct
    values with their multiplicities. NULL values rank last, as in Spark."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    key = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    if dense:
        return ordered_index(counts, [key], "_r", partitions).select(value, F.col("_r").alias(name))
    run = running_sum(counts, [key], "_c", "_cum", partitions)
    return run.select(value, (F.col("_cum") - F.col("_c") + F.lit(1)).alias(name))


def rank_by(df: DataFrame, value: str, name: str, descending: bool = True,
            dense: bool = False, partitions: int | None = None, counted: DataFrame | None = None) -> DataFrame:
    """The rows with their RANK (or DENSE_RANK) by one value column, joined
    back on the value, null-safe. Ranks are counted over ``counted`` (default
    the rows themselves): pass a written table when ranking several times."""
    ranked = rank_table(df if counted is None else counted, value, name, descending, dense, partitions)
    ranked = ranked.withColumnRenamed(value, "_v")
    return df.join(ranked, df[value].eqNullSafe(ranked["_v"]), "inner").drop("_v")


def middle_values(df: DataFrame, value: str, tie_break: Sequence[str],
                  partitions: int | None = None) -> DataFrame:
    """One row (lo, hi): the middle value(s) of non-null ``value``.

    For an odd count lo = hi; for an even count they are the two central
    values, and the exact median is (lo + hi) / 2. Exact and distributed:
    rows are numbered by ordered_index and the one or two central positions
    are selected; the row count enters as a scalar subquery."""
    vals = df.where(F.col(value).isNotNull()).select(value, *tie_break)
    n = vals.select(F.count(F.lit(1))).scalar()
    idx = ordered_index(vals, [value, *tie_break], "_i", partitions)
    lo_pos = F.floor((n + F.lit(1)) / 2)
    hi_pos = F.floor((n + F.lit(2)) / 2)
    mid = idx.where((F.col("_i") == lo_pos) | (F.col("_i") == hi_pos))
    # One row, written as both bounds are read from it.
    return materialize(mid.agg(F.min(value).alias("lo"), F.max(value).alias("hi")), "middle")
