"""Dimension lookups (LEFT joins on natural keys, NULL matching NULL)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_key(facts: DataFrame, dim: DataFrame, on: Sequence[str], key: str,
               null_safe: bool = True) -> DataFrame:
    """Attach ``dim[key]`` to each fact row by matching the ``on`` columns.

    ``null_safe`` uses ``<=>`` so a missing postal code matches the dimension
    row with a missing postal code. ``<=>`` is still an equi-join key, so the
    join stays a hash or sort-merge join. The join strategy is left to Spark:
    a small dimension is broadcast by the size check of
    ``autoBroadcastJoinThreshold`` (and by AQE at run time from measured
    sizes); a large one is sort-merge joined, with AQE splitting skewed keys."""
    right = dim.select(*[F.col(c).alias(f"_d_{c}") for c in on], F.col(key))
    conds = [(facts[c].eqNullSafe(right[f"_d_{c}"]) if null_safe else facts[c] == right[f"_d_{c}"])
             for c in on]
    joined = facts.join(right, reduce(lambda a, b: a & b, conds), "left")
    return joined.drop(*[f"_d_{c}" for c in on])
