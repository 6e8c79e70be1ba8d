"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import math
import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..session import materialize

__all__ = ["table", "text_or_empty", "long_id", "text_mark", "ascii_lower_bytes", "free_names", "give_back", "short_batches", "rows_kept",
           "connected_components", "known_labels", "smallest", "materialize", "NO_ID"]

#: Stands for a NULL id inside the operators, so that groupings stay total.
NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(text: str) -> Column:
    """A text column in which NULL counts as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def long_id(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def text_mark(text: str) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(text_or_empty(text))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def rows_kept(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with just the rows that ``kept`` names by (id, mark), see
    :func:`long_id` and :func:`text_mark`; one of those that are repeated."""
    kept = materialize(kept.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("n")), "rows-kept")
    a, b = free_names(docs, "id", "mark")
    some = docs.withColumns({a: long_id(id_col), b: text_mark(text_col)}) \
        .join(kept.select(F.col("id").alias(a), F.col("mark").alias(b)), [a, b])
    if kept.filter("n > 1").limit(1).count():
        some = some.dropDuplicates([a, b])
    return some.select(*docs.columns)


def give_back(encoders: bool = True, tables: bool = True) -> None:
    """Return what a worker does not use to the system, as workers live on
    while their executor needs the memory for other steps: memory that Python
    and Arrow have freed, and the remembered words of tokenizers and tables of
    networks that an earlier step has left."""
    quality = sys.modules.get(f"{__package__}.quality_cnn")
    if tables and quality is not None:
        quality._last.clear()
    tokens = sys.modules.get(f"{__package__}.tokens")
    if encoders and tokens is not None and tokens._loaded:
        tokens._loaded.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def short_batches(spark: SparkSession, limit: int = 4_000_000) -> None:
    """Let the session hand texts to Python in Arrow batches of about ``limit``
    bytes at most. Spark's own bounds, 10,000 rows and 64 MB, let a batch of
    long texts grow to tens of MB, held by the executor and its worker, a few
    times over, in every task. No result depends on it; a smaller bound that
    the session has stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sql(f"SET {name}").first()["value"]
    size = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", now.strip().lower())
    if size is None or int(size[1]) << 10 * " kmgtp".index(size[2] or " ") > limit:
        spark.conf.set(name, f"{limit}b")


@F.arrow_udf(BinaryType())
def ascii_lower_bytes(text: pa.Array) -> pa.Array:
    """UTF-8 bytes of a text with A-Z, and only those, lower-cased."""
    give_back()
    return pc.ascii_lower(text).cast(pa.binary())


def known_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``(id, y)``: the label, 0 or 1, of each labelled id, one row however
    often it is repeated; ids that have both labels are left out."""
    return labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")) \
        .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull()) \
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").select("id", "y")


def smallest(rows: DataFrame, n: int, mark: str, *ties: str) -> DataFrame:
    """The ``n`` rows that come first by ``mark``, an even 64-bit hash, then by
    ``ties``. A threshold that lets about so many through is taken first, so
    that not every task sends ``n`` rows to the one that picks them."""
    share = (n + 6 * math.sqrt(n) + 6) / max(rows.count(), 1)
    while share < 1:
        some = rows.filter(F.col(mark) <= int(share * 2.0 ** 64) - 2 ** 63)
        if some.count() >= n:
            rows = some
            break
        share *= 2
    return rows.orderBy(mark, *ties).limit(n)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node on an edge: root is the smallest node
    reachable. Alternating large and small stars; each half step is written,
    so lineage stays short and a lost executor costs one half step at most.

    A node with very many neighbours is aggregated map-side to its minimum,
    and the minimum joins back to the neighbours by a plain equality join
    whose large side Spark may split; no neighbour list is ever gathered."""
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .filter("u <> v").distinct(), "links")
    mark = _fingerprint(now)
    while mark[0]:
        both = now.union(now.select("v", "u"))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                            .select("u", F.least("u", "m").alias("m")), "large-star-min")
        large = materialize(both.join(least, "u").filter("v > u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .filter("u <> v").distinct(), "large-star")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "small-star-min")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.filter("u <> v").union(least).distinct(), "small-star")
        then, mark = mark, _fingerprint(now)
        if then == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _fingerprint(links: DataFrame) -> tuple:
    """Rows and an order-free checksum: equal after a step that changed nothing.
    The links are distinct, so none cancels another; a sum of hashes as longs
    would overflow with some ten thousand links."""
    row = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")).first()
    return tuple(row)
