"""Vector codes: product quantisation by equal-average search.

Vectors become integers and are cut into parts; each part position has a
codebook. The nearest entry is found by equal-average search: entries are
sorted by the sum of their components, the search starts where the part's own
sum falls and goes outwards on both sides, and a side ends as soon as the
squared gap of the sums, divided by the dimension, strictly exceeds the best
squared distance (which it bounds from below), so that ties are still met.
All arithmetic is on integers, hence exact.

Each round is one pass: tasks assign their vectors and add them up by part
and entry, the sums of tasks meet in a shuffle of at most parts x entries
rows a task, and the driver keeps just the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import give_back, materialize

LONG_MAX = (1 << 63) - 1
BLOCK = 4096


def to_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers where all fit with room for sums and
    squares, else as Python integers."""
    if not x.size or np.abs(x).max() * scale < 2.0 ** 29 / max(1, x.shape[1]):
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(x.shape, object)
    for at, value in np.ndenumerate(x):
        top, bottom = float(value).as_integer_ratio()
        out[at] = top * scale // bottom
    return out


class Codebook:
    """The entries of one part position, sorted by the sum of their components."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1) if entries.shape[1] else np.zeros(len(entries), np.int64)
        self.order = np.argsort(sums, kind="stable")
        self.sums, self.entries = sums[self.order], entries[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index, squared distance)`` of the nearest entry, ties to the lower index."""
        found = [self._nearest(parts[at:at + BLOCK]) for at in range(0, len(parts), BLOCK)]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, width = parts.shape
        sums = parts.sum(axis=1) if width else np.zeros(n, np.int64)
        start = np.searchsorted(self.sums, sums)
        here = np.minimum(start, len(self.sums) - 1)
        best, index = self._distance(parts, here), self.order[here]
        for step, at in ((1, start), (-1, start - 1)):
            at, rows = at.copy(), np.arange(n)
            while len(rows):
                rows = rows[(at[rows] >= 0) & (at[rows] < len(self.sums))]
                gap = self.sums[at[rows]] - sums[rows]
                rows = rows[(gap * gap <= best[rows] * width).astype(bool)]
                place = at[rows]
                distance, entry = self._distance(parts[rows], place), self.order[place]
                better = (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
                better = better.astype(bool)
                best[rows[better]], index[rows[better]] = distance[better], entry[better]
                at[rows] += step
        return index, best

    def _distance(self, parts: np.ndarray, place: np.ndarray) -> np.ndarray:
        gap = parts - self.entries[place]
        return (gap * gap).sum(axis=1) if gap.shape[1] else np.zeros(len(gap), np.int64)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), width)


def same_kind(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python integers if one is."""
    return (a.astype(object), b.astype(object)) if object in (a.dtype, b.dtype) else (a, b)


class Quantizer:
    """The codebooks of all part positions."""

    def __init__(self, entries: np.ndarray, parts: int, scale: int):
        self.entries, self.scale, self.width = entries, scale, entries.shape[1]
        edges = [self.width * i // parts for i in range(parts + 1)]
        self.spans = list(zip(edges, edges[1:]))

    def assign(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Integers, and index and squared distance of each part."""
        whole = to_integers(matrix(vectors, self.width), self.scale)
        found = []
        for lo, hi in self.spans:
            parts, entries = same_kind(whole[:, lo:hi], self.entries[:, lo:hi])
            found.append(Codebook(entries).nearest(parts))
        return whole, np.stack([i for i, _ in found], 1), np.stack([d for _, d in found], 1)

    def moved(self, sums: Iterable[tuple[int, int, int, list[str]]]) -> Quantizer:
        """Entries replaced by the means, rounded down, of their parts."""
        entries = self.entries.astype(object)
        for part, entry, count, total in sums:
            lo, hi = self.spans[part]
            entries[entry, lo:hi] = [int(x) // count for x in total]
        fits = not entries.size or max(map(abs, entries.flat)) < 2 ** 29 // max(1, self.width)
        return Quantizer(entries.astype(np.int64) if fits else entries, len(self.spans), self.scale)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        listed = (str(int(x)) for lo, hi in self.spans for entry in self.entries[:, lo:hi] for x in entry)
        return hashlib.sha256(",".join(listed).encode()).hexdigest()


SUMS = "part int, entry int, n long, total array<string>"


def _merged(sums: dict, rows: Iterable[tuple]) -> None:
    for part, entry, n, total in rows:
        had = sums.get((part, entry))
        sums[part, entry] = (n, total) if had is None else (had[0] + n, [x + y for x, y in zip(had[1], total)])


def _as_batch(sums: dict) -> pa.RecordBatch:
    keys = sorted(sums)
    return pa.RecordBatch.from_arrays([
        pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
        pa.array([sums[k][0] for k in keys], pa.int64()),
        pa.array([[str(x) for x in sums[k][1]] for k in keys], pa.list_(pa.string()))], ["part", "entry", "n", "total"])


def part_sums(kept: DataFrame, book: Quantizer) -> DataFrame:
    """Number and sum of the parts nearest to each entry."""

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            if not len(batch):
                continue
            whole, index, _ = book.assign(batch.column(0))
            for part, (lo, hi) in enumerate(book.spans):
                order = np.argsort(index[:, part], kind="stable")
                used, first, count = np.unique(index[order, part], return_index=True, return_counts=True)
                total = np.add.reduceat(whole[order, lo:hi], first, axis=0)
                _merged(sums, ((part, int(e), int(n), [int(x) for x in t]) for e, n, t in zip(used, count, total)))
            give_back()
        yield _as_batch(sums)

    def of_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            _merged(sums, ((r["part"], r["entry"], r["n"], list(map(int, r["total"]))) for r in batch.to_pylist()))
        yield _as_batch(sums)

    return kept.select("v").mapInArrow(of_task, SUMS).repartition("part", "entry").mapInArrow(of_all, SUMS)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, v, label)`` of the rows whose vector is finite throughout."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.col(label_col).alias("label"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("v").isNotNull() & ~bad)


def first_entries(kept: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the ``entries`` smallest ids, ascending: first the ids
    alone, so that only rows up to the last of them carry their vectors."""
    last = kept.select("vec_id").orderBy(F.asc_nulls_last("vec_id")).limit(entries) \
        .agg(F.max("vec_id").alias("id"), F.count("vec_id").alias("n")).first()
    few = kept if last["n"] < entries else kept.filter(F.col("vec_id") <= F.lit(last["id"]))
    order = [F.asc_nulls_last("vec_id"), F.asc("v")]
    chosen = materialize(few.select("vec_id", "v").orderBy(*order).limit(entries), "codebook")
    return [r["v"] for r in chosen.orderBy(*order).collect()]


def train(kept: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Quantizer | None:
    """Codebooks after ``rounds`` rounds over ``kept`` (None if it is empty)."""
    start = first_entries(kept, entries)
    if not start:
        return None
    book = Quantizer(to_integers(np.array(start, np.float64).reshape(len(start), -1), scale), parts, scale)
    for _ in range(rounds):
        book = book.moved(map(tuple, part_sums(kept, book).collect()))
    return book


def encode_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every row
    whose vector holds finite numbers only.

    Rows with a NULL vector, or one with NULL or non-finite components, are
    dropped; so are those whose length is not that of the vector with the
    smallest id (of the shortest, if rows repeat that id). Lengths that
    ``parts`` does not divide are cut as evenly as can be; a vector without
    components has the code of entry 0. NULL ids come last in choosing the
    first entries, rows that repeat an id in the order of their vectors; fewer
    rows than ``entries`` make smaller codebooks. Rows without a label share
    one label_error. Numbers of any size are exact, but errors and their sums
    stop at the largest long. Every row of repeated ids is returned; an empty
    table gives an empty result, other columns are ignored."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256, as a code has two hex digits a part")
    kept = usable(vectors, id_col, vector_col, label_col)
    kinds = {f.name: f for f in kept.schema.fields}
    schema = StructType([kinds["vec_id"], kinds["label"], *(StructField.fromJson(f) for f in (
        {"name": "code", "type": "string", "nullable": True, "metadata": {}},
        {"name": "error", "type": "long", "nullable": True, "metadata": {}}))])
    smallest = kept.agg(F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", F.size("v").alias("n"))).alias("s")).first()["s"]
    kept = kept.filter(F.size("v") == (smallest["n"] if smallest else 0))
    book = train(kept, parts, entries, rounds, scale)
    digest = book.digest() if book else None

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            _, index, distance = book.assign(batch.column(1))
            codes = [bytes(row).hex() for row in index.astype(np.uint8)]
            errors = [min(int(x), LONG_MAX) for x in distance.astype(object).sum(axis=1)] \
                if distance.dtype == object else distance.sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(codes, pa.string()),
                                              pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])
            give_back()

    coded = materialize(kept.select("vec_id", "v", "label").mapInArrow(code, schema), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("of")).agg(total.cast("long").alias("label_error"))
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"])) \
        .select("vec_id", "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))
