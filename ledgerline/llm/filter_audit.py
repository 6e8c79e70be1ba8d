"""How quality filters interact: what each removes in every order.

A table-driven byte transducer reads each text once. Its state is "between
words" or "in a word"; a table over (state, byte) gives what a byte emits: the
start or end of a word, a capital, a symbol, a code point (any byte but a
UTF-8 continuation byte), and a table over the byte the state that follows.
As the next state depends on the byte alone, a whole run of bytes goes
through the tables at once, and the state is carried from run to run. Words
come out as spans; the spans of a text go into a hash table that compares the
bytes whenever hashes meet, so that distinct words are counted exactly.

On Spark the texts leave one narrow row each: id, part, digest and the
filters that fail. Equal texts are found by the digest with map-side
aggregation, and all orders of the filters are derived from the counts by
(part, failing filters), at most 32 a part.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, long_id, materialize, text_or_empty

LETTERS = "ABCDE"
START, END, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8, 16
SPACE = b" \t\n\v\f\r"
RUN = 1 << 20


def transducer(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(after, emit)``: the state after each byte (1: in a word), and what
    byte b emits in state s, at s * 256 + b."""
    byte = np.arange(256)
    after = (~np.isin(byte, list(SPACE))).astype(np.uint8)
    plain = np.where((byte & 0xC0) != 0x80, POINT, 0) | np.where((byte >= 65) & (byte <= 90), CAPITAL, 0) \
        | np.where(np.isin(byte, list(symbols)), SYMBOL, 0)
    emit = np.concatenate([plain | np.where(after == 1, START, 0), plain | np.where(after == 0, END, 0)])
    return after, emit.astype(np.uint8)


def text_counts(data: np.ndarray, bounds: np.ndarray, symbols: bytes) -> list[np.ndarray]:
    """Words, distinct words, capitals, symbols and code points of the texts
    ``data[bounds[i]:bounds[i + 1]]``."""
    after, emit = transducer(symbols)
    n = len(bounds) - 1
    totals = {kind: np.zeros(n, np.int64) for kind in (CAPITAL, SYMBOL, POINT)}
    starts, ends = [], []
    for lo in range(int(bounds[0]), int(bounds[-1]), RUN):
        run = data[lo:min(lo + RUN, int(bounds[-1]))]
        state = np.empty(len(run), np.uint16)
        state[1:] = after[run[:-1]]
        state[0] = after[data[lo - 1]] if lo else 0
        fresh = bounds[np.searchsorted(bounds, lo):np.searchsorted(bounds, lo + len(run))]
        state[fresh - lo] = 0  # each text starts between words
        out = emit[state * 256 + run]
        for kind, total in totals.items():
            total += np.diff(np.searchsorted(np.flatnonzero(out & kind) + lo, bounds))
        starts.append(np.flatnonzero(out & START) + lo)
        ends.append(np.flatnonzero(out & END) + lo)
    last = bounds[1:][np.diff(bounds) > 0]
    ends.append(last[after[data[last - 1]] == 1])  # a text's end ends its word
    first = np.concatenate(starts or [np.zeros(0, np.int64)])
    stop = np.sort(np.concatenate(ends))
    cuts = np.searchsorted(first, bounds)
    distinct, base = np.zeros(n, np.int64), int(bounds[0])
    raw, a, b = data[base:int(bounds[-1])].tobytes(), (first - base).tolist(), (stop - base).tolist()
    for i in range(n):
        lo, hi = cuts[i], cuts[i + 1]
        distinct[i] = len({raw[s:e] for s, e in zip(a[lo:hi], b[lo:hi])})
    return [np.diff(cuts), distinct, totals[CAPITAL], totals[SYMBOL], totals[POINT]]


def counted(texts: pa.Array, symbols: bytes) -> list[np.ndarray]:
    """:func:`text_counts` of an Arrow array of texts, some runs of bytes at a time."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return [np.zeros(0, np.int64)] * 5
    _, offsets, body = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    found, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + RUN, "right")) - 1)
        found.append(text_counts(data, bounds[at:to + 1], symbols))
        at = to
    return [np.concatenate(column) for column in zip(*found)]


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                   least_words: int = 50, distinct_percent: int = 65, capital_percent: int = 5,
                   symbols: str = "#$%&*|") -> DataFrame:
    """One row per row of ``docs``: id (NULL as the smallest), part, digest of
    the text and the bits of the filters A to D that it fails."""
    marks = symbols.encode()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, distinct, capitals, found, points = counted(batch.column(3), marks)
            mask = (words < least_words) + 2 * (100 * distinct < distinct_percent * words) \
                + 4 * (100 * capitals > capital_percent * points) + 8 * (found > 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(mask.astype(np.int32))],
                                             ["id", "part", "digest", "mask"])
            give_back()

    body = docs.select(long_id(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"),
                       text_or_empty(text_col).alias("text"))
    return body.mapInArrow(scan, "id long, part string, digest binary, mask int")


def steps() -> list[dict]:
    """Each order and step: the bit of its filter and the bits of those before."""
    bit = {letter: 1 << k for k, letter in enumerate(LETTERS)}
    return [{"filter_order": "".join(order), "step": k + 1, "bit": bit[letter], "before": sum(bit[x] for x in order[:k])}
            for order in permutations(LETTERS) for k, letter in enumerate(order)]


def filter_interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        part_col: str = "source", **limits) -> DataFrame:
    """One row per part, order of the five filters and step: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost and shapley, as numbers of
    documents of the part: those left after the step, those its filter takes,
    those it would take that went before, those that fail it alone, labelled
    good or toxic ones it takes, and what it takes at any step in all orders.
    A: few words; B: few distinct ones; C: many capitals; D: a symbol; E: copies.

    NULL text counts as empty, a NULL part as the empty string. A NULL id is
    smaller than any other and has no label. E fails where a smaller id has
    the same text; rows that repeat the smallest id do not fail it. A document
    counts as good (toxic) if any of its label rows says so, so that repeated
    label rows count once; NULL labels say nothing. No documents give no rows.
    Other columns are ignored."""
    rows = materialize(failed_filters(docs, id_col, text_col, part_col, **limits), "filter-fails")
    first = rows.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")) \
        .filter("copies > 1").select("digest", "least")
    says = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).filter("good or toxic")
    failing = F.col("mask") + F.when(F.col("id") > F.col("least"), 16).otherwise(0)
    counts = materialize(
        rows.join(first, "digest", "left").join(says, "id", "left")
        .groupBy("part", failing.alias("fails"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")),
        "filter-counts")
    plan = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order string, step int, bit int, before int>>")
    at = counts.select("*", F.inline(plan))
    fails_it = F.col("fails").bitwiseAND(F.col("bit")) != 0
    went = F.col("fails").bitwiseAND(F.col("before")) != 0
    here = fails_it & ~went

    def total(rule, value: str = "n"):
        return F.sum(F.when(rule, F.col(value)).otherwise(0)).cast("long")

    return at.groupBy("part", "filter_order", "step").agg(
        total(~fails_it & ~went).alias("kept"), total(here).alias("removed"), total(fails_it & went).alias("redundant"),
        total(F.col("fails") == F.col("bit")).alias("unique_fails"), total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        # Of the 120 orders, each of m failing filters comes first among them in 120 / m.
        F.sum(F.when(fails_it, F.expr(f"n * ({len(steps()) // len(LETTERS)} div bit_count(fails))")).otherwise(0))
        .cast("long").alias("shapley"))
