"""Vector bin packing of examples into training sequences.

A sequence has three capacities: tokens, segments and loss-bearing tokens.
Each task packs its own partition as it reads it, so packing needs no
shuffle. Parts of a document that fill a sequence alone are cut off; the
rest of it waits in a pool of bounded size. The dot-product heuristic fills
one sequence at a time: of the examples that fit in every capacity, the one
whose demand has the largest dot product with the capacity left goes in,
both as shares of the whole. When none fits, the example of largest demand
is cut to fill what is left. Only the last sequence of a task stays short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, text_or_empty
from .tokens import encoder, in_small_batches

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long")
END_ID = 0


class Pool:
    """Examples that wait to be placed: ``(doc_id, start, ids, tokens of the
    document, first loss-bearing position)``, their demands as columns."""

    def __init__(self, limits: tuple[int, int, int], size: int, least: int):
        self.limits, self.size, self.least = np.array(limits, float), size, least
        self.items: list = [None] * size
        self.demand = np.full((size, 3), np.inf)
        self.free = list(range(size))

    def full(self) -> bool:
        return not self.free

    def empty(self) -> bool:
        return len(self.free) == self.size

    def add(self, item: tuple) -> None:
        at = self.free.pop()
        self.items[at] = item
        n = len(item[2]) // 4
        self.demand[at] = n, 1, loss(item, n)

    def take(self, at: int) -> tuple:
        item, self.items[at] = self.items[at], None
        self.demand[at] = np.inf
        self.free.append(at)
        return item

    def sequence(self) -> list[tuple]:
        """The examples of one sequence, in the order placed."""
        left, out = self.limits.copy(), []
        while not self.empty() and left[0] > 0 and left[1] > 0:
            fits = np.flatnonzero((self.demand <= left).all(axis=1))
            if len(fits):
                gain = (self.demand[fits] / self.limits) @ (left / self.limits)
                at = int(fits[gain.argmax()])
                left -= self.demand[at]
                out.append(self.take(at))
                continue
            waiting = np.flatnonzero(np.isfinite(self.demand[:, 0]))
            at = int(waiting[self.demand[waiting, 0].argmax()])
            item = self.take(at)
            cut = room(item, int(left[0]), int(left[2]))
            if cut < (self.least if out else 1):
                self.add(item)
                break
            out.append(item[:2] + (item[2][:4 * cut],) + item[3:])
            self.add((item[0], item[1] + cut, item[2][4 * cut:]) + item[3:])
            break
        return out


def loss(item: tuple, n: int) -> int:
    """Loss-bearing tokens among the first n of a piece."""
    return max(0, item[1] + n - max(item[1], item[4]))


def room(item: tuple, tokens: int, bearing: int) -> int:
    """How many of its first tokens fit into tokens and loss-bearing tokens."""
    return min(tokens, len(item[2]) // 4, max(0, item[4] - item[1]) + bearing)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         prompt_col: str | None = None, length: int = 1024, max_segments: int = 64,
         max_loss: int = 1024, pool: int = 1024, least: int = 8, with_ids: bool = False,
         remember: int = 500_000, release: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, loss_tokens, and ids (binary, little-endian unsigned
    32-bit) if asked for.

    A document is the ids of its prompt, if a prompt column is named, and of
    its text, each NULL counting as empty, and end id 0. Ids of the prompt
    bear no loss, nor does a document's first id, which nothing precedes.
    Every id lies in one piece; pieces of a sequence lie gapless from offset
    0. A cut shorter than ``least`` is not made. NULL ids and repeated rows
    are packed like others; other columns are ignored; an empty table gives
    no pieces. ``remember`` bounds the words whose ids a worker keeps; with
    ``release`` it keeps them and the tokenizer to the end of a task only, as
    an executor may have more workers than tasks at a time (both memory for
    time, the same result). Sequence ids are unique and, for the same
    partitions of input, the same in every run."""
    if min(length, max_segments, max_loss, pool) < 1:
        raise ValueError("every limit must be at least 1")

    limits = length, max_segments, max_loss

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = read_items(batches, tokenizer, prompt_col is not None, remember)
        yield from place_items(items, limits, pool, least, with_ids, TaskContext.get().partitionId() << 33)
        if release:
            items = None
            give_back()

    prompt = text_or_empty(prompt_col) if prompt_col else F.lit("")
    return docs.select(F.col(id_col).cast("long"), prompt.alias("prompt"), text_or_empty(text_col).alias("text")) \
        .mapInArrow(place, SCHEMA + (", ids binary" if with_ids else ""))


def read_items(batches: Iterator[pa.RecordBatch], tokenizer: str, prompts: bool,
               remember: int = 500_000) -> Iterator[tuple]:
    """``(doc_id, 0, ids, number of ids, first loss-bearing position)`` of
    each row ``(doc_id, prompt, text)``. Texts are encoded together while
    their words are not many more than those to remember."""
    code, end = encoder(tokenizer, remember), np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        give_back(encoders=False)
        doc_ids, texts = batch.column(0).to_pylist(), batch.column(2)
        sizes = pc.binary_length(texts).to_pylist()
        for some in in_small_batches(range(len(doc_ids)), sizes.__getitem__, min(2_000_000, 10 * remember)):
            cut = slice(some[0], some[-1] + 1)
            heads = code.encode(batch.column(1)[cut].to_pylist()) if prompts else [b""] * len(some)
            for doc, head, body in zip(doc_ids[cut], heads, code.encode(texts[cut].to_pylist())):
                whole = head + body + end
                yield doc, 0, whole, len(whole) // 4, max(1, len(head) // 4)


def place_items(items: Iterator[tuple], limits: tuple[int, int, int], pool: int, least: int, with_ids: bool,
                number: int) -> Iterator[pa.RecordBatch]:
    """Rows of pieces; sequences are numbered from ``number`` on."""
    waiting, rows = Pool(limits, pool, least), []
    length, _, max_loss = limits

    def emit(pieces: list[tuple]) -> None:
        nonlocal number
        offset = 0
        for p in pieces:
            n = len(p[2]) // 4
            rows.append((p[0], p[1], n, zlib.crc32(p[2]), p[3], number, offset, loss(p, n)) + ((p[2],) if with_ids else ()))
            offset += n
        number += 1

    for doc, _, ids, total, bearing in items:
        at, n = 0, len(ids) // 4
        while at < n:
            cut = min(length, n - at, max(0, bearing - at) + max_loss)
            if cut < length and cut == n - at:
                waiting.add((doc, at, ids[4 * at:], total, bearing))
            else:
                emit([(doc, at, ids[4 * at:4 * (at + cut)], total, bearing)])
            at += cut
        if waiting.full():
            while len(waiting.free) < pool // 2:
                emit(waiting.sequence())
        if len(rows) >= 20_000:
            yield _batch(rows, with_ids)
            rows.clear()
    while not waiting.empty():
        emit(waiting.sequence())
    if rows:
        yield _batch(rows, with_ids)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [f.split()[0] for f in SCHEMA.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64()] * 8 + [pa.binary()] * with_ids
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
