"""Quality classifier: a byte-level convolutional network in numpy.

Filters slide over the bytes of the whole document. Their responses are
max-pooled over overlapping chunks (two neighbouring halves each), a small
hidden layer turns the pooled chunk into a logit, and the mean over the
chunks gives the document's one probability. A filter over one-hot bytes is
a sum of table rows; two neighbouring bytes share one table when scoring.

Training uses a bounded, balanced sample of the labelled rows that are not
held out, collected as bytes; scoring runs in the tasks over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, known_labels, smallest, text_or_empty
from .tokens import in_small_batches

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
BLOCK = 1 << 16


@dataclass
class Network:
    filters: np.ndarray  # (width, 256, filters)
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    shift: float  # log odds added for the classes' true shares
    half: int = 512

    def parts(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.hidden, self.hidden_bias, self.out]

    def pair_tables(self) -> list[np.ndarray]:
        f = self.filters
        return [np.ascontiguousarray((f[j][:, None] + f[j + 1][None]).reshape(1 << 16, -1)) for j in range(0, len(f), 2)]

    def chunk_logits(self, chunks: np.ndarray) -> np.ndarray:
        return np.maximum(chunks @ self.hidden + self.hidden_bias, 0) @ self.out[:-1] + self.out[-1]


def halves_of(data: bytes, half: int) -> int:
    return max(1, -(-len(data) // half))


def pooled(net: Network, tables: list[np.ndarray], docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Filter maxima of every half of every document, and halves per document."""
    width, pad = len(net.filters), b"\0" * len(net.filters)
    flat = np.frombuffer(b"".join((d or b"\0") + pad for d in docs), np.uint8)
    starts, counts, at = [], [], 0
    for d in docs:
        n = halves_of(d, net.half)
        starts += range(at, at + n * net.half, net.half)
        ends = at + max(len(d), 1)
        starts.append(ends)  # the gap after a document is pooled too and dropped below
        counts.append(n)
        at = ends + width
    starts = np.array(starts)
    pairs = flat[:-1].astype(np.uint16) << 8 | flat[1:]
    maxima = np.full((len(starts), net.bias.size), -np.inf, np.float32)
    n = len(pairs) - width + 2
    for lo in range(0, n, BLOCK):
        hi = min(lo + BLOCK, n)
        response = tables[0][pairs[lo:hi]]
        for j, t in enumerate(tables[1:], 1):
            response += t[pairs[lo + 2 * j:hi + 2 * j]]
        first, last = np.searchsorted(starts, [lo, hi - 1], "right") - 1
        cuts = np.maximum(starts[first:last + 1] - lo, 0)
        maxima[first:last + 1] = np.maximum(maxima[first:last + 1], np.maximum.reduceat(response, cuts, axis=0))
    keep = np.ones(len(starts), bool)
    keep[np.cumsum(np.array(counts) + 1) - 1] = False
    return np.maximum(maxima[keep] + net.bias, 0), np.array(counts)


def chunk_rows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each chunk its two halves and its document: neighbouring halves,
    the one half twice where there is no other."""
    docs = np.repeat(np.arange(len(counts)), np.maximum(counts - 1, 1))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    within = np.arange(len(docs)) - np.searchsorted(docs, docs)
    left = first[docs] + within
    return left, left + (counts[docs] > 1), docs


def score(net: Network, tables: list[np.ndarray], docs: list[bytes]) -> np.ndarray:
    halves, counts = pooled(net, tables, docs)
    left, right, of = chunk_rows(counts)
    logits = net.chunk_logits(np.maximum(halves[left], halves[right]))
    mean = np.bincount(of, logits, len(docs)) / np.bincount(of, minlength=len(docs))
    return 1 / (1 + np.exp(-np.clip(mean + net.shift, -60, 60)))


def score_texts(net: Network, tables: list[np.ndarray], texts: pa.Array, limit: int = 1_000_000) -> np.ndarray:
    """Scores of a batch, some texts of about ``limit`` bytes at a time."""
    give_back(tables=False)
    sizes, out = pc.binary_length(texts).to_pylist(), [np.zeros(0)]
    for some in in_small_batches(range(len(sizes)), sizes.__getitem__, limit):
        part = texts.slice(some[0], len(some)).cast(pa.binary()).to_pylist()
        out.append(score(net, tables, part))
    return np.concatenate(out)


def train(texts: list[bytes], labels: list[int], share: float, filters: int = 24, width: int = 6, hidden: int = 16,
          epochs: int = 10, batch: int = 48, rate: float = 0.01, half: int = 512, seed: int = 7) -> Network:
    """Fit by Adam on the logistic loss. ``share`` is the true share of label
    1; one class alone, or no rows, gives that constant."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    net = Network(draw(width, 256, filters, scale=0.3), np.zeros(filters, np.float32),
                  draw(filters, hidden, scale=filters ** -0.5), np.zeros(hidden, np.float32),
                  np.append(draw(hidden, scale=hidden ** -0.5), np.float32(0)), 0.0, half)
    ones = sum(labels)
    if not 0 < ones < len(labels):
        net.out[:] = 0
        net.shift = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return net
    y = np.array(labels, np.float32)
    weights = np.where(y == 1, 0.5 / ones, 0.5 / (len(y) - ones)) * len(y)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            grads = _gradients(net, [texts[i] for i in some], y[some], weights[some].astype(np.float32))
            step += 1
            now = rate * min(1.0, 2.0 * (1 - epoch / epochs) + 0.05)
            for p, g, (m, v) in zip(net.parts(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    net.shift = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    return net


def _gradients(net: Network, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    width, half, n_filters = len(net.filters), net.half, net.bias.size
    counts = np.array([halves_of(t, half) for t in texts])
    windows = np.zeros((counts.sum(), half + width - 1), np.uint8)
    valid = np.zeros(len(windows), np.int64)
    at = 0
    for t, n in zip(texts, counts):
        whole = np.frombuffer((t or b"\0").ljust(n * half + width - 1, b"\0"), np.uint8)
        for i in range(n):
            windows[at] = whole[i * half:i * half + half + width - 1]
            valid[at] = min(half, max(len(t), 1) - i * half)
            at += 1
    best = np.empty((len(windows), n_filters), np.int64)
    top = np.empty((len(windows), n_filters), np.float32)
    for lo in range(0, len(windows), 64):
        w = windows[lo:lo + 64]
        response = net.filters[0][w[:, :half]]
        for j in range(1, width):
            response += net.filters[j][w[:, j:j + half]]
        response[np.arange(half) >= valid[lo:lo + 64, None]] = -np.inf
        best[lo:lo + 64] = response.argmax(axis=1)
        top[lo:lo + 64] = response.max(axis=1)
    halves = np.maximum(top + net.bias, 0)
    left, right, of = chunk_rows(counts)
    from_right = halves[right] > halves[left]
    chunks = np.where(from_right, halves[right], halves[left])
    act = np.maximum(chunks @ net.hidden + net.hidden_bias, 0)
    per = np.bincount(of, minlength=len(texts))
    logit = np.bincount(of, act @ net.out[:-1] + net.out[-1], len(texts)) / per
    error = ((1 / (1 + np.exp(-logit)) - y) * weight / len(texts)).astype(np.float32)
    d_chunk = (error / per)[of].astype(np.float32)
    d_out = np.append(d_chunk @ act, d_chunk.sum())
    d_act = d_chunk[:, None] * net.out[:-1] * (act > 0)
    d_pool = d_act @ net.hidden.T
    d_half = np.zeros_like(halves)
    np.add.at(d_half, left, d_pool * ~from_right)
    np.add.at(d_half, right, d_pool * from_right)
    d_half *= halves > 0
    d_filters = np.zeros_like(net.filters)
    rows, cols = np.nonzero(d_half)
    for j in range(width):
        np.add.at(d_filters[j], (windows[rows, best[rows, cols] + j], cols), d_half[rows, cols])
    return [d_filters, d_half.sum(axis=0), chunks.T @ d_act, d_act.sum(axis=0), d_out.astype(np.float32)]


def is_held_out(id_col: str, modulus: int, remainder: int):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", modulus: int = 3, remainder: int = 1, per_class: int = 800,
        train_bytes: int = 16_384, **shape) -> Network:
    """Train on at most ``per_class`` rows of either label, those of smallest
    id hash among the rows not held out. Of a text over ``train_bytes`` long,
    evenly spread pieces of that total length are learned from. Rows with a
    NULL id or label, ids with both labels, and labels without a document are
    not used; a repeated label counts once, and of documents that share an id
    the least text is used."""
    known = known_labels(labels, id_col, label_col).filter(~is_held_out("id", modulus, remainder))
    counts = dict(known.groupBy("y").count().collect())
    hashed = known.withColumn("h", F.xxhash64("id"))
    sample = smallest(hashed.filter("y = 0"), per_class, "h", "id").union(smallest(hashed.filter("y = 1"), per_class, "h", "id"))
    pieces, part = 16, train_bytes // 16

    @F.arrow_udf("binary")
    def spread(texts: pa.Array) -> pa.Array:
        def of(t: bytes) -> bytes:
            if len(t) <= train_bytes:
                return t
            gap = (len(t) - part) // (pieces - 1)
            return b"".join(t[i * gap:i * gap + part] for i in range(pieces))
        return pa.array([of(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t")) \
        .join(F.broadcast(sample), "id").select("id", F.struct("y", spread("t").alias("t")).alias("r")) \
        .groupBy("id").agg(F.min("r").alias("r")).orderBy("id").select("r.*").collect()  # at most twice per_class
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return train([bytes(r.t) for r in rows], [r.y for r in rows], share if counts else 0.5, **shape)


def quality_scores(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text",
                   modulus: int = 3, remainder: int = 1, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1, higher:
    label 1 likelier), predicted (1 if score >= threshold).

    NULL text counts as empty and is scored like any other; NULL ids stay and
    are not held out; repeated rows and ties score alike; only the text enters
    the score; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.pair_tables()
        for batch in batches:
            found = score_texts(net, tables, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col, modulus, remainder).alias("held_out"),
                       text_or_empty(text_col).alias("text")).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, net: Network, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored under the threshold; columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        net = shared.value
        tables = _tables(net)
        return pa.array(score_texts(net, tables, texts))

    return docs.filter(scored(text_or_empty(text_col)) >= threshold)


_last: list = []


def _tables(net: Network) -> list[np.ndarray]:
    """The pair tables of the network this worker used last."""
    if not _last or _last[0] is not net:
        _last[:] = [net, net.pair_tables()]
    return _last[1]
