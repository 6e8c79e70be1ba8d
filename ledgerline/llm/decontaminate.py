"""Benchmark decontamination: BM25 retrieval of test items by block-max WAND.

An inverted index holds the test items, cut into units of at most ``unit``
words. Every training passage, a window of each whole document, is a query;
all units whose BM25 score reaches ``share`` of their own score against
themselves are retrieved. A hit is verified on the document: the question
and the answer of the item must both be there, each with ``overlap`` of its
five-word shingles.

Impacts are divided by the unit's own score, so one threshold holds for all
units. The index is cut into blocks of neighbouring units, and the block
maxima of a passage's terms are summed for every block at once; only blocks
whose sum reaches the threshold are entered. In a block WAND runs: terms are
ordered by the unit they point at, the pivot is where the terms' maxima
reach the threshold, units before it are passed over, and the pivot's score
is taken when all terms before it have caught up.

The index is built on Spark, in parts of at most ``part_bytes`` of item
text; one part at a time is broadcast and met by all documents. Document
counts and lengths for BM25 are those of all parts together.
"""

from __future__ import annotations

import heapq
import pickle
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, free_names, give_back, long_id, materialize, text_mark, text_or_empty
from .tokens import in_small_batches

K1, B = 1.2, 0.75
SHINGLE = 5
#: Bytes that part words: white space, ASCII punctuation and controls.
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def words(text: str) -> list[bytes]:
    """Lower-cased words, parted by all that is ASCII but a letter or digit."""
    return text.lower().encode("utf-8", "replace").translate(_WORD_BYTES).split()


def question_and_answer(item: list[bytes], lines: list[list[bytes]]) -> tuple[list[bytes], list[bytes]]:
    """An item's last line is its answer and the rest its question; an item
    of one line, or with an end too short to tell, is halved. An item too
    short for two halves is both, whole."""
    if len(item) < 2 * SHINGLE:
        return item, item
    if len(lines) > 1 and min(len(lines[-1]), len(item) - len(lines[-1])) >= SHINGLE:
        return item[:-len(lines[-1])], lines[-1]
    half = (len(item) + 1) // 2
    return item[:half], item[half:]


def shingles(w: list[bytes]) -> set[tuple]:
    """Five-word shingles; the whole of a shorter text; none of an empty one."""
    if len(w) <= SHINGLE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(SHINGLE))))


class Index:
    """Inverted index over units ``(item_id, words)`` with block maxima."""

    def __init__(self, units: list[tuple[int, list[bytes]]], documents: dict[bytes, int], n: int,
                 average: float, blocks: int = 64):
        self.items = [item for item, _ in units]
        self.block = max(1, -(-len(units) // blocks))
        postings = defaultdict(list)
        for u, (_, w) in enumerate(units):
            own = {}
            for t in set(w):
                idf = np.log1p((n - documents[t] + 0.5) / (documents[t] + 0.5))
                tf = w.count(t)
                own[t] = float(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / average)))
            total = sum(own.values())
            for t, x in own.items():
                postings[t].append((u, x / total))
        self.terms = {t: i for i, t in enumerate(postings)}
        self.lists = [([u for u, _ in e], [x for _, x in e]) for e in postings.values()]
        #: Row t: the largest impact of term t in each block; the last row, of unknown words, is zero.
        #: Rounded up, so that no bound made of them lies under a score.
        self.maxima = np.zeros((len(self.lists) + 1, -(-len(units) // self.block)), np.float32)
        for t, (ids, impacts) in enumerate(self.lists):
            np.maximum.at(self.maxima[t], np.array(ids) // self.block, np.nextafter(np.float32(impacts), np.float32(2)))

    def wand(self, query: set[int], block: int, least: float) -> list[tuple[int, float]]:
        """``(unit, score)`` of the block's units scoring at least ``least``."""
        first, end = block * self.block, (block + 1) * self.block
        place, at, found = {}, [], []
        for t in query:
            if self.maxima[t, block]:
                k = place[t] = bisect_left(self.lists[t][0], first)
                at.append((self.lists[t][0][k], t))
        heapq.heapify(at)
        while at:
            front, bound = [], 0.0
            while at and (bound < least or at[0][0] == front[-1][0]):
                front.append(heapq.heappop(at))
                bound += float(self.maxima[front[-1][1], block])
            if bound < least:
                break
            pivot, score = front[-1][0], 0.0
            for _, t in front:
                ids, impacts = self.lists[t]
                k = bisect_left(ids, pivot, place[t])
                if k < len(ids) and ids[k] == pivot:
                    score += impacts[k]
                    k += 1
                place[t] = k
                if k < len(ids) and ids[k] < end:
                    heapq.heappush(at, (ids[k], t))
            if score >= least:
                found.append((pivot, score))
        return found


class Searcher:
    """An index with the items to verify against."""

    def __init__(self, index: Index, parts: dict[int, list], share: float, passage: int, overlap: float):
        self.index, self.share, self.passage, self.overlap = index, share, passage, overlap
        self.parts = {i: [(shingles(q), shingles(a)) for q, a in qa] for i, qa in parts.items()}

    def hits(self, texts: list[str]) -> list[tuple[int, int, float, float, float]]:
        """``(number of the text, item, score, question and answer overlap)``."""
        docs = [words(t) for t in texts]
        best: dict[tuple[int, int], float] = {}
        for doc, query, block in self._passages(docs):
            for unit, score in self.index.wand(query, block, self.share - 1e-9):
                key = doc, self.index.items[unit]
                best[key] = max(best.get(key, 0.0), score)
        out, there, last = [], set(), None
        for (doc, item), score in sorted(best.items()):
            if doc != last:
                last, there = doc, shingles(docs[doc])
            most = max(((_found(q, docs[doc], there), _found(a, docs[doc], there)) for q, a in self.parts[item]), key=min)
            if min(most) >= self.overlap:
                out.append((doc, item, min(score, 1.0), *most))
        return out

    def _passages(self, docs: list[list[bytes]]) -> Iterator[tuple[int, set[int], int]]:
        """Document, terms and block for every passage and block whose bound
        reaches the threshold. A passage is two neighbouring halves; a term
        counts once, where it first stands in the passage."""
        half, rows = self.passage // 2, self.index.maxima
        unknown, get = len(rows) - 1, self.index.terms.get
        known = np.fromiter((get(w, unknown) for d in docs for w in d), np.int64)
        sizes = np.array([len(d) for d in docs])
        if not len(known):
            return
        begin = np.cumsum(sizes) - sizes
        halves = -(-sizes // half)
        of = np.repeat(np.arange(len(docs)), halves)  # document of each half
        number = np.arange(len(of)) - np.repeat(np.cumsum(halves) - halves, halves)
        start = begin[of] + number * half
        mine = np.searchsorted(start, np.arange(len(known)), "right") - 1  # half of each word
        order = np.argsort(np.repeat(np.arange(len(docs)), sizes) * len(rows) + known, kind="stable")
        before = np.full(len(known), -1)
        key = of[mine] * len(rows) + known
        same = key[order[1:]] == key[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        use = known != unknown
        own = np.flatnonzero(use & (before < start[mine]))
        sums = _sums(rows, known[own], mine[own], len(of))
        more = np.flatnonzero(use & (number[mine] > 0) & (before < start[mine] - half))
        bounds = sums.copy()
        bounds[:-1] += _sums(rows, known[more], mine[more], len(of))[1:]
        bounds[(number > 0) & (number == halves[of] - 1)] = 0  # a last half is in the passage before it
        for p, block in np.argwhere(bounds >= self.share - 1e-4):
            text = of[p]
            end = min(start[p] + self.passage, begin[text] + sizes[text])
            yield int(text), set(known[start[p]:end].tolist()) - {unknown}, int(block)


def _sums(rows: np.ndarray, terms: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Sum of the terms' rows by group; groups ascend."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    for lo in range(0, len(terms), 1 << 15):
        g = groups[lo:lo + (1 << 15)]
        cuts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        out[g[cuts]] += np.add.reduceat(rows[terms[lo:lo + (1 << 15)]], cuts, axis=0)
    return out


def _found(part: set[tuple], text: list[bytes], there: set[tuple]) -> float:
    """Share of a part's shingles in a text. An empty part is found, a part
    shorter than a shingle is looked for as it is."""
    if not part:
        return 1.0
    n = len(next(iter(part)))
    if n < SHINGLE:
        there = set(zip(*(text[i:] for i in range(n))))
    return len(part & there) / len(part)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", unit: int = 64, passage: int = 128,
                 share: float = 0.6, overlap: float = 0.8, part_bytes: int = 4_000_000) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id,
    score (share of the item's own BM25 score, at most 1), question_overlap
    and answer_overlap.

    ``passage`` must be even and at least twice ``unit``, so that each run of
    a unit's words lies whole in one window. NULL texts count as empty; an empty text
    is in no document and holds no item. NULL ids stay NULL. Repeated
    documents are reported each; an item id used twice counts where either of
    its texts is found. Other columns are ignored; either table may be empty."""
    if passage < 2 * unit or passage % 2:
        raise ValueError("passage must be even and at least twice unit")
    spark = docs.sparkSession
    items = benchmark.select(long_id(item_col).alias("item"), text_or_empty(item_text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = total // part_bytes + 1

    @F.arrow_udf("array<struct<unit:int,words:array<binary>>>")
    def cut(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            w = words(t)
            n = -(-len(w) // unit)
            rows.append([{"unit": i, "words": w[len(w) * i // n:len(w) * (i + 1) // n]} for i in range(n)])
        return pa.array(rows, pa.list_(pa.struct([("unit", pa.int32()), ("words", pa.list_(pa.binary()))])))

    units = materialize(items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(n_parts)))
                        .select("part", "item", "text", F.explode(cut("text")).alias("u"))
                        .select("part", "item", "text", "u.unit", "u.words"), "bm25-units")
    n, length = units.agg(F.count(F.lit(1)), F.sum(F.size("words"))).first()
    terms = materialize(units.select("part", F.explode(F.array_distinct("words")).alias("term")), "bm25-terms")
    counts = materialize(terms.groupBy("term").agg(F.count(F.lit(1)).alias("documents")), "bm25-counts")
    found = []
    for part in range(n_parts if n else 0):
        # One part is bounded by part_bytes of text (or one longer item).
        rows = units.filter(F.col("part") == part).orderBy("item", "text", "unit").collect()
        if not rows:
            continue
        documents = {bytes(r[0]): r[1] for r in counts.join(
            terms.filter(F.col("part") == part).select("term").distinct(), "term", "left_semi").collect()}
        index = Index([(r.item, [bytes(x) for x in r.words]) for r in rows], documents, n, length / n)
        pairs = defaultdict(list)
        for item, text in sorted({(r.item, r.text) for r in rows}):
            w = words(text)
            pairs[item].append(question_and_answer(w, [x for x in map(words, text.split("\n")) if x]))
        found.append(_search(docs, spark.sparkContext.broadcast(
            pickle.dumps(Searcher(index, pairs, share, passage, overlap))), id_col, text_col))
    if not found:
        return spark.createDataFrame([], HITS)
    return reduce(DataFrame.union, found)


def _search(docs: DataFrame, packed, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = pickle.loads(packed.value)
        for batch in batches:
            give_back()
            out, ids = [], batch.column(0).to_pylist()
            for some in in_small_batches(zip(ids, batch.column(1)), lambda r: len(r[1].as_buffer()), 500_000):
                found = searcher.hits([t.as_py() for _, t in some])
                out += [(some[h[0]][0], None if h[1] == NO_ID else h[1], *h[2:]) for h in found]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 [f.split()[0] for f in HITS.split(", ")])

    return docs.select(F.col(id_col).cast("long"), text_or_empty(text_col)).mapInArrow(run, HITS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` without the rows whose text holds a test item, columns as they
    were. Rows are found again by a 64-bit mark of the text, not by id, so
    NULL or repeated ids do no harm."""
    (mark,) = free_names(docs, "mark")
    marked = docs.withColumn(mark, text_mark(text_col))
    bad = materialize(contaminated(marked, benchmark, mark, text_col, **limits)
                      .select(F.col("doc_id").alias(mark)).distinct(), "contaminated")
    return marked.join(bad, mark, "left_anti").select(*docs.columns)
