"""Near-duplicates by a chosen-path set similarity join.

A document is its set of word shingles. Documents with equal sets are one
entry. Independent trees branch the entries recursively: a node's entries are
split by their minwise token under a function that the node's path selects,
and with the chance that makes 1 / threshold functions on average, under a
second one, so that a pair at the threshold stays together in one child per
node on average. Small nodes are compared exhaustively, larger ones split
further. All trees advance together, one level a step; an entry's path is
derived from its own signature, so a level needs no more than counts.

Two things keep large groups of near copies cheap without losing a link:
first every entry is compared with one representative of its deep nodes, and
what that links is one component; a node whose entries are all in one component
is done, and within small nodes just entries of different components are
compared, whose links leave as a spanning forest. Pairs must pass the size
bound and a sketch of the signature; links are confirmed on the full sets of
the texts.

A pair exactly at 0.8 stays together to depth 3 of a tree with 0.58, to depth
5 with 0.46; ten trees miss it with 0.0002 and 0.002, closer pairs less.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, connected_components, give_back, long_id, materialize, rows_kept, text_mark, text_or_empty

LEVELS = 4  # of a signature; each has a function and a second one
SPARE = 16  # functions of the sketch beside those of the trees
FIELDS = 32  # of two bits in a word of the sketch
FIRST = 3  # depth at which nodes are first counted
LARGEST, FEW = 1 << 22, 64  # shingles of a small node, and members that are few for any size


def shingles(text: bytes, width: int = 2) -> set[bytes]:
    """Distinct shingles of ``width`` words between ASCII white space, A-Z
    lower-cased; with fewer words the whole sequence; none without words."""
    words = text.lower().split()
    if len(words) <= width:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(width)))))


@lru_cache(maxsize=8)
def functions(trees: int, generation: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([trees, generation])
    n = 2 * LEVELS * trees + SPARE
    return rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def signature(hashes: np.ndarray, trees: int, generation: int) -> np.ndarray:
    """Minwise values of all functions over 64-bit hashes."""
    a, b = functions(trees, generation)
    short, least = (hashes >> np.uint64(16)).astype(np.uint32), np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(least, (short[at:at + 2048, None] * a + b).min(axis=0), out=least)
    return least


def sketch(least: np.ndarray) -> list[int]:
    """Two mixed bits of every function, as signed words."""
    bits = ((least * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint64)
    words = [bits[at:at + FIELDS] for at in range(0, len(bits), FIELDS)]
    return [int(np.bitwise_or.reduce(w << np.arange(0, 2 * len(w), 2, dtype=np.uint64)).view(np.int64)) for w in words]


def sketch_words(trees: int) -> int:
    return -(-(2 * LEVELS * trees + SPARE) // FIELDS)


def entry_rows(docs: DataFrame, id_col: str, text_col: str, width: int, trees: int) -> DataFrame:
    """One row per row: id, mark, n (size of the set), digest of the set (NULL
    for none), signature and sketch."""
    words = sketch_words(trees)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signs, sketches = [], [], [], []
            for text in batch.column(2).cast(pa.large_binary()):
                grams = shingles(text.as_buffer().to_pybytes(), width)
                sizes.append(len(grams))
                if not grams:
                    digests.append(None), signs.append(None), sketches.append([None] * words)
                    continue
                hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, grams)), np.uint64).reshape(-1, 2)
                least = signature(hashes[:, 0], trees, 0)
                whole = hashes[np.lexsort((hashes[:, 1], hashes[:, 0]))]
                digests.append(xxhash.xxh3_128_digest(whole.tobytes()))
                signs.append(least.tobytes())
                sketches.append(sketch(least))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary()),
                 *(pa.array([s[k] for s in sketches], pa.int64()) for k in range(words))],
                ["id", "mark", "n", "digest", "sign", *(f"s{k}" for k in range(words))])
            give_back()

    body = docs.select(long_id(id_col).alias("id"), text_mark(text_col).alias("mark"), text_or_empty(text_col).alias("t"))
    return body.mapInArrow(scan, "id long, mark long, n long, digest binary, sign binary"
                           + "".join(f", s{k} long" for k in range(words)))


def step(level: int, rate: float, trees_at: str = "tree") -> Column:
    """Children of a node at ``level`` as an array of paths: by the level's
    function, and if the path says so, by its second one."""
    def child(branch: int) -> Column:
        place = F.col(trees_at) * (8 * LEVELS) + (4 * (2 * (level % LEVELS) + branch) + 1)
        return F.xxhash64("path", F.lit(2 * level + branch), F.substring("sign", place, F.lit(4)))
    if level == 0:
        return F.array(child(0))
    second = F.pmod(F.xxhash64("path", F.lit("second")), F.lit(1 << 20)) < int((rate - 1) * (1 << 20))
    return F.when(second, F.array(child(0), child(1))).otherwise(F.array(child(0)))


def most_differing(fields: int, threshold: int) -> int:
    """Of the sketch's fields, which differ with 3/4 (1 - J), the mean at the
    threshold (in percent) and four deviations."""
    p = 0.75 * (1 - threshold / 100)
    return int(fields * p + 4 * (fields * p * (1 - p)) ** 0.5 + 1)


def near(a: str, b: str, words: int, fields: int, threshold: int) -> Column:
    """Whether sizes and sketches of two structs allow the threshold."""
    least, most = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    odd = F.lit(0x5555555555555555)
    differ = reduce(Column.__add__, (F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(odd)) for x in (
        F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}")) for k in range(words))))
    return (100 * least >= threshold * most) & (differ <= most_differing(fields, threshold))


def nodes_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole nodes, from rows sorted by path: what a batch ends, then the last."""
    held: list[pa.Table] = []
    for batch in batches:
        if not len(batch):
            continue
        new, path = pa.Table.from_batches([batch]), batch.column(0).to_numpy()
        if held and held[-1]["path"][-1].as_py() != path[0]:
            yield pa.concat_tables(held)
            held = []
        ends = np.flatnonzero(path[1:] != path[:-1])
        if len(ends):
            yield pa.concat_tables([*held, new.slice(0, int(ends[-1]) + 1)])
            new, held = new.slice(int(ends[-1]) + 1), []
        held.append(new)
    if held:
        yield pa.concat_tables(held)


def columns_of(rows: pa.Table, words: int) -> tuple[np.ndarray, ...]:
    return tuple(rows[c].to_numpy() for c in ("path", "node", "comp", "n", *(f"s{k}" for k in range(words))))


def allowed(n: np.ndarray, sketches: list[np.ndarray], x: np.ndarray | int, y: np.ndarray, most: int, threshold: int) -> np.ndarray:
    """Whether sizes and sketches allow that x and y meet the threshold."""
    differ = np.zeros(len(y), np.int64)
    for s in sketches:
        bits = s[x] ^ s[y]
        differ += np.bitwise_count((bits | (bits >> 1)) & np.int64(0x5555555555555555))
    return (differ <= most) & (100 * np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]))


def with_partners(rows: pa.Table, words: int, fields: int, threshold: int) -> pa.Table:
    """Those members that have an allowed partner in another component of their node."""
    path, _, comp, n, *sketches = columns_of(rows, words)
    some, live, gap = np.zeros(len(path), bool), np.arange(len(path)), 0
    while len(live):
        gap += 1
        live = live[:np.searchsorted(live, len(path) - gap)]
        live = live[path[live] == path[live + gap]]
        x = live[comp[live] != comp[live + gap]]
        x = x[allowed(n, sketches, x, x + gap, most_differing(fields, threshold), threshold)]
        some[x] = some[x + gap] = True
    return rows.filter(pa.array(some))


def node_links(rows: pa.Table, words: int, fields: int, threshold: int, width: int) -> Iterator[tuple[int, int]]:
    """Of one node with the texts of its members: links that connect its
    components as all links do. Each member outside the largest component is
    compared with all others; what it meets becomes one component with it."""
    _, node, comp, n, *sketches = columns_of(rows, words)
    texts = rows["text"].cast(pa.large_binary())
    hashes = [np.fromiter(map(xxhash.xxh3_64_intdigest, shingles(t.as_buffer().to_pybytes(), width)), np.uint64) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
    tokens, place = np.unique(np.concatenate(hashes), return_inverse=True)
    del hashes
    label = np.unique(comp, return_inverse=True)[1]
    for x in np.flatnonzero(label != np.bincount(label).argmax()):
        others = np.flatnonzero(label != label[x])
        others = others[allowed(n, sketches, x, others, most_differing(fields, threshold), threshold)]
        if not len(others):
            continue
        mine = np.zeros(len(tokens), bool)
        mine[place[starts[x]:starts[x + 1]]] = True
        both = np.add.reduceat(mine[place], starts[:-1], dtype=np.int64)[others]
        for y in others[100 * both >= threshold * (n[others] + n[x] - both)]:
            if label[y] != label[x]:
                grams = [shingles(texts[int(i)].as_buffer().to_pybytes(), width) for i in (x, y)]
                if 100 * len(grams[0] & grams[1]) >= threshold * len(grams[0] | grams[1]):
                    yield int(node[x]), int(node[y])
                    label[label == label[y]] = label[x]


class Join:
    """One join: where its rows are, and what it has confirmed so far."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int, threshold: int, trees: int, small: int):
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        self.width, self.threshold, self.trees, self.small = width, threshold, trees, small
        self.words, self.fields = sketch_words(trees), 2 * LEVELS * trees + SPARE
        self.carry = ["n", *(f"s{k}" for k in range(self.words))]
        self.rows = materialize(entry_rows(docs, id_col, text_col, width, trees), "path-rows")
        some = [F.first(c).alias(c) for c in ("sign", *self.carry)]
        self.entries = materialize(self.rows.filter("n > 0").groupBy("digest").agg(F.min(F.struct("id", "mark")).alias("head"), *some)
                                   .withColumn("node", F.monotonically_increasing_id()), "path-entries")
        self.links: DataFrame | None = None

    def texts(self, nodes: DataFrame) -> DataFrame:
        """``(node, text)`` of the nodes, written; rows may repeat a head."""
        heads = self.entries.join(nodes, "node", "left_semi").select("node", F.col("head.id").alias("i"), F.col("head.mark").alias("m"))
        body = self.docs.select(long_id(self.id_col).alias("i"), text_mark(self.text_col).alias("m"),
                                text_or_empty(self.text_col).alias("text"))
        found = materialize(body.join(heads, ["i", "m"]).select("node", "text"), "path-texts")
        if found.groupBy("node").count().filter("count > 1").limit(1).count():
            found = materialize(found.dropDuplicates(["node"]), "path-texts")
        return found

    def confirm(self, pairs: DataFrame) -> None:
        """Adds those of the pairs (a, b) that meet the threshold on their full sets."""
        pairs = materialize(pairs.distinct(), "path-pairs")
        if not pairs.limit(1).count():
            return
        texts = self.texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a") \
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
        met = materialize(both.filter(similar(F.col("x"), F.col("y"), self.width, self.threshold)).select("a", "b"), "path-links")
        self.links = met if self.links is None else self.links.union(met)

    def components(self) -> DataFrame:
        """``(node, comp)`` of the entries that are linked so far."""
        return materialize(connected_components(self.links).select("node", F.col("root").alias("comp")), "path-components")

    def with_components(self, rows: DataFrame) -> DataFrame:
        """Rows by node with their component (the node itself if not linked)."""
        if self.links is None:
            return rows.withColumn("comp", F.col("node"))
        return rows.join(self.components(), "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def descend(self, rows: DataFrame, first: int, last: int, rate: float, *keep: str) -> DataFrame:
        """Rows (path, tree, sign, ...) taken from level ``first`` down to ``last``."""
        for level in range(first, last):
            rows = rows.withColumn("path", F.explode(step(level, rate)))
        return rows.select("path", "tree", *keep)

    def roots(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1)))) \
            .withColumn("path", F.xxhash64("tree"))

    def with_representatives(self, members: DataFrame, filtered: bool) -> DataFrame:
        """Pairs of each member and the smallest member of its node."""
        first = F.min(F.struct("node", *self.carry) if filtered else F.struct("node")).alias("x")
        shared = members.groupBy("path").agg(first, F.count(F.lit(1)).alias("many")).filter("many > 1")
        pairs = members.withColumn("y", F.struct("node", *self.carry) if filtered else F.struct("node")) \
            .join(shared, "path").filter("x.node < y.node")
        if filtered:
            pairs = pairs.filter(near("x", "y", self.words, self.fields, self.threshold))
        return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    def run(self) -> None:
        rate = 100 / self.threshold
        sized = self.roots(self.entries.select("node", "sign"))
        self.confirm(self.with_representatives(self.descend(sized, 0, LEVELS, 1.0, "node"), False))
        keep = ["node", "comp", *self.carry]
        rows = self.with_components(self.entries.select("node", "sign", *self.carry))
        now, level, found = self.descend(self.roots(rows), 0, FIRST, rate, *keep), FIRST, []
        while True:
            mixed = now.groupBy("path").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("size"), F.min("comp").alias("u"),
                                            F.max("comp").alias("v")).filter("many > 1 and u <> v").select("path", "many", "size")
            members = materialize(now.join(mixed, "path"), "path-members")
            is_small = (F.col("many") <= self.small) & ((F.col("size") <= LARGEST) | (F.col("many") <= FEW))
            found.append(materialize(self.exhaustive(members.filter(is_small)), "path-links"))
            large = members.filter(~is_small).drop("many", "size")
            if not large.limit(1).count():
                break
            if level == FIRST:  # once more, now within their nodes
                self.confirm(self.with_representatives(large, True))
                large = self.with_components(large.drop("comp"))
            large = large.join(self.signs(large.select("node").distinct(), level // LEVELS), "node")
            now = materialize(self.descend(large, level, level + 1, rate, *keep), "path-level")
            level += 1
        self.links = reduce(DataFrame.union, found if self.links is None else [self.links, *found])

    def exhaustive(self, members: DataFrame) -> DataFrame:
        """Links of small nodes: members that the sketches leave with a partner
        get their texts, and each node is compared in one task."""
        words, fields, threshold, width = self.words, self.fields, self.threshold, self.width
        columns = ["path", "node", "comp", *self.carry]

        def by_sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in nodes_of(batches):
                yield from with_partners(rows, words, fields, threshold).to_batches()
                give_back()

        def by_text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in nodes_of(batches):
                path = rows["path"].to_numpy()
                edges = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)]
                found = [link for lo, hi in zip(edges, edges[1:])
                         for link in node_links(rows.slice(lo, hi - lo), words, fields, threshold, width)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                                                 ["a", "b"])
                give_back()

        some = materialize(members.select(*columns).repartition("path").sortWithinPartitions("path").mapInArrow(
            by_sketch, members.select(*columns).schema), "path-partners")
        if not some.limit(1).count():
            return some.selectExpr("node AS a", "node AS b")
        return some.join(self.texts(some.select("node").distinct()), "node").select(*columns, "text") \
            .repartition("path").sortWithinPartitions("path").mapInArrow(by_text, "a long, b long")

    def signs(self, nodes: DataFrame, generation: int) -> DataFrame:
        """``(node, sign)``: the first signature is written, deeper levels sign anew."""
        if not generation:
            return self.entries.join(nodes, "node", "left_semi").select("node", "sign")
        width, trees = self.width, self.trees

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                signs = []
                for text in batch.column(1).cast(pa.large_binary()):
                    grams = shingles(text.as_buffer().to_pybytes(), width)
                    signs.append(signature(np.array(list(map(xxhash.xxh3_64_intdigest, grams)), np.uint64), trees, generation).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signs, pa.binary())], ["node", "sign"])
        return self.texts(nodes).mapInArrow(scan, "node long, sign binary")

    def named(self) -> DataFrame:
        """``(digest, head)``: head is the component's smallest (id, mark)."""
        rooted = materialize(self.with_components(self.entries.select("node", "digest", "head")), "path-rooted")
        heads = rooted.groupBy("comp").agg(F.min("head").alias("least"))
        return materialize(rooted.join(heads, "comp").select("digest", F.col("least").alias("head")), "path-named")


def similar(x: Column, y: Column, width: int, threshold: int) -> Column:
    """Whether the full sets of two texts meet the threshold (in percent)."""
    @F.arrow_udf("boolean")
    def of(xs: pa.Array, ys: pa.Array) -> pa.Array:
        last: dict[int, tuple[bytes, set[bytes]]] = {}

        def grams(side: int, text: pa.Scalar) -> set[bytes]:
            raw = text.as_buffer().to_pybytes()
            if last.get(side, (None,))[0] != raw:
                last[side] = raw, shingles(raw, width)
            return last[side][1]

        out = []
        for x, y in zip(xs.cast(pa.large_binary()), ys.cast(pa.large_binary())):
            a, b = grams(0, x), grams(1, y)
            both = len(a & b)
            out.append(100 * both >= threshold * (len(a) + len(b) - both))
        give_back()
        return pa.array(out, pa.bool_())
    return of(x, y)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2,
                   threshold: int = 80, trees: int = 10, small: int = 4096) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the
    smallest id reachable over links) and kept (doc_id = component_id).

    Documents link if 100 x intersection >= threshold x union of their
    distinct shingles. NULL text counts as empty; documents without words link
    with nothing and are their own component, documents with equal sets
    always link. A NULL id is smaller than any other in choosing and shown as
    NULL (kept if its component's smallest id is NULL too). Rows that repeat
    the smallest id are all kept (see :func:`drop_similar`). Other columns are
    ignored; empty in, empty out."""
    return _grouped(docs, id_col, text_col, width, threshold, trees, small).select(
        F.expr(f"nullif(id, {NO_ID})").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.expr(f"nullif(head.id, {NO_ID})").alias("component_id"), (F.col("id") == F.col("head.id")).alias("kept"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: int, trees: int, small: int) -> DataFrame:
    """``(id, mark, n, head)``."""
    if not 50 <= threshold <= 100:
        raise ValueError("threshold must be 50 to 100 percent")
    join = Join(docs, id_col, text_col, width, threshold, trees, small)
    join.run()
    rows = join.rows.select("id", "mark", "n", "digest")
    return rows.filter("n > 0").join(join.named(), "digest").select("id", "mark", "n", "head") \
        .union(rows.filter("n = 0").select("id", "mark", "n", F.struct("id", "mark")))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2,
                 threshold: int = 80, trees: int = 10, small: int = 4096) -> DataFrame:
    """``docs`` with the row of smallest id of each component, columns as they
    were; any one of them if rows repeat it."""
    kept = _grouped(docs, id_col, text_col, width, threshold, trees, small) \
        .filter("id = head.id and mark = head.mark").select("id", "mark")
    return rows_kept(docs, kept, id_col, text_col)
