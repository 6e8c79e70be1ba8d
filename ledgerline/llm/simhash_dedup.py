"""Near-duplicates by SimHash with deletion-variant signatures.

Fingerprints of 64 bits link when they differ in at most k bits. They are
cut into only k // 2 + 1 segments, so that two linked fingerprints agree in
one segment but for at most one bit; and if every segment but the last
differs in two or more, the last has k - 2 * (k // 2) bits left to differ
in. Each fingerprint is indexed under its one-wildcard variants, a segment
with one bit blanked, and, for an even k, under its last segment as it is.
An equality join on the variants gives candidates, whose distance is then
checked.

Everything works on distinct fingerprints, so any number of copies is one
entry. A variant shared by two or three fingerprints is solved by its
aggregates (minimum, maximum, exclusive or); up to ``bucket`` members are
gathered and compared; the members of larger variants are linked exactly by a second index without
pairs: two fingerprints differ in at most two bits just if their sets
"itself and each one-bit change" meet, so the at most 65 members of such a
meeting point are all linked to its smallest.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import NO_ID, connected_components, give_back, long_id, materialize, rows_kept, text_mark, text_or_empty

BITS = 64


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text: A-Z lower-cased, words between ASCII white space,
    word shingles with repeats (fewer words: the whole sequence; none: zero),
    XXH64 of each; a bit is set if it is set in over half the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    ones, n = np.zeros(BITS, np.int64), len(words) - shingle + 1
    for at in range(0, n, 16384):
        part = words[at:min(at + 16384, n) + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle)))
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = np.fromiter((digest(join(g), seed) for g in grams), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int, seed: int = 42) -> Column:
    @F.arrow_udf(LongType())
    def of(texts: pa.Array) -> pa.Array:
        give_back()
        return pa.array([_signed(fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle, seed))
                         for t in texts.cast(pa.binary())], pa.int64())
    return of(text)


def one_wildcard_variants(prints: DataFrame, max_distance: int) -> DataFrame:
    """``(fp, j, rest)``: for each bit j of a segment the segment with that
    bit blanked, and for an even distance the last segment unblanked."""
    segments = max_distance // 2 + 1
    edges = [BITS * i // segments for i in range(segments + 1)]
    spans = list(zip(edges, edges[1:]))
    whole = [spans.pop()] if max_distance % 2 == 0 else []
    masks = [(1 << hi) - (1 << lo) - (1 << j) for lo, hi in spans for j in range(lo, hi)]
    masks += [(1 << hi) - (1 << lo) for lo, hi in whole]
    return prints.select("fp", F.posexplode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("j", "mask")) \
        .select("fp", F.col("j").cast("byte").alias("j"), F.col("fp").bitwiseAND(F.col("mask")).alias("rest"))


def fingerprint_links(prints: DataFrame, max_distance: int = 2, bucket: int = 32) -> DataFrame:
    """Pairs ``(a, b)`` of the distinct fingerprints in ``prints`` (column fp,
    written) that differ in at most ``max_distance`` (0 to 2) bits. Complete
    up to connection: fingerprints are connected by the pairs just if they
    are connected by all links."""
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    if max_distance == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    variants = one_wildcard_variants(prints, max_distance)
    shared = materialize(
        variants.groupBy("j", "rest").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"),
                                          F.bit_xor("fp").alias("x")).filter("n > 1"), "simhash-variants")
    third = F.col("x").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b"))
    few = [F.struct("a", "b"), F.struct("a", third.alias("b")), F.struct(third.alias("a"), "b")]
    links = [shared.filter("n < 4").select(F.explode(F.when(F.col("n") == 2, F.array(few[0])).otherwise(F.array(*few))).alias("p"))
             .select("p.a", "p.b").filter(near)]
    crowd = shared.filter("n > 3").select("j", "rest", "n")
    if crowd.limit(1).count():
        members = materialize(variants.join(crowd, ["j", "rest"]), "simhash-members")
        gathered = members.filter(F.col("n") <= bucket).groupBy("j", "rest").agg(F.sort_array(F.collect_list("fp")).alias("l"))
        pairs = F.flatten(F.transform("l", lambda x, i: F.transform(
            F.filter(F.slice("l", i + 2, bucket), lambda y: F.bit_count(x.bitwiseXOR(y)) <= max_distance),
            lambda y: F.struct(x.alias("a"), y.alias("b")))))
        links.append(gathered.select(F.explode(pairs).alias("p")).select("p.a", "p.b"))
        large = members.filter(F.col("n") > bucket).select("fp").distinct()
        flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << j)) for j in range(BITS)))
        meet = large.select("fp", F.explode(flips).alias("flip")) \
            .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at")) \
            .groupBy("at").agg(F.collect_list("fp").alias("l")).filter(F.size("l") > 1)
        links.append(meet.select(F.array_min("l").alias("a"), F.explode("l").alias("b")).filter("a <> b").filter(near))
    return reduce(DataFrame.union, links).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest id reachable over links, itself included.

    NULL text counts as empty; texts without words have fingerprint zero and
    link like any other. A NULL id is smaller than any other in choosing,
    and shown as NULL. Repeated rows and ties in fingerprint fall into one
    component; other columns are ignored; empty in, empty out."""
    return _components(docs, id_col, text_col, shingle, max_distance).select(
        F.expr(f"nullif(id, {NO_ID})").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.expr(f"nullif(head.id, {NO_ID})").alias("component_id"))


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int) -> DataFrame:
    """``(id, mark, fp, head)``; head is the component's smallest (id, mark)."""
    marked = materialize(docs.select(long_id(id_col).alias("id"), text_mark(text_col).alias("mark"), fingerprint_column(
        text_or_empty(text_col), shingle).alias("fp")), "simhash-fingerprints")
    prints = materialize(marked.groupBy("fp").agg(F.min(F.struct("id", "mark")).alias("first")), "simhash-distinct")
    roots = materialize(connected_components(fingerprint_links(prints.select("fp"), max_distance)),
                        "simhash-roots")
    rooted = materialize(prints.join(roots, prints.fp == roots.node, "left")
                         .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    heads = materialize(rooted.groupBy("root").agg(F.min("first").alias("head")), "simhash-heads")
    named = materialize(rooted.join(heads, "root").select("fp", "head"), "simhash-components")
    return marked.join(named, "fp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with the row of smallest id of each component, columns as they
    were; any one of them if rows repeat it."""
    kept = _components(docs, id_col, text_col, shingle, max_distance) \
        .filter("id = head.id and mark = head.mark").select("id", "mark")
    return rows_kept(docs, kept, id_col, text_col)
