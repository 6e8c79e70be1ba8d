import random

import xxhash

from ledgerline.llm.common import connected_components
from ledgerline.llm.simhash_dedup import (drop_near_duplicates, fingerprint, fingerprint_links, simhash_components)


def brute_components(prints, k):
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for i, p in enumerate(prints):
        for q in prints[:i]:
            if bin((p ^ q) & (1 << 64) - 1).count("1") <= k:
                a, b = find(p), find(q)
                root[max(a, b)] = min(a, b)
    return {p: find(p) for p in prints}


def plain_fingerprint(text):
    words = text.lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in (b"", b" \n", b"One", b"One two", b"one two THREE", b"a b c a b c a b c", "é É x y z".encode(),
                 b"w " * 40000):
        assert fingerprint(text) == plain_fingerprint(text)


def crowded(seed, n):
    """Clouds of fingerprints within a few bits of common centres."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0]
    out = set()
    while len(out) < n:
        p = rng.choice(centres)
        for b in rng.sample(range(64), rng.choice([0, 1, 1, 2, 3, 4])):
            p ^= 1 << b
        out.add(p - (1 << 64) if p >> 63 else p)
    return out


def test_links_connect_as_all_pairs_do(spark):
    prints = crowded(5, 700)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for k, bucket in ((2, 32), (2, 3), (1, 32), (0, 32)):
        links = fingerprint_links(df, k, bucket)
        got = {r.node: r.root for r in connected_components(links).collect()}
        assert {p: got.get(p, p) for p in prints} == brute_components(prints, k)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 150)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 160), 200]}
    assert connected_components(df.limit(0)).count() == 0


def test_components_of_very_many_links(spark):
    links = spark.range(150_000).selectExpr("2 * id AS a", "2 * id + 1 AS b")
    got = connected_components(links)
    assert got.count() == 300_000 and got.filter("root <> node - node % 2").count() == 0


def test_documents(odd_docs):
    rows = odd_docs.collect()
    prints = {r.text: plain_fingerprint((r.text or "").encode()) for r in rows}
    roots = brute_components(set(prints.values()), 2)
    least = {}
    for r in rows:
        root = roots[prints[r.text]]
        ids = least.setdefault(root, [])
        ids.append((r.doc_id is not None, r.doc_id))
    want = [(r.doc_id, "%016x" % prints[r.text], min(least[roots[prints[r.text]]])[1]) for r in rows]
    got = [tuple(r) for r in simhash_components(odd_docs).collect()]
    order = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_drop(odd_docs, no_docs):
    kept = drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    roots = brute_components({plain_fingerprint((r.text or "").encode()) for r in odd_docs.collect()}, 2)
    assert kept.count() == len(set(roots.values()))
    assert drop_near_duplicates(no_docs).count() == 0
    assert simhash_components(no_docs).count() == 0
