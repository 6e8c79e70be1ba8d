import random
from itertools import combinations

import numpy as np
import pytest

from ledgerline.llm import chosen_path
from ledgerline.llm.chosen_path import Join, drop_similar, functions, shingles, signature, similar_groups, sketch


def brute(docs, width=2, threshold=80):
    """All pairs; ids as floats so that NULL is the smallest."""
    key = [(float("-inf") if d[0] is None else d[0]) for d in docs]
    sets = [shingles((d[1] or "").encode(), width) for d in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i in range(len(docs)):
        least[find(i)] = min(least.get(find(i), float("inf")), key[i])
    return sorted((str(d[0]), len(s), str(None if least[find(i)] == float("-inf") else int(least[find(i)])), key[i] == least[find(i)])
                  for i, (d, s) in enumerate(zip(docs, sets)))


def rows(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in df.collect())


def corpus(seed, n=220):
    """Families of near copies around the threshold, copies of copies, short texts."""
    rng, docs = random.Random(seed), []
    for _ in range(n // 11):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(11):
            text = list(base)
            for _ in range(int(len(base) * rng.choice([0, 0.01, 0.03, 0.05, 0.06, 0.08, 0.2]))):
                text[rng.randrange(len(text))] = f"w{rng.randrange(400)}"
            docs.append((" " if rng.random() < 0.5 else "\n").join(text).upper() if rng.random() < 0.2 else " ".join(text))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_all_components_against_all_pairs(spark):
    docs = corpus(64)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(similar_groups(df)) == brute(docs)


def test_without_representatives_nothing_is_lost(spark, monkeypatch):
    """The exhaustive nodes alone find the components, too."""
    docs = corpus(9, 110)
    monkeypatch.setattr(Join, "with_representatives", lambda self, m, filtered: m.selectExpr("node AS a", "node AS b").limit(0))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(similar_groups(df)) == brute(docs)


def test_large_group_of_near_copies_goes_below_the_first_signature(spark):
    """Texts that share 70 % link only with their own family; the shared part
    keeps nodes large, so deeper levels sign anew."""
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(90)]
    docs = []
    for family in range(40):
        own = [f"f{family}x{i}" for i in range(30)]
        for copy in range(5):
            text = shared + own
            if copy:
                text[rng.randrange(len(text))] = f"c{copy}"
            docs.append((len(docs), " ".join(text)))
    levels = []
    real = Join.signs

    def seen(self, nodes, generation):
        levels.append(generation)
        return real(self, nodes, generation)
    Join.signs = seen
    try:
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = rows(similar_groups(df, small=8))
    finally:
        Join.signs = real
    assert got == brute(docs) and max(levels) >= 1
    assert len({r[2] for r in got}) == 40


def test_odd_rows(spark, odd_docs):
    more = spark.createDataFrame([(21, "a"), (22, "A"), (23, "a b"), (24, "a b a b"), (25, " \t")], "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True) \
        .selectExpr("*", "1 AS node", "2 AS path", "3 AS tree", "4 AS comp", "5 AS n", "'x' AS digest")
    assert rows(similar_groups(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    kept = drop_similar(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert len(ids) == len(set(ids)) or ids.count("None") == 2  # a NULL id with a text and one without


def test_no_documents(spark, no_docs):
    assert similar_groups(no_docs).collect() == []


def test_nodes_over_batches_and_links_of_a_node():
    import pyarrow as pa
    rows_ = [(1, 1), (1, 2), (2, 3), (2, 4), (2, 5), (3, 6)]
    table = pa.table({"path": [p for p, _ in rows_], "node": [n for _, n in rows_]})
    for size in (1, 2, 4, 9):
        nodes = list(chosen_path.nodes_of(table.to_batches(max_chunksize=size)))
        assert [x for t in nodes for x in t["node"].to_pylist()] == [1, 2, 3, 4, 5, 6]
        paths = [set(t["path"].to_pylist()) for t in nodes]
        assert all(not a & b for i, a in enumerate(paths) for b in paths[i + 1:])


def test_sketch_and_signature_estimate_similarity():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 1 << 63, n, np.uint64) for n in (800, 100, 100))
    x, y = (signature(np.concatenate([common, own]), 10, 0) for own in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.15
    differ = sum(bin((p ^ q) & ((1 << 64) - 1) | 0).count("1") > 0 for p, q in zip(sketch(x), sketch(y)))
    assert differ <= len(sketch(x)) == chosen_path.sketch_words(10)
    assert len(functions(10, 0)[0]) == 96 and (functions(10, 1)[0] != functions(10, 0)[0]).any()


def test_other_widths_and_thresholds(spark):
    docs = corpus(5, 33)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(similar_groups(df, width=5, threshold=90)) == brute(docs, 5, 90)
    with pytest.raises(ValueError):
        similar_groups(df, threshold=40)
