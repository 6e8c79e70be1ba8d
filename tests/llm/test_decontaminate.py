import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm.decontaminate import Index, Searcher, contaminated, drop_contaminated, words

RNG = random.Random(4)
VOCABULARY = [f"w{i}" for i in range(400)] + ["the"] * 60


def prose(n):
    return " ".join(RNG.choices(VOCABULARY, k=n))


ITEMS = [(i, prose(RNG.choice([12, 25, 60, 150]))) for i in range(40)]


@pytest.fixture(scope="module")
def tables(spark):
    items = ITEMS + [(100, None), (101, ""), (None, "null id item text of twelve words here to be found again now"),
                     (7, ITEMS[3][1] + "\n" + prose(20)), (102, "two words")]
    half = ITEMS[5][1].split()
    docs = [(0, prose(300)), (1, prose(500) + " " + ITEMS[0][1].upper() + ", " + prose(10)),
            (2, ITEMS[1][1].replace(" ", "\n!! ")), (3, " ".join(half[:len(half) // 2])), (4, None), (5, ""),
            (6, prose(2000) + ITEMS[2][1] + " " + prose(2000) + " " + ITEMS[3][1]), (None, ITEMS[4][1]), (1, ITEMS[0][1]),
            (8, "it is the null id item text of twelve words here to be found again now"), (9, "some two words here")]
    return (spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, mark string"),
            spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, unit int"))


def test_finds_what_is_there(tables):
    got = {(r.doc_id, r.item_id) for r in contaminated(*tables).collect()}
    want = {(1, 0), (2, 1), (6, 2), (6, 3), (None, 4), (8, None), (9, 102)}
    last = ITEMS[2][1].split()[0]
    assert want - {(6, 2)} <= got <= want | {(6, 7)}, last


def test_parts_give_the_same(tables):
    docs, items = tables
    row = lambda r: (str(r.doc_id), str(r.item_id), round(r.question_overlap, 6), round(r.answer_overlap, 6))
    assert sorted(map(row, contaminated(docs, items).collect())) == \
        sorted(map(row, contaminated(docs, items, part_bytes=2000).collect()))


def test_wand_equals_full_scoring():
    units = [(i, words(t)[:64]) for i, t in ITEMS]
    documents = Counter(t for _, w in units for t in set(w))
    average = sum(len(w) for _, w in units) / len(units)
    for blocks in (1, 3, 64):
        index = Index(units, documents, len(units), average, blocks)
        for t, (ids, impacts) in enumerate(index.lists):  # bounds never lie under what they bound
            assert all(float(index.maxima[t, u // index.block]) >= x for u, x in zip(ids, impacts))
        search = Searcher(index, {}, 0.3, 128, 0.8)
        texts = [words(prose(n)) for n in (1, 64, 65, 128, 129, 400)] + [words(ITEMS[9][1]), [], words(prose(30) * 3)]
        got = {}
        for doc, query, block in search._passages(texts):
            for unit, score in index.wand(query, block, 0.3):
                got[doc, unit] = max(got.get((doc, unit), 0), score)
        want = {}
        for d, w in enumerate(texts):
            for s in range(0, max(len(w) - 64, 1), 64):
                query = {index.terms[t] for t in w[s:s + 128] if t in index.terms}
                total = np.zeros(len(units))
                for t in query:
                    for u, x in zip(*index.lists[t]):
                        total[u] += x
                for u in np.flatnonzero(total >= 0.3):
                    want[d, int(u)] = max(want.get((d, int(u)), 0), total[u])
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_rows_without_items_stay(tables):
    docs, items = tables
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "3", "4", "5"]
    assert drop_contaminated(docs, items.limit(0)).count() == docs.count()
    assert contaminated(docs.limit(0), items).count() == 0
