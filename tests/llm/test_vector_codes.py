import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm.vector_codes import Codebook, encode_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, v string, code int, entry int, of int"


def brute(rows, parts=4, entries=256, rounds=4):
    """All distances, by Python integers."""
    ok = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ok:
        return []
    width = len(ok[0][1])
    ok = [(i, [math.floor(Fraction(x) * 1024) for x in v], l) for i, v, l in ok if len(v) == width]
    edges = [width * p // parts for p in range(parts + 1)]
    cut = [[r[1][a:b] for r in ok] for a, b in zip(edges, edges[1:])]
    books = [[list(x) for x in part[:entries]] for part in cut]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)) for x in part]
                for part, book in zip(cut, books)]
    for _ in range(rounds):
        for part, book, near in zip(cut, books, assign()):
            for k in range(len(book)):
                mine = [x for x, (_, j) in zip(part, near) if j == k]
                if mine:
                    book[k] = [sum(c) // len(mine) for c in zip(*mine)]
    near = assign()
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [min(sum(n[i][0] for n in near), 2 ** 63 - 1) for i in range(len(ok))]
    by = {}
    for r, e in zip(ok, error):
        by[r[2]] = min(by.get(r[2], 0) + e, 2 ** 63 - 1)
    return sorted([(r[0], "".join("%02x" % n[i][1] for n in near), error[i], by[r[2]], sha) for i, r in enumerate(ok)], key=str)


def check(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    got = sorted(map(tuple, encode_vectors(df, **how).collect()), key=str)
    assert got == brute(rows, **how)


def test_search_meets_ties_and_all_entries():
    rng = np.random.default_rng(1)
    for width, spread in ((1, 3), (2, 3), (5, 40), (16, 1000)):
        entries = rng.integers(-spread, spread + 1, (60, width))
        parts = rng.integers(-spread, spread + 1, (500, width))
        index, best = Codebook(entries).nearest(parts)
        every = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (best == every.min(1)).all() and (index == every.argmin(1)).all()


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=10).tolist(), None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(120)]
    check(spark, rows, entries=16)
    check(spark, rows, entries=256, rounds=2)
    check(spark, rows, entries=5, parts=3)


def test_odd_rows(spark):
    rows = [(5, None, 1), (6, [1.0, None], 1), (7, [1.0, float("nan")], 1), (8, [float("inf"), 0.0], 1), (9, [0.5], 1),
            (None, [0.25, -0.25], None), (None, [0.25, -0.25], None), (1, [0.5, -0.0001], 2), (1, [0.5, -0.0001], 2),
            (2, [-3.0, 4.0], None), (3, [-3.0, 4.0], 2), (1, [0.25, 9.0], 2)]
    check(spark, rows)
    check(spark, rows, entries=2, parts=2)


def test_huge_numbers_are_exact_and_errors_stop_at_the_largest_long(spark):
    check(spark, [(1, [1e300, 1.0], 1), (2, [-1e300, 3.0], 1), (3, [1e20, 1e-300], 1), (4, [2.0 ** 60, 0.5], 2), (5, [0.0, 0.5], 2)],
          entries=2, parts=2)


def test_hot_vector(spark):
    check(spark, [(i, [0.125, 0.5, 0.25, 1.0] if i % 3 else [i / 9, -i / 7, 0.0, 2.0], i % 2) for i in range(90)], entries=4)


def test_empty_tables(spark):
    assert encode_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert encode_vectors(spark.createDataFrame([(1, None, 1, "x", 1, 2, 3)], SCHEMA)).collect() == []
    check(spark, [(1, [], 1), (2, [], None)])


def test_too_many_entries(spark):
    with pytest.raises(ValueError):
        encode_vectors(spark.createDataFrame([], SCHEMA), entries=257)
