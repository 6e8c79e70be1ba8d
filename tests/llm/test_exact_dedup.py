import hashlib

from ledgerline.llm.exact_dedup import drop_exact_duplicates, exact_groups


def lower(text):
    return (text or "").encode().lower()


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(lower(r.text), []).append(r.doc_id)
    out = []
    for r in rows:
        ids = groups[lower(r.text)]
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        out.append((r.doc_id, keep, len(ids), r.doc_id == keep, hashlib.sha256(lower(r.text)).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def test_groups_match_brute_force(odd_docs):
    got = [tuple(r) for r in exact_groups(odd_docs).collect()]
    assert sorted(got, key=key) == sorted(brute(odd_docs.collect()), key=key)


def test_digits_split_late_differences(spark):
    base = "a" * 5000
    texts = [base + c for c in "bcb"] + [base[:64], base[:65], base[:64], base[:576], base[:576]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for first, growth in ((64, 8), (1, 2), (7, 3)):
        got = [tuple(r) for r in exact_groups(docs, first=first, growth=growth).collect()]
        assert sorted(got) == sorted(brute(docs.collect()))


def test_one_row_of_each_group_stays(odd_docs):
    kept = drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(lower(r.text) for r in rows) == sorted({lower(r.text) for r in odd_docs.collect()})
    assert {r.doc_id for r in rows} == {2, 4, 5, 6, 7, 8, 9}
    assert {r.id for r in rows} == {7}


def test_empty(no_docs):
    assert exact_groups(no_docs).count() == 0
    assert drop_exact_duplicates(no_docs).columns == no_docs.columns
