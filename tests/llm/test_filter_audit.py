import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import filter_audit
from ledgerline.llm.filter_audit import counted, filter_interactions

SYMBOLS = b"#$%&*|"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)), len(text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbZ \t\n\x1c\x85#|é €\U0001f600")), max_size=8), st.integers(1, 9))
def test_transducer_counts_as_patterns_do(texts, run):
    old, filter_audit.RUN = filter_audit.RUN, run  # texts over several runs, runs over several texts
    try:
        got = counted(pa.array(["skipped", *texts], pa.string()).slice(1), SYMBOLS)
    finally:
        filter_audit.RUN = old
    assert [tuple(map(int, row)) for row in zip(*got)] == [plain_counts(t) for t in texts]


def test_long_text_over_many_runs():
    text = "wörd Been there #1 \n" * 200_000
    assert [int(x[0]) for x in counted(pa.array([text]), SYMBOLS)] == list(plain_counts(text))


def brute(docs, labels):
    rows, parts = [], sorted({d[2] or "" for d in docs})
    for id_, text, part in docs:
        t = text or ""
        words, distinct, caps, symbols, points = plain_counts(t)
        key = float("-inf") if id_ is None else id_
        fails = {"A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * caps > 5 * points, "D": symbols > 0,
                 "E": any((u or "") == t and (float("-inf") if i is None else i) < key for i, u, _ in docs)}
        mine = [x for x in labels if id_ is not None and x[0] == id_]
        rows.append((part or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part in parts:
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                mine = [r for r in rows if r[0] == part]
                went = [any(r[1][x] for x in order[:k]) for r in mine]
                here = [r for r, w in zip(mine, went) if r[1][f] and not w]
                out[part, order, k + 1] = [
                    sum(not w and not r[1][f] for r, w in zip(mine, went)), len(here),
                    sum(w and r[1][f] for r, w in zip(mine, went)), sum(r[1][f] and sum(r[1].values()) == 1 for r in mine),
                    sum(r[2] for r in here), sum(r[3] for r in here)]
    for (part, order, step), row in out.items():
        row.append(sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == order[step - 1]))
    return out


def as_dict(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def test_odd_rows_against_brute_force(spark, odd_docs):
    good = " ".join(f"word{i}" for i in range(60))
    more = [(20, good, None), (21, good, "t"), (21, good, "t"), (22, good + " $", "t"), (23, "AAA " * 60, "s")]
    docs = odd_docs.select("doc_id", "text", "source", "id", "mark").unionByName(
        spark.createDataFrame([(*m, 1, "digest") for m in more], "doc_id long, text string, source string, id long, mark string"))
    docs = docs.selectExpr("*", "1 AS part", "2 AS fails", "3 AS n", "4 AS quality", "5 AS step")
    labels = [(20, 1, 0), (20, 0, 1), (20, 1, None), (1, None, 1), (None, 1, 1), (22, 1, 0), (99, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS id", "2 AS good")
    got = as_dict(filter_interactions(docs, frame))
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], labels)


def test_no_documents(spark, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_interactions(no_docs, none).collect() == []


def test_no_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = as_dict(filter_interactions(odd_docs, none))
    assert len(got) == 2 * 600 and all(v[4] == v[5] == 0 for v in got.values())


def test_hot_text_is_counted_in_map_tasks(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', concat('t', id)) AS text", "'s' AS source")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = as_dict(filter_interactions(docs, none))
    assert got["s", "EABCD", 1][:2] == [2001, 999] and got["s", "ABCDE", 5][2] == 999
    assert np.sum([got["s", "ABCDE", k][1] for k in range(1, 6)]) == 3000


@pytest.mark.parametrize("symbols", ["", "é"])
def test_other_symbols(spark, symbols):
    docs = spark.createDataFrame([(1, "café #", "s")], "doc_id long, text string, source string")
    if symbols == "":
        rows = filter_audit.failed_filters(docs, symbols=symbols, least_words=0).collect()
        assert rows[0]["mask"] == 0
