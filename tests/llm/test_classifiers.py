import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import quality_cnn as Q
from ledgerline.llm import toxicity as T
from ledgerline.llm.common import known_labels, smallest

WORDS = [a + b + c for a in ("re", "th", "on", "an") for b in ("ing", "ed", "er", "at") for c in ("sh", "ti", "ly", "")]
BAD = [f"vile{x}" for x in "abcdefgh"]


def accuracy(rows, truth, held):
    some = [r for r in rows if r.held_out == held and r.doc_id in truth]
    return sum(r.predicted == truth[r.doc_id] for r in some) / len(some)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(700):
        w = rng.choices(WORDS, k=rng.randint(5, 200))
        quality, toxic = int(rng.random() < 0.75), int(rng.random() < 0.3)
        if toxic:
            for b in rng.sample(BAD, rng.randint(2, 4)):
                w.insert(rng.randrange(len(w)), b)
        if not quality:
            w = [x + rng.choice(["%%%", "&&&", "***"]) for x in w]
        rows.append((i, " ".join(w), "s", 0.5))
        labels.append((i, quality, toxic))
    rows += [(1000, None, None, None), (1001, "", "s", 0.1), (1002, "long text " * 40000, "s", 0.1), (None, "x", "s", 0.1),
             (1001, "", "s", 0.1)]
    labels += [(5000, 1, 1), (None, 0, 0), (1000, None, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string, features string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_on_held_out_rows(data):
    docs, labels = data
    net = Q.fit(docs, labels, per_class=150, epochs=6)
    rows = Q.quality_scores(docs, net).collect()
    assert len(rows) == docs.count()
    assert accuracy(rows, {r.doc_id: r.quality for r in labels.collect()}, True) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert Q.quality_scores(docs.limit(0), net).count() == 0
    kept = Q.keep_good(docs, net)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)


def test_held_out_labels_are_not_learned(data):
    docs, labels = data
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(Q.is_held_out("doc_id", 3, 1), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (Q.fit(docs, x, per_class=20, epochs=1) for x in (labels, turned))
    assert all((p == q).all() for p, q in zip(a.parts(), b.parts())) and a.shift == b.shift


def test_repeated_labels_count_once(spark, data):
    docs, labels = data
    again = labels.filter("doc_id = 3").crossJoin(spark.range(300)).drop("id")
    both = spark.createDataFrame([(1001, 0, 0), (1001, 1, 1)], labels.schema)
    more = labels.union(again).union(both)
    known = {r.id: r.y for r in known_labels(more, "doc_id", "quality").collect()}
    assert known == {r.doc_id: r.quality for r in labels.collect() if r.doc_id is not None and r.quality is not None}
    a, b = (Q.fit(docs, x, per_class=20, epochs=1) for x in (labels, more))
    assert all((p == q).all() for p, q in zip(a.parts(), b.parts())) and a.shift == b.shift
    a, b = (T.learn_lexicon(docs, x, toxic_rows=50, other_rows=60) for x in (labels, more))
    assert a[0].terms == b[0].terms and a[1] == b[1] and sorted(a[2].collect()) == sorted(b[2].collect())


def test_smallest_by_hash(spark):
    from pyspark.sql import functions as F
    rows = spark.range(30_000).withColumn("h", F.xxhash64("id"))
    for n in (0, 1, 50, 29_999, 40_000):
        assert smallest(rows, n, "h", "id").collect() == rows.orderBy("h", "id").limit(n).collect()
    few = rows.withColumn("h", F.col("id") * 0 + (1 << 62))  # all alike, and above the first threshold
    assert [r.id for r in smallest(few, 5, "h", "id").collect()] == [0, 1, 2, 3, 4]
    assert smallest(rows.limit(0), 5, "h", "id").count() == 0


def test_network_pools_the_whole_text():
    rng = np.random.default_rng(0)
    net = Q.train([b"a", b"b"], [0, 1], 0.5, epochs=1)
    docs = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 5, 511, 512, 513, 1024, 70_000)]
    halves, counts = Q.pooled(net, net.pair_tables(), docs)
    at = 0
    for d, n in zip(docs, counts):
        whole = (d or b"\0") + b"\0" * 8
        for h in range(n):
            stop = min((h + 1) * 512, max(len(d), 1))
            want = np.max([sum(net.filters[j][whole[t + j]] for j in range(6)) for t in range(h * 512, stop)], axis=0)
            assert np.allclose(halves[at], np.maximum(want + net.bias, 0), atol=1e-4)
            at += 1
    alone = [Q.score(net, net.pair_tables(), [d])[0] for d in docs]
    assert np.allclose(alone, Q.score(net, net.pair_tables(), docs), atol=1e-6)


def test_gradients():
    net = Q.train([b"abc" * 300, b"xyz"], [0, 1], 0.5, epochs=1, filters=3, hidden=4)
    net.shift = 0.0
    texts, y, w = [b"abcabd" * 200, b"q", b""], np.array([1, 0, 1], np.float32), np.ones(3, np.float32)
    for p in net.parts():
        p[:] = p.astype(np.float32)

    def loss():
        p = Q.score(net, net.pair_tables(), texts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    for p, g in zip(net.parts(), Q._gradients(net, texts, y, w)):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, eps = p[i], np.float32(1e-2)
        p[i] = old + eps
        up = loss()
        p[i] = old - eps
        down = loss()
        p[i] = old
        assert abs((up - down) / (2 * eps) - g[i]) < 0.05 * abs(g[i]) + 1e-3


def test_toxicity_on_held_out_rows(data):
    docs, labels = data
    rows = T.toxicity_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert accuracy(rows, {r.doc_id: r.toxic for r in labels.collect()}, True) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert T.toxicity_scores(docs.limit(0), labels).count() == 0
    assert T.toxicity_scores(docs, labels.limit(0)).count() == len(rows)


def test_label_model_finds_rates_and_correlations():
    rng = np.random.default_rng(3)
    n, prior = 200_000, 0.2
    y = rng.random(n) < prior
    hit, false = np.array([0.8, 0.6, 0.5, 0.7, 0.5, 0.4]), np.array([0.05, 0.02, 0.1, 0.01, 0.03, 0.2])
    votes = (rng.random((n, 6)) < np.where(y[:, None], hit, false)).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # a copy of the first voter
    seen = rng.choice(n, 400)
    model = T.fit_label_model(n, votes.T @ votes, prior, votes[seen], y[seen].astype(float))
    assert np.allclose(model.hit[:6], hit, atol=0.12) and np.allclose(model.false[:6], false, atol=0.06)
    assert model.correlation[0, 6] > 0.5 and model.weight[0] < 0.7 < model.weight[3]
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.93
