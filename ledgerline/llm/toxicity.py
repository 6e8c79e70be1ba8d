"""Toxicity by weak supervision.

Voters look at a whole text: lexicon voters fire on words, or word starts,
drawn from a bounded sample of labelled rows; pattern voters fire on shape
(shouting, address, runs of marks). A generative label model is fitted to
how often voters, and pairs of them, fire over all documents: each voter's
rate given either class, and which pairs agree more than the classes
explain. Its posterior, with correlated voters counted as fewer, labels a
bounded sample of documents, on which a linear classifier over the lexicon
entries and the patterns is trained. That classifier scores every document.

The texts are read once: their few features are written, and votes, moments
and scores come from those.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import known_labels, materialize, smallest, text_or_empty
from .decontaminate import words
from .quality_cnn import is_held_out

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
FEATURES = "doc_id long, held_out boolean, features array<int>"
START = 5  # characters of a word start

#: Pattern voters, on the text as written (fixed values).
PATTERNS = (
    r"\byou(?:'re| are| r)\b",
    r"\b(?:shut up|go away|get lost|drop dead)\b",
    r"!{2,}",
    r"\?{2,}",
    r"(?:\b[A-Z]{3,}\b\W+){3}",
    r"[*#$%&@]{3,}",
    r"\b(?:hate|kill|die|hurt)\w*\b",
    r"(?:\b(\w{4,})\W+\1\b)",
)
_PATTERNS = [re.compile(p) for p in PATTERNS]


def terms_of(w: list[bytes]) -> set[str]:
    """Words, and word starts of at least START characters marked ``^``."""
    distinct = {x.decode("utf-8", "replace") for x in set(w)}
    return distinct | {"^" + x[:START] for x in distinct if len(x) > START}


@dataclass
class Lexicon:
    """Terms in groups; each group is a voter."""

    terms: dict[str, int]  # term -> feature
    voter_of: np.ndarray  # feature -> voter

    @property
    def voters(self) -> int:
        return int(self.voter_of.max()) + 1 if len(self.voter_of) else 0

    def features(self, text: str) -> list[int]:
        found = {self.terms[t] for t in terms_of(words(text)) & self.terms.keys()}
        base = len(self.voter_of) - len(_PATTERNS)
        found |= {base + k for k, p in enumerate(_PATTERNS) if p.search(text)}
        return sorted(found)


def learn_lexicon(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", modulus: int = 4, remainder: int = 2, toxic_rows: int = 4000,
                  other_rows: int = 12_000, entries: int = 400, groups: int = 12, least: int = 4,
                  support: float = 0.005, odds: float = 3.0) -> tuple[Lexicon, float, DataFrame]:
    """The lexicon, the share of label 1 and the rows learned from: ``(id,
    y)``, at most ``toxic_rows`` of label 1 and ``other_rows`` of label 0,
    those of smallest id hash among the rows not held out; a repeated label
    counts once, ids with both labels are not used. Terms are counted
    on Spark, each text once however often it is repeated; of the terms in
    ``least`` toxic texts and a share ``support`` of them or more, with
    smoothed log odds over ``odds``, the ``entries`` of largest odds stay.
    Words and word starts are dealt to voters of like support."""
    known = known_labels(labels, id_col, label_col).filter(~is_held_out("id", modulus, remainder))
    counts = dict(known.groupBy("y").count().collect())
    hashed = known.withColumn("h", F.xxhash64("id"))
    sample = smallest(hashed.filter("y = 0"), other_rows, "h", "id").union(
        smallest(hashed.filter("y = 1"), toxic_rows, "h", "id")).select("id", "y")

    @F.arrow_udf("array<string>")
    def distinct_terms(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(terms_of(words(t))) for t in texts.to_pylist()], pa.list_(pa.string()))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t")) \
        .join(F.broadcast(sample), "id").select("y", F.xxhash64("t").alias("h"), distinct_terms("t").alias("terms")) \
        .dropDuplicates(["y", "h"])
    rows = materialize(rows, "toxicity-terms")
    sizes = dict(rows.groupBy("y").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    lift = F.log((F.col("pos") + 0.5) / (n1 + 1.0)) - F.log((F.col("neg") + 0.5) / (n0 + 1.0))
    top = rows.select("y", F.explode("terms").alias("term")).groupBy("term") \
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).filter(F.col("pos") >= max(least, math.ceil(support * n1))) \
        .withColumn("lift", lift).filter(F.col("lift") > odds).orderBy(F.col("lift").desc(), "term").limit(entries).collect()
    load = {}
    for kind in ("word", "start"):
        slots = [(0, g) for g in range(groups if kind == "word" else max(groups // 3, 1))]
        base = 0 if kind == "word" else groups
        for r in sorted((r for r in top if (r.term[0] == "^") == (kind == "start")), key=lambda r: (-r.pos, r.term)):
            slots.sort()
            used, g = slots[0]
            slots[0] = (used + r.pos, g)
            load[r.term] = base + g
    names = sorted(load)
    voter = [load[t] for t in names] + [groups + max(groups // 3, 1) + k for k in range(len(_PATTERNS))]
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return Lexicon({t: i for i, t in enumerate(names)}, np.array(voter)), share, sample


def text_features(docs: DataFrame, lexicon: Lexicon, id_col: str, text_col: str, modulus: int, remainder: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                                             ["doc_id", "held_out", "features"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col, modulus, remainder).alias("held_out"),
                       text_or_empty(text_col).alias("text")).mapInArrow(run, FEATURES)


def votes_of(features: list[list[int]], voter_of: np.ndarray, voters: int) -> np.ndarray:
    votes = np.zeros((len(features), voters), np.float64)
    for i, f in enumerate(features):
        votes[i, voter_of[f]] = 1
    return votes


def vote_moments(features: DataFrame, lexicon: Lexicon) -> tuple[int, np.ndarray]:
    """Documents, and for each two voters in how many both fire (the diagonal:
    each one), over all documents; one small matrix per task is summed."""
    voters, voter_of = lexicon.voters, lexicon.voter_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((voters, voters)), 0
        for batch in batches:
            v = votes_of(batch.column(0).to_pylist(), voter_of, voters)
            total += v.T @ v
            n += len(v)
        a, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(a, -1)), pa.array(np.append(b, -1)),
                                          pa.array(np.append(total[a, b], n).astype(np.int64))], ["a", "b", "n"])

    sums = features.select("features").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    both, n = np.zeros((voters, voters)), 0
    for r in sums.collect():  # at most voters squared, plus one
        if r.a < 0:
            n = r.n
        else:
            both[r.a, r.b] = r.n
    return n, both


@dataclass
class LabelModel:
    """P(fires | toxic), P(fires | not), the prior, and each voter's weight
    after its correlations."""

    hit: np.ndarray
    false: np.ndarray
    prior: float
    correlation: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    @property
    def weight(self) -> np.ndarray:
        return 1 / (1 + np.clip(self.correlation, 0, 1).sum(axis=1))

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        on = np.log(self.hit / self.false) * self.weight
        off = np.log((1 - self.hit) / (1 - self.false)) * self.weight
        return np.log(self.prior / (1 - self.prior)) + votes @ on + (1 - votes) @ off

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.evidence(votes) + self.shift, -60, 60)))

    def calibrate(self, votes: np.ndarray, labels: np.ndarray, steps: int = 50) -> None:
        """Scale and shift of the evidence by Newton steps on labelled rows,
        as weights for correlation keep the order but not the size."""
        if not 0 < labels.sum() < len(labels):
            return
        x = np.stack([self.evidence(votes), np.ones(len(votes))], axis=1)
        w = np.array([1.0, 0.0])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            w = w + np.clip(np.linalg.solve(hessian, x.T @ (labels - p) - 1e-3 * w), -1, 1)
        self.scale, self.shift = float(max(w[0], 0.0)), float(w[1])


def fit_label_model(n: int, both: np.ndarray, prior: float, seen: np.ndarray, labels: np.ndarray, rounds: int = 3,
                    steps: int = 1000, hold: float = 0.05) -> LabelModel:
    """Fit rates to the pair frequencies over all documents, E[ij] =
    p h_i h_j + (1-p) f_i f_j, by gradient descent, in rounds: after each,
    pairs whose correlation is left unexplained are taken out of the fit and
    noted as correlated. The rates start from those on the labelled rows
    (votes ``seen`` and ``labels``) and are held to them by ``hold``."""
    m, prior = len(both), float(np.clip(prior, 1e-3, 0.5))
    n = max(n, 1)
    rate = np.diag(both) / n
    pair, scale = both / n, np.sqrt(np.maximum(np.outer(rate, rate), 1e-10))
    use, correlation = 1 - np.eye(m), np.zeros((m, m))
    logit = lambda p: np.log(p / (1 - p))
    smooth = lambda v: (v.sum(axis=0) + rate) / (len(v) + 1.0)
    hit = hit0 = logit(np.clip(smooth(seen[labels == 1]), 1e-4, 0.99))
    false = false0 = logit(np.clip(smooth(seen[labels == 0]), 1e-5, 0.99))
    for _ in range(rounds):
        moments = [np.zeros((2, m)), np.zeros((2, m))]
        for step in range(1, steps + 1):
            h, f = 1 / (1 + np.exp(-hit)), 1 / (1 + np.exp(-false))
            off = use * (prior * np.outer(h, h) + (1 - prior) * np.outer(f, f) - pair) / scale ** 2
            own = (prior * h + (1 - prior) * f - rate) / np.maximum(rate, 1e-8) ** 2 * m
            g = np.stack([(2 * prior * (off @ h) + prior * own) * h * (1 - h) + hold * (hit - hit0),
                          (2 * (1 - prior) * (off @ f) + (1 - prior) * own) * f * (1 - f) + hold * (false - false0)])
            moments[0] += 0.1 * (g - moments[0])
            moments[1] += 0.01 * (g * g - moments[1])
            d = 0.03 * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-9)
            hit, false = np.clip(hit - d[0], -12, 6), np.clip(false - d[1], -12, 6)
        h, f = 1 / (1 + np.exp(-hit)), 1 / (1 + np.exp(-false))
        spread = np.sqrt(np.maximum(prior * h * (1 - h) + (1 - prior) * f * (1 - f), 1e-10))
        correlation = (pair - prior * np.outer(h, h) - (1 - prior) * np.outer(f, f)) / np.outer(spread, spread)
        np.fill_diagonal(correlation, 0)
        correlation[np.abs(correlation) < max(0.1, 4 / np.sqrt(n))] = 0
        use = (correlation == 0) * (1 - np.eye(m))
    swap = h < f  # a voter that says nothing about the class gets equal rates
    h[swap] = f[swap] = rate[swap]
    model = LabelModel(np.clip(h, 1e-4, 1 - 1e-4), np.clip(f, 1e-6, 1 - 1e-4), prior, correlation)
    model.calibrate(seen, labels)
    return model


def fit_linear(features: list[list[int]], target: np.ndarray, size: int, steps: int = 400, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft labels; the last weight is the constant."""
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    cols = np.fromiter((c for f in features for c in f), np.int64, len(rows))
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[cols], len(features)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target) / max(len(features), 1)
        g = np.append(np.bincount(cols, error[rows], size), error.sum())
        g[:-1] += ridge * w[:-1] / max(len(features), 1)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", modulus: int = 4, remainder: int = 2, threshold: float = 0.3,
                    sample: int = 20_000, **lexicon_limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1, higher:
    label 1 likelier), predicted (1 if score >= threshold).

    NULL text counts as empty and is scored; NULL ids stay and are not held
    out; repeated rows and ties score alike; only the text enters the score;
    without usable labels every voter is a pattern. The classifier learns
    from at most ``sample`` documents not held out, those of smallest hash of
    id and features; no more than about these go to the driver."""
    lexicon, share, known = learn_lexicon(docs, labels, id_col, text_col, label_col, modulus, remainder, **lexicon_limits)
    features = materialize(text_features(docs, lexicon, id_col, text_col, modulus, remainder), "toxicity-features")
    known = features.join(F.broadcast(known), features.doc_id == known.id).groupBy("id") \
        .agg(F.min(F.struct("features", "y")).alias("r")).orderBy("id").select("r.*").collect()  # one row per labelled id
    voted = votes_of([r[0] for r in known], lexicon.voter_of, lexicon.voters)
    model = fit_label_model(*vote_moments(features, lexicon), share, voted, np.array([r[1] for r in known], float))
    hashed = features.filter("not held_out").withColumn("h", F.xxhash64("doc_id", "features"))
    some = [r[0] for r in smallest(hashed, sample, "h", "doc_id", "features").select("features").collect()]
    target = model.posterior(votes_of(some, lexicon.voter_of, lexicon.voters))
    weights = fit_linear(some, target, len(lexicon.voter_of))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def linear(found: pa.Array) -> pa.Array:
        w = shared.value
        z = np.array([w[f].sum() + w[-1] for f in found.to_pylist()] or [0.0])[:len(found)]
        return pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))))

    return features.withColumn("score", linear("features")).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
