import random
import re
import textwrap

import pytest

from ledgerline.llm import queries
from ledgerline.llm.license_scan import PHRASES, TEMPLATES, _word_set, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, width=512, containment=0.8):
    text = text or ""
    w = WORD.findall(text.translate(LOWER))
    places, base = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    labels, best = set(base), 0.0
    for line in text.split("\n"):
        lw = re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", line.lower())
        step = width // 2
        for block in [lw] if len(lw) <= width else [lw[i:i + width] for i in range(0, len(lw) - step, step)]:
            shares = {label: len(set(t) & set(block)) / len(t) for label, t in ((a, _word_set(b)) for a, b in TEMPLATES)}
            top = max(shares.values())
            if top >= containment - 1e-9:
                labels |= {a for a, s in shares.items() if s == top}
                best = max(best, top)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), 1.0 if places else best)


@pytest.fixture(scope="module")
def docs(spark):
    t = dict(TEMPLATES)
    texts = [None, "", " ", "word", "MIT License", "mit\n\nLICENSE mit license", "MITÉ license", "mit x license",
             "permit license", "Apache-License. General  Public\tLicense general public license",
             "Licensed under CC BY-NC 4.0.", "licensed under cc by sa 4", "by 4 0 nc cc", t["mit-terms"], t["bsd-terms"].upper(),
             " ".join(t["apache-terms"].split()[:22]), t["gpl-terms"].replace(" ", "\n"), "é " * 700 + t["isc-terms"] + " é" * 700,
             "license " * 3000 + "mit license", t["mpl-notice"] + "\n" + t["unlicense"], "Émile 12 ñ\x00x\x7fy"]
    return spark.createDataFrame([(i, x, "l", 1) for i, x in enumerate(texts)] + [(4, "MIT License", "l", 1), (None, "x", None, None)],
                                 "doc_id long, text string, label string, h int")


def test_matches_brute_force(docs):
    got = sorted((str(r.doc_id), r[1:]) for r in scan_licenses(docs).collect())
    want = sorted((str(r.doc_id), brute(r.text)) for r in docs.collect())
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert tuple(g[1][:-1]) == w[1][:-1] and abs(g[1][-1] - w[1][-1]) < 1e-9, g[0]


def test_no_python_on_the_way(docs):
    plan = scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_and_wrong_templates(docs):
    assert scan_licenses(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        scan_licenses(docs, templates=(("none", "!"),))


def labels_of(spark, monkeypatch, texts):
    """Labels that the registered query gives the texts."""
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return [set(r.labels.split(",")) for r in queries.op5_license_scan(spark, "").orderBy("doc_id").collect()]


def brute_labels(text, width=512, containment=0.8, span=2):
    """Labels and best share of the registered query by force: stretches of
    every window of the whole text."""
    w = re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
    labels, best, step = set(), 0.0, width // 2
    for i in range(0, max(1, step * ((len(w) - 1) // step)), step):
        block, met = w[i:i + width], {}
        for label, notice in TEMPLATES:
            t = set(_word_set(notice))
            stretch = span * len(re.findall(r"[a-z0-9]+", notice.lower()))
            parts = [t & set(block[k:k + stretch]) for k in range(len(block)) if block[k] in t]
            parts = [p for p in parts if len(p) >= containment * len(t) - 1e-9]
            if parts:
                met[label] = max(map(len, parts)) / len(t), set().union(*parts)
        for label, (share, shared) in met.items():
            if not any(s > share and shared <= o for s, o in met.values()):
                labels.add(label)
                best = max(best, share)
    return labels, best


def test_notices_over_several_lines(spark, monkeypatch):
    wrapped = [("x " * 250 + "\n" if i % 2 else "Code\n\n") + "\n".join(" * " + x for x in textwrap.wrap(t, 40)) + "\n\nint x = 1;\n"
               for i, (_, t) in enumerate(TEMPLATES)]
    words = dict(TEMPLATES)["isc-terms"].split()
    spread = "x\n" * 300 + " ".join(words[:13]) + " y" * 400 + " " + " ".join(words[13:])
    got = labels_of(spark, monkeypatch, [*wrapped, spread, "a\nb", ""])
    for (label, _), labels in zip(TEMPLATES, got):
        assert label in labels
    assert got[-3:] == [{""}, {""}, {""}]  # words that lie far apart are no notice
    for text, labels in zip([*wrapped, spread], got):
        assert {a for a in labels if a in dict(TEMPLATES)} == brute_labels(text)[0]


def test_all_templates_of_a_block_count(spark, monkeypatch):
    t = dict(TEMPLATES)
    part = {a: " ".join(t[a].split()[:-1]) for a in ("bsd-terms", "apache-terms", "isc-terms")}
    got = labels_of(spark, monkeypatch, [t["mit-terms"] + " " + part["bsd-terms"], t["mit-terms"] + " " + part["apache-terms"] +
                                         " " + part["isc-terms"], t["cc-by-nc"], t["cc-by-nc"] + " " + t["cc-by-sa"],
                                         t["gpl-terms"], t["agpl-notice"]])
    assert got == [{"mit-terms", "bsd-terms"}, {"mit-terms", "apache-terms", "isc-terms"}, {"cc-by-nc"}, {"cc-by-nc", "cc-by-sa"},
                   {"gpl", "gpl-terms"}, {"agpl-notice", "gpl", "gpl-terms"}]


FAR = "a man from the city went to see what was there and found nothing of note "


def test_scattered_words_are_no_notice(spark, monkeypatch):
    texts = ["The hostages were released " + FAR * 4 + "under a new law " + FAR * 4 + "which needs a license of the state",
             "We opened 4 offices to 0 protest. " + FAR + "They are licensed by the state under rule cc of the code by nc staff.",
             dict(TEMPLATES)["apache-notice"] + ". " + FAR * 9 + "A talk at mit.",
             "Released under the " + "very " * 9 + "MIT License", "Released under the very MIT License"]
    assert labels_of(spark, monkeypatch, texts) == [{""}, {""}, {"apache", "apache-notice"}, {"mit"}, {"mit", "mit-notice"}]


def test_registered_query_matches_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    notices = [n.split() for _, n in TEMPLATES]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rnd.randint(1, 4)):
            words += ["x"] * rnd.choice([0, 3, 200, 240, 255, 256, 300])
            for word in rnd.choice(notices):
                if rnd.random() > 0.12:
                    words += [word] + rnd.choices(["the", "license", "\n", "K\u212a"], k=rnd.choice([0, 0, 0, 1, 2]))
        texts.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1]), (None, texts[2]), (500, None), (501, "")]
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((str(r.doc_id), r.n_words, r.labels, round(r.score, 9)) for r in queries.op5_license_scan(spark, "").collect())
    want = []
    for i, text in rows:
        own = brute(text)
        labels, best = brute_labels(text or "")
        labels |= set(filter(None, own[4].split(",")))
        want.append((str(i), own[0], ",".join(sorted(labels)), round(1.0 if own[1] else best, 9)))
    assert got == sorted(want)
