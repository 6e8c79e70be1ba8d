import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm.packing import pack
from ledgerline.llm.tokens import Encoder, default_tokenizer


def whole_ids(text):
    library = Tokenizer.from_file(default_tokenizer())
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check(rows, texts, length, segments, loss):
    """texts: ids per doc_id, of documents that occur once."""
    covered, sequences = collections.defaultdict(set), collections.defaultdict(list)
    for r in rows:
        ids = texts[r.doc_id]
        piece = ids[r.start:r.start + r.length]
        assert len(piece) == r.length > 0 and r.doc_tokens == len(ids)
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32
        span = set(range(r.start, r.start + r.length))
        assert not span & covered[r.doc_id]
        covered[r.doc_id] |= span
        sequences[r.sequence_id].append(r)
    assert {d: len(s) for d, s in covered.items()} == {d: len(i) for d, i in texts.items()}
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length and len(pieces) <= segments and sum(p.loss_tokens for p in pieces) <= loss
    return sequences


def test_every_id_once_within_all_limits(odd_docs):
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r.doc_id: whole_ids(r.text) for r in docs.collect()}
    for limits in ((1024, 64, 1024), (128, 2, 100), (16, 3, 5)):
        check(pack(docs, default_tokenizer(), "doc_id", "text", None, *limits, pool=4).collect(), texts, *limits)


def test_little_padding(spark):
    docs = spark.createDataFrame([(i, "some words of a text " * (i % 37 + 1)) for i in range(600)], "doc_id long, text string")
    docs = docs.coalesce(1)
    texts = {r.doc_id: whole_ids(r.text) for r in docs.collect()}
    sequences = check(pack(docs, default_tokenizer(), length=256).collect(), texts, 256, 64, 1024)
    filled = sum(p.length for s in sequences.values() for p in s)
    assert filled >= 0.98 * 256 * len(sequences)


def test_prompts_bear_no_loss_and_ids_come_back(spark):
    docs = spark.createDataFrame([(1, "Question?", "Answer."), (2, None, "Only text"), (3, "Only prompt", None)],
                                 "doc_id long, prompt string, text string")
    rows = pack(docs, default_tokenizer(), prompt_col="prompt", with_ids=True).collect()
    for r in rows:
        d = next(d for d in docs.collect() if d.doc_id == r.doc_id)
        head, whole = whole_ids(d.prompt)[:-1], np.concatenate([whole_ids(d.prompt)[:-1], whole_ids(d.text)])
        assert bytes(r.ids) == whole.tobytes()
        assert r.loss_tokens == len(whole) - max(1, len(head))


def test_empty_and_bad_limits(no_docs, odd_docs):
    assert pack(no_docs, default_tokenizer()).count() == 0
    with pytest.raises(ValueError):
        pack(odd_docs, default_tokenizer(), length=0)


def test_words_are_encoded_as_in_the_whole_text():
    import random
    rng = random.Random(1)
    parts = ["a", "b", "the", "é", "ß", " ", " ", "\n", "\t", "\r", "\xa0", "'s", "!", "12", "　", "<|endoftext|>",
             "%%%", "\x85", "\x1c", "你好", "🙂"]
    code = Encoder(default_tokenizer(), remember=60)
    for _ in range(60):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(20)]
        want = [np.array(e.ids, "<u4").tobytes() for e in code.library.encode_batch(texts, add_special_tokens=False)]
        assert code.encode(texts) == want
