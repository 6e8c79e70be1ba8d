import io
import random
import zlib

import numpy as np

from ledgerline.llm.common import NO_ID
from ledgerline.llm.token_files import (EliasFano, read_file, read_token_files, token_file_folder, write_file,
                                        write_token_files)
from ledgerline.llm.tokens import default_tokenizer
from test_packing import whole_ids


def test_elias_fano_round_trip_and_select():
    rng = random.Random(2)
    for values in ([], [0], [0, 0, 0], [5], [2**40], sorted(rng.randrange(10**6) for _ in range(3000)),
                   sorted(rng.randrange(2000) for _ in range(5000)), [2**62, 2**62 + 1]):
        code = EliasFano.read(io.BytesIO(EliasFano.of(np.array(values, np.uint64)).to_bytes()))
        assert code.values().tolist() == values
        for i in range(0, len(values), 97):
            assert code.select(i) == values[i]
        if len(values) > 1000:
            per = 8 * (len(code.lows) + len(code.highs) + 4 * len(code.samples)) / len(values)
            assert per <= 2.2 + max(0, np.log2(values[-1] / len(values))) + 0.5


def test_file_round_trip():
    for big in (10, 70_000):
        ids = [np.array(x, "<u4").tobytes() for x in ([1, 2, 0], [0], [big, 0], [3] * 1000 + [0])]
        out = io.BytesIO()
        write_file(out, [NO_ID, NO_ID, -5, 2**40], ids)
        rows = list(read_file(io.BytesIO(out.getvalue())))
        assert [r[0] for r in rows] == [None, None, -5, 2**40]
        assert [r[1] for r in rows] == [0, 3, 4, 6]
        assert [r[2].tobytes() for r in rows] == ids


def test_documents_in_order(spark, odd_docs):
    folder = token_file_folder(spark)
    manifest = write_token_files(odd_docs, default_tokenizer(), folder, file_ids=1000)
    assert manifest.count() > 1
    got = read_token_files(manifest, folder).orderBy("start").collect()
    want = sorted((r.doc_id if r.doc_id is not None else NO_ID, r.text or "") for r in odd_docs.collect())
    assert [r.doc_id for r in got] == [None if d == NO_ID else d for d, _ in want]
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    sums = sorted((len(whole_ids(t)), zlib.crc32(whole_ids(t).tobytes())) for _, t in want)
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sums


def test_empty(spark, no_docs):
    folder = token_file_folder(spark)
    assert read_token_files(write_token_files(no_docs, default_tokenizer(), folder), folder).count() == 0


def test_the_query_reads_by_the_select_structure(spark, odd_docs, tmp_path, monkeypatch):
    import numpy as np

    from ledgerline.llm.token_files import EVERY, EliasFano
    rng = np.random.default_rng(4)
    for n in (0, 1, EVERY - 1, EVERY, EVERY + 1, 5 * EVERY + 3):
        for top in (1, 50, 1 << 40):
            values = np.sort(rng.integers(0, top, n, np.uint64))
            coded = EliasFano.of(values)
            assert list(coded.ascending()) == values.tolist() == [coded.select(i) for i in range(n)]
    import inspect

    from ledgerline.llm import token_files
    assert "values()" not in inspect.getsource(token_files.read_file)


def test_rows_without_id_are_spread(spark, tmp_path):
    from ledgerline.llm.token_files import read_token_files, write_token_files
    from ledgerline.llm.tokens import default_tokenizer
    docs = spark.range(900).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "concat('text ', id) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_token_files(docs, default_tokenizer(), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["documents"] for r in manifest.collect()]
    assert sum(sizes) == 900 and max(sizes) < 300
    ids = [r["doc_id"] for r in read_token_files(manifest, str(tmp_path)).orderBy("start").collect()]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
