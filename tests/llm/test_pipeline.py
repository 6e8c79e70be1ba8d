import os
import re
import sys

import __spark_entry__ as entry
import corpus_pipeline
import pyarrow as pa
import pytest
from ledgerline.llm import queries, tokens
from ledgerline.llm.common import give_back, short_batches
from ledgerline.llm.packing import pack
from ledgerline.llm.tokens import default_tokenizer
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(bool(re.match(rf"op{n}_", q)) for q in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(names)


def test_stages(spark, odd_docs, no_docs, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "simhash near-dedup", "benchmark decontamination", "packing"]
    for start in (odd_docs, no_docs):
        docs, columns = start, start.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            path = f"{tmp_path}/{start is odd_docs}-{i}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            assert i == 4 or docs.columns == columns
        assert (docs.count() > 0) == (start is odd_docs)


def test_run_packs_what_the_stages_keep(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id for r in rows}
    assert 0.5 * len(docs) < len(kept) <= len(docs)
    assert len({docs[d].encode().lower() for d in kept}) == len(kept)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(item in docs[d] for d in kept for item in items)
    assert all(sum(r.length for r in rows if r.doc_id == d) == next(r.doc_tokens for r in rows if r.doc_id == d) for d in kept)


BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_hand_texts_over_in_short_batches(spark, no_docs, stage):
    before = spark.conf.get(BYTES)
    try:
        stage(spark, no_docs, SF)
        texts = spark.range(0, 8_000, 1, 1).select(F.repeat(F.lit("0123456789"), 200).alias("text"))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

        rows, most = texts.mapInArrow(sizes, "n long, size long").agg(F.sum("n"), F.max("size")).first()
        assert rows == 8_000 and most < 5_000_000  # 16 MB in one batch otherwise
    finally:
        spark.conf.set(BYTES, before)


def test_a_smaller_bound_of_the_session_stays(spark):
    before = spark.conf.get(BYTES)
    try:
        for given, kept in (("1m", "1m"), ("64m", "4000000b"), ("2000000", "2000000")):
            spark.conf.set(BYTES, given)
            short_batches(spark)
            assert spark.sql(f"SET {BYTES}").first()["value"] == kept
    finally:
        spark.conf.set(BYTES, before)


def test_packing_leaves_no_tokenizer_in_workers(spark):
    """An executor has more workers than tasks: none keeps words after its task."""
    docs = spark.range(0, 400, 1, 8).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("word"), "id").alias("text"))
    assert corpus_pipeline.packing(spark, docs, SF).select("doc_id").distinct().count() == 400

    def left(batches):
        from ledgerline.llm import tokens
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens._loaded)])], ["n"])

    assert spark.range(0, 64, 1, 32).mapInArrow(left, "n long").agg(F.max("n")).first()[0] == 0


def test_few_words_give_the_same_pieces(spark):
    docs = spark.createDataFrame([(i, f"Some {i}\nwords {i % 7} of text{i} " * 30) for i in range(200)], "doc_id long, text string").coalesce(1)
    few = pack(docs, default_tokenizer(), length=128, remember=40, release=True).collect()
    assert few == pack(docs, default_tokenizer(), length=128).collect()


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_freed_memory_goes_back_without_a_tokenizer(monkeypatch):
    monkeypatch.setattr(tokens, "_loaded", {})

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    some = [bytes(2_000) for _ in range(50_000)]
    last = [bytes(2_000) for _ in range(100)]  # lies behind, so that free() alone does not shrink the heap
    del some
    held = resident()
    give_back()
    assert resident() < held - 50_000_000 and len(last) == 100
