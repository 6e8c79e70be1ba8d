"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages
but the last return the columns of documents. NULL texts count as empty,
NULL ids and repeated rows are handled as the operators say, other columns
pass through, and no documents give no rows. A stage leaves the session with
Arrow batches bounded by bytes (``short_batches``), as its DataFrame runs later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import materialize, short_batches, table
from ledgerline.llm.decontaminate import drop_contaminated
from ledgerline.llm.exact_dedup import drop_exact_duplicates
from ledgerline.llm.packing import pack
from ledgerline.llm.quality_cnn import fit, keep_good
from ledgerline.llm.simhash_dedup import drop_near_duplicates
from ledgerline.llm.tokens import default_tokenizer


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more."""
    short_batches(spark)
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    short_batches(spark)
    return drop_exact_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id."""
    short_batches(spark)
    return drop_near_duplicates(docs, shingle=3, max_distance=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    short_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences of 1024 tokens.
    Workers keep few words and no tokenizer after a task: executors have
    filled their heap by now, and more workers live than tasks run."""
    short_batches(spark)
    return pack(docs, default_tokenizer(), length=1024, max_segments=64, max_loss=1024, remember=50_000, release=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The classifier, fingerprints and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
