"""Training text from raw documents: quality, near copies, benchmark passages, secrets, packing.

Each stage takes what its predecessor kept. All but the last return the columns
of ``documents``; the last returns pieces of sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt.llm import decontamination, ngram_join, packing, quality, secrets
from fleetwatt.llm.common import held_out, importable, stored, table


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from their labels outside the quarter held out."""
    importable(spark)
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 4, 2))
    return quality.accepted(docs, quality.train(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    importable(spark)
    return ngram_join.one_of_each(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced and their characters counted anew."""
    importable(spark)
    names = docs.columns
    redacted = secrets.redact(docs, secrets.train())
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    importable(spark)
    return packing.digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_text),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", not_in_benchmark),
    ("secret scans", without_secrets),
    ("packing", packed),
]

# Compressed sizes, a forest and a tokenizer are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"stage-{number + 1}")
    return docs
