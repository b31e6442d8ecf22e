"""Language of a text by the shortest exact code under one byte context tree per language."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm import ppm
from fleetwatt.llm.common import held_out, id_text, stored, text_steps

UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


def train(labelled: DataFrame) -> ppm.Tree:
    """One tree per language of ``text, lang``; rows without a language teach nothing. Texts count in lower case."""
    return ppm.build(
        ppm.gram_counts(labelled.where(F.col("lang").isNotNull()).select(F.lower("text").alias("text"), F.col("lang").alias("kind")))
    )


def identify(documents: DataFrame, tree: ppm.Tree) -> DataFrame:
    """doc_id, lang_pred, score: the language with the shortest code of the whole text, and its posterior.

    Languages are equally likely beforehand; ties go to the first by name.
    NULL texts, texts without a letter, and all texts where nothing was
    learned give ``und`` with score 0. Each row is judged alone, so repeated
    rows and NULL ids each give their row. Other columns are left out.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tree)
    whole = tree.cold is None

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bits under each language; what follows contexts without a row in the tree is named, to be joined."""
        from pyspark import TaskContext

        model = shared.value
        number = TaskContext.get().partitionId() << 40
        for batch, data, offsets in text_steps(batches):
            rows = batch.num_rows
            away: list = []
            bits = model.code_lengths(data, offsets, away=None if whole else away)
            lettered = [text is not None and LETTER.search(text) is not None for text in batch.column(1).to_pylist()]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * len(model.kinds)), pa.array(bits.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lettered, pa.bool_()), lists, *([] if whole else [pa.array(number + np.arange(rows)), *ppm.away_lists(away, rows)])],
                names=["doc_id", "lettered", "bits", *([] if whole else ["row", "grams", "gram_times"])],
            )
            number += rows

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = batch.num_rows
            lang = np.full(rows, UNDETERMINED, object)
            score = np.zeros(rows)
            if model.kinds and rows:
                bits = batch.column(2).flatten().to_numpy().reshape(rows, len(model.kinds)).copy()
                if not whole:
                    more = batch.column(3)
                    of = np.repeat(np.arange(rows), pc.fill_null(pc.list_value_length(more), 0).to_numpy(zero_copy_only=False))
                    entries = more.flatten()
                    np.add.at(bits, (of, entries.field(0).to_numpy()), entries.field(1).to_numpy())
                best = bits.argmin(1)
                weight = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000))
                lettered = batch.column(1).to_numpy(zero_copy_only=False)
                lang[lettered] = np.array(model.kinds, object)[best[lettered]]
                score[lettered] = (1 / weight.sum(1))[lettered]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang.tolist(), pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
            )

    texts = id_text(documents).select("doc_id", F.lower("text").alias("text"))
    made = "doc_id long, lettered boolean, bits array<double>"
    if whole:
        rows = texts.mapInArrow(coded, made)
    else:
        # Written once: both uses below see the same row numbers.
        kept = stored(texts.mapInArrow(coded, f"{made}, row long, grams array<long>, gram_times array<long>"), "coded")
        more = ppm.corrections(kept.select("row", "grams", "gram_times"), tree, shared)
        more = more.groupBy("row").agg(F.collect_list(F.struct("kind", "more")).alias("more"))
        rows = kept.drop("grams", "gram_times").join(more, "row", "left").select("doc_id", "lettered", "bits", "more")
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those outside the fifth held out."""
    from fleetwatt.llm.common import table

    documents = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 5, 0)
    tree = train(documents.where(~out))
    return identify(documents, tree).select("doc_id", out.alias("held_out"), "lang_pred", "score")
