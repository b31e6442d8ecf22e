"""Log probability of texts: adaptive byte contexts (PPM) and smoothed word frequencies.

Word counts cover all training texts. The words that make up at least one in
``FREQUENT`` of all are at most ``FREQUENT`` many, whatever the corpus: those
are looked up in the task that reads the text. All others are joined to their
counts, so no key of that join holds more than a small share of the rows. Byte
contexts are treated the same way: the frequent ones are in the tree, what
follows the others is joined to its counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm import ppm
from fleetwatt.llm.common import held_out, id_text, stored, table, text_steps
from fleetwatt.llm.tokens import word_keys

FREQUENT = 1 << 16
# Key of the end of a text, which counts as one more word.
END = 0
HELD_WORDS = 1 << 20


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n: how often each word occurs in all texts, with one end per text. Words are 64-bit keys."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = ends = 0

        def out(word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

        for batch, data, offsets in text_steps(batches):
            ends += batch.num_rows
            _, found = word_keys(data, offsets)
            word, n = np.unique(found, return_counts=True)
            keys.append(word)
            counts.append(n)
            held += len(word)
            if held > HELD_WORDS:
                word, n = ppm.merged(keys, counts)
                keys, counts, held = [word], [n], len(word)
                if held > HELD_WORDS // 2:
                    yield out(word, n)
                    keys, counts, held = [], [], 0
        if keys:
            yield out(*ppm.merged(keys, counts))
        if ends:
            yield out(np.array([END], np.uint64), np.array([ends]))

    return texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def score(documents: DataFrame, training: DataFrame, *keep: str) -> DataFrame:
    """Scores of ``documents(doc_id, text, *keep)`` by what ``training(text)`` holds.

    Returns doc_id, keep, n_tokens, n_known, train_tokens, base_score, score.
    NULL texts are empty: one token, their end. Each row is scored alone, so
    repeated rows and NULL ids each give a row. Without training texts no word
    is known, N and V are 0, and ``score`` spreads evenly over the byte values.
    """
    spark = documents.sparkSession
    counts = stored(word_counts(training), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = counts.where(F.col("n") >= max(1, total / FREQUENT)).toArrow()
    words = frequent.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    words = words[order]
    logs = np.log10(frequent.column("n").to_numpy()[order] + 1.0)
    tree = ppm.build(ppm.gram_counts(training.select("text", F.lit("all").alias("kind"))))
    whole = tree.cold is None
    tree_shared = spark.sparkContext.broadcast(tree)
    shared = spark.sparkContext.broadcast((words, logs))
    even = -float(np.log10(256))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, logs = shared.value
        tree = tree_shared.value
        number = TaskContext.get().partitionId() << 40
        for batch, data, offsets in text_steps(batches):
            rows = batch.num_rows
            text, found = word_keys(data, offsets)
            text = np.concatenate([text, np.arange(rows)])
            found = np.concatenate([found, np.full(rows, END, np.uint64)])
            place = np.minimum(np.searchsorted(words, found), max(0, len(words) - 1))
            hit = words[place] == found if len(words) else np.zeros(len(found), bool)
            known = np.bincount(text[hit], minlength=rows)
            gained = np.bincount(text[hit], logs[place[hit]], minlength=rows) if len(words) else np.zeros(rows)
            rest = np.flatnonzero(~hit)
            by = rest[np.lexsort((found[rest], text[rest]))]
            other = np.ones(len(by), bool)
            other[1:] = (found[by][1:] != found[by][:-1]) | (text[by][1:] != text[by][:-1])
            heads = np.flatnonzero(other)
            times = np.diff(np.append(heads, len(by)))
            cuts = np.concatenate([[0], np.cumsum(np.bincount(text[by][heads], minlength=rows))]).astype(np.int32)
            away: list = []
            if tree.kinds:
                logp = -tree.code_lengths(data, offsets, away=None if whole else away)[:, 0] * np.log10(2)
            else:
                logp = (np.diff(offsets) + 1) * even
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(number + np.arange(rows)),
                    pa.array(np.bincount(text, minlength=rows)),
                    pa.array(known),
                    pa.array(gained),
                    pa.array(logp),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(found[by][heads].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(times.astype(np.int32))),
                    *([] if whole else ppm.away_lists(away, rows)),
                ],
                names=[*batch.schema.names, "row", "n_tokens", "known", "gained", "score", "words", "times", *([] if whole else ["grams", "gram_times"])],
            ).drop_columns(["text"])
            number += rows

    texts = documents.select("doc_id", "text", *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields if f.name != "text")
    made = f"{kept}, row long, n_tokens long, known long, gained double, score double, words array<long>, times array<int>"
    made += "" if whole else ", grams array<long>, gram_times array<long>"
    # Written once: both uses below see the same row numbers.
    rows = stored(texts.mapInArrow(read, made), "scored")
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    gains = rare.join(counts, "word").select(
        "row", "times", (F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("gain"), F.lit(0.0).alias("bits")
    )
    if not whole:
        bits = ppm.corrections(rows.select("row", "grams", "gram_times"), tree, tree_shared)
        gains = gains.unionByName(bits.select("row", F.lit(0).alias("times"), F.lit(0.0).alias("gain"), F.col("more").alias("bits")))
    found = gains.groupBy("row").agg(F.sum("times").alias("more"), F.sum("gain").alias("gain"), F.sum("bits").alias("bits"))
    size = F.lit(float(np.log10(total + distinct + 1)))
    return rows.join(found, "row", "left").select(
        "doc_id",
        *keep,
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("gained") + F.coalesce("gain", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"),
        (F.col("score") - F.coalesce("bits", F.lit(0.0)) * F.lit(float(np.log10(2)))).alias("score"),
    )


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those outside the seventh held out."""
    out = held_out(F.col("doc_id"), 7, 2)
    documents = id_text(table(spark, sf_dir, "documents")).withColumn("held_out", out)
    return score(documents, documents.where(~F.col("held_out")), "held_out")
