"""Text quality from compressed sizes: a dictionary of good and one of bad text, the difference calibrated.

A text is cut into pieces of ``PIECE`` bytes, each compressed alone with either
dictionary, so that the dictionaries and not the text before decide the size.
The normalised difference of the sizes becomes a probability by logistic
calibration on labelled texts that the dictionaries have not seen. Beside it
stands the size under the good dictionary, since text that repeats itself is
small under either and the difference says little about it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import held_out, id_text, table, text_steps

PIECE = 1024
DICTIONARY_BYTES = 112 << 10
LEVEL = 1
ACCEPT = 0.7
# Bytes added to the length, so that very short texts do not count as extreme.
DIFFERENCE_PRIOR, SIZE_PRIOR = 100, 50
# Bounds of the sample a model is fitted on.
SAMPLE_PER_LABEL = 4000
SAMPLE_BYTES = 16 << 10


@dataclass
class Compressors:
    """What a task needs to score: the dictionaries as bytes, and the calibration."""

    good: bytes
    bad: bytes
    weights: np.ndarray  # of the measures
    offset: float

    def open(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return compressor(self.good), compressor(self.bad)


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if not content:
        return zstandard.ZstdCompressor(**settings)
    prepared = zstandard.ZstdCompressionDict(content)
    prepared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=prepared, **settings)


def measures(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, float, float]:
    """Bytes that the bad dictionary needs more, per byte of text; bytes under the good one, and their square. All 0 if empty."""
    by_good = by_bad = 0
    for start in range(0, len(text), PIECE):
        piece = text[start : start + PIECE]
        by_good += len(good.compress(piece))
        by_bad += len(bad.compress(piece))
    size = by_good / (len(text) + SIZE_PRIOR)
    return (by_bad - by_good) / (len(text) + DIFFERENCE_PRIOR), size, size * size


def excerpt(text: bytes) -> bytes:
    """At most SAMPLE_BYTES for training, in evenly spaced pieces of the whole text."""
    if len(text) <= SAMPLE_BYTES:
        return text
    pieces = SAMPLE_BYTES // PIECE
    starts = np.linspace(0, len(text) - PIECE, pieces).astype(int)
    return b"".join(text[s : s + PIECE] for s in starts)


def dictionary(samples: list[bytes]) -> bytes:
    pieces = [text[s : s + PIECE] for text in samples for s in range(0, len(text), PIECE)]
    pieces = [p for p in pieces if len(p) >= 64]
    joined = b"".join(pieces)
    if len(pieces) < 64 or len(joined) < 4 * DICTIONARY_BYTES:
        # Too little to choose from: the text itself is the dictionary.
        return joined[-DICTIONARY_BYTES:]
    return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 80, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and offset of the logistic curve of y on the columns of x by Newton's method."""
    middle, spread = x.mean(0), x.std(0) + 1e-9
    design = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    weight = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ weight, -30, 30)))
        gradient = design.T @ (y - p) - ridge * weight
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(weight))
        step = np.clip(np.linalg.solve(curve, gradient), -3, 3)
        weight += step
        if np.abs(step).max() < 1e-9:
            break
    return weight[:-1] / spread, float(weight[-1] - (weight[:-1] * middle / spread).sum())


def train(documents: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Compressors:
    """Fit on ``labels(doc_id, quality)`` joined to their texts.

    Of each label ``per_label`` documents are used, chosen by a hash of the id,
    with at most SAMPLE_BYTES of each. Half of them, by another hash, make the
    dictionaries, the others the calibration. Labels of one id that disagree count as bad;
    NULL labels, ids and texts teach nothing. Without any label scores are 1/2;
    with one label only, they are its share.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id", F.lit(6)), "doc_id"]
    chosen = [known.where(own).orderBy(*order).limit(per_label) for own in (F.col("quality") == 1, F.col("quality") != 1)]
    learns = F.pmod(F.xxhash64("doc_id", F.lit(61)), F.lit(2)) == 1
    bound = F.broadcast(chosen[0].unionByName(chosen[1]).withColumn("learns", learns))  # at most 2 x per_label rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [excerpt((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.binary()), batch.column(2), batch.column(3), batch.column(0)], names=["text", "quality", "learns", "doc_id"]
            )

    sample = (
        id_text(documents)
        .where(F.col("text").isNotNull())
        .join(bound, "doc_id")
        .mapInArrow(cut, "text binary, quality int, learns boolean, doc_id long")
        .toPandas()
        .sort_values(["quality", "doc_id", "text"])
    )
    texts, quality, learn = sample["text"].tolist(), sample["quality"].to_numpy(), sample["learns"].to_numpy(bool)
    good = dictionary([t for t, q, own in zip(texts, quality, learn, strict=True) if own and q == 1])
    bad = dictionary([t for t, q, own in zip(texts, quality, learn, strict=True) if own and q != 1])
    check = ~learn if (~learn).any() else learn
    if not len(texts):
        return Compressors(b"", b"", np.zeros(3), 0.0)
    by_good, by_bad = compressor(good), compressor(bad)
    x = np.array([measures(t, by_good, by_bad) for t, own in zip(texts, check, strict=True) if own])
    y = (quality[check] == 1).astype(float)
    # The sample holds as many of either label; weights bring back their shares.
    share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    weights, offset = calibrate(x, y)
    sampled = y.mean()
    if 0 < share < 1 and 0 < sampled < 1:
        offset += float(np.log(share / (1 - share)) - np.log(sampled / (1 - sampled)))
    return Compressors(good, bad, weights, offset)


def scores(model: Compressors, compressors: tuple, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    whole = data.tobytes()
    x = np.array([measures(whole[a:b], *compressors) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]).reshape(-1, 3)
    return 1 / (1 + np.exp(-np.clip(x @ model.weights + model.offset, -700, 700)))


def score(documents: DataFrame, model: Compressors) -> DataFrame:
    """doc_id and ``score`` from 0 to 1 of each row of ``documents(doc_id, text)``.

    Empty and NULL texts have the size 0 and get the score that goes with it.
    Each row is judged alone by its whole text; repeated rows give equal scores,
    rows without id stay. Other columns are left out.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        opened = known.open()
        for batch, data, offsets in text_steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(known, opened, data, offsets))], names=["doc_id", "score"])

    return id_text(documents).mapInArrow(judge, "doc_id long, score double")


def accepted(documents: DataFrame, model: Compressors, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``documents``, with all their columns, whose text scores at least ``accept``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        opened = known.open()
        for batch, data, offsets in text_steps(batches):
            yield batch.filter(pa.array(scores(known, opened, data, offsets) >= accept))

    return documents.mapInArrow(choose, documents.schema)


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels outside the quarter held out."""
    documents = id_text(table(spark, sf_dir, "documents"))
    out = held_out(F.col("doc_id"), 4, 2)
    model = train(documents, table(spark, sf_dir, "labels").where(~out))
    scored = score(documents, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
