"""Approximate nearest neighbours: inverted lists, scanned with adaptive numbers of dimensions.

A random rotation spreads the length of every difference evenly over the
dimensions, so a few of them estimate a distance. Within a probed list the
candidates are read in blocks of columns; after each block a hypothesis test
drops those whose partial distance already says that they are farther than the
best found so far. Survivors are measured in double precision on the originals.

Lists are dealt out in blocks of LIST_BLOCK rows; queries go to each block of
the lists they probe and pass through in batches, so a task holds one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import stored, table

NEIGHBOURS = 10
# Bounds of the sample that the index is fitted on.
SAMPLE = 20_000
SAMPLE_QUERIES = 256
MAX_LISTS = 2048
TARGET = 0.97
LIST_BLOCK = 4096
COLUMNS = 8
DEVIATIONS = 2.5  # of the estimate, below which a candidate stays


@dataclass
class Index:
    rotation: np.ndarray
    centres: np.ndarray  # rotated
    probes: int
    sizes: np.ndarray  # vectors per list

    def to_centres(self, rotated: np.ndarray) -> np.ndarray:
        return (rotated**2).sum(1)[:, None] - 2 * rotated @ self.centres.T + (self.centres**2).sum(1)

    def lists_of(self, rotated: np.ndarray) -> np.ndarray:
        return self.to_centres(rotated).argmin(1)

    def probed(self, rotated: np.ndarray, least: int) -> list[np.ndarray]:
        """Nearest lists of each query: ``probes``, and more until they hold ``least`` vectors."""
        order = np.argsort(self.to_centres(rotated), axis=1, kind="stable")
        held = np.cumsum(self.sizes[order], axis=1)
        counts = np.maximum(self.probes, (held < least).sum(1) + 1)
        return [row[: min(n, len(row))] for row, n in zip(order, counts, strict=True)]


def distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.maximum((queries**2).sum(1)[:, None] - 2 * queries @ vectors.T + (vectors**2).sum(1), 0)


def fit(sample: np.ndarray, total: int, target: float = TARGET, rounds: int = 8, seed: int = 9) -> Index:
    """Rotation, centres, and the number of lists that find ``target`` of the sample's own neighbours."""
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1]
    rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0].astype(np.float32)
    rotated = sample @ rotation
    lists = int(max(1, min(MAX_LISTS, np.sqrt(total), len(sample))))
    centres = rotated[rng.choice(len(rotated), lists, replace=False)].copy()
    index = Index(rotation, centres, 1, np.zeros(lists, np.int64))
    for _ in range(rounds):
        own = index.lists_of(rotated)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rotated)
        counts = np.bincount(own, minlength=lists)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    own = index.lists_of(rotated)
    queries = rotated[: min(SAMPLE_QUERIES, len(rotated))]
    nearest = np.argsort(distances(queries, rotated), axis=1, kind="stable")[:, : NEIGHBOURS + 1]
    place = np.empty((len(queries), lists), np.int64)
    np.put_along_axis(place, np.argsort(index.to_centres(queries), axis=1, kind="stable"), np.arange(lists)[None, :], 1)
    needed = np.sort(np.take_along_axis(place, own[nearest], 1).ravel())
    index.probes = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1
    return index


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector (doubles) of vectors that take part.

    Left out: NULL ids and vectors, zero vectors, NULL or non-finite components,
    and vectors whose length is not the most frequent one (ties: the smaller).
    """
    vector = F.col(vector_column).cast("array<double>")
    kept = vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
    )
    kept = kept.where(
        F.coalesce(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
        & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    length = kept.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.where(F.size("vector") == (length.n if length else 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def scan(index: Index, ids: np.ndarray, own: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best of one block: query id, vector ids and distances, nearest first."""
    rotated = (own @ index.rotation).astype(np.float32)
    turned = (queries @ index.rotation).astype(np.float32)
    dimension = rotated.shape[1]
    columns = [np.ascontiguousarray(rotated[:, c : c + COLUMNS]) for c in range(0, dimension, COLUMNS)]
    out = []
    first = min(len(ids), 4 * k)
    for query_id, query, spun in zip(query_ids, queries, turned, strict=True):
        # The first rows, in full, give the distance to beat.
        some = ids[:first] != query_id
        start = np.sort(((rotated[:first][some] - spun) ** 2).sum(1))
        limit = float(start[k - 1]) if len(start) >= k else np.inf
        alive = np.flatnonzero(ids != query_id)
        partial = np.zeros(len(alive), np.float32)
        for n, block in enumerate(columns):
            partial = partial + ((block[alive] - spun[n * COLUMNS : n * COLUMNS + block.shape[1]]) ** 2).sum(1)
            seen = min((n + 1) * COLUMNS, dimension)
            if seen < dimension:
                # Estimate of the whole: partial * dimension / seen, with a relative
                # deviation that falls with the root of the dimensions seen.
                slack = (1 + DEVIATIONS / np.sqrt(seen) * np.sqrt(1 - seen / dimension)) ** 2
                stay = partial * (dimension / seen) <= limit * slack
            else:
                stay = partial <= limit * (1 + 1e-4) + 1e-9
            alive, partial = alive[stay], partial[stay]
        exact = np.sqrt(((own[alive] - query) ** 2).sum(1))
        best = np.lexsort((ids[alive], exact))[:k]
        out.append((int(query_id), ids[alive][best], exact[best]))
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of ``vectors(id, vector)`` for each of ``queries(id, vector)``.

    Both come from ``usable``. A query never finds its own id. Ties go to the
    smaller id. Of equal vectors only the k + 1 smallest ids can be an answer,
    so others are left out before any shuffle of vectors. The index is fitted on
    SAMPLE vectors chosen by a hash of the id. Repeated ids count once for the
    smallest vector. Without vectors or queries the result is empty.
    """
    spark = vectors.sparkSession
    by_copy = Window.partitionBy("vector").orderBy("id")
    candidates = (
        vectors.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("copy", F.row_number().over(by_copy)).where(F.col("copy") <= k + 1)
    )
    candidates = stored(candidates.select("id", "vector"), "vectors")
    total = candidates.count()
    kinds = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], kinds)
    rows = candidates.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(SAMPLE).select("vector").toArrow()
    sample = matrix(rows.column("vector").combine_chunks()).astype(np.float32)
    index = fit(sample, total)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            own = known.lists_of(matrix(batch.column(1)).astype(np.float32) @ known.rotation)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=["id", "vector", "list"])

    listed = stored(candidates.mapInArrow(assign, "id long, vector array<double>, list int"), "lists")
    for row in listed.groupBy("list").count().collect():  # at most MAX_LISTS rows
        index.sizes[row["list"]] = row["count"]
    complete = spark.sparkContext.broadcast(index)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = complete.value
        blocks = -(-known.sizes // LIST_BLOCK)
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = known.probed(matrix(batch.column(1)).astype(np.float32) @ known.rotation, k + 1)
            pairs = [(n, at, b) for n, own in enumerate(lists) for at in own.tolist() for b in range(int(blocks[at]))]
            if pairs:
                row, at, block = map(list, zip(*pairs, strict=True))
                picked = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(at, pa.int32()), pa.array(block, pa.int32()), pa.array([1] * len(row), pa.int32())],
                    names=["id", "vector", "list", "block", "query"],
                )

    made = "id long, vector array<double>, list int, block int, query int"
    sent = queries.groupBy("id").agg(F.min("vector").alias("vector")).mapInArrow(probe, made)
    blocks = F.element_at(F.lit([int(-(-n // LIST_BLOCK)) or 1 for n in index.sizes]), F.col("list") + 1)
    dealt = listed.withColumn("block", F.pmod(F.xxhash64("id", F.lit(8)), blocks).cast("int")).withColumn("query", F.lit(0))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = complete.value
        at: tuple | None = None
        ids: list[np.ndarray] = []
        own: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in (2, 3, 4)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key, part = tuple(keys[:2, a].tolist()), batch.slice(a, b - a)
                if key != at:
                    at, ids, own = key, [], []
                if not keys[2, a]:  # vectors come before queries
                    ids.append(part.column(0).to_numpy())
                    own.append(matrix(part.column(1)))
                elif ids:
                    ids, own = [np.concatenate(ids)], [np.concatenate(own)]
                    found = scan(known, ids[0], own[0], matrix(part.column(1)), part.column(0).to_numpy(), k)
                    sizes = [len(f[1]) for f in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([f[0] for f in found], sizes).astype(np.int64)),
                            pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)),
                            pa.array(np.concatenate([f[2] for f in found])),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    keys = ["list", "block"]
    both = dealt.select("id", "vector", "list", "block", "query").unionByName(sent)
    found = both.repartition(*keys).sortWithinPartitions(*keys, "query").mapInArrow(read, "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    vectors = stored(usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "usable")
    return search(vectors, vectors.where(F.col("id") % 100 == 0))
