"""Jaccard join of documents on sets of five-word n-grams, by MinHash banding.

1. Every document gets its n-gram set, and from it a digest, MinHash bands and
   a sketch (one byte of each MinHash value). Equal sets are one class.
2. Classes that share a band meet in a bucket. Their sketches drop pairs that
   are far below the threshold; what remains is linked, each class to the
   smallest it reaches.
3. The linked classes form groups. Each group brings its full n-gram sets
   together once, and all its pairs are verified on them.

Buckets and groups beyond a block are dealt out as pairs of blocks, so no task
holds more than two blocks; pairs are counted where they meet and never become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import fresh, stored, table, text_steps
from fleetwatt.llm.components import components
from fleetwatt.llm.tokens import NOT_ALPHANUMERIC, spread, word_keys

N = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
MAX_HASHES = 128
# Rows of a block: of sketches, and of n-gram sets. Groups of more than 24 blocks have larger ones, up to 8 times.
SKETCH_BLOCK = 512
BLOCK = 128
# Rows without id come after all others.
NO_ID = (1 << 63) - 1
# Columns of a dense product in verification.
SPAN = 1 << 14


def banding(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows per band for which ``hashes`` reach the recall at the threshold."""
    for rows in range(16, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram keys of each text, one after another, and where each begins.

    A text of fewer than n words, but not none, has one n-gram of all of them.
    """
    rows = len(offsets) - 1
    text, word = word_keys(data, offsets, NOT_ALPHANUMERIC)
    counts = np.bincount(text, minlength=rows)
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(len(word))  # words from here to the end of the text
    key = np.zeros(len(word), np.uint64)
    first = np.arange(len(word)) == np.repeat(ends - counts, counts)
    padded = np.concatenate([word, np.zeros(n, np.uint64)])
    for j in range(n):
        key = spread(key * np.uint64(0x9E3779B97F4A7C15) + np.where(left > j, padded[j : j + len(word)], np.uint64(j + 1)))
    keep = (left >= n) | first
    text, key = text[keep], key[keep]
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    other = np.ones(len(key), bool)
    other[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    text, key = text[other], key[other]
    return key, np.concatenate([[0], np.cumsum(np.bincount(text, minlength=rows))])


def digest(keys: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(keys.tobytes()) - (1 << 63)


def min_hashes(keys: np.ndarray, cuts: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash values of the non-empty sets: an array of hashes x sets."""
    factors = spread(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    starts = cuts[:-1][np.diff(cuts) > 0]
    out = np.empty((hashes, len(starts)), np.uint64)
    for i, factor in enumerate(factors):
        product = keys * factor
        product ^= product >> np.uint64(32)
        out[i] = np.minimum.reduceat(product * factor, starts)
    return out


def signatures(documents: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, mark, node, bands, sketch of each row of ``documents(doc_id, text, mark)``; node is the digest of the n-gram set, NULL without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_steps(batches):
            keys, cuts = gram_sets(data, offsets)
            filled = np.flatnonzero(np.diff(cuts) > 0)
            node: list[int | None] = [None] * batch.num_rows
            band: list[list[int] | None] = [None] * batch.num_rows
            sketch: list[bytes | None] = [None] * batch.num_rows
            if len(filled):
                values = min_hashes(keys, cuts, bands * rows)
                joined = np.zeros((bands, len(filled)), np.uint64)
                for j in range(rows):
                    joined = spread(joined * np.uint64(0x9E3779B97F4A7C15) + values[j::rows] + np.arange(bands, dtype=np.uint64)[:, None])
                joined = np.ascontiguousarray(joined.T).view(np.int64)
                low = np.ascontiguousarray((spread(values) & np.uint64(0xFF)).astype(np.uint8).T)
                for at, row in enumerate(filled.tolist()):
                    node[row] = digest(keys[cuts[row] : cuts[row + 1]])
                    band[row] = joined[at]
                    sketch[row] = low[at].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(node, pa.int64()), pa.array(band, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                names=["doc_id", "mark", "node", "bands", "sketch"],
            )

    return documents.mapInArrow(sign, "doc_id long, mark long, node long, bands array<long>, sketch binary")


def text_mark(text: Column) -> Column:
    """Tells texts apart that share an id, or have none."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def dealt(df: DataFrame, size: str, least: int, largest: int) -> DataFrame:
    """One row per pair of blocks that a row takes part in: adds i <= j and ``own``, the row's block.

    A group of ``size`` rows has as many blocks as it needs; a small one is the
    pair (0, 0) alone. The block of a row follows from its node.
    """
    block = F.greatest(F.lit(least), F.least(F.lit(largest), F.floor(F.col(size) / 24)))
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(2)), blocks).cast("int")
    return (
        df.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", size)
    )


def together(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one key in one task and in order. The number of tasks is given, since few bytes may be much work."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys).sortWithinPartitions(*keys)


def groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Runs of rows equal in the first ``width`` columns, from batches in that order."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(width)]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(k[a] for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def reached(linked: np.ndarray, left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """Of ``count`` rows the smallest row number each is connected with, by links between ``left`` and ``right``."""
    label = np.arange(count)
    any_left, any_right = linked.any(1), linked.any(0)
    left, right, linked = left[any_left], right[any_right], linked[any_left][:, any_right]
    while linked.size:
        before = label.copy()
        np.minimum.at(label, left, np.where(linked, label[right][None, :], count).min(1))
        np.minimum.at(label, right, np.where(linked, label[left][:, None], count).min(0))
        label = label[label]
        if (label == before).all():
            break
    return label


def sides(own: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of either block; both times all rows if the blocks are one."""
    if i == j:
        every = np.arange(len(own))
        return every, every
    return np.flatnonzero(own == i), np.flatnonzero(own == j)


def agreement(sketch: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In how many places the sketches ``left`` equal the sketches ``right``."""
    if len(left) * len(right) <= 4096:
        return (sketch[left][:, None, :] == sketch[right][None, :, :]).sum(2)
    out = np.zeros((len(left), len(right)), np.int16)
    for place in np.ascontiguousarray(sketch.T):
        out += place[left][:, None] == place[right][None, :]
    return out


def candidate_links(classes: DataFrame, bands: int, rows: int, threshold: float) -> DataFrame:
    """Links a, b between classes that share a band and whose sketches do not rule them out."""
    hashes = bands * rows
    agree = threshold + (1 - threshold) / 256
    # Six standard deviations below what the threshold leads to expect.
    least = int(hashes * agree - 6 * np.sqrt(hashes * agree * (1 - agree)))
    entries = classes.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = entries.join(shared, "bucket").join(classes.select("node", "sketch"), "node")
    spread_out = dealt(members, "size", SKETCH_BLOCK, 8 * SKETCH_BLOCK).select("bucket", "i", "j", "own", "node", "sketch")
    keys = ["bucket", "i", "j"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for group in groups(batches, 3):
            if len(group) < 2:
                continue
            i, j = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            node = group.column(4).to_numpy()
            order = np.argsort(node)
            node = node[order]
            sketch = np.frombuffer(b"".join(group.column(5).to_pylist()), np.uint8).reshape(len(node), hashes)[order]
            left, right = sides(group.column(3).to_numpy()[order], i, j)
            alike = agreement(sketch, left, right) >= least
            if i == j:
                np.fill_diagonal(alike, False)
            root = reached(alike, left, right, len(node))
            linked = np.flatnonzero(root != np.arange(len(node)))
            a += node[linked].tolist()
            b += node[root[linked]].tolist()
            if len(a) > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return together(spread_out, keys).mapInArrow(link, "a long, b long")


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``."""
    used = np.unique(np.concatenate([left, right]))
    row = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    gram, column, times = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True, return_counts=True)
    common = times > 1  # only these can be in two sets
    rank = np.cumsum(common) - 1
    keep = common[column]
    row, column = row[keep], rank[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    place = np.searchsorted(used, left), np.searchsorted(used, right)
    out = np.zeros((len(left), len(right)), np.float32)
    total = int(common.sum())
    for low in range(0, total, SPAN):
        a, b = np.searchsorted(column, [low, low + SPAN])
        part = np.zeros((len(used), min(SPAN, total - low)), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        out += part[place[0]] @ part[place[1]].T
    return out


def verified(documents: DataFrame, grouped: DataFrame, threshold: float) -> DataFrame:
    """node, links, a, b: verified partners of a class in one pair of blocks, and links to the smallest class reached.

    ``grouped(doc_id, mark, node, size, root, members)`` names a document of each
    class, the number of its copies, its group and the size of that group.
    """
    # Shuffled at every size: the groups grow with the corpus.
    texts = documents.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "mark", "text").join(grouped.hint("merge"), ["doc_id", "mark"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_steps(batches):
            keys, cuts = gram_sets(data, offsets)
            node = batch.column(2).to_numpy()
            # The marks of two texts may be the same.
            right = [r for r in range(len(node)) if cuts[r + 1] > cuts[r] and digest(keys[cuts[r] : cuts[r + 1]]) == node[r]]
            if right:
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(pa.array(right)) for c in (2, 3, 4, 5)],
                        pa.array([keys[cuts[r] : cuts[r + 1]].tobytes() for r in right], pa.binary()),
                    ],
                    names=["node", "size", "root", "members", "grams"],
                )

    sets = texts.select("doc_id", "text", "node", "size", "root", "members").mapInArrow(
        expand, "node long, size long, root long, members long, grams binary"
    )
    keys = ["root", "i", "j"]
    spread_out = dealt(sets, "members", BLOCK, 8 * BLOCK).select(*keys, "own", "node", "size", "grams")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 3):
            i, j = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            node, first = np.unique(group.column(4).to_numpy(), return_index=True)
            group = group.take(pa.array(first))  # repeated rows of one document
            size = group.column(5).to_numpy()
            sets = [np.frombuffer(g, np.uint64) for g in group.column(6).to_pylist()]
            count = np.array([len(s) for s in sets])
            left, right = sides(group.column(3).to_numpy(), i, j)
            if not len(left) or not len(right):
                continue
            common = shared_counts(sets, left, right)
            either = count[left][:, None] + count[right][None, :] - common
            linked = common + 1e-6 >= threshold * either
            if i == j:
                np.fill_diagonal(linked, False)
            gained = np.zeros(len(node), np.int64)
            gained[left] += linked @ size[right]
            if i != j:
                gained[right] += linked.T @ size[left]
            root = reached(linked, left, right, len(node))
            child = np.flatnonzero(root != np.arange(len(node)))
            has = np.flatnonzero(gained)
            none = pa.nulls(len(has), pa.int64())
            if len(has):
                yield pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(gained[has]), none, none], names=["node", "links", "a", "b"])
            if len(child):
                none = pa.nulls(len(child), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(node[child]), pa.array(node[root[child]])], names=["node", "links", "a", "b"])

    return together(spread_out, keys).mapInArrow(verify, "node long, links long, a long, b long")


def classed(documents: DataFrame, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """doc_id, mark, node of each row, and per node (n-gram set) its class, the class's smallest id and the number of links."""
    bands, rows = banding(threshold, recall)
    documents = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_mark(F.col("text")).alias("mark")
    )
    signed = stored(signatures(documents, bands, rows), "signatures")
    classes = stored(
        signed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "mark")).alias("first"),
            F.count("*").alias("size"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    near = components(candidate_links(classes, bands, rows, threshold))
    members = near.groupBy("root").agg(F.count("*").alias("members"))
    grouped = near.join(members, "root").join(classes.select("node", "first.*", "size"), "node")
    grouped = stored(grouped.select("doc_id", "mark", "node", "size", "root", "members"), "groups")
    found = stored(verified(documents, grouped, threshold), "verified")
    links = found.where(F.col("node").isNotNull()).groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(found.where(F.col("a").isNotNull()).select("a", "b"))
    first = classes.select("node", "first_doc")
    smallest = whole.join(first, "node").groupBy("root").agg(F.min("first_doc").alias("smallest"))
    placed = whole.join(smallest, "root").select("node", "root", "smallest")
    answer = (
        classes.select("node", "first_doc", "size")
        .join(placed, "node", "left")
        .join(links, "node", "left")
        .select(
            "node",
            F.coalesce("root", "node").alias("root"),
            F.coalesce("smallest", "first_doc").alias("class_id"),
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    return signed.select("doc_id", "mark", "node"), answer


def join(documents: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id, n_links of each row of ``documents(doc_id, text)``.

    ``n_links`` is the number of other rows whose n-gram sets have a Jaccard
    similarity of at least ``threshold``, copies included. ``class_id`` is the
    smallest doc_id that links lead to. Any two rows are found with at least
    the probability ``recall`` if they are at the threshold, and more above it.
    Words are lower-cased (A-Z) and cut at ASCII characters other than letters
    and digits, so punctuation does not tell copies apart.
    Texts without words (NULL, empty) have no links and are their own class.
    Repeated rows are copies of each other. Rows without id are compared like
    others; a class of such rows alone has no id. Extra columns are left out.
    """
    signed, answer = classed(documents, threshold, recall)
    worded = signed.where(F.col("node").isNotNull()).join(answer, "node").select("doc_id", "class_id", "n_links")
    wordless = signed.where(F.col("node").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return worded.unionByName(wordless)


def one_of_each(documents: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """The rows of ``documents``, with all their columns, that are the first of their class.

    The first has the smallest id (rows without id come last), and of one id the
    text with the smallest hash; of rows that repeat both, one stays. Texts without
    words are in no class and all stay. Other texts under the id of a row stay or
    go by their own class.
    """
    signed, answer = classed(documents, threshold, recall)
    key = ["_id", "_mark"]
    rows = signed.where(F.col("node").isNotNull()).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("mark").alias("_mark"), "node")
    counted = rows.groupBy(*key, "node").agg(F.count("*").alias("n")).join(answer.select("node", "root"), "node")
    firsts = counted.groupBy("root").agg(F.min(F.struct(*key, "n")).alias("first")).select("first.*")
    wordless = signed.where(F.col("node").isNull()).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("mark").alias("_mark"), F.lit(1).cast("long").alias("n"))
    names = {name: fresh(documents, name) for name in (*key, "n")}
    chosen = stored(firsts.unionByName(wordless.distinct()), "firsts").withColumnsRenamed(names)
    own = {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_mark": text_mark(F.col("text"))}
    kept = documents.withColumns({names[name]: value for name, value in own.items()}).join(chosen, [names[name] for name in key])
    # Only rows that repeat an id and its text are sorted, and tasks keep one of each before the shuffle.
    order = Window.partitionBy(*(names[name] for name in key)).orderBy(F.lit(0))
    place = fresh(documents, "_place")
    again = kept.where(F.col(names["n"]) > 1).withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return kept.where(F.col(names["n"]) == 1).unionByName(again).select(*(F.col(f"`{c}`") for c in documents.columns))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Classes and numbers of links of all documents."""
    return join(table(spark, sf_dir, "documents"))
