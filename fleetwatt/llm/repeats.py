"""Removal of repeated byte strings, over all documents, by hash-compared suffix sorting.

Every string of LENGTH bytes has an anchor: the K-gram in it with the smallest
hash. Equal strings have equal anchors at the same place, so only strings with
the same anchor are ever compared, and each string belongs to one anchor.

1. Copies of whole texts are found by digest; the first of them is compared.
2. Anchors are counted over all documents; those that occur once are done.
3. Each other anchor brings the context of its strings, as a digest. Equal contexts
   become one row with their earliest place, with minima before the shuffle: all
   others are repeated as a whole.
4. Where contexts of one anchor differ, the earliest copy of each is brought to the
   anchor, and the strings whose hash occurs again are suffix sorted. Suffixes are
   compared by binary search for their common extension over prefix polynomial
   hashes, in a mergesort; equal neighbours are verified byte by byte.
5. An anchor with more differing contexts than a task can hold is no group: the strings
   of these contexts are told apart by 128-bit hashes, again with minima before
   the shuffle, and joined back, where adaptive execution splits a skewed string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import byte_view, steps, stored, table, text_steps
from fleetwatt.llm.numbering import numbered
from fleetwatt.llm.tokens import spread

LENGTH = 100
K = 20
# Anchors are told apart by 48 bits; the others are 0 and cost nothing in a shuffle. Two
# K-grams with one hash share a group, where their strings are compared like any others.
GRAM_BITS = ~np.uint64(0xFFFF)
# Differing contexts of one anchor that a task can hold.
MOST_CONTEXTS = 16384
LAST_ID = (1 << 63) - 1
CHUNK = 1 << 19
PLACE_BITS = 20  # of a place within a chunk
SORT_BYTES = 1 << 20
SORT_STRINGS = 1 << 18
# Bounds of the sample that the dictionary of the shuffled texts is made of.
DICTIONARY_TEXTS = 3000
DICTIONARY_BYTES = 512 << 10
LEVEL = 6

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
OTHER = np.uint64(0xD1342543DE82EF95)
OTHER_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
BYTE_VALUES = spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, size: int) -> np.ndarray:
    """The first powers of a base modulo 2^64; the longest row asked for so far is kept."""
    known = POWERS.get(int(base))
    if known is None or len(known) < size:
        known = np.full(max(size, 1 << 16), base, np.uint64)
        known[0] = 1
        POWERS[int(base)] = known = np.multiply.accumulate(known)
    return known[:size]


def prefix_sums(data: np.ndarray, base: np.uint64, up: np.ndarray | None = None) -> np.ndarray:
    """Sums of byte values times powers of the base, modulo 2^64: one more than bytes."""
    up = powers(base, len(data)) if up is None else up
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def string_hashes(data: np.ndarray, length: int, base: np.uint64 = BASE, back: np.uint64 = BASE_BACK) -> np.ndarray:
    """Hash of the ``length`` bytes from each place on."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(data, base)
    return spread((sums[length:] - sums[:-length]) * powers(back, len(data) - length + 1))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` neighbours from each place on."""
    size = 1
    out = x
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """Anchors of the texts: text number, gram hash, place, first and last start of the strings they are the anchor of."""
    width = length - k + 1
    empty = np.zeros(0, np.int64)
    parts = []
    for start in range(0, max(0, len(data) - length + 1), CHUNK):
        stop = min(start + CHUNK, len(data) - length + 1)  # of the starts of strings
        grams = string_hashes(data[start : stop + length - 1], k)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        least = sliding_least((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), width)
        place = (least & mask).astype(np.int64)
        at = np.arange(start, stop)
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + length <= offsets[text + 1]
        place, at, text = place[inside], at[inside], text[inside]
        if not len(at):
            continue
        cut = np.ones(len(at), bool)
        cut[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        heads = np.flatnonzero(cut)
        tails = np.append(heads[1:], len(at)) - 1
        begin = offsets[text[heads]]
        parts.append((text[heads], (grams[place[heads]] & GRAM_BITS).view(np.int64), place[heads] + start - begin, at[heads] - begin, at[tails] - begin))
    if not parts:
        return empty, empty, empty, empty, empty
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def common_extension(sums: np.ndarray, up: np.ndarray, i: np.ndarray, j: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j, up to ``limit``, by binary search over hashes."""
    found = np.zeros(len(i), np.int64)
    step = 1 << (limit.bit_length() - 1)
    while step:
        reach = found + step
        fits = reach <= limit
        a, b = i + found, j + found
        grown = np.minimum(step, limit - found)
        same = (sums[a + grown] - sums[a]) * up[b] == (sums[b + grown] - sums[b]) * up[a]
        found = np.where(fits & same, reach, found)
        step >>= 1
    return found


def suffix_sort(data: np.ndarray, at: np.ndarray, segment: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings at ``at`` within their segments (given in order), and which equal the one before.

    A bottom-up mergesort of all segments at once: each round ranks the
    elements of neighbouring runs among each other by binary search.
    """
    up = powers(BASE, len(data) + 1)
    sums = prefix_sums(data, BASE, up)
    tail = np.append(data, np.uint8(0))
    n = len(at)
    order = np.arange(n)
    heads = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    sizes = np.diff(np.append(heads, n))
    head, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    place = np.arange(n) - head

    def below(i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        shared = common_extension(sums, up, i, j, length)
        return np.where(shared >= length, or_equal, tail[np.minimum(i + shared, len(data))] < tail[np.minimum(j + shared, len(data))])

    width = 1
    while width < (sizes.max() if n else 0):
        run = place // width
        left = run % 2 == 0
        other = (run ^ 1) * width  # where the neighbouring run begins
        count = np.clip(size - other, 0, width)
        low, high = np.zeros(n, np.int64), count.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            theirs = at[order[head[open_] + other[open_] + middle]]
            # A left element passes smaller right ones, a right one also equal left ones.
            passes = below(theirs, at[order[open_]], ~left[open_])
            low[open_] = np.where(passes, middle + 1, low[open_])
            high[open_] = np.where(passes, high[open_], middle)
        target = head + (run // 2) * 2 * width + place % width + low
        sorted_ = np.empty(n, np.int64)
        sorted_[target] = order
        order = sorted_
        width *= 2
    equal = np.zeros(n, bool)
    inner = np.flatnonzero(segment[1:] == segment[:-1]) + 1
    equal[inner] = common_extension(sums, up, at[order[inner - 1]], at[order[inner]], length) >= length
    return order, equal


def verified(data: np.ndarray, at: np.ndarray, order: np.ndarray, equal: np.ndarray, length: int) -> bool:
    """Whether all strings said to be equal to the one before are."""
    for low in range(0, len(order), 1 << 15):
        these = np.flatnonzero(equal[low : low + (1 << 15)]) + low
        reach = np.arange(length)
        if (data[at[order[these]][:, None] + reach] != data[at[order[these - 1]][:, None] + reach]).any():
            return False
    return True


@dataclass
class Contexts:
    """Stretches of text around equal or other anchors: their bytes one after another, and numbers for each."""

    data: np.ndarray
    offsets: np.ndarray
    group: np.ndarray  # rises with the anchor
    ids: np.ndarray
    first: np.ndarray  # start of the first string
    back: np.ndarray  # from there to the anchor

    def take(self, rows: np.ndarray) -> Contexts:
        lengths = np.diff(self.offsets)[rows]
        at = np.repeat(self.offsets[rows] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return Contexts(self.data[at], offsets, self.group[rows], self.ids[rows], self.first[rows], self.back[rows])


def same_as_before(*columns: np.ndarray) -> np.ndarray:
    same = np.ones(len(columns[0]), bool)
    same[:1] = False
    for c in columns:
        same[1:] &= c[1:] == c[:-1]
    return same


def equal_contexts(own: Contexts) -> np.ndarray:
    """Whether an earlier document, or an earlier place, has the very same context; compared by hash, then by byte."""
    lengths = np.diff(own.offsets)
    hashes = []
    for base, back in ((BASE, BASE_BACK), (OTHER, OTHER_BACK)):
        sums = prefix_sums(own.data, base)
        hashes.append((sums[own.offsets[1:]] - sums[own.offsets[:-1]]) * powers(back, len(own.data) + 1)[own.offsets[:-1]])
    key = (own.group, own.back, lengths, *hashes)
    order = np.lexsort((own.first, own.ids, *reversed(key)))
    later = same_as_before(*(k[order] for k in key))
    for low in range(0, len(order), 1 << 14):
        these = np.flatnonzero(later[low : low + (1 << 14)]) + low
        size = lengths[order[these]]
        reach = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        left, right = (np.repeat(own.offsets[order[these - n]], size) + reach for n in (0, 1))
        if (own.data[left] != own.data[right]).any():
            return equal_one_by_one(own)
    out = np.zeros(len(order), bool)
    out[order] = later
    return out


def equal_one_by_one(own: Contexts) -> np.ndarray:
    """The same without hashes, for contexts whose hashes collide."""
    out = np.zeros(len(own.ids), bool)
    seen: set[tuple] = set()
    for row in np.lexsort((own.first, own.ids)):
        key = (own.group[row], own.back[row], own.data[own.offsets[row] : own.offsets[row + 1]].tobytes())
        out[row] = key in seen
        seen.add(key)
    return out


def settle(own: Contexts, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Ids and starts of strings that another context of the same group holds earlier. The contexts differ."""
    windows = np.diff(own.offsets) - length + 1
    row = np.repeat(np.arange(len(windows)), windows)
    shift = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    # Equal strings have the anchor at the same place.
    segment = own.group[row] * length + own.back[row] - shift
    at = own.offsets[row] + shift
    whole = string_hashes(own.data, length)[at]
    # A string whose hash is alone in its segment equals no other.
    by = np.lexsort((whole, segment))
    twin = same_as_before(segment[by], whole[by])
    twin[:-1] |= twin[1:]
    by = by[twin]
    ids, start = own.ids[row[by]], own.first[row[by]] + shift[by]
    back = np.lexsort((start, ids, segment[by]))
    by, ids, start = by[back], ids[back], start[back]
    found: list[np.ndarray] = []
    cuts = np.append(np.flatnonzero(~same_as_before(segment[by])), len(by))
    low = 0
    while low < len(by):
        high = int(cuts[np.searchsorted(cuts, low + SORT_STRINGS, "right") - 1])
        high = high if high > low else int(cuts[np.searchsorted(cuts, low, "right")])
        part = by[low:high]
        order, equal = suffix_sort(own.data, at[part], segment[part], length)
        if verified(own.data, at[part], order, equal, length):
            # The sort is stable and came from id and start, so the first of a run is the earliest.
            found.append(order[equal] + low)
        else:
            seen: set[tuple[int, bytes]] = set()
            for n, (a, g) in enumerate(zip(at[part].tolist(), segment[part].tolist(), strict=True)):
                key = (g, own.data[a : a + length].tobytes())
                if key in seen:
                    found.append(np.array([n + low]))
                seen.add(key)
        low = high
    later = np.concatenate(found) if found else np.zeros(0, np.int64)
    return ids[later], start[later]


def runs(ids: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring starts of one id as ranges: id, from, to."""
    by = np.lexsort((starts, ids))
    ids, starts = ids[by], starts[by]
    cut = np.ones(len(ids), bool)
    cut[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + 1)
    heads = np.flatnonzero(cut)
    tails = np.append(heads[1:], len(ids)) - 1 if len(ids) else heads
    return ids[heads], starts[heads], starts[tails] + length


def settled(rows: DataFrame, length: int) -> DataFrame:
    """id, nth, from, to of repeated stretches of ``rows(gram, id, nth, start, back, context)``."""

    def answer(block: pa.Table) -> pa.RecordBatch:
        gram, ids, nth, first, back = (block.column(c).to_numpy() for c in range(5))
        order = np.lexsort((first, nth, ids, gram))
        order = order[~same_as_before(gram[order], ids[order], nth[order], first[order])]  # repeated rows of one document
        data, offsets = byte_view(block.column(5).combine_chunks().take(pa.array(order)).cast(pa.binary()))
        group = np.cumsum(~same_as_before(gram[order])) - 1
        # Documents by number, in their order.
        by = np.lexsort((nth[order], ids[order]))
        number = np.empty(len(order), np.int64)
        number[by] = np.cumsum(~same_as_before(ids[order][by], nth[order][by])) - 1
        id_of, nth_of = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        id_of[number], nth_of[number] = ids[order], nth[order]
        own = Contexts(data, offsets, group, number, first[order], back[order])
        later = equal_contexts(own)
        differing = np.flatnonzero(~later)
        many = np.bincount(own.group[differing], minlength=len(group) + 1) > 1
        strings = settle(own.take(differing[many[own.group[differing]]]), length)
        parts = runs(*strings, length)
        whole = (own.ids[later], own.first[later], own.first[later] + np.diff(own.offsets)[later])
        document, low, high = (np.concatenate(c) for c in zip(parts, whole, strict=True))
        columns = [id_of[document], nth_of[document], low, high]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "nth", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < SORT_BYTES:
                continue
            gram = np.concatenate([b.column(0).to_numpy() for b in held])
            cut = int(np.searchsorted(gram, gram[-1], "left"))  # the last anchor may go on
            if not cut:
                continue
            block = pa.Table.from_batches(held)
            yield answer(block.slice(0, cut))
            held = block.slice(cut).to_batches()
            size = sum(b.num_rows * 200 for b in held)
        if held:
            yield answer(pa.Table.from_batches(held))

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "gram").sortWithinPartitions("gram").mapInArrow(run, "id long, nth long, from long, to long")


def shared_words(texts: DataFrame) -> bytes:
    """A dictionary of what texts have in common, from at most DICTIONARY_TEXTS of them, or nothing if they are few."""
    digest = F.md5("text").alias("digest")
    chosen = texts.select("id", digest).orderBy(F.xxhash64("id", F.lit(1)), "id", "digest").limit(DICTIONARY_TEXTS).distinct()
    part = F.substring("text", 1, 8192).alias("text")
    # Rows may repeat a text under its id, so what the join finds is bounded once more.
    rows = texts.select("id", part, digest).join(F.broadcast(chosen), ["id", "digest"]).limit(DICTIONARY_TEXTS).select("id", "text").toPandas()
    samples = [t.encode() for t in rows.sort_values(["id", "text"])["text"]]
    samples = [t[:4096] for t in samples if len(t) >= 64]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if size < 4096 or len(samples) < 64:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def squeezed(texts: DataFrame, words: Broadcast) -> DataFrame:
    """id, zipped, n_bytes, digest of ``texts(id, text)``: texts travel compressed, since they are shuffled whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = zstandard.ZstdCompressionDict(words.value) if words.value else None
        zipper = zstandard.ZstdCompressor(level=LEVEL, dict_data=own)
        for batch, data, offsets in text_steps(batches):
            rows = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([zipper.compress(r) for r in rows], pa.binary()),
                    pa.array(np.diff(offsets)),
                    pa.array([hashlib.md5(r).hexdigest() for r in rows], pa.string()),
                ],
                names=["id", "zipped", "n_bytes", "digest"],
            )

    return texts.mapInArrow(run, "id long, zipped binary, n_bytes long, digest string")


def opened(batches: Iterator[pa.RecordBatch], words: bytes) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches (id, zipped, n_bytes, ...) with the bytes and offsets of their texts."""
    unzipper = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(batch.column(2).to_numpy())]).astype(np.int64)
        for start, stop in steps(ends):
            part = batch.slice(start, stop - start)
            whole = b"".join(unzipper.decompress(z) for z in part.column(1).to_pylist())
            yield part, np.frombuffer(whole, np.uint8), ends[start : stop + 1] - ends[start]


def found_anchors(texts: DataFrame, words: Broadcast, length: int) -> DataFrame:
    """gram, id, nth, packed: every anchor of ``texts(id, zipped, n_bytes, nth)``; packed holds its place and its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in opened(batches, words.value):
            text, gram, place, low, high = anchors(data, offsets, length)
            packed = (place << 14) | ((place - low) << 7) | (high - low)
            of = pa.array(text)
            columns = [pa.array(gram), batch.column(0).take(of), batch.column(3).take(of), pa.array(packed)]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "id", "nth", "packed"])

    return texts.mapInArrow(run, "gram long, id long, nth long, packed long")


SCHEMAS = {
    "digests": "gram long, shape long, w long, v long, id long, nth long, start long",
    "contexts": "gram long, id long, nth long, start long, back long, context binary",
    "strings": "w long, v long, id long, nth long, start long",
}


def expanded(texts: DataFrame, words: Broadcast, kind: str, length: int) -> DataFrame:
    """The contexts of the anchors in ``texts(id, zipped, n_bytes, nth, marks)``, as SCHEMAS has them by ``kind``:
    two hashes of each, its bytes, or two hashes of each of its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in opened(batches, words.value):
            marks = batch.column(4)
            flat = marks.flatten()
            row = np.repeat(np.arange(batch.num_rows), marks.value_lengths().to_numpy(zero_copy_only=False))
            gram, packed = (flat.field(c).to_numpy(zero_copy_only=False) for c in range(2))
            back = (packed >> 7) & 127
            start = (packed >> 14) - back
            count = (packed & 127) + 1
            ids, nth = (batch.column(c).to_numpy()[row] for c in (0, 3))
            at = offsets[row] + start
            if kind == "digests":
                columns = [gram, packed & 16383, *hashes_at(data, at, count + length - 1), ids, nth, start]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "shape", "w", "v", "id", "nth", "start"])
            elif kind == "contexts":
                whole = data.tobytes()
                context = [whole[a : a + n] for a, n in zip(at.tolist(), (count + length - 1).tolist(), strict=True)]
                columns = [*(pa.array(c) for c in (gram, ids, nth, start, back)), pa.array(context, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["gram", "id", "nth", "start", "back", "context"])
            else:
                step = 1 << 13
                for a in range(0, len(at), step):
                    n = count[a : a + step]
                    shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    own = np.repeat(np.arange(a, a + len(n)), n)
                    places = at[own] + shift
                    columns = [*hashes_at(data, places, np.full(len(places), length)), ids[own], nth[own], start[own] + shift]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["w", "v", "id", "nth", "start"])

    return texts.mapInArrow(run, SCHEMAS[kind])


def hashes_at(data: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Two independent hashes of the stretches at some places."""
    out = []
    for base, back in ((BASE, BASE_BACK), (OTHER, OTHER_BACK)):
        if not len(places):
            out.append(np.zeros(0, np.int64))
            continue
        low = int(places.min())
        part = data[low : int((places + lengths).max())]
        sums = prefix_sums(part, base)
        local = places - low
        out.append(spread((sums[local + lengths] - sums[local]) * powers(back, len(part))[local]).view(np.int64))
    return out


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, spans, kept of each row of ``documents(doc_id, text)``.

    ``spans`` are the maximal removed runs (start and end in bytes), ``kept`` the
    remaining bytes. A byte goes if a string of ``length`` bytes over it also
    starts earlier: in a document with a smaller id, or before in the same one;
    strings are judged on the input. NULL texts are empty, and texts below
    ``length`` lose nothing. Documents without id come after all others, and
    documents that share an id, or have none, go by the digest of their text. Rows
    that repeat both are one document and give equal rows. Extra columns are left out.
    """
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    keys = stored(texts.select("id", F.md5("text").alias("digest")).distinct(), "keys")
    # Documents with one id are told apart by a number; nearly all have 0.
    shared = keys.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    others = stored(numbered(keys.join(shared, "id"), "id", ["digest"]).select("id", "digest", F.col("idx").alias("nth")), "shared")
    number = F.coalesce("nth", F.lit(0)).cast("long").alias("nth")
    firsts = keys.groupBy("digest").agg(F.min("id").alias("first"))
    info = keys.join(others, ["id", "digest"], "left").join(firsts, "digest")
    info = stored(info.select("id", number, (F.col("first") < F.col("id")).alias("copy")), "info")
    # One shuffle of the texts serves all uses below.
    words = documents.sparkSession.sparkContext.broadcast(shared_words(texts))
    placed = squeezed(texts, words).join(others, ["id", "digest"], "left").select("id", "zipped", "n_bytes", number).repartition(tasks, "id", "nth")
    key = ["id", "nth"]
    compared = placed.join(info.where("not copy").select(*key).hint("shuffle_hash"), key).where(F.col("n_bytes") >= length)
    compared = compared.select("id", "zipped", "n_bytes", "nth")

    def marked(marks: DataFrame) -> DataFrame:
        # A set, since rows may repeat a document.
        found = marks.groupBy(*key).agg(F.collect_set(F.struct("gram", "packed")).alias("marks"))
        return compared.join(found.hint("shuffle_hash"), key).select("id", "zipped", "n_bytes", "nth", "marks")

    every = found_anchors(compared, words, length)
    repeated = every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    contexts = stored(expanded(marked(every.join(repeated, "gram")), words, "digests", length), "contexts")
    digest = ["gram", "shape", "w", "v"]
    earliest = contexts.groupBy(*digest).agg(F.min(F.struct("id", "nth", "start")).alias("first"), F.count("*").alias("n"))
    earliest = stored(earliest.select(*digest, F.col("first.id").alias("id"), F.col("first.nth").alias("nth"), F.col("first.start").alias("start"), "n"), "earliest")
    before = [F.col(c).alias(f"first_{c}") for c in (*key, "start")]
    later = contexts.join(earliest.where("n > 1").select(*digest, *before), digest).where(
        F.struct("first_id", "first_nth", "first_start") < F.struct("id", "nth", "start")
    )
    span = F.col("shape").bitwiseAND(127) + length
    whole = later.select(*key, F.col("start").alias("from"), (F.col("start") + span).alias("to"))
    counts = earliest.groupBy("gram").agg(F.count("*").alias("contexts")).where("contexts > 1")
    back = F.shiftright("shape", 7)
    differing = earliest.join(counts, "gram").select(
        "gram", *key, (F.shiftleft(F.col("start") + back, 14) + F.col("shape")).alias("packed"), (F.col("contexts") > MOST_CONTEXTS).alias("hot")
    )
    differing = stored(differing, "differing")
    gone = settled(expanded(marked(differing.where("not hot")), words, "contexts", length), length)
    strings = expanded(marked(differing.where("hot")), words, "strings", length)
    counted = strings.groupBy("w", "v").agg(F.min(F.struct("id", "nth", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    hot_gone = strings.join(counted.select("w", "v", "first"), ["w", "v"]).where(F.col("first") < F.struct("id", "nth", "start"))
    ranges = gone.unionByName(whole).unionByName(hot_gone.select(*key, F.col("start").alias("from"), (F.col("start") + length).alias("to")))
    by_id = ranges.groupBy(*key).agg(F.collect_set(F.struct("from", "to")).alias("ranges"))
    joined = placed.join(info.hint("shuffle_hash"), key).join(by_id.hint("shuffle_hash"), key, "left")
    ready = joined.select("id", "zipped", "n_bytes", (F.col("copy") & (F.col("n_bytes") >= length)).alias("whole"), "ranges")
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in opened(batches, words.value):
            whole = batch.column(3).to_pylist()
            spans, kept = [], []
            for row in range(batch.num_rows):
                own = data[offsets[row] : offsets[row + 1]]
                found = batch.column(4)[row]
                if whole[row]:
                    ranges = np.array([[0, len(own)]])
                elif found.is_valid and len(found):
                    values = found.values
                    ranges = np.stack([values.field(c).to_numpy() for c in (0, 1)], 1)
                else:
                    spans.append([])
                    kept.append(own.tobytes())
                    continue
                change = np.zeros(len(own) + 1, np.int64)
                np.add.at(change, ranges[:, 0], 1)
                np.add.at(change, ranges[:, 1], -1)
                removed = np.cumsum(change)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8)))
                spans.append([{"from": int(a), "to": int(b)} for a, b in edges.reshape(-1, 2)])
                kept.append(own[~removed].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    made = ready.mapInArrow(cut, "id long, n_bytes long, spans array<struct<from:long,to:long>>, kept binary")
    return made.select(F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_bytes", "spans", "kept")


def op8_repeats(spark, sf_dir: str) -> DataFrame:
    """What repeated strings of 100 bytes leave of all documents."""
    made = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
    return made.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
