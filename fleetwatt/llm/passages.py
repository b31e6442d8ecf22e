"""Removal of passages that an earlier document has, by an FM-index per shard.

A passage is a window of LENGTH consecutive words. Each window has an anchor,
the K-gram of words in it with the smallest hash, so equal windows have equal
anchors, and an index need only hold windows of the anchors of its shard.

1. Every anchor brings the stretch of words that its windows cover, as a digest.
   Equal stretches become one row with the smallest id, summed before the shuffle.
2. Anchors of one document are done. Of the others, one copy of each differing
   stretch is brought to the shard of its anchor.
3. A shard is an FM-index over its stretches. All of them are streamed past it
   backwards; matching statistics tell which windows occur in which interval of
   suffixes, and the smallest id in that interval is the earliest document.
4. An anchor with more differing stretches than a shard can hold is no shard:
   its windows are told apart by 128-bit hashes of all of their words, again with
   minima before the shuffle, so no group grows with it.
5. What was found for a stretch is joined to all of its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import byte_view, stored, table, text_steps
from fleetwatt.llm.fm_index import FMIndex
from fleetwatt.llm.repeats import BASE, BASE_BACK, OTHER, OTHER_BACK, powers, sliding_least
from fleetwatt.llm.tokens import spread, word_keys

LENGTH = 50
K = 16
# Differing stretches of an anchor that a shard can hold, and the words from which a shard is closed.
MOST_STRETCHES = 4096
SHARD_WORDS = 1 << 18
# Documents without id come after all others.
LAST_ID = (1 << 63) - 1
CHUNK = 1 << 20
PLACE_BITS = 21  # of a place within a chunk and the window after it
STRETCH = ["gram", "first_hash", "second_hash"]


class Words:
    """Words of texts as 64-bit keys, and hashes of any run of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        text, self.keys = word_keys(data, offsets, lower=False)
        self.begin = np.searchsorted(text, np.arange(len(offsets)))  # of each text, and the end
        self.sums = []
        for base, keys in ((BASE, self.keys), (OTHER, spread(self.keys ^ OTHER))):
            sums = np.zeros(len(keys) + 1, np.uint64)
            np.cumsum(keys * powers(base, len(keys)), out=sums[1:])
            self.sums.append(sums)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        """Two independent hashes of the words from ``first`` up to ``last``."""
        found = []
        for sums, back in zip(self.sums, (BASE_BACK, OTHER_BACK), strict=True):
            found.append(spread((sums[last] - sums[first]) * powers(back, len(self.keys) + 1)[first]).view(np.int64))
        return found

    def stretches(self, length: int, k: int) -> tuple[np.ndarray, ...]:
        """Per anchor its text, gram, first word and number of windows."""
        parts = []
        width = length - k + 1
        for start in range(0, max(0, len(self.keys) - length + 1), CHUNK):
            at = np.arange(start, min(start + CHUNK, len(self.keys) - length + 1))  # where windows begin
            places = np.arange(start, at[-1] + width)
            grams = self.hashes(places, places + k)[0]
            mask = np.uint64((1 << PLACE_BITS) - 1)
            least = sliding_least((grams.view(np.uint64) & ~mask) | (places - start).astype(np.uint64), width)
            anchor = (least & mask).astype(np.int64)
            text = np.searchsorted(self.begin, at, "right") - 1
            inside = at + length <= self.begin[text + 1]
            anchor, at, text = anchor[inside], at[inside], text[inside]
            cut = np.ones(len(at), bool)
            cut[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            heads = np.flatnonzero(cut)
            parts.append((text[heads], grams[anchor[heads]], at[heads], np.diff(np.append(heads, len(at)))))
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (empty,) * 4


def occurrences(texts: DataFrame, length: int, k: int) -> DataFrame:
    """Every anchor of ``texts(id, mark, text)``: its stretch, the document, the first word and the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_steps(batches):
            words = Words(data, offsets)
            text, gram, first, windows = words.stretches(length, k)
            hashes = words.hashes(first, first + windows + length - 1)
            of = pa.array(text)
            columns = [gram, *hashes, batch.column(0).take(of), batch.column(1).take(of), first - words.begin[text], windows]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*STRETCH, "id", "mark", "first", "windows"])

    kind = "gram long, first_hash long, second_hash long, id long, mark long, first long, windows long"
    return texts.mapInArrow(run, kind)


def copies(texts: DataFrame, length: int, by_window: bool) -> DataFrame:
    """The words of the stretches wanted of ``texts(text, wanted)``, or the hashes of each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_steps(batches):
            wanted = batch.column(1)
            flat = wanted.flatten()
            text = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
            column = {name: flat.field(i).to_numpy() for i, name in enumerate((*STRETCH, "least", "first", "windows"))}
            words = Words(data, offsets)
            first = words.begin[text] + column["first"]
            names = [*STRETCH, "least"]
            if not by_window:
                last = first + column["windows"] + length - 1
                whole = [words.keys[a:b].tobytes() for a, b in zip(first, last, strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.array(column[n]) for n in names), pa.array(whole, pa.binary())], names=[*names, "words"])
                continue
            step = 1 << 14
            for low in range(0, len(first), step):
                n = column["windows"][low : low + step]
                row = np.repeat(np.arange(low, low + len(n)), n)
                shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = first[row] + shift
                made = [*(column[c][row] for c in names), shift, *words.hashes(at, at + length)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=[*names, "shift", "w", "v"])

    kind = "gram long, first_hash long, second_hash long, least long, "
    return texts.mapInArrow(run, kind + ("shift long, w long, v long" if by_window else "words binary"))


def searched(stretches: DataFrame, length: int) -> DataFrame:
    """Windows of ``stretches(STRETCH, least, words)`` that another stretch has in an earlier document.

    Runs of windows of one earliest document are a row: STRETCH, shift of the first window, n, least.
    """

    def answer(rows: pa.Table) -> pa.RecordBatch:
        data, at = byte_view(rows.column("words").combine_chunks())
        symbols, offsets = np.ascontiguousarray(data).view(np.uint64), at // 8
        index = FMIndex(symbols, offsets, length)
        size, low, _ = index.statistics(symbols, offsets)
        own = rows.column("least").to_numpy()
        earliest = np.minimum.reduceat(own[index.string], index.heads[:-1])
        here = np.flatnonzero(size >= length)  # all windows, since each stretch is in the index itself
        of = np.searchsorted(offsets, here, "right") - 1
        least = earliest[index.group[low[here]]]
        keep = least < own[of]
        here, of, least = here[keep], of[keep], least[keep]
        cut = np.ones(len(here), bool)
        cut[1:] = (here[1:] != here[:-1] + 1) | (of[1:] != of[:-1]) | (least[1:] != least[:-1])
        heads = np.flatnonzero(cut)
        columns = [rows.column(c).to_numpy()[of[heads]] for c in STRETCH]
        columns += [here[heads] - offsets[of[heads]], np.diff(np.append(heads, len(here))), least[heads]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*STRETCH, "shift", "n", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # Batches may be large; a shard is cut where a gram ends.
            gram = batch.column(0).to_numpy()
            ends = np.cumsum(np.diff(byte_view(batch.column(4))[1]) // 8)
            start = 0
            for cut in [*(np.flatnonzero(gram[1:] != gram[:-1]) + 1).tolist(), batch.num_rows]:
                if held and size >= SHARD_WORDS and held[-1].column(0)[-1].as_py() != gram[start]:
                    yield answer(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(batch.slice(start, cut - start))
                size += int(ends[cut - 1] - (ends[start - 1] if start else 0))
                start = cut
        if held:
            yield answer(pa.Table.from_batches(held))

    sorted_rows = stretches.repartition("gram").sortWithinPartitions("gram")
    return sorted_rows.mapInArrow(run, "gram long, first_hash long, second_hash long, shift long, n long, least long")


def remove_passages(documents: DataFrame, length: int = LENGTH, k: int = K, most: int = MOST_STRETCHES) -> DataFrame:
    """doc_id, n_words, spans, kept of each row of ``documents(doc_id, text)``.

    A word goes if a window of ``length`` words over it also starts in a document
    with a smaller doc_id; windows are judged on the input. ``spans`` are the
    maximal removed runs (first word, word after the last), ``kept`` the other words
    joined by one space, as UTF-8 bytes. NULL texts have no words; texts of fewer
    words lose nothing. Documents without id come after all others. Rows that share
    an id, or have none, are no earlier than each other and take nothing from each
    other. Extra columns are left out; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    every = stored(occurrences(texts, length, k), "anchors")
    stretches = every.groupBy(*STRETCH).agg(
        F.min("id").alias("least"),
        F.max("id").alias("most"),
        # Any copy will do: rows with one mark have one text, and each place in it that is given has the stretch.
        F.min_by("id", "mark").alias("id"),
        F.min("mark").alias("mark"),
        F.min_by("first", "mark").alias("first"),
        F.first("windows").alias("windows"),
    )
    stretches = stored(stretches, "stretches")
    grams = stretches.groupBy("gram").agg(F.min("least").alias("gram_least"), F.max("most").alias("gram_most"), F.count("*").alias("n"))
    live = stretches.join(grams.where("gram_least < gram_most").select("gram", "n"), "gram")
    live = stored(live, "live")
    wanted = F.collect_list(F.struct(*STRETCH, "least", "first", "windows")).alias("wanted")

    def brought(which: DataFrame, by_window: bool) -> DataFrame:
        of_text = which.groupBy("id", "mark").agg(wanted)
        found = texts.repartition("id", "mark").join(of_text.hint("shuffle_hash"), ["id", "mark"])
        # Rows that repeat a text bring its stretches again, which changes no minimum.
        return copies(found.select("text", "wanted"), length, by_window)

    found = searched(brought(live.where((F.col("n") > 1) & (F.col("n") <= most)), False), length)
    windows = brought(live.where(F.col("n") > most), True)
    earliest = windows.groupBy("w", "v").agg(F.min("least").alias("earliest"), F.max("least").alias("latest")).where("earliest < latest")
    hot = windows.join(earliest, ["w", "v"]).where("earliest < least").select(*STRETCH, "shift", F.lit(1).cast("long").alias("n"), F.col("earliest").alias("least"))
    own = live.where("least < most").select(*STRETCH, F.lit(0).cast("long").alias("shift"), F.col("windows").alias("n"), "least")
    pieces = own.unionByName(found).unionByName(hot)
    # A removed run in one number: its first word and its length, which is below 2 * length.
    reach = F.col("n") + length - 1
    ranges = (
        every.select(*STRETCH, "id", "mark", "first")
        .join(pieces, STRETCH)
        .where("id > least")
        .groupBy("id", "mark")
        .agg(F.collect_set((F.col("first") + F.col("shift")) * (2 * length) + reach).alias("ranges"))
    )
    joined = texts.repartition("id", "mark").join(ranges.hint("shuffle_hash"), ["id", "mark"], "left")
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_steps(batches):
            counts, spans, kept = [], [], []
            for row in range(batch.num_rows):
                words = data[offsets[row] : offsets[row + 1]].tobytes().split()
                counts.append(len(words))
                gone = batch.column(2)[row]
                if not gone.is_valid:
                    spans.append([])
                    kept.append(b" ".join(words))
                    continue
                first, size = np.divmod(gone.values.to_numpy(), 2 * length)
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, first + size, -1)
                removed = np.cumsum(change)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8))).reshape(-1, 2).tolist()
                spans.append([{"from": a, "to": b} for a, b in edges])
                stops = [0, *(place for edge in edges for place in edge), len(words)]
                kept.append(b" ".join(w for a, b in zip(stops[::2], stops[1::2], strict=True) for w in words[a:b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], names=["id", "n_words", "spans", "kept"]
            )

    made = joined.select("id", "text", "ranges").mapInArrow(cut, "id long, n_words long, spans array<struct<from:long,to:long>>, kept binary")
    return made.select(F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_words", "spans", "kept")


def op12_passages(spark, sf_dir: str) -> DataFrame:
    """What passages of 50 words of earlier documents leave of all documents."""
    made = remove_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
    return made.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
windows AS (
  SELECT r, doc_id, first, md5(array_to_string(words[first : first + 49], ' ')) AS w
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS first FROM texts)),
earliest AS (SELECT w, min(coalesce(doc_id, 9223372036854775807)) AS least FROM windows GROUP BY w),
hits AS (
  SELECT DISTINCT r, first FROM windows JOIN earliest USING (w) WHERE least < coalesce(doc_id, 9223372036854775807)),
gone AS (SELECT DISTINCT r, unnest(range(first, first + 50)) AS place FROM hits),
each AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT e.r, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
  FROM each e ANTI JOIN gone g ON g.r = e.r AND g.place = e.place GROUP BY e.r)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(len(t.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.r = t.r
"""
