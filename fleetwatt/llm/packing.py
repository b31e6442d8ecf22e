"""Token sequences of a fixed length, filled by the minimum bin slack rule.

Each task tokenizes the documents it reads, sends every full window of a
document off as a sequence, and keeps the rest of each document in a pool of
at most ``POOL`` pieces. A window takes the longest piece of the pool; a bitset
of reachable sums then finds the multiset of remaining lengths that comes
closest to its capacity, and the counts are traced back. What no multiset can
fill is filled by cutting one more piece, and the last, short sequence of a
task is cut at powers of two, where no padding is due.
"""

from __future__ import annotations

import functools
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import id_text, table, text_steps

CAPACITY = 4096
END_ID = 2
POOL = 4096
# Words and parts of words whose ids a worker keeps.
KNOWN_WORDS = 3 << 19
OUT_BYTES = 4 << 20

# How the tokenizer cuts a text, for texts of these Latin-1 characters only, where
# lower case and character classes are beyond doubt. White space always cuts.
PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])
LETTER = r"a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\s{LETTER}{NUMBER}]+")
SPECIAL = "<|"
WORD_END = "</w>"


class Encoder:
    """Ids of texts as little-endian 32-bit bytes. Ids of a word are found once and kept for the worker's life."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def parts_of(self, parts: list[str], together: int = 1000) -> Iterator[bytes]:
        """Ids of each part; many go through the tokenizer as one text, since each ends with an id of a word end."""
        for at in range(0, len(parts), together):
            some = parts[at : at + together]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                yield from self.whole(some)
                continue
            raw, last = ids.tobytes(), 0
            for cut in (4 * cuts).tolist():
                yield raw[last:cut]
                last = cut

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        simple: list[tuple[int, list[str]]] = []
        unsure: list[int] = []
        for i, text in enumerate(texts):
            if plain(text):
                simple.append((i, text.lower().split()))
            else:
                unsure.append(i)
        for i, ids in zip(unsure, self.whole([texts[i] for i in unsure]), strict=True):
            out[i] = ids
        if len(self.words) + len(self.parts) > KNOWN_WORDS:
            self.words.clear()
            self.parts.clear()
        missing = set().union(*(words for _, words in simple)).difference(self.words) if simple else set()
        if missing:
            cut = {word: PARTS.findall(word) for word in missing}
            parts = list(set().union(*cut.values()).difference(self.parts))
            self.parts.update(zip(parts, self.parts_of(parts), strict=True))
            ids_of = self.parts.__getitem__
            self.words.update((word, b"".join(map(ids_of, own))) for word, own in cut.items())
        for i, words in simple:
            out[i] = b"".join(map(self.words.__getitem__, words))
        return out


@functools.lru_cache(maxsize=2)
def encoder_for(path: str) -> Encoder:
    return Encoder(path)


def plain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, PLAIN) and SPECIAL not in text
    except UnicodeEncodeError:
        return False


def closest(lengths: list[int], counts: dict[int, int], room: int) -> tuple[dict[int, int], int]:
    """How many of each length fill ``room`` best, and the sum; ``lengths`` in the order of preference.

    Bit s of the bitset says that some multiset sums to s. Counts are taken in
    powers of two, so each length needs few steps. Stops once the room is filled.
    """
    reach = 1
    mask = (1 << (room + 1)) - 1
    trail: list[tuple[int, int, int]] = []
    full = 1 << room
    for length in lengths:
        if length > room:
            continue
        left = min(counts[length], room // length)
        step = 1
        while left:
            take = min(step, left)
            grown = (reach | (reach << (take * length))) & mask
            if grown != reach:
                trail.append((reach, length, take))
                reach = grown
            left -= take
            step *= 2
        if reach & full:
            break
    total = at = reach.bit_length() - 1
    chosen: dict[int, int] = defaultdict(int)
    for before, length, take in reversed(trail):
        if not before >> at & 1:
            chosen[length] += take
            at -= take * length
    return chosen, total


Piece = tuple[int, int, bytes, int]  # document, ids before it, ids, ids of the document


class Pool:
    """Pieces waiting for a window, by length."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.pieces: dict[int, list[Piece]] = defaultdict(list)
        self.size = 0

    def add(self, piece: Piece) -> None:
        self.pieces[len(piece[2]) // 4].append(piece)
        self.size += 1

    def take(self, length: int) -> Piece:
        found = self.pieces[length].pop()
        if not self.pieces[length]:
            del self.pieces[length]
        self.size -= 1
        return found

    def fill(self, last: bool) -> Iterator[list[Piece]]:
        """Sequences until half the pool is left, or all of it at the end."""
        until = 0 if last else POOL // 2
        lengths = sorted(self.pieces, reverse=True)
        while self.size > until:
            lengths = [n for n in lengths if n in self.pieces]
            window = [self.take(lengths[0])]
            room = self.capacity - len(window[0][2]) // 4
            chosen, total = closest([n for n in lengths if n in self.pieces], {n: len(p) for n, p in self.pieces.items()} if last else Counts(self.pieces), room)
            for length, times in chosen.items():
                window += [self.take(length) for _ in range(times)]
            room -= total
            if room and self.size:
                # No multiset fits: all others are longer than the room. Cut one.
                longest = max(self.pieces)
                doc, start, ids, tokens = self.take(longest)
                window.append((doc, start, ids[: 4 * room], tokens))
                rest = (doc, start + room, ids[4 * room :], tokens)
                self.add(rest)
                lengths = sorted(self.pieces, reverse=True)
                room = 0
            if room:
                yield from at_powers(window, self.capacity - room)
            else:
                yield window


class Counts:
    """Lengths of the lists of a dictionary, looked up when needed."""

    def __init__(self, lists: dict[int, list]) -> None:
        self.lists = lists

    def __getitem__(self, key: int) -> int:
        return len(self.lists[key])


def at_powers(window: list[Piece], total: int) -> Iterator[list[Piece]]:
    """The pieces cut into sequences whose sizes are the powers of two that make up ``total``."""
    waiting = list(reversed(window))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        part: list[Piece] = []
        while room:
            doc, start, ids, tokens = waiting.pop()
            n = len(ids) // 4
            if n > room:
                waiting.append((doc, start + room, ids[4 * room :], tokens))
                ids, n = ids[: 4 * room], room
            part.append((doc, start, ids, tokens))
            room -= n
        yield part


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``documents`` in sequences: doc_id, start, ids, length, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers as bytes, ``tokenizer`` is
    a file that every executor can read at that path. NULL and empty texts are
    their end id alone. Every row is packed, so repeated rows and NULL ids are
    pieces of their own; no row at all gives no sequence. Other columns are
    left out. Sequence ids follow the partition of the input, so a repeated
    task gives the same ones.
    """
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_for(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 40
        pool = Pool(capacity)
        ready: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "ids", "length", "doc_tokens", "sequence_id", "offset"]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            ready.clear()
            return made

        def place(window: list[Piece]) -> None:
            nonlocal number, held
            offset = 0
            for doc, start, ids, tokens in window:
                n = len(ids) // 4
                ready.append((doc, start, ids, n, tokens, number, offset))
                offset += n
                held += len(ids)
            number += 1

        for batch, _, _ in text_steps(batches):
            docs = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(docs, encoder.encode(texts), strict=True):
                ids += end
                tokens = len(ids) // 4
                full = len(ids) - len(ids) % width
                for at in range(0, full, width):
                    place([(doc, at // 4, ids[at : at + width], tokens)])
                if full < len(ids):
                    pool.add((doc, full // 4, ids[full:], tokens))
                if pool.size >= POOL:
                    for window in pool.fill(last=False):
                        place(window)
                if held > OUT_BYTES:
                    yield out()
                    held = 0
        for window in pool.fill(last=True):
            place(window)
        if ready:
            yield out()

    return id_text(documents).mapInArrow(
        run, "doc_id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long"
    )


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    import public_tokenizers

    return digests(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
