"""Prediction by partial matching over bytes, with frozen statistics.

Spark counts all byte 4-grams of the training texts, per class, and all of them
count. What follows contexts of up to two symbols is gathered whole: it is
bounded by the alphabet. Of the contexts of three the most frequent have a row
of code lengths in the tree, escapes and symbol exclusion worked out in full.
The others stay in the stored counts: tasks code what follows them as if the
context were new and name the 4-grams, and ``corrections`` joins these to their
counts and gives the difference. So scoring is exact for all that was trained.

Texts are coded from three boundary symbols on, and end with one, so that the
probabilities of all texts add up to at most one. Every byte value that was
trained, of any class, is a symbol; all others share one and its probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import stored, text_steps

ORDER = 3
BOUNDARY = 0xFF  # not a byte of UTF-8
SHARED = 1
# Bounds of the rows in the tree: of its 4-grams per kind, its contexts of three, its cells. The rest is joined.
MAX_GRAMS = 1 << 18
MAX_ROWS = 1 << 15
MAX_CELLS = 1 << 25
# Distinct 4-grams that a task holds before it hands them on.
HELD_GRAMS = 1 << 21


def framed(data: np.ndarray, offsets: np.ndarray, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts with three ``fill`` before and one after each, and where each frame begins (n + 1)."""
    lengths = np.diff(offsets)
    frames = np.concatenate([[0], np.cumsum(lengths + ORDER + 1)])
    out = np.full(frames[-1], fill, np.uint8)
    keep = np.ones(frames[-1], bool)
    for place in range(ORDER):
        keep[frames[:-1] + place] = False
    keep[frames[1:] - 1] = False
    out[keep] = data
    return out, frames


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, index = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(index, np.concatenate(counts).astype(np.float64)).astype(np.int64)


def gram_counts(texts: DataFrame) -> DataFrame:
    """kind, gram, n: how often each byte 4-gram occurs in the texts of each kind; NULL text is empty.

    The counts are stored, since the tree reads them twice. Tasks add up before they hand on, so a frequent gram or kind is one row per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, (keys, counts) in held.items():
                gram, n = merged(keys, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)], names=["kind", "gram", "n"]
                )
            held.clear()

        for batch, data, offsets in text_steps(batches):
            kinds = np.array(batch.column(1).to_pylist(), object)
            for kind in set(kinds.tolist()):
                rows = np.flatnonzero(kinds == kind)
                if len(rows) == len(kinds):
                    own, at = data, offsets
                else:
                    own = np.concatenate([data[offsets[r] : offsets[r + 1]] for r in rows])
                    at = np.concatenate([[0], np.cumsum(offsets[rows + 1] - offsets[rows])])
                out, frames = framed(own, at, BOUNDARY)
                wide = out.astype(np.uint32)
                grams = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
                inside = np.ones(len(grams), bool)
                for back in range(1, ORDER + 1):
                    inside[frames[1:-1] - back] = False
                gram, n = np.unique(grams[inside], return_counts=True)
                keys, counts = held.setdefault(kind, ([], []))
                keys.append(gram)
                counts.append(n)
                if len(keys) >= 8:
                    gram, n = merged(keys, counts)
                    held[kind] = ([gram], [n])
            if sum(len(k[0]) for k, _ in held.values()) > HELD_GRAMS:
                yield from flush()
        yield from flush()

    counted = (
        texts.select("text", F.col("kind").cast("string").alias("kind"))
        .mapInArrow(count, "kind string, gram long, n long")
        .groupBy("kind", "gram")
        .agg(F.sum("n").alias("n"))
    )
    return stored(counted, "grams")


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, 0 where there is none; ``keys`` are sorted."""
    if not len(keys):
        return np.zeros(len(wanted))
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0.0)


def log2(x: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(x, 1e-30))


class Short:
    """Counts of what follows contexts of two, one and no symbol, of all kinds, by packed and sorted keys.

    What has followed a context has also followed its shorter ones. So what
    exclusion takes away below a context is one number per context.
    """

    def __init__(self, kinds: int, size: int, sharing: float, kind: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, n: np.ndarray):
        self.size, self.sharing = size, sharing
        self.three, self.n3 = merged([((kind * size + b) * size + c) * size + d], [n])
        pair_of = self.three // size
        self.two, index = np.unique(pair_of, return_inverse=True)
        last = self.three % size
        self.total2 = np.bincount(index, self.n3)
        self.different2 = np.bincount(index)
        one_of = self.two // size // size * size + self.two % size  # kind and c
        self.pairs, self.n2 = merged([one_of[index] * size + last], [self.n3])
        self.covered1 = np.bincount(index, looked_up(self.pairs, self.n2, one_of[index] * size + last))
        ones = kinds * size
        self.total1 = np.bincount(self.pairs // size, self.n2, ones)
        self.different1 = np.bincount(self.pairs // size, minlength=ones)
        kind_of = self.pairs // size // size
        self.n1 = np.bincount(kind_of * size + self.pairs % size, self.n2, ones)
        self.covered0 = np.bincount(self.pairs // size, self.n1[kind_of * size + self.pairs % size], ones)
        self.total0 = self.n1.reshape(kinds, size).sum(1)
        self.different0 = (self.n1.reshape(kinds, size) > 0).sum(1)

    def bits(self, kind: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, different3: np.ndarray | int = 0, covered2: np.ndarray | int = 0) -> np.ndarray:
        """Code lengths of ``d`` from the context of two on; ``different3`` symbols of counts ``covered2`` here are excluded."""
        size = self.size
        two, one = (kind * size + b) * size + c, kind * size + c
        different2, different1, different0 = looked_up(self.two, self.different2, two), self.different1[one], self.different0[kind]
        spent = np.zeros(len(d))
        open_ = np.ones(len(d), bool)
        for n, total, different, left in (
            (looked_up(self.three, self.n3, two * size + d), looked_up(self.two, self.total2, two) - covered2, different2 - different3, size - different2),
            (looked_up(self.pairs, self.n2, one * size + d), self.total1[one] - looked_up(self.two, self.covered1, two), different1 - different2, size - different1),
            (self.n1[kind * size + d], self.total0[kind] - self.covered0[one], different0 - different1, size - different0),
        ):
            out = np.where((left > 0) & (total > 0), different, 0)
            hit = open_ & (n > 0)
            open_ &= ~hit
            spent += np.where(hit, log2(total + out) - log2(n), 0) + np.where(open_ & (total > 0), log2(total + out) - log2(out), 0)
        return spent + np.where(open_, log2(np.maximum(size - different0, 1)), 0) + np.where(d == SHARED, self.sharing, 0)


@dataclass
class Tree:
    """Frozen code lengths. ``bits`` has a row per frequent context of three, a column per symbol, a layer per kind.

    ``cold`` has the trained contexts without a row: kind, context, followers
    (symbol, n). It stays with the driver. Without such contexts it is None.
    """

    kinds: list[str]
    symbols: np.ndarray  # of each of the 256 byte values
    contexts: np.ndarray  # row of each packed context of three symbols, -1 for those without
    bits: np.ndarray
    short: Short
    cold: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cold": None}

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray, block: int = 1 << 19, away: list | None = None) -> np.ndarray:
        """Bits of each text under each kind: an array of texts x kinds.

        Contexts without a row count as new; their texts and 4-grams are added to ``away``.
        """
        out, frames = framed(data, offsets, BOUNDARY)
        coded = self.symbols[out].astype(np.int32)
        totals = np.zeros((len(offsets) - 1, len(self.kinds)))
        size = self.bits.shape[2]
        skip = np.zeros(len(coded), bool)
        for place in range(ORDER):
            skip[frames[:-1] + place] = True
        for start in range(ORDER, len(coded), block):
            stop = min(start + block, len(coded))
            row = self.contexts[(coded[start - 3 : stop - 3] * size + coded[start - 2 : stop - 2]) * size + coded[start - 1 : stop - 1]]
            cells = np.maximum(row, 0) * np.int64(size) + coded[start:stop]
            first = int(np.searchsorted(frames, start, "right")) - 1
            last = int(np.searchsorted(frames, stop, "left"))
            cuts = np.maximum(frames[first:last], start) - start
            used = ~skip[start:stop]
            rest = np.flatnonzero((row < 0) & used)
            at = rest + start
            gram = (out[at - 3].astype(np.int64) << 24) | (out[at - 2].astype(np.int64) << 16) | (out[at - 1].astype(np.int64) << 8) | out[at]
            every, index = np.unique(gram, return_inverse=True)
            _, b, c, d = self.parts(every)
            if away is not None:
                away.append((np.searchsorted(frames, at, "right") - 1, gram))
            for layer in range(len(self.kinds)):
                spent = np.where(used, self.bits[layer].reshape(-1)[cells], 0.0)
                if len(rest):
                    spent[rest] = self.short.bits(np.full(len(every), layer), b, c, d)[index]
                totals[first:last, layer] += np.add.reduceat(spent, cuts, dtype=np.float64)
        return totals

    def parts(self, gram: np.ndarray) -> list[np.ndarray]:
        """The four symbols of 4-grams."""
        return [self.symbols[(gram >> s) & 0xFF].astype(np.int64) for s in (24, 16, 8, 0)]


def away_lists(away: list, rows: int) -> tuple[pa.Array, pa.Array]:
    """What ``code_lengths`` added to ``away`` as two lists per text: different 4-grams and how often each occurs."""
    key = np.concatenate([(text.astype(np.int64) << 32) | gram for text, gram in away] or [np.zeros(0, np.int64)])
    key, times = np.unique(key, return_counts=True)
    cuts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(key >> 32, minlength=rows))]).astype(np.int32))
    return pa.ListArray.from_arrays(cuts, pa.array(key & 0xFFFFFFFF)), pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64)))


def corrections(rows: DataFrame, tree: Tree, shared: Broadcast) -> DataFrame:
    """row, kind (its number), more: bits that the contexts in ``tree.cold`` add to the code lengths of ``rows(row, grams, gram_times)``.

    ``shared`` is the broadcast tree.
    """

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Tree = shared.value
        short, numbers = known.short, {k: i for i, k in enumerate(known.kinds)}
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, times = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            kind = np.array([numbers[k] for k in batch.column(3).to_pylist()], np.int64)
            followers = batch.column(4)
            different = pc.list_value_length(followers).to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(batch.num_rows), different)
            entries = followers.flatten()
            symbol = known.symbols[entries.field(0).to_numpy()].astype(np.int64)
            n = entries.field(1).to_numpy().astype(np.float64)
            _, b, c, d = known.parts(gram)
            covered = np.bincount(of, looked_up(short.three, short.n3, (((kind * short.size + b) * short.size + c) * short.size)[of] + symbol), batch.num_rows)
            own = np.bincount(of, np.where(symbol == d[of], n, 0), batch.num_rows)
            out = np.where(short.size > different, different, 0)
            whole = np.bincount(of, n, batch.num_rows) + out
            bits = np.where(own > 0, log2(whole) - log2(own), log2(whole) - log2(out) + short.bits(kind, b, c, d, different, covered))
            more = times * (bits - short.bits(kind, b, c, d))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kind.astype(np.int32)), pa.array(more)], names=["row", "kind", "more"])

    wanted = rows.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("g")).select("row", "g.*")
    wanted = wanted.withColumn("context", F.shiftright("grams", 8))
    joined = wanted.join(tree.cold, "context").select("row", "grams", "gram_times", "kind", "followers")
    return joined.mapInArrow(differ, "row long, kind int, more double").groupBy("row", "kind").agg(F.sum("more").alias("more"))


def numbered(column: pa.ChunkedArray, kinds: list[str]) -> np.ndarray:
    return pc.index_in(column, pa.array(kinds, pa.string())).to_numpy().astype(np.int64)


def build(counts: DataFrame, max_grams: int = MAX_GRAMS, max_rows: int = MAX_ROWS) -> Tree:
    """The tree of counts ``kind, gram, n``.

    Of all kinds together the most frequent contexts of three symbols have a row
    of their own, at most ``max_rows`` with ``max_grams`` 4-grams per kind (fewer
    with many kinds); this bounds the rows, not what counts: the others are in
    ``cold``. Without counts there are no kinds.
    """
    spark = counts.sparkSession
    lower = counts.groupBy("kind", F.col("gram").bitwiseAND(F.lit(0xFFFFFF).cast("long")).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    kinds = sorted(pc.unique(lower.column("kind")).to_pylist())
    gram = lower.column("gram").to_numpy()
    n = lower.column("n").to_numpy().astype(np.float64)
    seen = np.bincount(gram & 0xFF, minlength=256) > 0
    seen[BOUNDARY] = False
    own = np.flatnonzero(seen)
    symbols = np.full(256, SHARED, np.uint8)
    symbols[own] = np.arange(len(own)) + 2  # UTF-8 has at most 243 byte values
    symbols[BOUNDARY] = 0
    size = len(own) + 2
    b, c, d = (symbols[(gram >> s) & 0xFF].astype(np.int64) for s in (16, 8, 0))
    # Bytes that share a symbol split its probability evenly.
    short = Short(len(kinds), size, float(np.log2(max(1, 255 - len(own)))), numbered(lower.column("kind"), kinds), b, c, d, n)
    contexts = np.full(size**3, -1, np.int32)
    if not kinds:
        return Tree(kinds, symbols, contexts, np.zeros((0, 1, size), np.float32), short)

    room = min(max_rows, MAX_CELLS // (len(kinds) * size))
    totals = counts.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("n"), F.count("*").alias("grams"))
    ranked = totals.orderBy(F.desc("n"), "context").limit(room + 1).toArrow()
    fits = (np.cumsum(ranked.column("grams").to_numpy()) <= max_grams * len(kinds)) & (np.arange(ranked.num_rows) < room)
    hot = ranked.column("context").to_numpy()[fits]
    named = F.broadcast(spark.createDataFrame(pa.table({"context": hot}), "context long"))
    placed = counts.withColumn("context", F.shiftright("gram", 8))
    cold = None
    if len(hot) < ranked.num_rows:
        follower = F.struct(F.col("gram").bitwiseAND(F.lit(0xFF).cast("long")).cast("int").alias("symbol"), "n")
        cold = placed.join(named, "context", "left_anti").groupBy("context", "kind").agg(F.collect_list(follower).alias("followers"))
    rows = placed.join(named, "context").select("kind", "gram", "n").toArrow()
    bits = rows_of_bits(short, symbols, hot, numbered(rows.column("kind"), kinds), rows.column("gram").to_numpy(), rows.column("n").to_numpy(), len(kinds))
    packed = (symbols[hot >> 16].astype(np.int64) * size + symbols[(hot >> 8) & 0xFF]) * size + symbols[hot & 0xFF]
    contexts[packed] = np.arange(len(hot))
    return Tree(kinds, symbols, contexts, bits, short, cold)


def rows_of_bits(short: Short, symbols: np.ndarray, hot: np.ndarray, kind: np.ndarray, gram: np.ndarray, n: np.ndarray, kinds: int) -> np.ndarray:
    """Code lengths of all symbols after each context of ``hot``: kinds x contexts x symbols."""
    size = short.size
    order = np.argsort(hot)
    place = order[np.searchsorted(hot, gram >> 8, sorter=order)] if len(hot) else np.zeros(0, np.int64)
    last = symbols[gram & 0xFF].astype(np.int64)
    b, c = (symbols[(hot >> s) & 0xFF].astype(np.int64) for s in (8, 0))
    bits = np.zeros((kinds, max(1, len(hot)), size), np.float32)
    at_two, at_one = (short.three // size).astype(np.int64), short.pairs // size
    for layer in range(kinds):
        own = kind == layer
        order3 = dense(place[own], last[own], n[own], len(hot), size)
        mid, index = np.unique(at_two[at_two // size**2 == layer], return_inverse=True)
        mine = at_two // size**2 == layer
        # One more row, without counts, for contexts that the kind does not know.
        order2 = dense(index, short.three[mine] % size, short.n3[mine], len(mid) + 1, size)
        mine = at_one // size == layer
        order1 = dense(at_one[mine] % size, short.pairs[mine] % size, short.n2[mine], size, size)
        order0 = short.n1[layer * size : (layer + 1) * size]
        for low in range(0, len(hot), 4096):
            part = slice(low, min(low + 4096, len(hot)))
            two = (layer * size + b[part]) * size + c[part]
            row = np.searchsorted(mid, two)
            row = np.where(np.append(mid, -1)[row] == two, row, len(mid))
            chance = mixed([order3[part], order2[row], order1[c[part]], np.broadcast_to(order0, (len(two), size))], size)
            cost = -np.log2(np.maximum(chance, 1e-30))
            cost[:, SHARED] += short.sharing
            bits[layer, part] = cost
    return bits


def dense(row: np.ndarray, column: np.ndarray, weight: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return np.bincount(row * columns + column, weight, minlength=rows * columns).reshape(rows, columns).astype(np.float32)


def mixed(levels: list[np.ndarray], size: int) -> np.ndarray:
    """Symbol probabilities of contexts, longest first.

    A context that has been followed by t symbols, d of them different, escapes
    with d / (t + d). After an escape the symbols it had seen cannot follow, so
    shorter contexts count only the others; in the end all that remain are
    equally likely. A context that has seen every symbol does not escape.
    """
    rows = levels[0].shape[0]
    chance = np.zeros((rows, size))
    escape = np.ones((rows, 1))
    open_ = np.ones((rows, size), bool)
    for counts in levels:
        usable = np.where(open_, counts, 0).astype(np.float64)
        total = usable.sum(1, keepdims=True)
        different = (usable > 0).sum(1, keepdims=True)
        left = open_.sum(1, keepdims=True) - different
        out = np.where((left > 0) & (total > 0), different, 0)
        share = np.where(total > 0, escape / np.maximum(total + out, 1e-300), 0)
        chance += usable * share
        escape = np.where(total > 0, escape * out / np.maximum(total + out, 1e-300), escape)
        open_ &= ~(usable > 0)
    left = open_.sum(1, keepdims=True)
    return chance + np.where(open_, escape / np.maximum(left, 1), 0)
