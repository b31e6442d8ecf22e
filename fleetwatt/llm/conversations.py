"""Repair of conversations: the cheapest edits that make turns alternate, and a record of them.

A conversation is right if the initials of its roles are ``(s?(ua)+)?``. Rows may
be kept, given another role, deleted, and empty turns put between them. Which of
equally cheap ways is taken is settled by the letters of the edits, so the answer
is one: a weight is a single integer whose high digits are the cost and whose low
digits, of fixed width and one per edit, are the letters, with zeros after the
last. The shortest path through the graph of (row, what the roles so far ask for)
is then a plain minimum of integers.

Each row counts for the path by one symbol only: its initial, whether it must go,
whether it is truncated. Symbols are cut into blocks of BLOCK rows. Costs of a
block from each state to each state are put together from the last block to the
first, which tells every block the cost of what follows it; then all blocks find
their paths at once, and a second pass along the conversation picks one per block.
So a conversation of any length takes a byte per row, and its texts pass by once,
in order. (The hash of a conversation is a chain and takes one task by its nature.)
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import stored, table

SPACE = " \t\n\v\f\r"
BLOCK = 512
# A symbol: the class of the initial in the low bits, and two flags.
CLASSES = "sua"
OTHER, MUST_GO, CUT_SHORT = 3, 4, 8
# What has been said: nothing, a system turn, a user turn, an assistant turn.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOWS = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
NEXT = [AFTER_U, AFTER_U, AFTER_A, AFTER_U]  # after the turn that is due, of a user or an assistant
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4  # in the order of their letters
LETTERS = " DIKR"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
NEVER = 1 << 60
PAIRS = ("su", "ua", "au")


@functools.cache
def edits(symbol: int) -> list[list[tuple[int, int, int]]]:
    """By state: the edits of a row with this symbol as letter, cost and next state."""
    short = 1 if symbol & CUT_SHORT else 0
    found = []
    for state in range(4):
        ways = [(DELETE, COST[DELETE], state)]
        if not symbol & MUST_GO:
            if (state, symbol & 3) in FOLLOWS:
                ways.append((KEEP, COST[KEEP] + short, FOLLOWS[state, symbol & 3]))
            ways.append((REROLE, COST[REROLE] + short, NEXT[state]))
        found.append(ways)
    return found


@functools.cache
def step_costs(symbol: int) -> np.ndarray:
    """Least cost from state to state by one row, with an inserted turn before it where this helps."""
    out = np.full((4, 4), NEVER)
    for state in range(4):
        for before, cost in ((state, 0), (NEXT[state], COST[INSERT])):
            for _, more, after in edits(symbol)[before]:
                out[state, after] = min(out[state, after], cost + more)
    return out


@functools.lru_cache(1 << 14)
def block_costs(symbols: bytes) -> bytes:
    """Least costs of a block from each state to each, row by row, as 16 integers."""
    costs = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for symbol in symbols:
        costs = np.minimum((costs[:, :, None] + step_costs(symbol)[None]).min(1), NEVER)
    return costs.astype(np.int64).tobytes()


@functools.lru_cache(1 << 14)
def block_paths(symbols: bytes, after: tuple[int, ...], last: bool) -> tuple[tuple[int, str, int], ...]:
    """By state before the block: cost up to the end of the conversation, letters of the block, state after it.

    ``after`` has the cost of what follows by state. One inserted turn before a row,
    or at the end, is enough: two could be left out together, and a lone system turn
    is cheaper deleted than answered.
    """
    width = 3 * (2 * len(symbols) + 1)  # digits of at most one insertion per row, one per row, and one at the end
    top = width - 3
    low = (1 << width) - 1

    def put_before(letter: int, weight: int) -> int:
        """The weight of a path with one more letter in front of all others."""
        return ((weight >> width) + COST[letter] << width) + (letter << top) + ((weight & low) >> 3)

    best = [cost << width for cost in after]
    if last:
        best = [min(best[state], put_before(INSERT, best[NEXT[state]])) for state in range(4)]
    for symbol in reversed(symbols):
        short = (1 if symbol & CUT_SHORT else 0) << width
        by_row = []
        for ways in edits(symbol):
            by_row.append(min(put_before(letter, best[then]) + (0 if letter == DELETE else short) for letter, _, then in ways))
        best = [min(by_row[state], put_before(INSERT, by_row[NEXT[state]])) for state in range(4)]
    found = []
    for state, weight in enumerate(best):
        letters, digits, row = [], weight & low, 0
        while digits:
            letter = digits >> top
            letters.append(LETTERS[letter])
            if letter == INSERT:
                state = NEXT[state]
            else:
                state = next(then for kind, _, then in edits(symbols[row])[state] if kind == letter)
                row += 1
            digits = (digits << 3) & low
        found.append((weight >> width, "".join(letters), state))
    return tuple(found)


def conversation_name(conv_id: Column) -> Column:
    """A name without NULL."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def faults(rows: DataFrame) -> DataFrame:
    """conv, turn, role, digest, n and faults of the differing rows of ``rows(conv, turn, role, text)``.

    Equal rows of one turn are one row with their number ``n``; all of them but the
    first of a conversation repeat it.
    """
    said = F.btrim("text", F.lit(SPACE))
    light = rows.select("conv", "turn", "role", F.unhex(F.md5("text")).alias("digest"), said.alias("said"))
    kinds = light.select("conv", "turn", "role", "digest", (F.col("said") == "").alias("blank"), (~F.right("said", F.lit(1)).isin(".", "!", "?")).alias("short"))
    runs = kinds.groupBy("conv", "turn", "role", "digest", "blank", "short").agg(F.count("*").alias("n"))
    runs = stored(runs, "turns")
    first = runs.where("not blank").groupBy("conv", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("least"))
    joined = runs.join(first, ["conv", "role", "digest"], "left")
    is_first = F.col("turn").isNull() | (~F.col("unplaced") & (F.col("turn") == F.col("least")))
    fresh = ~F.col("blank") & F.coalesce(is_first, F.lit(False))
    return joined.select("conv", "turn", "role", "digest", "n", "blank", fresh.alias("fresh"), (fresh & F.col("short")).alias("short"))


def stream(rows: DataFrame, by: list[str], descending: bool = False) -> DataFrame:
    """Rows of a conversation in one task, in order, to be read one after another."""
    order = [F.desc(c) if descending else F.asc(c) for c in by]
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


def batched(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held.clear()
    if held:
        yield made()


def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


BLOCK_KINDS = {
    "conv": pa.string(),
    "place": pa.int64(),
    "copy": pa.int64(),
    "symbols": pa.binary(),
    "first": pa.string(),
    "last": pa.string(),
    "illegal": pa.int64(),
}
BLOCK_SCHEMA = "conv string, place long, copy long, symbols binary, first string, last string, illegal long"


def blocks(runs: DataFrame, size: int) -> DataFrame:
    """Symbols of up to ``size`` rows of a conversation, and their pairs of neighbours; (place, copy) increases along it."""

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        head: tuple = ()
        conv, symbols, first, last, illegal = None, bytearray(), "", "", 0
        for own, place, role, n, fresh, short in rows:
            initial = role[:1]
            kind = CLASSES.find(initial) if initial else OTHER
            kind = OTHER if kind < 0 else kind
            for copy in range(n):
                if own != conv or len(symbols) >= size:
                    if symbols:
                        yield (*head, bytes(symbols), first, last, illegal)
                    conv, head, symbols, first, illegal = own, (own, place, copy), bytearray(), initial, 0
                elif last + initial not in PAIRS:
                    illegal += 1
                last = initial
                symbols.append(kind | (0 if fresh and not copy else MUST_GO) | (CUT_SHORT if short and not copy else 0))
        if symbols:
            yield (*head, bytes(symbols), first, last, illegal)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(cut(tuples(batches)), BLOCK_KINDS)

    by = ["conv", "turn", "role", "digest"]
    ordered = runs.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id())
    return ordered.select("conv", "place", "role", "n", "fresh", "short").mapInArrow(run, BLOCK_SCHEMA)


def costs_after(found: DataFrame) -> DataFrame:
    """Blocks with ``after``, the least cost of what follows each by state, and whether nothing does."""

    def scan(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, after = None, np.zeros(4, np.int64)
        for row in rows:
            last = row[0] != conv
            if last:
                conv, after = row[0], np.array([0 if state in (START, AFTER_A) else NEVER for state in range(4)])
            yield (*row[:-1], after.tolist(), last)
            costs = np.frombuffer(row[-1], np.int64).reshape(4, 4)
            if last:  # a turn may be put after the last row
                after = np.minimum(after, [after[NEXT[state]] + COST[INSERT] for state in range(4)])
            after = np.minimum((costs + after[None]).min(1), NEVER)

    kinds = BLOCK_KINDS | {"after": pa.list_(pa.int64()), "is_last": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(scan(tuples(batches)), kinds)

    def with_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [block_costs(s) for s in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.binary())], names=[*BLOCK_KINDS, "costs"])

    costed = found.mapInArrow(with_costs, BLOCK_SCHEMA + ", costs binary")
    return stream(costed, ["place", "copy"], True).mapInArrow(run, BLOCK_SCHEMA + ", after array<long>, is_last boolean")


def audits(found: DataFrame) -> DataFrame:
    """conv, illegal, cost, audit of all conversations, from their blocks with the costs of what follows."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, after, is_last = (batch.column(c).to_pylist() for c in (3, 7, 8))
            paths = [block_paths(s, tuple(a), z) for s, a, z in zip(symbols, after, is_last, strict=True)]
            columns = [*(batch.column(c) for c in (0, 1, 2, 4, 5, 6))]
            columns += [pa.array([[p[part] for p in four] for four in paths], pa.list_(kind)) for part, kind in enumerate((pa.int64(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "place", "copy", "first", "last", "illegal", "cost", "letters", "then"])

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, state, total, last, illegal, parts = None, START, 0, "", 0, []
        for own, _, _, first, end, inside, cost, letters, then in rows:
            if own != conv:
                if conv is not None:
                    yield conv, illegal, total, "".join(parts)
                conv, state, total, illegal, parts = own, START, cost[START], 0, []
            elif last + first not in PAIRS:
                illegal += 1
            illegal += inside
            last = end
            parts.append(letters[state])
            state = then[state]
        if conv is not None:
            yield conv, illegal, total, "".join(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(join(tuples(batches)), {"conv": pa.string(), "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string()})

    # Dealt out by block, so that a long conversation is solved by many tasks.
    solved = found.repartition("place", "copy").mapInArrow(
        solve,
        "conv string, place long, copy long, first string, last string, illegal long, cost array<long>, letters array<string>, then array<long>",
    )
    return stream(solved, ["place", "copy"]).mapInArrow(run, "conv string, illegal long, cost long, audit string")


def edited(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv, edit, role, text of the repaired ``rows(conv, turn, role, text)``, each conversation in order in one task."""

    def apply(given: Iterator[tuple]) -> Iterator[tuple]:
        conv, letters, at, said = None, "", 0, ""

        def due() -> str:
            return "assistant" if said == "u" else "user"

        def inserted() -> Iterator[tuple]:
            nonlocal at, said
            while at < len(letters) and letters[at] == "I":
                role = due()
                said = role[0]
                at += 1
                yield conv, "I", role, ""

        for own, is_row, role, text in given:
            if not is_row:
                yield from inserted()
                conv, letters, at, said = own, text, 0, ""
                continue
            yield from inserted()
            letter = letters[at]
            at += 1
            if letter == "D":
                continue
            role = due() if letter == "R" else role
            said = role[0]
            yield conv, letter, role, text
        yield from inserted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = ((own, is_row, role, text) for batch in batches for own, is_row, role, text in tuples([batch.select(["conv", "is_row", "role", "text"])]))
        return batched(apply(given), {"conv": pa.string(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}, 256)

    texts = rows.select("conv", F.lit(1).alias("is_row"), "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text")
    first = found.select(
        "conv",
        F.lit(0).alias("is_row"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"),
    )
    return stream(first.unionByName(texts), ["is_row", "turn", "role", "digest"]).mapInArrow(run, "conv string, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """conv, sha256 of the lines ``role:text`` of each conversation of ``edited``, which has them in order in one task."""

    def chain(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, state = None, hashlib.sha256()
        for own, role, text in rows:
            if own != conv:
                if conv is not None:
                    yield conv, state.hexdigest()
                conv, state = own, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if conv is not None:
            yield conv, state.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in tuples([batch.select(["conv", "role", "text"])]))
        return batched(chain(rows), {"conv": pa.string(), "repaired_sha256": pa.string()})

    return repaired.mapInArrow(run, "conv string, repaired_sha256 string")


def repair(rows: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Per conversation of ``rows(conv, turn, role, text)`` its faults and edits, and the repaired rows.

    The first result has conv, gaps, blank, duplicate, truncated, illegal, cost and
    audit, the second (``edited``) conv, edit, role and text in order. Rows go by
    turn, NULL first; rows of one turn by role and the digest of their text, equal
    ones side by side. ``role`` and ``text`` hold no NULL. An empty role, or one
    of another initial, is never kept. Conversations without rows are in neither.
    """
    runs = stored(faults(rows), "runs")
    n = F.col("n")
    by_turn = runs.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(n - F.col("fresh").cast("long"))).alias("duplicate"),
        F.sum(F.col("short").cast("long")).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    counts = by_turn.groupBy("conv").agg(gaps.alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    cut = stored(blocks(runs, size), "blocks")
    solved = stored(audits(costs_after(cut)), "audits")
    return counts.join(solved, "conv"), edited(rows, solved)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text of ``conversations`` with one row in five damaged, told by crc32 of ``conv_id:turn``; NULLs are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    return (
        conversations.where(kind != 0)
        .select(
            conversation_name(F.col("conv_id")).alias("conv"),
            F.col("turn").cast("long").alias("turn"),
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations, damaged first.

    A NULL in any column is one space for the damage, for roles and for texts; a
    NULL turn comes first and leaves no gap, and rows without ``conv_id`` are one
    conversation. Rows of one turn are ordered by role and the digest of their text.
    An empty table gives no rows. Extra columns are left out.
    """
    conversations = table(spark, sf_dir, "conversations")
    found, repaired = repair(damaged(conversations))
    given = conversations.select("conv_id", conversation_name(F.col("conv_id")).alias("conv")).distinct()
    none = F.lit(0).cast("long")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        given.join(found, "conv", "left")
        .join(digests(repaired), "conv", "left")
        .select(
            "conv_id",
            *(F.coalesce(c, none).alias(c) for c in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


# Shortest paths over (row, state) as pairs of cost and letters; equal costs never have one's letters begin the other's.
OP13_SQL = r"""
WITH RECURSIVE
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT coalesce('=' || conv_id, '') AS conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place, left(role, 1) AS initial,
    NOT regexp_matches(text, '[^ 	-
]') AS blank,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') AS short
  FROM damaged),
faults AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY place) AS before,
    NOT blank AND row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1 AS again FROM placed),
rows_of AS (SELECT *, NOT blank AND NOT again AND short AS truncated FROM faults),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum(again::INT) AS duplicate,
    sum(truncated::INT) AS truncated, sum((before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::INT) AS illegal, count(*) AS n
  FROM rows_of GROUP BY conv),
moves(state, initial, after) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
due(state, after) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
put AS (SELECT state, state AS after, 0 AS cost, '' AS letter FROM due UNION ALL SELECT state, after, 2, 'I' FROM due),
ways AS (
  SELECT r.conv, r.place, p.state, w.after, p.cost + w.cost AS cost, p.letter || w.letter AS letters
  FROM rows_of r CROSS JOIN put p JOIN LATERAL (
    SELECT p.after AS after, 3 AS cost, 'D' AS letter
    UNION ALL SELECT m.after, r.truncated::INT, 'K' FROM moves m WHERE m.state = p.after AND m.initial = r.initial AND NOT r.blank AND NOT r.again
    UNION ALL SELECT d.after, 2 + r.truncated::INT, 'R' FROM due d WHERE d.state = p.after AND NOT r.blank AND NOT r.again) w ON true),
paths AS (
  SELECT conv, CAST(0 AS BIGINT) AS place, 0 AS state, {'cost': CAST(0 AS BIGINT), 'letters': ''} AS best FROM counts
  UNION ALL
  SELECT p.conv, w.place, w.after, min({'cost': p.best.cost + w.cost, 'letters': p.best.letters || w.letters})
  FROM paths p JOIN ways w ON w.conv = p.conv AND w.place = p.place + 1 AND w.state = p.state GROUP BY p.conv, w.place, w.after),
ended AS (
  SELECT p.conv, min(CASE WHEN p.state IN (0, 3) THEN p.best ELSE {'cost': p.best.cost + 2, 'letters': p.best.letters || 'I'} END) AS best
  FROM paths p JOIN counts c ON c.conv = p.conv AND c.n = p.place WHERE p.state <> 1 GROUP BY p.conv),
letters AS (SELECT conv, unnest(string_split(best.letters, '')) AS letter, unnest(range(1, length(best.letters) + 1)) AS pos FROM ended),
matched AS (
  SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY conv ORDER BY pos) AS place FROM letters),
left_over AS (
  SELECT m.conv, m.pos, m.letter, r.role, r.text, row_number() OVER (PARTITION BY m.conv ORDER BY m.pos) AS number,
    first_value(m.letter = 'K' AND r.initial = 's') OVER (PARTITION BY m.conv ORDER BY m.pos) AS has_system
  FROM matched m LEFT JOIN rows_of r ON r.conv = m.conv AND r.place = m.place AND m.letter <> 'I' WHERE m.letter <> 'D'),
repaired AS (
  SELECT conv, string_agg(CASE WHEN letter = 'K' THEN role WHEN (number - has_system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY pos) AS lines
  FROM left_over GROUP BY conv)
SELECT g.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
  coalesce(e.best.letters, '') AS audit, sha256(coalesce(r.lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations) g
LEFT JOIN counts c USING (conv) LEFT JOIN ended e USING (conv) LEFT JOIN repaired r USING (conv)
"""
