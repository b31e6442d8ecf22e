import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pytest

from fleetwatt.llm.conversations import OP13_SQL, block_paths, damaged, op13_conversation_repair, repair
from fleetwatt.llm.queries import QUERIES
from tests.test_queries import result

NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, place int, conv string, n int, digest string"
VALID = re.compile("(s?(ua)+)?")


def damage(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, role, text


def cheapest(rows):
    """Cost, letters and lines by a search over whole edit sequences in order of (cost, letters): no states, no weights.

    ``rows`` are (initial, must go, truncated, role, text). Turns are put in one at a time.
    """
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, letters, at, initials, lines = heapq.heappop(heap)
        if at == len(rows) and VALID.fullmatch(initials):
            return cost, letters, "\n".join(lines)
        if not re.fullmatch("s?(ua)*u?", initials):
            continue
        if not letters.endswith("II"):
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2, letters + "I", at, initials + role[0], (*lines, f"{role}:")))
        if at == len(rows):
            continue
        initial, must_go, short, role, text = rows[at]
        heapq.heappush(heap, (cost + 3, letters + "D", at + 1, initials, lines))
        if must_go:
            continue
        heapq.heappush(heap, (cost + short, letters + "K", at + 1, initials + (initial or " "), (*lines, f"{role}:{text}")))
        for other in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2 + short, letters + "R", at + 1, initials + other[0], (*lines, f"{other}:{text}")))


def brute(rows):
    by_conv = {row[0]: [] for row in rows}
    for row in damage(rows):
        by_conv[row[0]].append(row)
    found = []
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))
        seen, given, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            said = text.strip(" \t\n\v\f\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            given.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated"), role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(given, given[1:], strict=False))
        cost, letters, lines = cheapest(given)
        found.append((conv, gaps, *count.values(), illegal, cost, letters, hashlib.sha256(lines.encode()).hexdigest()))
    return found


def made_rows(n=60, seed=3):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "agent", "", None, "user", "assistant"]
    texts = ["Yes.", "No", "What?", " ", "", None, "Go on! \n", "one.\ttwo", " ", "über"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 6)):
            at = None if rng.random() < 0.1 else turn * rng.choice([1, 1, 3])
            rows.append((None if conv == 7 else conv, at, rng.choice(roles), rng.choice(texts)))
    return rows


def stored_table(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, 1, "c", 2, "d") for r in rows], SCHEMA).repartition(3)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")


def test_against_search(spark, tmp_path):
    rows = made_rows()
    stored_table(spark, tmp_path, rows)
    made = op13_conversation_repair(spark, str(tmp_path))
    assert made.columns == NAMES
    assert result(NAMES, [tuple(r) for r in made.collect()]) == result(NAMES, brute(rows))


@pytest.mark.parametrize("size", [1, 3, 512])
def test_long_conversations_in_blocks(spark, size):
    """One conversation of 400 turns cut into blocks of any size, with a run of equal rows, has one answer."""
    rng = random.Random(9)
    rows = [("=1", n, rng.choice(["user", "assistant", "system"]), f"{n}{rng.choice(['.', ''])}") for n in range(400)]
    rows += [("=1", 200, "user", "same.")] * 300 + [("=2", 1, "user", "x.")]
    frame = spark.createDataFrame(rows, "conv string, turn long, role string, text string").repartition(4)
    found, repaired = repair(frame, size)
    long, short = sorted(found.collect())
    assert (short.cost, short.audit) == (2, "KI")
    kept = [r for r in repaired.collect() if r.conv == "=1"]
    assert VALID.fullmatch("".join(r.role[0] for r in kept))
    assert [r.edit for r in kept] == [letter for letter in long.audit if letter != "D"]
    assert long.duplicate == 299 and len(long.audit.replace("I", "")) == 700
    own = sorted((r for r in rows if r[0] == "=1"), key=lambda r: (r[1], r[2], hashlib.md5(r[3].encode()).digest()))
    seen, symbols = set(), bytearray()
    for _, _, role, text in own:
        symbols.append("sua".index(role[0]) | (4 if (role, text) in seen else 8 if not text.endswith(".") else 0))
        seen.add((role, text))
    assert (long.cost, long.audit) == block_paths(bytes(symbols), (0, 1 << 60, 1 << 60, 0), True)[0][:2]


def test_empty_and_dropped(spark, tmp_path):
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    stored_table(spark, tmp_path, [(dropped, 0, "user", "x.")])
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in op13_conversation_repair(spark, str(tmp_path)).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]
    stored_table(spark, tmp_path / "none", [])
    assert op13_conversation_repair(spark, str(tmp_path / "none")).collect() == []


def test_query_against_sql_and_search(spark, sf_dir):
    frame = QUERIES["op13_conversation_repair"](spark, sf_dir)
    found = result(frame.columns, [tuple(r) for r in frame.collect()])
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found == result(NAMES, brute(rows))
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    cursor = connection.execute(OP13_SQL)
    assert found == result([c[0] for c in cursor.description], cursor.fetchall())


def test_sql_on_nulls_and_ties(spark, tmp_path):
    rows = made_rows(40, 5)
    stored_table(spark, tmp_path, rows)
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = connection.execute(OP13_SQL)
    assert result([c[0] for c in cursor.description], cursor.fetchall()) == result(NAMES, brute(rows))
    assert damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")).columns == ["conv", "turn", "role", "text"]
