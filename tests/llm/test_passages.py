import hashlib
import re

import duckdb
import numpy as np
import pytest

from fleetwatt.llm.fm_index import FMIndex
from fleetwatt.llm.passages import LAST_ID, OP12_SQL, remove_passages
from fleetwatt.llm.queries import QUERIES
from tests.test_queries import result

SPACES = re.compile("[\x20\x09-\x0d]+")


def brute(rows, length):
    """doc_id, words, removed words and kept text of each row."""
    texts = [(LAST_ID if i is None else i, i, [w for w in SPACES.split(t or "") if w]) for i, t in rows]
    first = {}
    for order, _, words in texts:
        for at in range(len(words) - length + 1):
            window = tuple(words[at : at + length])
            first[window] = min(first.get(window, order), order)
    found = []
    for order, doc_id, words in texts:
        gone = set()
        for at in range(len(words) - length + 1):
            if first[tuple(words[at : at + length])] < order:
                gone.update(range(at, at + length))
        found.append((doc_id, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(found, key=str)


def ran(frame, **options):
    made = remove_passages(frame, **options).collect()
    return sorted(((r.doc_id, r.n_words, sum(s["to"] - s["from"] for s in r.spans), bytes(r.kept).decode()) for r in made), key=str)


def corpus(seed=1, copies=12):
    """Prose with shared passages, near copies of one text, and one hot passage in differing surroundings."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{n}" for n in range(60)] + ["ü", "Word", "word"]

    def prose(n):
        return [vocabulary[i] for i in rng.integers(0, len(vocabulary), n)]

    shared, near = [prose(n) for n in (9, 14, 40)], prose(70)
    rows = []
    for number in range(copies):
        other = list(near)
        other[rng.integers(0, 70)] = "changed"
        rows.append((100 - number, " ".join(other)))
        rows.append((200 + number, "\t".join([*prose(rng.integers(0, 12)), *shared[number % 3], *prose(rng.integers(0, 12))])))
        rows.append((300 + number, "  ".join([*prose(3), *shared[0], *shared[1], *prose(4)]) + "\n"))
    rows += [(400, "a " * 40), (401, "a " * 25), (402, " ".join(["a", "b"] * 20)), (402, " ".join(["a", "b"] * 20))]
    rows += [(None, rows[0][1]), (None, None), (7, None), (8, ""), (9, " \v\f"), (10, "  x"), (402, rows[1][1]), (None, " ".join(near))]
    return rows


@pytest.mark.parametrize(("length", "k", "most"), [(8, 3, 4096), (8, 3, 1), (8, 3, 4), (10, 10, 4096)])
def test_against_brute_force(docs, length, k, most):
    rows = corpus()
    assert ran(docs(*rows, parts=3), length=length, k=k, most=most) == brute(rows, length)


def test_default_length(docs):
    rows = [(i, " ".join(f"x{n}" for n in range(i, i + 60 + i % 3))) for i in (3, 1, 2, 20)] + [(5, " ".join(f"x{n}" for n in range(1, 50)))]
    made = ran(docs(*rows))
    assert made == brute(rows, 50)
    assert sum(r[2] for r in made) > 100


def test_empty_and_short(docs):
    assert ran(docs((1, "x")).where("false")) == []
    assert ran(docs((1, "x y"), (2, "x y"))) == [(1, 2, 0, "x y"), (2, 2, 0, "x y")]


def test_words_of_any_length(docs):
    long = "z" * 3_000_000
    rows = [(1, " ".join([long, *"abcdefghij"])), (2, " ".join(["q", long, *"abcdefghij"])), (3, long)]
    assert ran(docs(*rows), length=8, k=3) == brute(rows, 8)


def test_index_against_plain_search():
    rng = np.random.default_rng(5)
    for _ in range(20):
        kinds, cap = int(rng.integers(1, 6)), int(rng.integers(1, 7))
        strings = [rng.integers(0, kinds, rng.integers(0, 15)).astype(np.uint64) for _ in range(rng.integers(1, 6))]
        streamed = [*strings, *(rng.integers(0, kinds + 1, rng.integers(0, 12)).astype(np.uint64) for _ in range(4))]
        index = FMIndex(np.concatenate(strings), np.cumsum([0, *map(len, strings)]), cap)
        offsets = np.cumsum([0, *map(len, streamed)])
        size, low, high = index.statistics(np.concatenate(streamed), offsets)
        for number, text in enumerate(streamed):
            for at in range(len(text)):
                here = offsets[number] + at
                for n in range(1, min(cap, len(text) - at) + 1):
                    has = [s for s, t in enumerate(strings) for p in range(len(t) - n + 1) if list(t[p : p + n]) == list(text[at : at + n])]
                    assert bool(has) == (n <= size[here])
                    if n == size[here]:
                        assert sorted(index.string[low[here] : high[here]].tolist()) == has


def test_query_against_sql_and_brute_force(spark, sf_dir):
    frame = QUERIES["op12_passages"](spark, sf_dir)
    found = result(frame.columns, [tuple(r) for r in frame.collect()])
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    wanted = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows, 50)]
    assert found == result(["doc_id", "n_words", "n_removed", "kept_sha256"], wanted)
    assert any(r[2] for r in wanted)
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    cursor = connection.execute(OP12_SQL)
    assert found == result([c[0] for c in cursor.description], cursor.fetchall())
