import hashlib
import random

import numpy as np
import pytest

from fleetwatt.llm import queries, repeats


def brute(pairs, length):
    """Result of each pair in order, strings looked up in a set; rows with one id go by the digest of their text, equal rows are one document."""
    last = (1 << 63) - 1
    seen, result = set(), {}
    for key, _, text in sorted({(last if d is None else d, hashlib.md5((t or "").encode()).hexdigest(), t or "") for d, t in pairs}):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            string = data[s : s + length]
            if string in seen:
                gone[s : s + length] = True
            seen.add(string)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        result[key, text] = (len(data), [tuple(e) for e in edges.reshape(-1, 2).tolist()], kept)
    return [(d, *result[last if d is None else d, t or ""]) for d, t in pairs]


def rows(found):
    return sorted([(r.doc_id, r.n_bytes, [(s["from"], s["to"]) for s in r.spans], bytes(r.kept)) for r in found.collect()], key=str)


@pytest.fixture
def pairs():
    rng = random.Random(6)

    def text(n):
        return "".join(rng.choice("abcdefgé \n") for _ in range(n))

    passage, line = text(260), text(55)
    found = [(i, text(rng.randint(0, 300))) for i in range(30)]
    found += [(100 + i, text(rng.randint(0, 90)) + passage[rng.randint(0, 99) : rng.randint(150, 260)] + text(60)) for i in range(30)]
    found += [(200 + i, line + text(rng.randint(10, 60)) + line + text(80)) for i in range(25)]
    base = text(500)
    found += [(300 + i, base[: 20 * i] + "#" + base[20 * i :]) for i in range(20)]
    found += [(400, "ab" * 300), (401, "ab" * 80), (402, "x" * 99), (403, "x" * 100), (404, "x" * 101), (405, None), (406, "")]
    found += [(500 + i, base) for i in range(4)] + [found[40], (41, "shares an id with an other text " * 9), (41, passage), (None, passage), (None, passage)]
    found += [(None, passage[n:] + "none") for n in range(5)] + [(None, None), (41, base[30:])] + [(42, base[n:] + passage[n:]) for n in range(4)]
    rng.shuffle(found)
    return found


@pytest.mark.parametrize("most", [10**9, 5, 1])
def test_against_brute_force(docs, pairs, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
    assert rows(repeats.remove_repeats(docs(*pairs, parts=3))) == sorted(brute(pairs, 100), key=str)


def test_rows_without_id_lose_what_others_have(docs):
    passage = "".join(random.Random(4).choices("abcdefgh", k=195))
    found = rows(repeats.remove_repeats(docs((1, passage), (None, passage + "x"), (None, "y" + passage))))
    assert [(d, n, b"".join([kept])) for d, n, _, kept in found] == [(1, 195, passage.encode()), (None, 196, b"x"), (None, 196, b"y")]


def test_empty_table(docs):
    assert repeats.remove_repeats(docs()).count() == 0


def test_suffix_sort_orders_and_finds_equal_strings():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    at = rng.permutation(300)[:200]
    segment = np.sort(rng.integers(0, 4, 200))
    order, equal = repeats.suffix_sort(data, at, segment, 9)
    strings = [data[a : a + 9].tobytes() for a in at]
    assert order.tolist() == sorted(range(200), key=lambda i: (segment[i], strings[i], i))
    assert all(e == (n > 0 and segment[order[n]] == segment[order[n - 1]] and strings[order[n]] == strings[order[n - 1]]) for n, e in enumerate(equal))


def test_collisions_are_verified(monkeypatch):
    texts = [b"a" * 120, b"b" * 120, b"a" * 121, b"a" * 120, b"c" * 120]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    zero = np.zeros(5, np.int64)
    own = repeats.Contexts(data, offsets, zero, np.arange(5), zero, zero + 5)

    def result():
        differing = own.take(np.flatnonzero(~repeats.equal_contexts(own)))
        ids, starts = repeats.settle(differing, 100)
        return repeats.equal_contexts(own).tolist(), sorted(zip(ids.tolist(), starts.tolist(), strict=True))

    expected = result()
    assert expected[0] == [False, False, False, True, False] and expected[1] == [(2, s) for s in range(21)]
    monkeypatch.setattr(repeats, "BYTE_VALUES", np.zeros(256, np.uint64))  # every two strings collide
    assert result() == expected
    monkeypatch.setattr(repeats, "SORT_STRINGS", 7)
    assert result() == expected


def test_anchors_cover_each_string_once(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 64)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 900).astype(np.uint8)
    offsets = np.array([0, 0, 50, 450, 900])
    text, gram, place, low, high = repeats.anchors(data, offsets)
    covered = sorted((t, s) for t, a, b in zip(text, low, high, strict=True) for s in range(a, b + 1))
    assert covered == [(2, s) for s in range(301)] + [(3, s) for s in range(351)]
    assert ((low <= place) & (place <= low + 100 - repeats.K) & (high <= place)).all()


def test_query(spark, sf_dir):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = {d: (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for d, n, spans, kept in brute(table, 100)}
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op8_repeats"](spark, sf_dir).collect()}
    assert found == expected
