import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from fleetwatt.llm import ngram_join as nj
from fleetwatt.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(pairs):
    sets = [grams(t) for _, t in pairs]
    links, parent = Counter(), list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(pairs)), 2):
        if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[max(root(a), root(b))] = min(root(a), root(b))
    found = []
    for n, (doc, _) in enumerate(pairs):
        ids = [pairs[m][0] for m in range(len(pairs)) if root(m) == root(n) and pairs[m][0] is not None]
        found.append((doc, min(ids) if ids and sets[n] else doc, links[n]))
    return sorted(found, key=str)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"e{rng.randint(0, 999)}"
    return " ".join(words)


@pytest.fixture
def near(request):
    rng = random.Random(4)
    pairs = []
    for g in range(6):
        base = [f"{'ABab'[g % 4]}{rng.randint(0, 60)}" for _ in range(rng.randint(30, 150))]
        pairs += [(len(pairs) + n, edited(rng, base, rng.randint(0, 5))) for n in range(25)]
    pairs += [(500, None), (501, ""), (502, "  \n"), (503, "two words"), (504, "TWO words"), (505, "two"), (506, "Two, words!"), (507, "*** --"), (None, pairs[3][1]), (None, None)]
    return pairs + [pairs[0], pairs[30], (30, "an other text that shares the id of one above")]


def test_against_brute_force(docs, near):
    found = sorted((tuple(r) for r in nj.join(docs(*near, parts=3)).collect()), key=str)
    assert found == brute(near)


def test_blocks_give_the_same(docs, near, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 3)
    monkeypatch.setattr(nj, "SKETCH_BLOCK", 4)
    found = sorted((tuple(r) for r in nj.join(docs(*near, parts=3)).collect()), key=str)
    assert found == brute(near)


def survivors(rows):
    """Of each class the row with the smallest id (none is last) and hash of its text, once; texts without words all stay."""
    sets = [grams(t) for _, t in rows]

    def key(n):
        mark = xxhash.xxh64_intdigest((rows[n][1] or "").encode(), seed=42)
        return (rows[n][0] is None, rows[n][0] or 0, mark - (1 << 64) * (mark >> 63))

    group = list(range(len(rows)))

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
            group[max(root(i), root(j))] = min(root(i), root(j))
    first = {}
    for n in range(len(rows)):
        if sets[n] and (root(n) not in first or key(n) < key(first[root(n)])):
            first[root(n)] = n
    return sorted([rows[n] for n in first.values()] + [r for r, s in zip(rows, sets, strict=True) if not s], key=str)


def test_one_of_each_class_stays(docs, near):
    table = docs(*near)
    kept = nj.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == survivors(near)


def test_rows_that_share_an_id_or_have_none(docs):
    """Different texts under one id stay, copies without id go, and rows that repeat all are one."""
    one, two, three = (" ".join(f"{c}{n}" for n in range(30)) for c in "abc")
    rows = [(1, one), (1, two), (None, three), (None, three), (None, one), (2, two), (5, None), (5, None), (6, one + " more"), (1, one)]
    kept = sorted(((r.doc_id, r.text) for r in nj.one_of_each(docs(*rows, parts=3)).collect()), key=str)
    assert kept == survivors(rows) == sorted([(1, one), (1, two), (None, three), (5, None), (5, None)], key=str)


def test_empty_table(docs):
    assert nj.join(docs()).count() == 0 and nj.join(docs((1, None))).collect() == [(1, 1, 0)]


def test_banding_reaches_its_target():
    bands, rows = nj.banding()
    assert bands * rows <= nj.MAX_HASHES and 1 - (1 - nj.THRESHOLD**rows) ** bands >= nj.TARGET_RECALL
    with pytest.raises(ValueError, match="too few"):
        nj.banding(hashes=4)


def test_min_hashes_estimate_the_similarity():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
    both = np.concatenate([a[:900], a[100:]])
    values = nj.min_hashes(both, np.array([0, 900, 1800]), 2000)
    assert abs((values[:, 0] == values[:, 1]).mean() - 0.8) < 0.03


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(50, 50), (60, 61), (60, 61)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 30)} | {60: 60, 61: 60}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
