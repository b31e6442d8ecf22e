import numpy as np
import pytest

from fleetwatt.llm import nearest


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, query_id string").repartition(3)


def brute(ids, vectors, queries, k=10):
    found = {}
    for q in queries:
        own = vectors[list(ids).index(q)]
        distance = np.sqrt(((vectors - own) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, distance)) if ids[i] != q][:k]
        found[q] = [(int(ids[i]), float(distance[i])) for i in order]
    return found


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("block", [40, 4096])
def test_recall_and_distances(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "LIST_BLOCK", block)
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(1500, 32)).astype(np.float32)
    vectors[300:700] = vectors[300]  # a hot vector
    ids = rng.permutation(5000)[:1500]
    own = nearest.usable(table(spark, [(int(i), v.tolist(), "x") for i, v in zip(ids, vectors, strict=True)]), "vec_id", "embedding")
    queries = sorted(int(i) for i in ids if i % 50 == 0)
    found = answers(nearest.search(own, own.where("id % 50 = 0")))
    expected = brute(ids, vectors.astype(float), queries)
    assert sorted(found) == queries
    hits = [len({v for v, _ in found[q]} & {v for v, _ in expected[q]}) / 10 for q in queries]
    assert np.mean(hits) >= 0.9 and all(len(found[q]) == 10 for q in queries)
    exact = {(q, v): s for q in queries for v, s in brute(ids, vectors.astype(float), [q], 1500)[q]}
    assert all(abs(exact[q, v] - s) < 1e-12 for q in queries for v, s in found[q])
    hot = [q for q in queries if 300 <= list(ids).index(q) < 700]
    assert all(found[q] == expected[q] for q in hot)


def test_few_and_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.0], "b"), (3, [0.0, 2.0], "c"), (4, None, "d"), (5, [0.0, 0.0], "e"), (6, [1.0, None], "f")]
    rows += [(7, [float("nan"), 1.0], "g"), (8, [float("inf"), 1.0], "h"), (9, [1.0], "i"), (None, [1.0, 1.0], "j"), (3, [0.0, 2.0], "k")]
    own = nearest.usable(table(spark, rows), "vec_id", "embedding")
    assert {r.id for r in own.collect()} == {1, 2, 3}
    found = answers(nearest.search(own, own))
    assert found[1] == [(2, 0.0), (3, pytest.approx(5**0.5))] and found[3] == [(1, pytest.approx(5**0.5)), (2, pytest.approx(5**0.5))]
    empty = nearest.usable(table(spark, []), "vec_id", "embedding")
    assert nearest.search(empty, empty).count() == 0
    assert nearest.search(own, own.where("id > 100")).count() == 0
    alone = own.where("id = 1")
    assert nearest.search(alone, alone).count() == 0
