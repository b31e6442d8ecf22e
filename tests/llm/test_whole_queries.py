"""Registered queries on whole given tables against plain loops."""

from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from fleetwatt.llm import quality, queries
from fleetwatt.llm.common import held_out, id_text, table
from tests.llm.test_ngram_join import grams


def test_nearest_finds_what_all_distances_say(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    found = {}
    for r in queries.QUERIES["op7_nearest"](spark, sf_dir).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 100 == 0)
    hits = []
    for query, answer in found.items():
        distance = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(1))
        order = [n for n in np.lexsort((ids, distance)) if ids[n] != query][:10]
        assert sorted(answer) == list(range(1, len(order) + 1))
        got = [answer[rank] for rank in sorted(answer)]
        assert got == sorted(got, key=lambda a: (a[1], a[0]))
        exact = dict(zip(ids.tolist(), distance.tolist(), strict=True))
        assert all(score == pytest.approx(exact[i], abs=1e-12) for i, score in got)
        hits.append(len({i for i, _ in got} & {int(ids[n]) for n in order}) / len(order))
    assert np.mean(hits) >= 0.9


def test_join_finds_all_links_of_all_documents(spark, sf_dir):
    """Every pair at 0.8 or more by an inverted list of n-grams; classes by following links."""
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    sets = {i: grams(t) for i, t in texts.items()}
    holders, links, group = {}, Counter(), {i: i for i in texts}
    for i, own in sets.items():
        for gram in own:
            holders.setdefault(gram, []).append(i)

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, own in sets.items():
        shared = Counter(j for gram in own for j in holders[gram] if j > i)
        for j, common in shared.items():
            if 10 * common >= 8 * (len(own) + len(sets[j]) - common):
                links.update((i, j))
                a, b = sorted((root(i), root(j)))
                group[b] = a
    found = {r.doc_id: (r.class_id, r.n_links) for r in queries.QUERIES["op2_ngram_join"](spark, sf_dir).collect()}
    assert found == {i: (root(i), links[i]) for i in texts}
    assert any(n for _, n in found.values())


def test_quality_is_the_difference_of_plain_sizes(spark, sf_dir):
    documents = id_text(table(spark, sf_dir, "documents"))
    model = quality.train(documents, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 4, 2)))
    settings = dict(level=1, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(content, text):
        plain = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content), **settings)
        return sum(len(plain.compress(text[a : a + 1024])) for a in range(0, len(text), 1024))

    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    rows = queries.QUERIES["op6_quality_classifier"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        text = texts[row.doc_id]
        good, bad = size(model.good, text), size(model.bad, text)
        share = good / (len(text) + 50)
        logit = np.dot([(bad - good) / (len(text) + 100), share, share * share], model.weights) + model.offset
        assert row.score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)
        assert row.predicted == (row.score >= 0.7)
