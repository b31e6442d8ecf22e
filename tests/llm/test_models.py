"""Quality, language, language model scores: context trees against a plain trie, accuracy on held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwatt.llm import language_id, lm_scoring, ppm, quality, queries


def trie_bits(training, text, order=3):
    """Code length by a plain dictionary of contexts with escapes and exclusion; boundary symbol -1."""
    contexts = {}
    for t in training:
        s = [-1] * order + list(t) + [-1]
        for i in range(order, len(s)):
            for k in range(order + 1):
                contexts.setdefault(tuple(s[i - k : i]), Counter())[s[i]] += 1
    alphabet = {-1, *(b for t in training for b in t)}
    # All unseen bytes share one more symbol.
    unseen = 256 - 1 - len(alphabet - {-1})
    total = 0.0
    s = [-1] * order + [b if b in alphabet else -2 for b in text] + [-1]
    for i in range(order, len(s)):
        gone, escape, done = set(), 1.0, False
        for k in range(order, -1, -1):
            counts = {b: n for b, n in contexts.get(tuple(s[i - k : i]), {}).items() if b not in gone}
            if not counts:
                continue
            out = len(counts) if len(alphabet) + 1 - len(gone) - len(counts) > 0 else 0
            whole = sum(counts.values()) + out
            if s[i] in counts:
                total -= math.log2(escape * counts[s[i]] / whole)
                done = True
                break
            escape *= out / whole
            gone |= set(counts)
        if not done:
            total -= math.log2(escape / (len(alphabet) + 1 - len(gone)))
            if s[i] == -2:
                total += math.log2(unseen)
    return total


def flat(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def test_tables_equal_the_trie(spark):
    rng = random.Random(1)
    training = ["".join(rng.choice("abé ") for _ in range(rng.randint(0, 40))) for _ in range(30)]
    rows = spark.createDataFrame([(t, "all") for t in training], "text string, kind string").repartition(3)
    tree = ppm.build(ppm.gram_counts(rows))
    texts = [t.encode() for t in ["", "abab", "é a", "zq ab", training[0], "".join(rng.choice("abz") for _ in range(60))]]
    found = tree.code_lengths(*flat(texts), block=7)[:, 0]
    expected = [trie_bits([t.encode() for t in training], t) for t in texts]
    assert np.allclose(found, expected, rtol=1e-4)


def test_probabilities_add_up_to_one(spark):
    rows = spark.createDataFrame([("abcabd", "x"), ("bbb", "y"), (None, "y")], "text string, kind string")
    tree = ppm.build(ppm.gram_counts(rows))
    size = int(tree.symbols[tree.symbols != 0].max()) + 1
    shared = 255 - (size - 2)
    weight = np.ones(size)
    weight[ppm.SHARED] = shared
    chance = np.exp2(-tree.bits[:, :, :size].astype(float)) * weight
    assert np.allclose(chance.sum(2), 1, atol=1e-4)


def test_trees_are_bounded(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([("".join(rng.choice("abcdefgh") for _ in range(3000)), "k")], "text string, kind string")
    counts = ppm.gram_counts(rows)
    tree = ppm.build(counts, max_grams=500, max_rows=50)
    assert tree.bits.shape[1] <= 50 + 200 + 129
    assert np.isfinite(tree.code_lengths(*flat([b"abcabc", b"zzz"]))).all()
    assert ppm.build(counts.limit(0)).kinds == []


def test_contexts_without_a_row_count_in_full(spark, docs):
    rng = random.Random(4)
    training = ["".join(rng.choice("abcé ж") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    texts = [*training[:6], "", "zab abc", "жжж abca", "abab" * 30]
    rows = spark.createDataFrame([(t,) for t in training], "text string").repartition(3)
    build = ppm.build
    for max_rows in (0, 5, 1 << 15):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ppm, "build", lambda counts, m=max_rows: build(counts, max_rows=m))
            found = {r.doc_id: r.score for r in lm_scoring.score(docs(*enumerate(texts)).select("doc_id", "text"), rows).collect()}
        for i, text in enumerate(texts):
            assert math.isclose(found[i], -trie_bits([t.encode() for t in training], text.encode()) * math.log10(2), rel_tol=1e-4)


def test_all_bytes_of_many_scripts_are_symbols(spark):
    letters = "".join(chr(c) for start in (0x400, 0x600, 0x900, 0x3040, 0x4E00, 0xAC00) for c in range(start, start + 90)) + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,;:!?-()"
    rng = random.Random(5)
    training = ["".join(rng.choice(letters) for _ in range(400)) for _ in range(4)]
    tree = ppm.build(ppm.gram_counts(spark.createDataFrame([(t, "k") for t in training], "text string, kind string")))
    used = {b for t in training for b in t.encode()}
    assert len(used) > 126 and ppm.SHARED not in {int(tree.symbols[b]) for b in used} and len({int(tree.symbols[b]) for b in used}) == len(used)
    text = training[0][:50].encode()
    assert math.isclose(tree.code_lengths(*flat([text]))[0, 0], trie_bits([t.encode() for t in training], text), rel_tol=1e-4)


def test_language(spark, docs, sf_dir):
    rows = queries.QUERIES["op10_language_id"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").collect()
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.9
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in rows.collect())
    tree = language_id.train(spark.createDataFrame([("the and of the", "en"), ("der die und", "de"), ("le", None)], "text string, lang string"))
    pairs = [(1, "THE AND"), (1, "THE AND"), (2, None), (3, ""), (4, "12 34 ..."), (None, "und die")]
    found = sorted(map(str, [(r.doc_id, r.lang_pred) for r in language_id.identify(docs(*pairs), tree).collect()]))
    assert found == sorted(map(str, [(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "de")]))
    nothing = language_id.train(spark.createDataFrame([], "text string, lang string"))
    assert [(r.lang_pred, r.score) for r in language_id.identify(docs((1, "a")), nothing).collect()] == [("und", 0.0)]
    assert language_id.identify(docs(), tree).count() == 0


def test_small_languages_keep_their_contexts(spark, docs):
    rng = random.Random(6)
    letters = {"aa": "abcdefgh ", "bb": "abcdefgh ", "ru": "абвгдежз "}
    texts = {k: ["".join(rng.choice(v) for _ in range(80)) for _ in range(60 if k == "aa" else 3)] for k, v in letters.items()}
    rows = spark.createDataFrame([(t, k) for k, own in texts.items() for t in own], "text string, lang string")
    asked = [texts["aa"][0], texts["bb"][0], texts["bb"][2], texts["ru"][1], "", "abc", "12"]
    build = ppm.build
    for max_rows in (0, 20):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ppm, "build", lambda counts, m=max_rows: build(counts, max_rows=m))
            tree = language_id.train(rows)
        assert tree.cold is not None
        found = {r.doc_id: r for r in language_id.identify(docs(*enumerate(asked), (None, None)), tree).collect()}
        full = build(ppm.gram_counts(rows.select("text", F.col("lang").alias("kind"))))
        bits = full.code_lengths(*flat([t.encode() for t in asked]))
        assert full.cold is None and len(found) == len(asked) + 1 and found[None].lang_pred == "und"
        for i, text in enumerate(asked):
            if not re.search("[^\\W\\d]", text):
                assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
                continue
            assert found[i].lang_pred == full.kinds[bits[i].argmin()]
            assert math.isclose(found[i].score, 1 / np.exp2(bits[i].min() - bits[i]).sum(), rel_tol=1e-3)
        assert [found[i].lang_pred for i in range(4)] == ["aa", "bb", "bb", "ru"]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(training, text):
    def tokens(t):
        return [*WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})), None]

    counts = Counter(w for t in training for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    own = tokens(text)
    score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
    return len(own), sum(counts[w] > 0 for w in own), total, score


@pytest.mark.parametrize("frequent", [3, 1 << 16])
def test_word_scores(spark, docs, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    rng = random.Random(3)
    words = ["The", "the", "É", "é", "x,", " y", "z" * 40, "THE"]
    pairs = [(i, rng.choice([" ", "\n", " \t "]).join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    pairs += [(90, None), (91, ""), (92, " \x0b"), pairs[3], (3, "unknown words"), (None, "the é")]
    training = [t for _, t in pairs[:20]]
    table = spark.createDataFrame([(t,) for t in training], "text string")
    found = lm_scoring.score(docs(*pairs, parts=3).select("doc_id", "text"), table).collect()
    made = sorted([(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found])
    wanted = [(d, *base(training, t)) for d, t in pairs]
    assert made == sorted([(str(d), n, k, t, round(s, 6)) for d, n, k, t, s in wanted])
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_word_scores_without_training(spark, docs):
    found = lm_scoring.score(docs((1, "a b"), (2, None)).select("doc_id", "text"), spark.createDataFrame([], "text string"))
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found.collect()) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_lm_query(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    training = [r.text for r in documents if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    found = {r.doc_id: r for r in queries.QUERIES["op9_lm_scoring"](spark, sf_dir).collect()}
    assert len(found) == len(documents)
    for r in documents[:25]:
        own = found[r.doc_id]
        n, known, total, score = base(training, r.text)
        assert (own.n_tokens, own.n_known, own.train_tokens) == (n, known, total) and abs(own.base_score - score) < 1e-6 * abs(score)
    per_byte = [r.score / max(1, r.n_tokens) for r in found.values()]
    assert max(per_byte) < 0


def test_quality(spark, docs):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op6_quality_classifier"](spark, sf)
    labelled = rows.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.score for r in labelled if r.quality == 1]
    bad = [r.score for r in labelled if r.quality == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.8 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in labelled)


def test_quality_of_odd_rows(spark, docs):
    pairs = [(i, ("good words here " if i % 2 else "B@D!! $$$ ### ") * 20) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(1, None, "x"), (None, 1, "x"), (999, 1, "x")], "doc_id long, quality int, score string")
    model = quality.train(docs(*pairs), labels)
    odd = [(100, None), (101, ""), (None, "good words here " * 9), (102, "B@D!! $$$ ### " * 9), (102, "B@D!! $$$ ### " * 9), (103, "good words " * 30_000)]
    found = quality.score(docs(*odd), model).collect()
    scores = {r.doc_id: r.score for r in found}
    assert len(found) == 6 and scores[102] < 0.3 < scores[None] and scores[100] == scores[101]
    table = docs(*odd)
    kept = quality.accepted(table, model)
    assert kept.schema == table.schema and 102 not in {r.doc_id for r in kept.collect()}
    nothing = quality.train(docs(), labels.limit(0))
    assert [r.score for r in quality.score(docs((1, "x")), nothing).collect()] == [0.5]
    assert quality.score(docs(), model).count() == 0 and np.isfinite(quality.train(docs(*pairs), labels.where(F.col("quality") == 1)).weights).all()
