import pickle
import random
import re

import numpy as np
import pytest

from fleetwatt.llm import pii, queries, tagger
from fleetwatt.llm.tagger import Tagger

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PATTERNS = [EMAIL, pii.IP, pii.CARD, pii.PHONE]


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            keep = [
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                14 <= len(digits) <= 19 and pii.luhn(digits),
                10 <= len(digits) <= 15,
            ][kind]
            if keep:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


@pytest.fixture(scope="module")
def finder():
    return pii.Finder(pii.train(pii.made_windows(1500), epochs=6))


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(5)
    for letters in ("ab._@@-+12 ().é", "0123456789 -+.()", "a.b@c-", "25.5@x"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 45)))
            assert pii.base_spans(text) == brute(text), text
    assert pii.base_spans("x 4012888888881881 y +1 (385) 555-1563 z") == [(2, 2, 18), (21, 3, 38)]


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000) == [] and pii.base_spans("1" * 300_000) == []
    assert pii.base_spans("a" * 300_000 + "@b.c") == [(0, 0, 300_004)]


def test_gradients():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 5, (3, 7)), rng.integers(0, 3, (3, 7))
    tagger = Tagger({k: v.astype(float) for k, v in Tagger.fresh(5, 3, 4, 3).weights.items()})
    _, grads = tagger.gradients(x, y)
    for name, weight in tagger.weights.items():
        at = tuple(rng.integers(0, s) for s in weight.shape)
        old = weight[at]
        weight[at] = old + 1e-4
        up = tagger.gradients(x, y)[0]
        weight[at] = old - 1e-4
        down = tagger.gradients(x, y)[0]
        weight[at] = old
        assert abs((up - down) / 2e-4 - grads[name][at]) < 1e-2 * max(1, abs(grads[name][at])), name


def test_best_sequence_is_that_of_all():
    import itertools

    rng = np.random.default_rng(1)
    tagger = Tagger.fresh(4, 3)
    tagger.weights["move"], tagger.weights["first"] = rng.normal(size=(3, 3)), rng.normal(size=3)
    scores = rng.normal(size=(4, 5, 3))
    lengths = np.array([5, 3, 1, 4])
    found = tagger.best(scores, lengths)
    for row, n in enumerate(lengths):
        def worth(tags, row=row):
            total = tagger.weights["first"][tags[0]] + scores[row, 0, tags[0]]
            return total + sum(tagger.weights["move"][a, b] + scores[row, t + 1, b] for t, (a, b) in enumerate(itertools.pairwise(tags)))

        assert tuple(found[row, :n]) == max(itertools.product(range(3), repeat=int(n)), key=worth)


def test_only_parts_in_doubt_are_searched(finder):
    """Tags are those of a search over everything: on random scores and weights, and on those of the tagger."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        tagger = Tagger.fresh(4, 5)
        tagger.weights["move"], tagger.weights["first"] = rng.normal(size=(5, 5)).astype(np.float32), rng.normal(size=5).astype(np.float32)
        texts = [(rng.normal(size=(n, 5)) + [rng.uniform(0, 4), 0, 0, 0, 0]).astype(np.float32) for n in (1, 2, 9, 40)]
        for scores, tags in zip(texts, tagger.decoded(texts, 2), strict=True):
            assert tags.tolist() == tagger.best(scores[None], np.array([len(scores)]))[0].tolist()
    parts = [t for t, _ in pii.made_windows(300, seed=12) if t] + [" ".join(t for t, _ in pii.made_windows(40, seed=13))[:2048]]
    doubts = []
    for scores, tags in zip(pii.text_scores(finder.tagger, parts), pii.tagged(finder.tagger, parts), strict=True):
        assert tags.tolist() == finder.tagger.best(scores[None], np.array([len(scores)]))[0].tolist()
        doubts.append(finder.tagger.in_doubt(scores).mean())
    assert np.mean(doubts) < 0.9


def test_scores_are_those_of_the_trained_network(finder):
    rng = np.random.default_rng(3)
    x = rng.integers(0, pii.SYMBOL_COUNT, (7, 50)).astype(np.uint8)
    w = finder.tagger.weights
    both = np.concatenate([finder.tagger.run(x, way, False)[0] for way in "fb"], 2)
    assert np.abs(finder.tagger.emissions(x) - (both @ w["out"] + w["out0"]).transpose(1, 0, 2)).max() < 1e-3


def test_onnxruntime_and_numpy_read_the_same(finder, monkeypatch):
    rng = np.random.default_rng(5)
    lengths = np.array([0, 1, 3, 20, 60])
    x = rng.integers(0, pii.SYMBOL_COUNT, (5, 60)).astype(np.uint8)
    fast = finder.tagger.emissions(x, lengths)
    assert pickle.loads(pickle.dumps(finder.tagger)).emissions(x, lengths).tolist() == fast.tolist()
    monkeypatch.setattr(tagger, "onnxruntime", None)
    slow = finder.tagger.emissions(x, lengths)
    assert all(np.abs(fast[row, :n] - slow[row, :n]).max(initial=0) < 1e-3 for row, n in enumerate(lengths))


def test_texts_read_together_are_read_alone(finder):
    texts = ["call 385 555 1563", "", "x", " ".join(t for t, _ in pii.made_windows(30, seed=21)), "jane (at) example.com"]
    together = pii.text_scores(finder.tagger, texts)
    for text, scores in zip(texts, together, strict=True):
        [alone] = pii.text_scores(finder.tagger, [text])
        assert alone.shape == (len(text), pii.TAGS) and np.abs(alone - scores).max(initial=0) < 1e-3


def test_windows_read_little_twice():
    """All of a text is read, and of a long one less than an eighth again."""
    for length in [*range(1, 3000), 8192, 100_000]:
        read = np.zeros(length, int)
        for a, b in pii.stretches("x" * length):
            cuts = pii.windows(b - a)
            assert cuts[0][0] == 0 and cuts[-1][1] == b - a and max(d - c for c, d in cuts) <= pii.WINDOW
            assert all(left[1] - right[0] == pii.WINDOW - pii.STRIDE for left, right in zip(cuts, cuts[1:], strict=False))
            for c, d in cuts:
                read[a + c : a + d] += 1
        assert read.min() == 1 and (length < 2000 or read.sum() < 1.125 * length)


def test_texts_without_signs_are_not_searched_for_spelled_addresses():
    rng = random.Random(6)
    bits = ["at", " at ", "(at)", "[ AT ]", "@", "dot", " dot ", " DOT ", "(dot)", ".", "a", "b.c", " ", "example", "1"]
    hits = 0
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 9)))
        found = pii.LOOSE[0].search(text) is not None
        hits += found
        assert pii.maybe_spelled(text) or not found, text
    assert hits > 500 and not pii.maybe_spelled("we met at noon. (Then we left.)")


def test_first_evident_parts():
    plainly = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]", re.IGNORECASE)
    dense = "".join(random.Random(8).choices("aAtT([{)]} 1@x", k=20_000))
    assert [m.span() for m in pii.EVIDENCE.finditer(dense)] == [m.span() for m in plainly.finditer(dense)]
    rng = random.Random(7)
    text = "".join(rng.choice(["1", "@", "[at]"] + ["word " * 30] * 2) for _ in range(200))
    every = pii.evident(text, 10**9)
    assert len(every) > 5 and all(pii.evident(text, n) == every[:n] for n in (1, 2, 5))


def test_spans_of_tags():
    def plain(tags):
        found, start, kind = [], -1, -1
        for i, tag in enumerate([*tags, 0]):
            own = (tag - 1) // 2 if tag else -1
            if start >= 0 and (own != kind or tag % 2 == 1):
                found.append((start, kind, i))
                start = -1
            if own >= 0 and start < 0:
                start, kind = i, own
        return found

    rng = np.random.default_rng(4)
    for _ in range(500):
        tags = rng.choice([0, 0, 1, 2, 2, 3, 4, 4], rng.integers(1, 30)).astype(np.int8)
        assert pii.spans_of(tags) == plain(tags.tolist())


def test_held_out_accuracy(finder):
    right = made = wanted = 0
    held = pii.made_windows(400, seed=99)
    for tags, (text, spans) in zip(pii.tagged(finder.tagger, [t for t, _ in held]), held, strict=True):
        found = {s for s in pii.spans_of(tags) if pii.plausible(text, s)}
        right, made, wanted = right + len(found & set(spans)), made + len(found), wanted + len(spans)
    assert right / made > 0.9 and right / wanted > 0.85


def test_added_spans_touch_no_base_span(finder):
    texts = ["call (385) 555-1563 now, or +1 (385) 555-1563 then", "the year 2024 and version 2.0", "", "none"]
    bases, added = finder.find(texts)
    assert bases[0] == brute(texts[0])
    assert all(a[2] <= b[0] or a[0] >= b[2] for a in added[0] for b in bases[0])
    assert [texts[0][s:e] for s, _, e in added[0]] in ([], ["(385) 555-1563"])
    assert bases[1:] == [[], [], []] and added[1:] == [[], [], []]


def test_windows_agree_with_one_window(finder):
    text = "x " * 300 + "mail ab.cd@example.com or 10.20.30.40 " + "y " * 300
    [(a, b)] = pii.stretches(text)
    [tags] = pii.tagged(finder.tagger, [text[a:b]])
    found = {(k, text[a + s : a + e]) for s, k, e in pii.spans_of(tags)}
    assert {(0, "ab.cd@example.com"), (1, "10.20.30.40")} <= found


def test_whole_texts_are_read(finder):
    forms = ["jane at example dot com", "jane.doe＠example.org", "+１ (３８５) ５５５-１５６３", "+1 (٣٨٥) ٥٥٥-١٥٦٣"]
    for form in forms:
        for lead in (0, 900, 1000):
            text = "er on " * lead + "mail th " + form + " es of " + "in ed " * 40
            added = finder.find([text])[1][0]
            assert form in [text[s:e] for s, _, e in added], (form, lead)
    text = "word " * 3000
    pieces = pii.stretches(text)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text) and all(b[0] == a[1] - 2 * pii.MARGIN for a, b in zip(pieces, pieces[1:], strict=False))


def test_corpus_labels_know_other_forms():
    for form, kind in (("(385) 555-1563", 3), ("a.bc [at] example.com", 0), ("jane at example dot com", 0), ("10[.]20[.]30[.]40", 1)):
        text = f"er on {form} th"
        assert (text.index(form), kind, text.index(form) + len(form)) in pii.loose_spans(text), form
    assert pii.loose_spans("we met at noon in 2024, see v1.2 at home, look at example.com") == []


def test_rows(docs, finder):
    pairs = [(1, "é a@b.co 10.0.0.1"), (1, "é a@b.co 10.0.0.1"), (2, None), (3, ""), (None, "+1 385 555 1563")]
    found = {(r.doc_id, tuple((s.start, s.kind, s.end) for s in r.spans if s.base)) for r in pii.find(docs(*pairs), finder).collect()}
    assert found == {(1, ((2, "email", 8), (9, "ip", 17))), (2, ()), (3, ()), (None, ((0, "phone", 15),))}
    assert pii.find(docs(*pairs), finder).count() == 5 and pii.find(docs(), finder).count() == 0


def test_query(spark, sf_dir):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in queries.QUERIES["op3_pii"](spark, sf_dir).collect():
        base = brute(texts[row.doc_id] or "")
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert row.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(filter(None, line.split(","))) <= set(row.spans.split(","))
