import __spark_entry__ as entry
import corpus_pipeline
from fleetwatt.llm import common, decontamination, ngram_join, quality, queries, secrets
from tests.llm.test_decontamination import brute as brute_items
from tests.llm.test_ngram_join import grams

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    names, steps = zip(*corpus_pipeline.STAGES, strict=True)
    assert names == ("quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing")
    state = [common.stored(documents, "t")]
    for step in steps:
        state.append(common.stored(step(spark, state[-1], SF), "t"))
    assert all(s.columns == documents.columns for s in state[:-1])
    rows = [{r.doc_id: r for r in s.collect()} for s in state[:-1]]
    # 1: just the documents that score below the mark are gone, and clean ones stay.
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(documents, labels.where(~common.held_out(labels.doc_id, 4, 2)))
    scores = {r.doc_id: r.score for r in quality.score(documents, model).collect()}
    assert set(rows[1]) == {d for d, s in scores.items() if s >= quality.ACCEPT}
    good = [r.doc_id for r in labels.collect() if r.quality == 1]
    assert sum(d in rows[1] for d in good) / len(good) > 0.95
    # 2: of what is near each other the smallest id stays.
    sets = {d: grams(r.text) for d, r in rows[1].items()}
    group = {d: d for d in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    shared = {}
    for d, s in sets.items():
        for g in s:
            shared.setdefault(g, []).append(d)
    pairs = {(a, b) for own in shared.values() if 1 < len(own) < 60 for a in own for b in own if a < b}
    for a, b in pairs:
        if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            group[max(root(a), root(b))] = min(root(a), root(b))
    assert set(rows[2]) == {d for d in sets if root(d) == d}
    # 3: just the documents with a passage of the benchmark are gone.
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, _, n, _ in brute_items([(d, r.text) for d, r in rows[2].items()], items) if n}
    assert hit and set(rows[3]) == set(rows[2]) - hit
    # 4: all stay, without their secrets.
    detector = secrets.train()
    assert set(rows[4]) == set(rows[3])
    for d, r in rows[4].items():
        text = rows[3][d].text
        [spans] = detector.scan([text], [""])
        for start, end, _, p in reversed(spans):
            text = text[:start] + secrets.REPLACEMENT + text[end:] if p >= detector.accept else text
        assert r.text == text and r.n_chars == len(text)
    # 5: all are packed.
    pieces = state[-1].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {p.doc_id for p in pieces} == set(rows[4]) and all(p["sum(length)"] == p["max(doc_tokens)"] for p in pieces)


def test_pipeline_is_registered(spark, sf_dir):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries())


def test_null_rows_pass_the_filters(docs, spark):
    pairs = [(1, None), (None, None), (None, "some words of a clean text"), (2, "")]
    table = docs(*pairs)
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    for kept in (ngram_join.one_of_each(table), decontamination.clean(table, items), secrets.redact(table, secrets.train())):
        assert sorted(map(str, [(r.doc_id, r.text) for r in kept.collect()])) == sorted(map(str, pairs))
