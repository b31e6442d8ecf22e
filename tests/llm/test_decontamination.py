import hashlib
import random
import re

from fleetwatt.llm import queries
from fleetwatt.llm.decontamination import clean, contamination, covered
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(documents, items):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(10, len(w))
        for i in range(len(w) - n + 1):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    found = []
    for doc, text in documents:
        w, hit, ids = words(text), set(), set()
        for n in range(1, 11):
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit |= set(range(i, i + n))
                    ids |= own
        found.append((doc, len(w), len(hit), ",".join(sorted(ids))))
    return sorted(found, key=str)


def result(found):
    made = found.select("doc_id", "n_words", covered(F.col("hits")), F.array_join("item_ids", ","))
    return sorted((tuple(r) for r in made.collect()), key=str)


def test_against_brute_force(spark, docs):
    rng = random.Random(1)
    letters = "ab cé DÉ x1"
    vocabulary = ["a", "b", "É", "é", "C3", "d-e", "漢"]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 9, 10, 11, 14, 30]))) for i in range(12)] + [(40, None), (41, "..."), (None, "a b c"), (3, text(12))]
    pairs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(100, None), (101, ""), (102, letters), (None, items[6][1])]
    pairs += [(200 + i, text(5) + " " + (items[i][1] or "") + " " + text(5)) for i in range(12)]
    pairs += [pairs[70], (pairs[70][0], "other text"), (300, " ".join([items[7][1]] * 400))]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs(*pairs), table)
    assert result(found) == brute(pairs, items)
    kept = clean(docs(*pairs), table)
    assert kept.columns == docs(*pairs).columns
    expected = [(d, t) for (d, t), row in ((p, brute([p], items)[0]) for p in pairs) if row[2] == 0]
    assert sorted(map(str, [(r.doc_id, r.text) for r in kept.collect()])) == sorted(map(str, expected))


def test_places_of_very_long_texts(spark, docs, monkeypatch):
    # Places wrap around early, as they do at 2^20 words.
    from fleetwatt.llm import decontamination

    monkeypatch.setattr(decontamination, "PLACE_BITS", 4)
    monkeypatch.setattr(decontamination, "PLACE_MASK", 15)
    rng = random.Random(2)
    item = " ".join(f"w{i}" for i in range(12))
    pairs = [(i, " ".join(f"v{rng.randint(0, 9)}" for _ in range(rng.randint(0, 200))) + " " + item) for i in range(9)]
    found = contamination(docs(*pairs), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert result(found) == brute(pairs, [(1, item)])


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert result(contamination(docs((1, "a b c")), items)) == [(1, 3, 0, "")]
    assert contamination(docs(), items).count() == 0


def test_query_equals_sql(spark, sf_dir):
    import duckdb

    for name in ("documents", "benchmark"):
        duckdb.sql(f"create or replace view {name} as select * from '{sf_dir}/{name}.parquet'")
    wanted = duckdb.sql(queries.ORACLES["op1_decontamination"])
    made = queries.QUERIES["op1_decontamination"](spark, sf_dir)
    assert made.columns == wanted.columns
    assert sorted(tuple(r) for r in made.collect()) == sorted(wanted.fetchall())
    assert made.where("contaminated").count() and made.where("items_sha256 = '" + hashlib.sha256(b"").hexdigest() + "'").count()


def test_main_path_has_no_python(spark, sf_dir):
    from tests.conftest import plan

    text = plan(queries.QUERIES["op1_decontamination"](spark, sf_dir))
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", text)
