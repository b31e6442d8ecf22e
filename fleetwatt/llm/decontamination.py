"""Benchmark passages in documents, found by winnowing; DataFrame functions only.

A shared span of ``WINDOW`` words holds WINDOW - K + 1 hashed K-grams. Winnowing
keeps the smallest of them on both sides, so every such span has a fingerprint
in common. Fingerprints that meet name candidate windows around them, and these
are compared in full. Items shorter than a window are one window of their own
length, whose hash is compared at every place of a document.

The stored item tables tell the planner their size: small ones are broadcast,
large ones are joined by shuffles, where a frequent passage is split as skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import fresh, stored, table

WINDOW = 10
K = 5
AT = "array<struct<start:int,n:int>>"
GUARANTEE = WINDOW - K + 1  # K-grams of a window
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower case
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A fingerprint is one number: hash above, place modulo 2^PLACE_BITS below.
PLACE_BITS = 20
PLACE_MASK = (1 << PLACE_BITS) - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_words(text: Column) -> Column:
    """Words of a text as they stand."""
    return F.array_remove(F.split(text, BETWEEN), "")


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; none if it is NULL."""
    text = F.coalesce(text, F.lit(""))
    # Plain ASCII has a faster way to lower case with the same result.
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return split_words(low)


def places(count: Column) -> Column:
    """0 .. count - 1, empty if there is nothing to count."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once; inside lambdas it is then a variable at hand."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprints(texts: DataFrame, *keys: str) -> DataFrame:
    """keys, place, print of the winnowed K-grams of ``w``, an array of words.

    Of any GUARANTEE neighbouring K-grams the one with the smallest hash stays.
    ``place`` is modulo 2^PLACE_BITS.
    """

    def grams(h: Column) -> Column:
        return F.transform(
            places(F.size(h) - (K - 1)),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(K)]).bitwiseAND(F.lit(~PLACE_MASK)).bitwiseOR(
                i.bitwiseAND(F.lit(PLACE_MASK)).cast("long")
            ),
        )

    def least(g: Column) -> Column:
        return F.transform(places(F.size(g) - (GUARANTEE - 1)), lambda i: F.least(*[F.get(g, i + j) for j in range(GUARANTEE)]))

    def changes(m: Column) -> Column:
        # A number stays the smallest for a run of windows.
        return F.filter(m, lambda x, i: ~x.eqNullSafe(F.get(m, i - 1)))

    kept = bound(F.transform("w", lambda x: F.xxhash64(x)), lambda h: bound(grams(h), lambda g: bound(least(g), changes)))
    one = texts.select(*keys, F.explode(kept).alias("_x"))
    return one.select(
        *keys,
        F.col("_x").bitwiseAND(F.lit(PLACE_MASK)).cast("int").alias("place"),
        F.shiftright("_x", PLACE_BITS).alias("print"),
    )


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, n, words of each window of ``items(item_id, text)``; items without id or words have none."""
    cut = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(
        F.col("item_id").isNotNull() & (F.size("w") > 0)
    )
    n = F.least(F.size("w"), F.lit(WINDOW))
    every = F.transform(places(F.size("w") - n + 1), lambda i: F.slice(F.col("w"), i + 1, F.least(F.size("w"), F.lit(WINDOW))))
    return cut.select("item_id", n.alias("n"), F.explode(every).alias("words")).distinct()


KEY = ["_i", "_r"]


def keys() -> list[Column]:
    """Two numbers that tell rows apart: the id (0 if NULL), and a hash of id and text."""
    doc_id = F.col("doc_id").cast("long")
    return [F.coalesce(doc_id, F.lit(0)).alias("_i"), F.xxhash64(doc_id, F.col("text").cast("string")).alias("_r")]


def contamination(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: doc_id, n_words, hits, item_ids.

    ``hits`` are structs of start and length (in words) of the item windows that
    occur, ``item_ids`` the ids (text, sorted) of their items. Both are empty for
    clean, empty and NULL texts, or without items. Repeated rows give equal rows,
    rows that share an id but not a text are judged apart, NULL ids are kept.
    """
    counted = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *keys(),
        F.size(split_words(F.coalesce(F.col("text").cast("string"), F.lit("")))).cast("long").alias("n_words"),
    )
    return counted.join(hits_by_key(documents, items), KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("hits", F.array().cast(AT)).alias("hits"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def clean(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``documents``, with all their columns, in which no item window occurs."""
    names = [fresh(documents, "_hit_i"), fresh(documents, "_hit_r")]
    hit = stored(hits_by_key(documents, items).select(*[F.col(k).alias(n) for k, n in zip(KEY, names, strict=True)]), "hit-keys")
    doc_id, text_hash = keys()
    return documents.join(hit, (doc_id == F.col(names[0])) & (text_hash == F.col(names[1])), "left_anti")


def hits_by_key(documents: DataFrame, items: DataFrame) -> DataFrame:
    """KEY, hits, item_ids of the rows with hits."""
    keyed = documents.select(*keys(), F.col("text").cast("string").alias("text"))
    key = KEY
    windows = stored(item_windows(items), "item-windows")
    whole = windows.where(F.col("n") == WINDOW)
    item_prints = fingerprints(whole.select(F.col("words").alias("w"))).select("print").distinct()
    item_prints = stored(item_prints, "item-prints")
    worded = keyed.select(*key, words(F.col("text")).alias("w"))
    found = fingerprints(worded, *key).join(item_prints, "print").groupBy(*key).agg(F.collect_set("place").alias("places"))
    candidates = found.select(*key, "places", F.array().cast(AT).alias("short"))
    for row in windows.where(F.col("n") < WINDOW).select("n").distinct().collect():  # at most WINDOW - 1 lengths
        candidates = candidates.unionByName(short_candidates(worded, windows.where(F.col("n") == row.n), row.n, key))
    candidates = candidates.groupBy(*key).agg(
        F.flatten(F.collect_list("places")).alias("places"), F.flatten(F.collect_list("short")).alias("short")
    )
    # Stored, so that the planner knows how few keys there may be before it would shuffle all texts.
    candidates = stored(candidates, "candidates")
    named = stored(candidates.select(*key), "candidate-keys")
    chosen = keyed.join(named, key, "left_semi")
    cut = chosen.join(candidates, key).select(*key, words(F.col("text")).alias("w"), "places", "short")
    # Places repeat every 2^PLACE_BITS words.
    true_places = F.flatten(F.transform("places", lambda p: F.sequence(p, F.greatest(p, F.size("w") - 1), F.lit(PLACE_MASK + 1))))
    starts = F.array_distinct(
        F.flatten(F.transform(true_places, lambda p: F.sequence(F.greatest(p - (GUARANTEE - 1), F.lit(0)), p)))
    )
    every = F.concat(F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(WINDOW).alias("n"))), F.col("short"))
    compared = cut.select(*key, "w", every.alias("at")).select(
        *key,
        F.inline(
            F.filter(
                F.transform(
                    "at", lambda c: F.struct(c["start"].alias("start"), c["n"].alias("n"), F.slice(F.col("w"), c["start"] + 1, c["n"]).alias("words"))
                ),
                lambda c: F.size(c["words"]) == c["n"],
            )
        ),
    )
    return (
        compared.join(windows, ["n", "words"])
        .groupBy(*key)
        .agg(F.collect_set(F.struct("start", "n")).alias("hits"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )


def short_candidates(worded: DataFrame, windows: DataFrame, n: int, key: list[str]) -> DataFrame:
    """Places where the hash of ``n`` words is that of an item of ``n`` words."""
    wanted = windows.select(F.xxhash64("words").alias("print")).distinct()
    every = worded.select(
        *key,
        F.posexplode(F.transform(places(F.size("w") - (n - 1)), lambda i: F.xxhash64(F.slice(F.col("w"), i + 1, n)))).alias("start", "print"),
    )
    found = every.join(wanted, "print").groupBy(*key).agg(F.collect_set(F.struct("start", F.lit(n).alias("n"))).alias("short"))
    return found.select(*key, F.array().cast("array<int>").alias("places"), F.col("short").cast(AT).alias("short"))


def covered(hits: Column) -> Column:
    """Number of words under any of the spans."""
    end = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        F.array_sort(hits),
        end,
        lambda a, x: F.struct(
            F.greatest(a["end"], x["start"] + x["n"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(a["end"], x["start"]))).alias("n"),
        ),
        lambda a: a["n"].cast("long"),
    )


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = covered(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
       FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0 AND item_id IS NOT NULL),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT * FROM d, (SELECT DISTINCT n FROM bw)), unnest(range(1, len(w) - n + 2)) AS t(i)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (k, n)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM h, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
