import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetwatt.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")


def checked(pieces, pairs, tokenizer, capacity):
    """All ids lie in one piece each, sequences have no gaps, padding is due nowhere but where it must."""
    expected = sorted(ids_of(tokenizer, t).tobytes() for _, t in pairs)
    by_row, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        by_row[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    found = []
    for doc, parts in by_row.items():
        texts = [t for d, t in pairs if d == doc]
        if len(texts) == 1:
            at, whole = 0, b""
            for p in sorted(parts, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids_of(tokenizer, texts[0]))
                at += p.length
                whole += bytes(p.ids)
            found.append(whole)
        else:
            assert sum(p.length for p in parts) == sum(len(ids_of(tokenizer, t)) for t in texts)
            found += [ids_of(tokenizer, t).tobytes() for t in texts]
    assert sorted(found) == expected


@pytest.mark.parametrize("capacity", [64, 4096])
def test_round_trip(docs, tokenizer, capacity, monkeypatch):
    monkeypatch.setattr(packing, "POOL", 64)
    rng = random.Random(1)
    vocabulary = ["the", "Größe", "don't", "x2", "!!!", "漢字", "and", " ", "ﬁ"]
    pairs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 20, 90])))) for i in range(250)]
    pairs += [(900, None), (901, ""), (902, "the " * 9000), (None, "no id"), (None, "nor this"), pairs[5], (5, "shares an id")]
    checked(packing.pack(docs(*pairs, parts=3), PATH, capacity).collect(), pairs, tokenizer, capacity)


def test_empty_table(docs):
    assert packing.pack(docs(), PATH).count() == 0


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(2)
    letters = [chr(i) for i in [*range(0x20, 0x250), 0x0B, 0x85, 0xA0, 0x1C, 0x2028, 0x301, 0x3A3, 0x130, 0x4E2D, 0x1F600]]
    letters += ["'s", "'LL", " ", "\n", "don't", "<|endoftext|>"] * 20
    latin = [chr(i) for i in range(0x20, 0x100)] + ["'s", "'RE", " "] * 20
    texts = ["".join(rng.choices(rng.choice([letters, latin]), k=rng.randint(0, 30))) for _ in range(6000)]
    found = packing.Encoder(PATH).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_closest_sum_is_the_best():
    rng = random.Random(3)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 5))}
        room = rng.randint(0, 60)
        sums = {0}
        for length, times in counts.items():
            sums = {s + k * length for s in sums for k in range(times + 1)}
        chosen, total = packing.closest(sorted(counts, reverse=True), counts, room)
        assert total == max(s for s in sums if s <= room) == sum(n * k for n, k in chosen.items())
        assert all(k <= counts[n] for n, k in chosen.items())


def test_query(spark, sf_dir, tokenizer):
    from fleetwatt.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for p in QUERIES["op4_packing"](spark, sf_dir).collect():
        ids = ids_of(tokenizer, texts[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
