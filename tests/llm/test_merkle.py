import hashlib
import zlib

import pytest

from fleetwatt.llm import merkle
from fleetwatt.llm.merkle import op11_merkle_manifest
from fleetwatt.llm.queries import ORACLES, QUERIES
from tests.test_queries import result

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, tree string, idx int, leaf string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    n_chars = None if row[4] is None else row[4] + more
    return h("".join(enc(v) for v in (row[0], row[3], row[2], n_chars, row[1])))


def climb(leaves):
    """Root and, per leaf, the siblings by level with their side."""
    paths = [[] for _ in leaves]
    at = list(range(len(leaves)))
    level = leaves
    while len(level) > 1:
        for i, a in enumerate(at):
            b = a ^ 1
            paths[i].append((b < a, level[b]) if b < len(level) else None)
        at = [a // 2 for a in at]
        level = [h("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
    return level[0], paths


def brute(rows):
    """All columns by the definition, one tree after the other."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = (own, *climb([leaf_of(r) for r in own]))
    root, upper = climb([trees[lang][1] for lang in langs])
    found = []
    for at, lang in enumerate(langs):
        own, subroot, paths = trees[lang]
        for row, path in zip(own, paths, strict=True):
            path = [*path, *upper[at]]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf_of(row, 1 if tampered else 0)
            for step in path:
                node = h(node) if step is None else h(step[1] + node) if step[0] else h(node + step[1])
            found.append((row[0], leaf_of(row), subroot, root, h("".join(s[1] for s in path if s)), node, node == root))
    return found


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "p", "t", 1, "l") for r in rows], SCHEMA).repartition(3)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    made = op11_merkle_manifest(spark, str(tmp_path))
    assert made.columns == NAMES
    assert result(NAMES, [tuple(r) for r in made.collect()]) == result(NAMES, brute(rows))


def test_nulls_ties_and_repeats(spark, tmp_path):
    rows = [(i, f"text {i} ü", ["en", "fr", None, "", "=", "ü", "de"][i % 7], "s", i) for i in range(60)]
    rows += [(5, "text 5 ü", "ü", "s", 5)] * 3 + [(5, "other", "ü", None, None)]
    rows += [(None, None, None, None, None)] * 2 + [(None, "x", "lone", "s", 1), (14, "", "fr", "s", None), (21, None, "fr", "s", (1 << 63) - 1)]
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("n", [1, 2, 3, 37])
def test_blocks_of_four(spark, tmp_path, monkeypatch, n):
    """Several rounds, with short last blocks and one tree far larger than the others."""
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rows = [(i, f"t{i}", "en" if i % 12 else f"l{i}", "s", i) for i in range(1, n + 1)]
    check(spark, tmp_path, rows)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_merkle_manifest(spark, str(tmp_path)).collect() == []


def test_versions_share_untouched_nodes():
    leaves = [h(str(i)) for i in range(11)]
    tree = merkle.Tree(leaves, merkle.levels_of(11))
    before = [list(level) for level in tree.levels]
    path = tree.version(6, h("other"))
    assert tree.levels == before and len(path) == len(tree.levels)
    other = merkle.Tree([*leaves[:6], h("other"), *leaves[7:]], merkle.levels_of(11))
    for level, nodes in enumerate(other.levels):
        assert nodes[6 >> level] == path[level]
        assert all(a == b for i, (a, b) in enumerate(zip(nodes, tree.levels[level], strict=True)) if i != 6 >> level)
    assert merkle.unpacked(merkle.packed(tree.siblings(10))) == tree.siblings(10)


def test_query_against_sql_and_brute_force(spark, sf_dir):
    import duckdb

    frame = QUERIES["op11_merkle_manifest"](spark, sf_dir)
    found = result(frame.columns, [tuple(r) for r in frame.collect()])
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert found == result(NAMES, brute([tuple(r) for r in rows]))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    cursor = connection.execute(ORACLES["op11_merkle_manifest"])
    assert found == result([c[0] for c in cursor.description], cursor.fetchall())
