"""Manifest of a dataset: a hash tree per group of rows, a tree over the groups, and a proof of each row.

Trees are cut into aligned blocks of BLOCK leaves. A block is small enough for
one task, its root is a leaf of the round above, so a tree of any size takes a
few rounds, and each round is BLOCK times smaller.

A tree is persistent: a changed leaf makes a version that copies the ancestors
of this leaf and shares every other node with the tree as it was. In its block
the version is made beside the base nodes; above, it goes on through the
siblings that the rounds above have sent down, once per block, so versions are
never gathered in the upper blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import stored, table
from fleetwatt.llm.numbering import numbered

HEIGHT = 10
BLOCK = 1 << HEIGHT
# Sides of a sibling in a path: a node alone in its run has none.
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"


def hash_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(size: int) -> int:
    """Levels above ``size`` leaves until one node is left."""
    return max(size - 1, 0).bit_length()


class Tree:
    """The base nodes of a block, level by level, and versions that share them."""

    def __init__(self, leaves: list[str], height: int) -> None:
        self.levels = [leaves]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([hash_of("".join(below[at : at + 2])) for at in range(0, len(below), 2)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[bytes, str]]:
        """Side and digest of the sibling at each level below the root."""
        found = []
        for level in self.levels[:-1]:
            beside = at ^ 1
            if beside < len(level):
                found.append((LEFT if beside < at else RIGHT, level[beside]))
            else:
                found.append((ALONE, ""))
            at >>= 1
        return found

    def version(self, at: int, leaf: str) -> list[str]:
        """The nodes that the version with another leaf at ``at`` copies, leaf to root; all others are the base's."""
        return copied(leaf, self.siblings(at))


def copied(node: str, siblings: Sequence[tuple[bytes, str]]) -> list[str]:
    """A node and its ancestors, made anew from untouched siblings."""
    path = [node]
    for side, beside in siblings:
        node = hash_of(beside + node if side == LEFT else node + beside)
        path.append(node)
    return path


def packed(siblings: Sequence[tuple[bytes, str]]) -> bytes:
    return b"".join(side + bytes.fromhex(beside) for side, beside in siblings)


def unpacked(path: bytes) -> list[tuple[bytes, str]]:
    found, at = [], 0
    while at < len(path):
        side = path[at : at + 1]
        end = at + 1 + (0 if side == ALONE else 32)
        found.append((side, path[at + 1 : end].hex()))
        at = end
    return found


def block_column() -> Column:
    return F.shiftright("idx", HEIGHT).alias("block")


def block_roots(nodes: DataFrame) -> DataFrame:
    """The round above ``nodes(tree, idx, size, digest)``: one node per block."""

    def root(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        size = rows.column("size")[0].as_py()
        top = Tree([d.hex() for d in rows.column("digest").to_pylist()], min(HEIGHT, levels_of(size))).root
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()], pa.string()),
                "idx": pa.array([key[1].as_py()], pa.int64()),
                "size": pa.array([-(-size // BLOCK)], pa.int64()),
                "digest": pa.array([bytes.fromhex(top)], pa.binary()),
            }
        )

    return nodes.select("tree", block_column(), "idx", "size", "digest").groupBy("tree", "block").applyInArrow(root, "tree string, idx long, size long, digest binary")


def rounds_above(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and all rounds above; the last has one node per tree, its root."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("size")).first()[0] or 0) > 1:
        rounds.append(stored(block_roots(rounds[-1]), "nodes"))
    return rounds


def paths_below(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The path of each node of the lowest of ``rounds`` as (tree, block, path), from that of the roots in ``above``."""

    def down(key: tuple, rows: pa.Table, upper: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        size = rows.column("size")[0].as_py()
        tree = Tree([d.hex() for d in rows.column("digest").to_pylist()], min(HEIGHT, levels_of(size)))
        rest = upper.column("path")[0].as_py()
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()] * rows.num_rows, pa.string()),
                "block": rows.column("idx"),
                "path": pa.array([packed(tree.siblings(at)) + rest for at in range(rows.num_rows)], pa.binary()),
            }
        )

    for nodes in reversed(rounds):
        grouped = nodes.select("tree", block_column(), "idx", "size", "digest").groupBy("tree", "block")
        above = grouped.cogroup(above.groupBy("tree", "block")).applyInArrow(down, "tree string, block long, path binary")
        above = stored(above, "paths")
    return above


@dataclass
class Manifest:
    """``rows(key, tree, idx, leaf, path, folded)``, ``subroots(tree, subroot)`` and ``root`` (NULL if there are no rows).

    ``path`` has the siblings of a row from leaf to root, each as a byte for its
    side (0 none, 1 left, 2 right) and 32 bytes. ``proof`` is the hash of these
    siblings as hex text, ``folded`` the root of the version with the changed
    leaf, or what the row's own leaf folds to where it is not changed.
    """

    rows: DataFrame
    subroots: DataFrame
    root: str | None


def manifest(leaves: DataFrame) -> Manifest:
    """Trees over ``leaves(tree, key, leaf, changed)``, in the order of ``key`` within each tree.

    Digests are binary; ``changed`` is the digest of the tampered row or NULL.
    Trees are ordered by their name, bytewise. Rows with equal keys are ordered
    by their digest. ``tree`` holds no NULL; keys may, and come first.
    """
    leaves = stored(leaves, "leaves")
    base = stored(numbered(leaves, "tree", ["key", "leaf"]), "leaves")
    rounds = rounds_above(base.select("tree", "idx", "size", F.col("leaf").alias("digest")))
    subroots = rounds[-1].select("tree", "digest")
    tops = stored(numbered(subroots.select(F.lit("").alias("all"), "tree", "digest"), "all", ["tree"]), "subroots")
    upper = rounds_above(tops.select(F.col("all").alias("tree"), "idx", "size", "digest"))
    top = upper[-1].first()
    root = bytes(top.digest).hex() if top else None
    nothing = upper[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit(b"").alias("path"))
    over = paths_below(upper, nothing)
    named = tops.select("tree", F.col("idx").alias("at")).join(over.select(F.col("block").alias("at"), "path"), "at")
    above = paths_below(rounds[1:], named.select("tree", F.lit(0).cast("long").alias("block"), "path"))

    def prove(key: tuple, rows: pa.Table, upper_path: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        size = rows.column("size")[0].as_py()
        own = [d.hex() for d in rows.column("leaf").to_pylist()]
        tree = Tree(own, min(HEIGHT, levels_of(size)))
        rest = upper_path.column("path")[0].as_py()
        beyond = unpacked(rest)
        tail = "".join(beside for _, beside in beyond)
        paths, proofs, folded = [], [], []
        for at, changed in enumerate(rows.column("changed").to_pylist()):
            siblings = tree.siblings(at)
            paths.append(packed(siblings) + rest)
            proofs.append(hash_of("".join(beside for _, beside in siblings) + tail))
            block_root = tree.version(at, changed.hex() if changed is not None else own[at])[-1]
            folded.append(copied(block_root, beyond)[-1])
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()] * len(own), pa.string()),
                "idx": rows.column("idx"),
                "key": rows.column("key"),
                "leaf": pa.array(own, pa.string()),
                "path": pa.array(paths, pa.binary()),
                "proof": pa.array(proofs, pa.string()),
                "folded": pa.array(folded, pa.string()),
            }
        )

    grouped = base.select("tree", block_column(), "idx", "size", "key", "leaf", "changed").groupBy("tree", "block")
    kind = base.schema["key"].dataType.simpleString()
    proved = grouped.cogroup(above.groupBy("tree", "block")).applyInArrow(
        prove, f"tree string, idx long, key {kind}, leaf string, path binary, proof string, folded string"
    )
    return Manifest(proved, tops.select("tree", F.lower(F.hex("digest")).alias("subroot")), root)


def field(column: Column) -> Column:
    """A value as the leaves hash it: ``-`` for NULL, else its length in bytes, a colon and the value."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*columns: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(c) for c in columns)), 256))


def tree_name(group: Column) -> Column:
    """A name without NULL that keeps the order of the groups, NULL first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Proofs of all documents, with one in seven of them tampered with.

    NULL columns hash as ``-``; rows without ``lang`` are a tree of their own and
    rows without ``doc_id`` come first in theirs and are not tampered with; a NULL
    ``n_chars`` stays, so such a row verifies. Rows that share an id are ordered by
    their digest. An empty table gives no rows. Extra columns are left out.
    """
    documents = table(spark, sf_dir, "documents")
    doc_id, n_chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    before, text = (doc_id, F.col("source"), F.col("lang")), F.col("text")
    hit = doc_id.isNotNull() & (F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0)
    leaves = documents.select(
        tree_name(F.col("lang")).alias("tree"),
        doc_id.alias("key"),
        row_digest(*before, n_chars, text).alias("leaf"),
        F.when(hit, row_digest(*before, n_chars.cast("decimal(20,0)") + 1, text)).alias("changed"),
    )
    made = manifest(leaves)
    return made.rows.join(made.subroots, "tree").select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(made.root)).alias("verified"),
    )


# Byte-wise crc32; levels and folds are recursive. Digests are hex text throughout.
OP11_SQL = """
WITH RECURSIVE
rows_of AS (
  SELECT row_number() OVER () AS r, doc_id, lang,
    (CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END)
    || (CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END)
    || (CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END) AS head,
    CAST(n_chars AS HUGEINT) AS n,
    (CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS tail,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 7 = 0 AS hit
  FROM documents),
leaves AS (
  SELECT r, doc_id, lang, sha256(head || coalesce(strlen(CAST(n AS VARCHAR)) || ':' || n, '-') || tail) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(strlen(CAST(n + 1 AS VARCHAR)) || ':' || (n + 1), '-') || tail) END AS changed
  FROM rows_of),
placed AS (
  SELECT *, coalesce('=' || lang, '') AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, pos, size, leaf AS node FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM nodes WHERE size > 1 GROUP BY tree, level, pos // 2, (size + 1) // 2),
subroots AS (
  SELECT tree, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1),
upper_nodes AS (
  SELECT 0 AS level, pos, size, node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM upper_nodes WHERE size > 1 GROUP BY level, pos // 2, (size + 1) // 2),
steps AS (
  SELECT p.r, n.level AS step, n.pos % 2 AS odd, s.node AS beside
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.size > 1 AND n.pos = p.pos >> n.level
  LEFT JOIN nodes s ON s.tree = n.tree AND s.level = n.level AND s.pos = xor(n.pos, 1)
  UNION ALL
  SELECT p.r, 100 + n.level, n.pos % 2, s.node
  FROM placed p JOIN subroots t ON t.tree = p.tree JOIN upper_nodes n ON n.size > 1 AND n.pos = t.pos >> n.level
  LEFT JOIN upper_nodes s ON s.level = n.level AND s.pos = xor(n.pos, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY step) AS number FROM steps),
folds AS (
  SELECT r, 0 AS number, coalesce(changed, leaf) AS node FROM placed
  UNION ALL
  SELECT f.r, f.number + 1, sha256(CASE WHEN s.beside IS NULL THEN f.node WHEN s.odd = 1 THEN s.beside || f.node ELSE f.node || s.beside END)
  FROM folds f JOIN numbered s ON s.r = f.r AND s.number = f.number + 1),
proofs AS (SELECT r, string_agg(beside, '' ORDER BY number) AS all_beside FROM numbered GROUP BY r),
folded AS (SELECT r, arg_max(node, number) AS node FROM folds GROUP BY r),
top AS (SELECT node AS root FROM upper_nodes WHERE size = 1)
SELECT p.doc_id, p.leaf, t.node AS subroot, top.root, sha256(coalesce(q.all_beside, '')) AS proof_sha256,
  f.node AS folded_root, f.node = top.root AS verified
FROM placed p JOIN subroots t ON t.tree = p.tree JOIN folded f ON f.r = p.r CROSS JOIN top LEFT JOIN proofs q ON q.r = p.r
"""
