"""Merkle manifest of a dataset with cogrouped subtree exchange (op 13).

Every row is a leaf, the hash of its fields.  The leaves of a partition
(``lang``), ordered, make a tree of ``FANOUT`` children a node, whose root is
the partition's; these roots, ordered, make the tree of the manifest's root.

1. *Leaves* are digests by Spark's own functions; texts are read once and go
   nowhere else.
2. *Places.*  Leaves are numbered within their partition by sorted ranges
   (``numbering``), so a partition of any size is spread over all tasks.
3. *Up.*  A superblock is ``FANOUT ** depth`` neighbouring nodes.  Each is
   reduced to its top; tops are the nodes of the next round, until a partition
   has one, and in the same way until the manifest has one.  A round's table
   is 1 / 512 of the one before.
4. *Down.*  The outer nodes that a superblock needs are the siblings along the
   way from its top to the root.  Each round's nodes are cogrouped by
   superblock with the outer nodes that the round above has found, and give
   those of the round below.  In the last cogroup, of the leaves, one function
   reduces the superblock, joins each leaf's siblings with the outer ones and
   folds leaf and proof to a root.

A fold starts from the leaf, or from the leaf of the tampered row where there
is one, and uses the siblings of the untampered tree: ``verified`` says whether
it gives the root.

Cases: a null field is ``-`` (an empty one ``0:``), so they differ; rows
without a partition value are one partition, the first; rows without doc_id
come first in theirs and are never tampered with; rows of equal doc_id are
ordered by leaf, and equal rows are leaves each; a lone leaf is its partition's
root, and the only partition's root is the manifest's; very long texts are
hashed where they are read; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.llm.numbering import numbered
from propensa.session import written

FANOUT, DEPTH = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A node on its way: siblings left and right of it, one string a level.
PATH = "lefts array<string>, rights array<string>"


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(fields: Sequence[Column]) -> Column:
    """Hash of the fields: each its UTF-8 byte count, a colon and itself."""
    def framed(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def levels_of(nodes: list[str], n: int, depth: int) -> list[list[str]]:
    """The levels of a superblock, its nodes first, of a tree of ``n`` nodes.
    One that is all its tree has ends at one node, others after ``depth``
    levels more."""
    levels, alone = [nodes], n <= FANOUT ** depth
    while len(levels[-1]) > 1 if alone else len(levels) <= depth:
        last = levels[-1]
        levels.append([digest(last[i:i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return levels


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """The digests left and right of node ``at`` and of its ancestors, in
    their runs."""
    lefts, rights = [], []
    for level in levels[:-1]:
        first = at - at % FANOUT
        lefts.append("".join(level[first:at]))
        rights.append("".join(level[at + 1:first + FANOUT]))
        at //= FANOUT
    return lefts, rights


def fold(node: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    for left, right in zip(lefts, rights):
        node = digest((left, node, right))
    return node


def _tops(nodes: DataFrame, depth: int) -> DataFrame:
    """tree, at, n, node of the superblocks of ``nodes``, as a written table."""
    size = FANOUT ** depth

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        at, n = int(rows["at"].iloc[0]), int(rows["n"].iloc[0])
        top = levels_of(rows["node"].tolist(), n, depth)[-1][0]
        return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "at": [at // size], "n": [-(-n // size)], "node": [top]})

    blocks = nodes.select("tree", "at", "n", "node").groupBy("tree", _block(depth))
    return written(blocks.applyInPandas(reduce, "tree string, at bigint, n bigint, node string"), "tops")


def _block(depth: int) -> Column:
    return F.floor(F.col("at") / FANOUT ** depth).cast("bigint").alias("block")


def _rounds(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """``nodes`` and the tops of each round, the last with one node a tree."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 1) > 1:
        rounds.append(_tops(rounds[-1], depth))
    return rounds


def _down(rounds: list[DataFrame], outer: DataFrame, depth: int) -> DataFrame:
    """Outer nodes (tree, at, path, subroot, root) of the nodes of the first of
    ``rounds``, from those of the trees' roots."""
    def extend(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        levels = levels_of(rows["node"].tolist(), int(rows["n"].iloc[0]), depth)
        up = above.iloc[0]
        found = [siblings(levels, k) for k in range(len(rows))]
        return pd.DataFrame({
            "tree": rows["tree"], "at": rows["at"], "lefts": [[*left, *up["lefts"]] for left, _ in found],
            "rights": [[*right, *up["rights"]] for _, right in found], "subroot": up["subroot"], "root": up["root"]})

    for nodes in rounds[-2::-1]:
        outer = written(nodes.select("tree", "at", "n", "node").groupBy("tree", _block(depth)).cogroup(
            outer.groupBy("tree", F.col("at").alias("block"))).applyInPandas(
            extend, f"tree string, at bigint, {PATH}, subroot string, root string"), "outer")
    return outer


def _outer_of_partitions(subroots: DataFrame, depth: int) -> DataFrame:
    """tree, at (0), path to the manifest's root, subroot and root, a row for
    each partition.  ``subroots``: tree and node."""
    leaves = written(subroots.select("tree", "node", F.monotonically_increasing_id().alias("row")), "subroots")
    placed = numbered(leaves, [F.col("tree")], [], "row").withColumnsRenamed({"tree": "of"}).withColumn(
        "tree", F.lit("")).select("of", "tree", "at", "n", "node")
    placed = written(placed, "subroots")
    rounds = _rounds(placed, depth)
    none = F.array().cast("array<string>")
    top = rounds[-1].select("tree", "at", none.alias("lefts"), none.alias("rights"),
                            F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    paths = _down(rounds, top, depth).select("at", "lefts", "rights", "root")
    return written(placed.join(paths, "at").select(
        F.col("of").alias("tree"), F.lit(0).cast("bigint").alias("at"), "lefts", "rights", F.col("node").alias("subroot"),
        "root"), "outer")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, partition: str = "lang", order: str = "doc_id",
             tampered: Sequence[Column] | None = None, where: Column | None = None, proofs: bool = False,
             depth: int = DEPTH) -> DataFrame:
    """Per row: ``order``, leaf, subroot, root, proof_sha256, folded_root and
    verified; with ``proofs`` also lefts and rights, the siblings level by
    level.  A superblock has ``depth`` levels.  ``tampered``: fields that replace the row's before folding, where
    ``where`` is true."""
    kind = docs.schema[order].dataType.simpleString()
    own = [docs[f] for f in fields]
    other = leaf_of(tampered) if tampered is not None else F.lit(None).cast("string")
    # partition values are never null inside: "" for null, which comes first
    leaves = written(docs.select(
        docs[order].alias("id"), F.coalesce(F.concat(F.lit("="), docs[partition].cast("string")), F.lit("")).alias("tree"),
        leaf_of(own).alias("node"), F.when(where if where is not None else F.lit(True), other).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    placed = written(numbered(leaves, [F.col("id").asc_nulls_first(), F.col("node")], ["tree"], "row").select(
        "tree", "at", "n", "node", "changed", F.col("id").cast("string").alias("id")), "placed")
    rounds = _rounds(placed, depth)
    # down to the tops of the leaves' superblocks
    outer = _down(rounds[1:], _outer_of_partitions(rounds[-1].select("tree", "node"), depth), depth)
    return _finished(placed, outer, order, kind, proofs, depth)


def _finished(placed: DataFrame, outer: DataFrame, order: str, kind: str, proofs: bool, depth: int) -> DataFrame:
    whole = f", {PATH}" if proofs else ""

    def finish(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        nodes = rows["node"].tolist()
        levels = levels_of(nodes, int(rows["n"].iloc[0]), depth)
        up = above.iloc[0]
        outer_lefts, outer_rights, root = list(up["lefts"]), list(up["rights"]), up["root"]
        outer_proof = "".join(left + right for left, right in zip(outer_lefts, outer_rights))
        out = []
        for k, (node, changed) in enumerate(zip(nodes, rows["changed"])):
            lefts, rights = siblings(levels, k)
            proof = digest((*(left + right for left, right in zip(lefts, rights)), outer_proof))
            lefts, rights = lefts + outer_lefts, rights + outer_rights
            folded = fold(changed or node, lefts, rights)
            out.append((node, up["subroot"], root, proof, folded, folded == root)
                       + ((lefts, rights) if proofs else ()))
        found = pd.DataFrame(out, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                             + (["lefts", "rights"] if proofs else []))
        found.insert(0, "id", rows["id"].tolist())
        return found

    done = placed.groupBy("tree", _block(depth)).cogroup(outer.groupBy("tree", F.col("at").alias("block"))).applyInPandas(
        finish, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                f"verified boolean{whole}")
    return done.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", order)


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, UPPER, LOWER)
