"""A Merkle manifest of a table: a digest for every row, a tree of digests for
every group (such as a language), one root over the groups, and for every row the
proof that leads from its leaf to the root.

Leaves are SHA-256 of a row's values. In a group they stand by id (ties by
digest, null ids first); every two neighbours become one node, a lone last one a
node by itself, until one is left, the group's subroot. Subroots stand by group
(null first, then by UTF-8 bytes) and are joined the same way. Digests are hashed
as lowercase hex text.

A group may hold any share of the rows, so no task sees a whole tree. Rows are
sorted into key ranges, numbered by range, and the ranges' counts say where in
its tree each row stands. ``BLOCK`` neighbours are a superblock, and a superblock
is the unit of work:

* up: each superblock is reduced to one node; these nodes are leaves of the next
  round, until every tree has one node (three rounds for 10**11 rows);
* down: the superblocks of a round are cogrouped with what lies outside them, the
  steps from their top node to the root. One task finishes a superblock: it reduces
  it again, joins each node's inner steps to the outer ones, and (for leaves)
  folds the proof from the leaf as it is found now to the root.

Texts are hashed in the scan; only digests are shuffled. Nulls: a null value is
``-`` in a leaf, a null id or group is one like any other. Repeated rows are
leaves of their own. An empty table gives an empty result. Columns other than
the hashed ones are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from billmodel.llm.common import checkpointed, partitions, ship_package

#: Levels of a superblock, and its nodes.
LEVELS = 12
BLOCK = 1 << LEVELS
VALUES = ("doc_id", "source", "lang", "n_chars", "text")
LEFT, RIGHT, ALONE = b"L"[0], b"R"[0], b"N"[0]
STEPS = "tree string, pos long, path binary, subroot binary, root binary"
RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, proof string")


def _part(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 (binary) of string columns, each with its length."""
    return F.unhex(F.sha2(F.concat(*map(_part, values)), 256))


# --- places ---------------------------------------------------------------------


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``pos``, a row's place in its tree by ``order``,
    and ``n``, the rows of the tree. No tree is in one task: ranges are numbered
    apart and their counts (a row for each range and tree in it) added up."""
    n = partitions(rows.sparkSession)
    keys = ["tree", *order]
    ranged = checkpointed(rows).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # in a partition the ids rise by one a row; the partition is in the upper bits
    numbered = checkpointed(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33)))
    runs = numbered.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    tree = W.partitionBy("tree")
    before = F.coalesce(F.sum("size").over(tree.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "range", (before - F.col("first")).alias("shift"), F.sum("size").over(tree).alias("n"))
    return numbered.join(runs, ["tree", "range"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "range", "shift")


# --- trees ----------------------------------------------------------------------


def _depth(n: int, levels: int) -> int:
    """Levels that a superblock of a tree of ``n`` nodes is reduced by."""
    return min(levels, (n - 1).bit_length())


def _climb(nodes: list[bytes], depth: int) -> list[list[bytes]]:
    """All levels of a superblock, hex digests."""
    out = [nodes]
    for _ in range(depth):
        below = out[-1]
        out.append([sha256(below[i] + below[i + 1] if i + 1 < len(below) else below[i]).hexdigest().encode() for i in range(0, len(below), 2)])
    return out


def _inner(levels: list[list[bytes]], slot: int) -> bytes:
    """Steps from a node to the top of its superblock: the side of the sibling
    and its digest, or that there is none."""
    out = []
    for row in levels[:-1]:
        other = slot ^ 1
        out.append((b"L" if other < slot else b"R") + row[other] if other < len(row) else b"N")
        slot >>= 1
    return b"".join(out)


def _fold(node: bytes, path: bytes) -> tuple[bytes, list[bytes]]:
    """The digest that a path leads to, and the siblings on it."""
    at, siblings = 0, []
    while at < len(path):
        side, other = path[at], path[at + 1 : at + 65]
        if side == ALONE:
            node, at = sha256(node).hexdigest().encode(), at + 1
            continue
        node = sha256(other + node if side == LEFT else node + other).hexdigest().encode()
        siblings.append(other)
        at += 65
    return node, siblings


def _hex(digests: pd.Series) -> list[bytes]:
    return [bytes(d).hex().encode() for d in digests]


def _top(levels: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """A superblock's top node."""

    def run(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        n = int(nodes["n"].iloc[0])
        top = _climb(_hex(nodes["hash"]), _depth(n, levels))[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n >> levels)], "hash": [bytes.fromhex(top.decode())]})

    return run


def _outer(levels: int) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Every node of a superblock with its steps to the root."""

    def run(key: tuple, nodes: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        nodes, beyond = nodes.sort_values("pos"), outside.iloc[0]
        rows = _climb(_hex(nodes["hash"]), _depth(int(nodes["n"].iloc[0]), levels))
        paths = [_inner(rows, slot) + bytes(beyond["path"]) for slot in range(len(nodes))]
        return pd.DataFrame({"tree": key[0], "pos": nodes["pos"].to_numpy(), "path": paths, "subroot": beyond["subroot"], "root": beyond["root"]})

    return run


def _leaves(levels: int, with_proof: bool) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Every leaf of a superblock: its proof, and where it leads from what is
    found now."""

    def run(key: tuple, leaves: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        leaves, beyond = leaves.sort_values("pos"), outside.iloc[0]
        path, root, subroot = bytes(beyond["path"]), bytes(beyond["root"]).hex(), bytes(beyond["subroot"]).hex()
        hashes = _hex(leaves["hash"])
        rows = _climb(hashes, _depth(int(leaves["n"].iloc[0]), levels))
        proofs, folded, whole = [], [], []
        for slot, (leaf, found) in enumerate(zip(hashes, leaves["found"])):
            steps = _inner(rows, slot) + path
            end, siblings = _fold(leaf if found is None else bytes(found).hex().encode(), steps)
            folded.append(end.decode())
            proofs.append(sha256(b"".join(siblings)).hexdigest())
            whole.append(steps.decode() if with_proof else None)
        return pd.DataFrame({"doc_id": leaves["doc_id"].to_numpy(), "leaf": [h.decode() for h in hashes], "subroot": subroot, "root": root,
                             "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded], "proof": whole})

    return run


NODE = "tree string, pos long, n long, hash binary"


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes of every round, from the leaves to one node a tree."""
    out, most = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while len(out) == 1 or most > 1:
        blocks = out[-1].select("tree", "pos", "n", "hash", F.shiftright("pos", levels).alias("block")).groupBy("tree", "block")
        out.append(checkpointed(blocks.applyInPandas(_top(levels), NODE)))
        most = -(-most >> levels)
    return out


def _down(nodes: DataFrame, outside: DataFrame, levels: int, run: Callable, schema: str) -> DataFrame:
    """Superblocks of ``nodes`` cogrouped with the steps from their top."""
    inside = nodes.withColumn("block", F.shiftright("pos", levels)).groupBy("tree", "block")
    return inside.cogroup(outside.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(run, schema)


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", value_cols: tuple[str, ...] = VALUES,
                    found: dict[str, Column] | None = None, levels: int = LEVELS, with_proof: bool = False) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, proof)
    for every row of ``docs``. ``found`` replaces values by what a later reader
    finds (strings; columns of ``docs``): the proof is folded from the leaf of
    those, and ``verified`` says whether it leads to the root. ``proof`` (null
    unless ``with_proof``) lists the steps: L or R and the sibling on that side,
    N where a node is alone. ``levels`` sets the superblock's size, not the result."""
    ship_package(docs.sparkSession)
    text = {c: F.col(f"`{c}`").cast("string") for c in value_cols}
    group = F.col(f"`{group_col}`").cast("string")
    leaf = leaf_digest([text[c] for c in value_cols])
    now = leaf_digest([(found or {}).get(c, text[c]) for c in value_cols])
    differs = F.lit(False)
    for c, value in (found or {}).items():
        differs = differs | ~value.eqNullSafe(text[c])
    rows = docs.select(F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), group)).alias("tree"),
                       F.col(f"`{id_col}`").cast("long").alias("doc_id"), leaf.alias("hash"), F.when(differs, now).alias("found"))
    leaves = _placed(rows, ["doc_id", "hash"])
    rounds = _rounds(leaves, levels)
    # the groups' subroots are the leaves of one more tree
    subroots = _placed(rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash"), ["group"])
    above = _rounds(subroots, levels)
    steps = above[-1].select("tree", "pos", F.lit(b"").alias("path"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    for nodes in reversed(above[:-1]):
        steps = _down(nodes.select("tree", "pos", "n", "hash"), steps, levels, _outer(levels), STEPS)
    steps = (subroots.select("pos", "group", "hash").join(steps.select("pos", "path", "root"), "pos")
             .select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("hash").alias("subroot"), "root"))
    for nodes in reversed(rounds[1:-1]):
        steps = _down(nodes, steps, levels, _outer(levels), STEPS)
    return _down(leaves, steps, levels, _leaves(levels, with_proof), RESULT)
