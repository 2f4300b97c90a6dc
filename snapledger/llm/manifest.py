"""Merkle manifest of a dataset: persistent trees in aligned blocks, joined by distributed tiers.

Every row is a leaf.  The leaves of a group are numbered in order and dealt into aligned blocks
of ``FAN ** HEIGHT``; a task folds a block to one node, and these nodes are the leaves of the next
tier, until one is left.  The nodes left by the groups form a tree of their own, above which is the
root.  Then the siblings above a block are handed down from tier to tier.  In its block, a
changed leaf makes a new version of the tree, which copies the ancestors of that leaf and shares
all other nodes; the version goes on through the siblings that the block was handed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, partitions

#: Nodes under a parent (fixed by contract), and levels of a block.
FAN, HEIGHT = 8, 4
#: Columns of a leaf in order (fixed by contract).
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves in a partition of the sorted table, about.
PER_PARTITION = 1 << 20

_PATH = "array<struct<left:binary,right:binary>>"


class Node(NamedTuple):
    digest: bytes
    children: tuple[Node, ...] = ()


def digest(*parts: bytes) -> bytes:
    """Digest of digests, which are read as hexadecimal text."""
    return sha256("".join([p.hex() for p in parts]).encode()).digest()


def parent(children: Sequence[Node]) -> Node:
    return Node(digest(*[c.digest for c in children]), tuple(children))


def levels_of(n: int, height: int) -> int:
    """Levels between the leaves of a block and its node, in a tier of ``n`` nodes."""
    if n > FAN ** height:
        return height
    levels = 0
    while FAN ** levels < n:
        levels += 1
    return levels


def grown(leaves: Iterable[bytes], levels: int) -> Node:
    """The tree of a block."""
    row = [Node(d) for d in leaves]
    for _ in range(levels):
        row = [parent(row[i:i + FAN]) for i in range(0, len(row), FAN)]
    return row[0]


def version(node: Node, place: int, levels: int, leaf: bytes) -> Node:
    """The tree with another leaf at ``place``: new ancestors, all else shared."""
    if not levels:
        return Node(leaf)
    step = FAN ** (levels - 1)
    at, below = divmod(place, step)
    kept = node.children
    return parent((*kept[:at], version(kept[at], below, levels - 1, leaf), *kept[at + 1:]))


def siblings(node: Node, place: int, levels: int) -> list[tuple[bytes, bytes]]:
    """Digests left and right of the path to the leaf at ``place``, lowest level first."""
    found = []
    for level in range(levels - 1, -1, -1):
        at = place // FAN ** level % FAN
        found.append(tuple(b"".join(c.digest for c in side)
                           for side in (node.children[:at], node.children[at + 1:])))
        node = node.children[at]
    return found[::-1]


def folded(leaf: bytes, path: Iterable[tuple[bytes, bytes]]) -> bytes:
    for left, right in path:
        leaf = digest(left, leaf, right)
    return leaf


def _block(table: pa.Table, height: int) -> tuple[list[dict], int, Node]:
    rows = sorted(table.to_pylist(), key=lambda r: r["at"])
    levels = levels_of(rows[0]["n"], height)
    return rows, levels, grown((r["digest"] for r in rows), levels)


_NODE = "tree long, at long, n long, digest binary"


def _fold(height: int, table: pa.Table) -> pa.Table:
    rows, _, top = _block(table, height)
    r, size = rows[0], FAN ** height
    return pa.table({"tree": [r["tree"]], "at": [r["at"] // size], "n": [-(-r["n"] // size)],
                     "digest": [top.digest]})


def _above(parents: pa.Table) -> tuple[list[tuple[bytes, bytes]], dict]:
    [row] = parents.to_pylist()
    return [(p["left"], p["right"]) for p in row["path"]], row


_HANDED = f"tree long, at long, path {_PATH}, subroot binary, root binary"


def _hand_down(height: int, children: pa.Table, parents: pa.Table) -> pa.Table:
    rows, levels, top = _block(children, height)
    above, given = _above(parents)
    paths = [siblings(top, r["at"] % FAN ** height, levels) + above for r in rows]
    pair = pa.struct([("left", pa.binary()), ("right", pa.binary())])
    return pa.table({
        "tree": [r["tree"] for r in rows], "at": [r["at"] for r in rows],
        "path": pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], pa.list_(pair)),
        "subroot": pa.array([given["subroot"] or r["digest"] for r in rows], pa.binary()),
        "root": pa.array([given["root"]] * len(rows), pa.binary())})


_PROVEN = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
           "folded_root string, verified boolean")


def _prove(height: int, children: pa.Table, parents: pa.Table) -> pa.Table:
    rows, levels, top = _block(children, height)
    above, given = _above(parents)
    tail = "".join(a.hex() + b.hex() for a, b in above).encode()
    known: dict[bytes, bytes] = {}  # versions that end in the same node go on alike
    out: dict[str, list] = {name.split()[0]: [] for name in _PROVEN.split(", ")}
    for r in rows:
        place = r["at"] % FAN ** height
        own = siblings(top, place, levels)
        if r["changed"] is None:
            node = folded(r["digest"], own)
        else:
            node = version(top, place, levels, r["changed"]).digest
        if node not in known:
            known[node] = folded(node, above)
        proof = sha256("".join(a.hex() + b.hex() for a, b in own).encode())
        proof.update(tail)
        for name, value in (
                ("doc_id", r["doc_id"]), ("leaf", r["digest"].hex()), ("subroot", given["subroot"].hex()),
                ("root", given["root"].hex()), ("proof_sha256", proof.hexdigest()),
                ("folded_root", known[node].hex()), ("verified", known[node] == given["root"])):
            out[name].append(value)
    return pa.table({**out, "doc_id": pa.array(out["doc_id"], pa.int64())})


def field(value: Column) -> Column:
    """A column's part of a leaf: its length and itself, so that no two rows read alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: Iterable[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def numbered(scratch: Scratch, rows: DataFrame, name: str, order: Sequence[str],
             groups: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``place``, sorted into partitions; and for each part (of the table) and group:
    where its places begin (``low``), how many rows of the group come before, and all its rows (``n``).

    Only the second frame, as large as partitions and groups together, is ranked.
    """
    parts = partitions(scratch.spark, rows.count(), PER_PARTITION)
    sorted_ = scratch.keep(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                           .withColumn("place", F.monotonically_increasing_id()), name)
    counts = sorted_.groupBy(F.shiftright("place", 33).alias("part"), *groups).agg(
        F.min("place").alias("low"), F.count("*").alias("count"))
    within = Window.partitionBy(*(groups or [F.lit(0)]))
    before = within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", *groups, "low",
                           F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"),
                           F.sum("count").over(within).alias("n"))
    return sorted_, scratch.keep(starts, f"{name}-starts")


def tiers(scratch: Scratch, nodes: DataFrame, name: str, height: int) -> list[DataFrame]:
    """``nodes`` (tree, at, n, digest) and the tiers above, until every tree is one node."""
    found = [nodes]
    while (found[-1].agg(F.max("n")).first()[0] or 1) > 1:
        folded_ = _blocks(found[-1].select("tree", "at", "n", "digest"), height).applyInArrow(
            _bound(_fold, height), _NODE)
        found.append(scratch.keep(folded_, f"{name}-{len(found)}"))
    return found


def _bound(work: Callable, height: int) -> Callable:
    if work is _fold:
        return lambda table: _fold(height, table)
    return lambda children, parents: work(height, children, parents)


def _blocks(nodes: DataFrame, height: int):
    return nodes.groupBy("tree", F.floor(F.col("at") / FAN ** height).cast("long").alias("block"))


def _down(nodes: DataFrame, handed: DataFrame, work: Callable, schema: str, height: int) -> DataFrame:
    blocks = handed.groupBy("tree", F.col("at").alias("block"))
    return _blocks(nodes, height).cogroup(blocks).applyInArrow(_bound(work, height), schema)


def prove(documents: DataFrame, changed: Column, change: Callable[[Column], Column],
          height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    Of ``documents`` the columns ``FIELDS`` are read; a tree is made for each lang.  In the rows
    where ``changed`` holds, the leaf is made anew with ``change`` of the text, and
    ``folded_root`` is the root of that version.  Leaves ascend by doc_id, null first; rows with
    the same doc_id go by their digest, equal ones in any order, each with its own place and
    proof.  A null in a column is a leaf's ``-``, a null lang is a group, the first one.  A long
    text is digested where it lies, only digests are shuffled.  No rows: no rows.  ``height`` is
    the number of levels of a block; results do not depend on it.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "manifest")
    columns = {c: F.col(c) for c in FIELDS}
    other = leaf({**columns, "text": change(columns["text"])}.values())
    leaves = scratch.keep(documents.select(
        "doc_id", "lang", leaf(columns.values()).alias("digest"),
        F.when(F.coalesce(changed, F.lit(False)), other).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    sorted_, starts = numbered(scratch, leaves, "sorted", ["lang", "doc_id", "digest", "row"], ["lang"])
    langs, first = numbered(scratch, starts.select("lang").distinct(), "langs", ["lang"])
    trees = langs.join(first, F.shiftright("place", 33) == F.col("part")).select(
        F.col("lang").alias("of"), (F.col("place") - F.col("low") + F.col("before")).alias("tree"),
        F.col("n").alias("n_trees"))
    starts = scratch.keep(starts.join(trees, F.col("lang").eqNullSafe(F.col("of"))).drop("of"), "starts")
    nodes = scratch.keep(sorted_.withColumn("part", F.shiftright("place", 33)).alias("a").join(
        starts.alias("b"), (F.col("a.part") == F.col("b.part"))
        & F.col("a.lang").eqNullSafe(F.col("b.lang"))).select(
        "doc_id", "digest", "changed", "tree", "n",
        (F.col("place") - F.col("low") + F.col("before")).alias("at")), "nodes")

    lower = tiers(scratch, nodes, "tier", height)
    n_trees = starts.select("tree", "n_trees").distinct()
    tops = lower[-1].select("tree", "digest").join(n_trees, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("n_trees").alias("n"),
        "digest")
    upper = tiers(scratch, scratch.keep(tops, "subroots"), "upper", height)
    handed = upper[-1].select(
        "tree", "at", F.array().cast(_PATH).alias("path"),
        F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    for k, tier in enumerate(reversed(upper)):
        handed = scratch.keep(_down(tier, handed, _hand_down, _HANDED, height), f"handed-upper-{k}")
        if k + 1 < len(upper):
            handed = handed.withColumn("subroot", F.lit(None).cast("binary"))
    handed = handed.select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "path",
                           "subroot", "root")
    for k, tier in enumerate(reversed(lower[1:])):
        handed = scratch.keep(_down(tier, handed, _hand_down, _HANDED, height), f"handed-{k}")
    return _down(nodes, handed, _prove, _PROVEN, height)
