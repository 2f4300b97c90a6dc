"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are spread over nodes that share a block of bits: two fingerprints that differ in
at most ``distance`` bits agree on one of ``distance + 1`` blocks, so each is sent to that many
nodes.  A node with more than ``node_limit`` fingerprints is split again by blocks of its free
bits, so no node is larger than that or than two to the power of its few free bits, whatever
the skew.  In a partition the fingerprints stand in Gray order, where neighbours share most
bits; consecutive ones are factored into upper entries that hold the bits they share, and two
groups are dropped together once their shared bits differ in more than ``distance`` places.
What is left is folded into one star per connected set, never into all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lookup, pieces, texts

DISTANCE, NODE_LIMIT, FAN = 2, 2048, 16
#: Seed of the shingle hash (fixed by contract).
SEED = 42


def fingerprint(text: bytes, size: int = 3) -> int:
    """A bit is 1 where over half of the shingles' hashes have it; no word: zero."""
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    step, total = 1 << 17, np.zeros(64, dtype=np.int64)
    n = max(1, len(words) - size + 1)
    first, last = starts[:n].tolist(), ends[min(size, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, step):
        hashes = np.array([digest(line[a:b], SEED) for a, b in
                           zip(first[at:at + step], last[at:at + step])], dtype=">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        values = np.array([fingerprint(t) for t in texts(batch.column("text"))], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])


def gray_rank(code: Column) -> Column:
    """Position of ``code`` in the Gray sequence: each bit is the parity of those above it."""
    return reduce(lambda x, by: x.bitwiseXOR(F.shiftrightunsigned(x, by)),
                  (1, 2, 4, 8, 16, 32), code)


def _thirds(free: int, parts: int) -> list[int]:
    """The free bits of a mask in ``parts`` consecutive blocks."""
    bits = [b for b in range(64) if free >> b & 1]
    cuts = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _spread(rows: DataFrame, masks: dict[int, int]) -> DataFrame:
    """Each fingerprint once for each path: the bits that the path fixes, and its Gray rank
    among the others."""
    nodes = [F.struct(F.lit(path).alias("path"),
                      F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("pattern"),
                      gray_rank(F.col("fp").bitwiseAND(F.lit(_signed(~mask & (1 << 64) - 1)))
                                ).alias("rank"))
             for path, mask in masks.items()]
    return rows.select("fp", F.explode(F.array(*nodes)).alias("n")).select("fp", "n.*")


def _roots(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Union of the sets that pairs (u, v) connect; the smallest index is the root."""
    while True:
        a, b = parent[u], parent[v]
        differ = a != b
        if not differ.any():
            return parent
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def _grouped(low: np.ndarray, reducer) -> np.ndarray:
    return reducer.reduceat(low, np.arange(0, len(low), FAN))


def stars(fp: np.ndarray, node: np.ndarray, distance: int = DISTANCE,
          chunk: int = 1 << 18) -> np.ndarray:
    """Root index of each fingerprint; ``fp`` stands in order of ``node`` and Gray rank."""
    ands, ors, first, last = [fp], [fp], [node], [node]
    while len(ands[-1]) > FAN:
        ands.append(_grouped(ands[-1], np.bitwise_and))
        ors.append(_grouped(ors[-1], np.bitwise_or))
        first.append(_grouped(first[-1], np.minimum))
        last.append(_grouped(last[-1], np.maximum))
    parent = np.arange(len(fp))
    top = len(ands) - 1
    i, j = np.triu_indices(len(ands[top]))
    work = [(top, i, j)]
    while work:
        level, i, j = work.pop()
        shared = ~((ands[level] ^ ors[level])[i] | (ands[level] ^ ors[level])[j])
        apart = np.bitwise_count((ands[level][i] ^ ands[level][j]) & shared)
        near = (apart <= distance) & (first[level][j] <= last[level][i])
        i, j = i[near], j[near]
        if level == 0:
            parent = _roots(parent, i, j)
            continue
        size, step = len(ands[level - 1]), np.arange(FAN)
        for at in range(0, len(i), max(1, chunk // FAN**2)):
            part = slice(at, at + max(1, chunk // FAN**2))
            a = np.repeat(i[part][:, None] * FAN + step, FAN, axis=1).ravel()
            b = np.tile(j[part][:, None] * FAN + step, (1, FAN)).ravel()
            keep = (a < size) & (b < size) & (a <= b)
            work.append((level - 1, a[keep], b[keep]))
    return parent


def _linker(distance: int, rows: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of node and Gray rank.  Full blocks of whole nodes are searched,
        the node that a block breaks off in waits for the next rows."""
        waiting: list[tuple[np.ndarray, ...]] = []
        held = 0

        def search(columns, cut):
            fp, path, pattern = (c[:cut] for c in columns)
            fp = fp.view(np.uint64)
            fresh = np.concatenate([[False], (path[1:] != path[:-1])
                                    | (pattern[1:] != pattern[:-1])])
            root = stars(fp, np.cumsum(fresh), distance)
            linked = np.flatnonzero(root != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[linked].view(np.int64)), pa.array(fp[root[linked]].view(np.int64))],
                names=["u", "v"])

        for batch in batches:
            waiting.append(tuple(batch.column(c).to_numpy() for c in ("fp", "path", "pattern")))
            held += batch.num_rows
            if held >= rows:
                columns = tuple(map(np.concatenate, zip(*waiting)))
                same = (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
                cut = int(np.argmax(same))
                if cut:
                    yield search(columns, cut)
                waiting, held = [tuple(c[cut:] for c in columns)], len(columns[0]) - cut
        if held:
            columns = tuple(map(np.concatenate, zip(*waiting)))
            yield search(columns, held)

    return link


def links(scratch: Scratch, codes: DataFrame, distance: int = DISTANCE,
          node_limit: int = NODE_LIMIT) -> DataFrame:
    """Edges (u, v) whose connected sets are those of all pairs of ``codes.fp`` within
    ``distance`` bits.  ``codes`` holds each fingerprint once."""
    spark, found = scratch.spark, []
    masks = dict(enumerate(_thirds((1 << 64) - 1, distance + 1)))
    rows = scratch.keep(_spread(codes, masks), "nodes-0")
    while True:
        level = len(found)
        free = 64 - max(m.bit_count() for m in masks.values())
        crowded = (rows.groupBy("path", "pattern").count().filter(F.col("count") > node_limit)
                   .drop("count"))
        last = 1 << free <= node_limit or free < 2 * (distance + 1)
        crowded = None if last else scratch.keep(crowded, f"crowded-{level}")
        if crowded is not None and crowded.isEmpty():
            crowded = None
        small = rows if crowded is None else rows.join(crowded, ["path", "pattern"], "left_anti")
        count = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sorted_rows = (small.repartition(count, "path", "pattern")
                       .sortWithinPartitions("path", "pattern", "rank")
                       .select("fp", "path", "pattern"))
        found.append(sorted_rows.mapInArrow(_linker(distance, 1 << 16), "u long, v long"))
        if crowded is None:
            break
        below = {}
        step = []
        for path, mask in masks.items():
            for part in _thirds(~mask & (1 << 64) - 1, distance + 1):
                below[len(below)] = mask | part
                step.append((path, len(below) - 1))
        children = [F.when(F.col("path") == path, F.struct(
            F.lit(child).alias("path"),
            F.col("fp").bitwiseAND(F.lit(_signed(below[child]))).alias("pattern"),
            gray_rank(F.col("fp").bitwiseAND(F.lit(_signed(~below[child] & (1 << 64) - 1)))
                      ).alias("rank"))) for path, child in step]
        inside = rows.join(crowded, ["path", "pattern"], "left_semi")
        rows = scratch.keep(
            inside.select("fp", F.explode(F.filter(F.array(*children), lambda n: n.isNotNull())).alias("n"))
            .select("fp", "n.*"), f"nodes-{level + 1}")
        masks = below
    return reduce(DataFrame.unionByName, found)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``, root being the smallest node that it reaches.

    Alternating large-star and small-star steps; each step is written to the shared folder.
    Minima are aggregated before they are joined back, and AQE splits a crowded hub's rows.
    """
    def kept(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        table = scratch.keep(df.filter("u != v").distinct(), name)
        state = table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return table, tuple(state)

    def both(df: DataFrame) -> DataFrame:
        return df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def star(df: DataFrame, bound: Column) -> DataFrame:
        near = both(df)
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        pulled = near.join(least, "u").filter(bound)
        return pulled.select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small(df: DataFrame) -> DataFrame:
        down = df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(least.select("u", F.col("m").alias("v"))))

    table, state = kept(edges.select(F.greatest("u", "v").alias("u"),
                                     F.least("u", "v").alias("v")), "edges-0")
    turn = 0
    while True:
        turn += 1
        large = star(table, F.col("v") > F.col("u"))
        table, new = kept(small(large), f"edges-{turn}")
        if new == state:
            break
        state = new
    return table.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(scratch: Scratch, codes: DataFrame, distance: int = DISTANCE,
           node_limit: int = NODE_LIMIT) -> DataFrame:
    """``codes`` (each fp once) with ``root``, the smallest fp that each reaches by steps of at
    most ``distance`` bits."""
    linked = scratch.keep(links(scratch, codes.select("fp"), distance, node_limit), "links")
    roots = components(scratch, linked)
    return scratch.keep(codes.join(roots, codes.fp == roots.node, "left").select(
        *codes.columns, F.coalesce("root", "fp").alias("root")), "placed")


def near_duplicates(documents: DataFrame, distance: int = DISTANCE,
                    node_limit: int = NODE_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) for every
    row of ``documents``; only ``doc_id`` and ``text`` are read.

    Null and wordless texts have fingerprint zero and link like any other.  Repeated rows come
    out as often as they come in.  A null doc_id is no smallest id; where a component has no
    other, component_id is null.  No rows: no rows.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "simhash")
    marked = scratch.keep(documents.select("doc_id", "text").mapInArrow(
        _fingerprints, "doc_id long, fp long"), "fingerprints")
    codes = scratch.keep(marked.groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n")), "codes")
    placed = groups(scratch, codes, distance, node_limit)
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"),
                                       F.count("*").alias("n_codes"))
    n_codes = placed.count()
    named = lookup(placed, least.withColumnRenamed("n_codes", "weight"), "root", "weight", n_codes)
    named = scratch.keep(named.select("fp", "n", "component_id"), "named")
    total = marked.count()
    result = lookup(marked, named, "fp", "n", total)
    return result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")



