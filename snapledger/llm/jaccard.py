"""Near-duplicates by the share of word shingles: pairs of at least 0.8 five-word Jaccard.

Texts with the same set of shingles are one set.  Sets are searched by operator 1's index first:
its fingerprints are linked at ``DISTANCE`` or fewer differing bits through the Gray-order hierarchy.
What it links is compared by whole sets.

A pair of 0.8 may differ in twelve bits, further than an index of 64 bits can search a large corpus.
So each set also gets ``BANDS`` keys of ``ROWS`` minima of its hashes; sets that share a
key and are not connected by the index are candidates (a pair of 0.8 shares none with a probability
of 3 in a million, a closer one more rarely).  Candidates are compared by their whole sets.

Sets that share keys, directly or by others, are a cluster, found from keys alone.  A cluster of
bounded size is compared in one tile, so each of its texts is sent once; inside a tile two sets
that are connected already are not compared again.  A larger cluster is first compared by few keys, in
tiles, which connects large groups of near copies.  What that leaves open is compared where the
rarest shingles of two sets meet, which finds every pair that is left.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, pieces, small, texts
from .simhash import SEED, components, fingerprint, groups

#: Words of a shingle, and the least similarity as a fraction.
SIZE, SHARE = 5, (4, 5)
#: Differing bits of two fingerprints that are searched by the index.
DISTANCE = 6
#: Keys of a set, minima in each, and how many keys are searched first.
BANDS, ROWS, EARLY = 24, 4, 2
#: Sets of a tile and their shingles, about.
TILE, TILE_SHINGLES = 1_000, 1 << 20

_MIX = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_MIX[0] = _MIX[0] << np.uint64(1) | np.uint64(1)


def shingles(text: bytes, size: int = SIZE) -> np.ndarray:
    """Hashes of the distinct shingles in order; fewer words than ``size`` are one shingle."""
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:max(1, len(words) - size + 1)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter(
        (digest(line[a:b], SEED) for a, b in
         zip(starts.tolist(), ends[min(size, len(words)) - 1:].tolist())), np.uint64, len(starts)))


def keys(hashes: np.ndarray) -> list[int]:
    """A key for each band; none without a shingle."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1 << 10):
        mixed = _MIX[0][:, None] * hashes[at:at + (1 << 10)] + _MIX[1][:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    raw = least.tobytes()
    step = 8 * ROWS
    return [xxhash.xxh64_intdigest(raw[k * step:(k + 1) * step], k) for k in range(BANDS)]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _marker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 1 << 20):
        read = texts(batch.column("text"))
        sets = [shingles(t) for t in read]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(_signed([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets])),
             pa.array([len(s) for s in sets], pa.int64()),
             pa.array(_signed([fingerprint(t) for t in read])),
             pa.array([_signed(keys(s)) for s in sets], pa.list_(pa.int64()))],
            names=[*batch.schema.names, "set", "size", "fp", "keys"])


def connected(sets: Sequence[np.ndarray], label: np.ndarray) -> np.ndarray:
    """``label`` after sets of at least ``SHARE`` similarity are joined; equal labels are
    connected before."""
    label = label.copy()
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.cumsum(sizes) - sizes
    mark = np.zeros(int(flat.max()) + 1, dtype=bool)
    over, under = SHARE
    for i in range(len(sets) - 1):
        if (label[i + 1:] == label[i]).all():
            continue
        own = flat[begin[i]:begin[i] + sizes[i]]
        mark[own] = True
        at = begin[i + 1]
        common = np.add.reduceat(mark[flat[at:]], begin[i + 1:] - at, dtype=np.int64)
        mark[own] = False
        near = common * (over + under) >= over * (sizes[i] + sizes[i + 1:])
        joined = np.unique(label[i + 1:][near])
        label[np.isin(label, joined)] = label[i]
    return label


def _verify(table: pa.Table) -> pa.Table:
    """Edges between the connected sets of a tile."""
    table = table.combine_chunks()
    names = table.column("set").to_numpy()
    sets = [shingles(t) for t in texts(table.column("text").combine_chunks())]
    _, label = np.unique(table.column("root").to_numpy(), return_inverse=True)
    _, first, group = np.unique(connected(sets, label), return_index=True, return_inverse=True)
    centre = first[group]
    linked = np.flatnonzero(centre != np.arange(len(names)))
    return pa.table({"u": names[linked], "v": names[centre[linked]]})


def _candidates(members: DataFrame) -> DataFrame:
    """Keys (with their number of tiles and smallest set) of sets that are not all connected.
    Of several keys with the same sets one is enough."""
    tiles = F.ceil(F.greatest(F.col("n") / TILE, F.col("weight") / TILE_SHINGLES))
    return (members.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("size").alias("weight"), F.min("set").alias("low"),
        F.max("set").alias("high"), F.bit_xor(F.xxhash64("set")).alias("mix"),
        F.min("root").alias("r"), F.max("root").alias("s"))
        .filter("r != s").groupBy("n", "weight", "low", "high", "mix")
        .agg(F.min("key").alias("key")).select("key", "low", tiles.alias("tiles")))


def _tiles(members: DataFrame, found: DataFrame) -> DataFrame:
    """key, tile, set: sets dealt into tiles, each with the smallest set of all."""
    own = F.pmod(F.xxhash64("set", "key"), F.col("tiles"))
    dealt = members.join(found, "key").select("key", own.alias("tile"), "set")
    centre = found.filter("tiles > 1").select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"),
        F.col("low").alias("set"))
    return dealt.unionByName(centre).distinct()


class _Search:
    """Links found so far between the sets of a corpus."""

    def __init__(self, scratch: Scratch, marked: DataFrame, sets: DataFrame):
        self.scratch, self.marked, self.sets = scratch, marked, sets
        self.edges: list[DataFrame] = []
        self.linked = scratch.spark.createDataFrame([], "node long, root long")

    def compare(self, tiles: DataFrame, name: str) -> None:
        """Compare the sets of each tile (key, tile, set, root); a text is read where it lies
        and sent to its tiles only."""
        scratch = self.scratch
        needed = tiles.select("set").distinct().join(self.sets.select("set", "row"), "set")
        needed = scratch.keep(needed, f"needed-{name}")
        read = self.marked.select("row", "text").join(small(needed), "row").drop("row")
        links = tiles.join(read, "set").groupBy("key", "tile").applyInArrow(_verify, "u long, v long")
        self.edges.append(scratch.keep(links.distinct(), f"links-{name}"))
        inner = Scratch(scratch.spark, "jaccard-links")
        self.linked = scratch.keep(components(inner, reduce(DataFrame.unionByName, self.edges)),
                                   f"linked-{name}")
        inner.drop("")
        scratch.drop(f"needed-{name}")

    def placed(self, sets: DataFrame) -> DataFrame:
        """``sets`` with the root that each is connected with by now."""
        return sets.join(self.linked, sets["set"] == self.linked["node"], "left").drop("node").withColumn(
            "root", F.coalesce("root", "set"))


def _alike(search: _Search, sets: DataFrame) -> None:
    """Compare sets whose fingerprints the index links, directly or by others."""
    scratch = search.scratch
    inner = Scratch(scratch.spark, "jaccard-index")
    codes = inner.keep(sets.groupBy("fp").agg(F.count("*").alias("n")), "codes")
    placed = groups(inner, codes, DISTANCE)
    several = placed.groupBy("root").agg(F.sum("n").alias("n")).filter("n > 1").select("root")
    near = scratch.keep(placed.join(several, "root").select("fp", F.col("root").alias("key")), "near")
    inner.drop("")
    members = scratch.keep(sets.join(small(near), "fp").select(
        "set", "size", F.col("set").alias("root"), "key"), "alike")
    found = scratch.keep(_candidates(members), "alike-candidates")
    if not found.isEmpty():
        tiles = _tiles(members, found).withColumn("root", F.col("set"))
        search.compare(scratch.keep(tiles, "alike-tiles"), "alike")
    scratch.drop("near", "alike", "alike-candidates", "alike-tiles")


def _shared(scratch: Scratch, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets that share keys and are not all connected, by clusters: (cluster, set, root) of clusters
    that are one tile, and the sets of all others."""
    members = sets.select("set", "root", F.explode("keys").alias("key"))
    live = scratch.keep(members.groupBy("key").agg(
        F.min("set").alias("low"), F.min("root").alias("r"), F.max("root").alias("s"))
        .filter("r != s").select("key", "low"), "live")
    stars = scratch.keep(members.join(live, "key").filter("set != low").select(
        F.col("set").alias("u"), F.col("low").alias("v")).distinct(), "stars")
    inner = Scratch(scratch.spark, "jaccard-clusters")
    clusters = components(inner, stars)
    clusters = scratch.keep(clusters.unionByName(clusters.select(
        F.col("root").alias("node"), "root").distinct()).distinct().select(
        F.col("root").alias("cluster"), F.col("node").alias("set")), "clusters")
    inner.drop("")
    weighed = clusters.join(sets.select("set", "size"), "set")
    wide = scratch.keep(weighed.groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum("size").alias("weight"))
        .filter((F.col("n") > TILE) | (F.col("weight") > TILE_SHINGLES)).select("cluster"), "wide")
    crowd = scratch.keep(sets.join(clusters.join(small(wide), "cluster", "left_semi"), "set"), "crowd")
    fitting = scratch.keep(clusters.join(small(wide), "cluster", "left_anti").join(
        sets.select("set", "root"), "set"), "fitting")
    scratch.drop("live", "stars", "clusters", "wide")
    return fitting, crowd


def roots(scratch: Scratch, marked: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) for every set that is connected with another."""
    search = _Search(scratch, marked, sets)
    sets = sets.filter("size > 0")
    _alike(search, sets)
    sets = scratch.keep(search.placed(sets), "searched")
    fitting, crowd = _shared(scratch, sets)
    if not fitting.isEmpty():
        search.compare(fitting.select(F.col("cluster").alias("key"), F.lit(0).cast("long").alias("tile"),
                                      "set", "root"), "fitting")
    if not crowd.isEmpty():
        members = scratch.keep(crowd.select("set", "size", "root", F.explode(
            F.slice("keys", 1, EARLY)).alias("key")), "members")
        found = scratch.keep(_candidates(members), "candidates")
        tiles = _tiles(members, found).join(sets.select("set", "root"), "set")
        search.compare(scratch.keep(tiles, "tiles"), "early")
        scratch.drop("members", "candidates", "tiles")
        _finish(search, crowd)
    return search.linked


def _finish(search: _Search, crowd: DataFrame) -> None:
    """Compare what is not connected yet of crowded clusters, by the rarest shingles of sets.

    Of two sets that share ``SHARE`` of their shingles, each has one in common with the other
    among its rarest ``size - ceil(SHARE * size) + 1``, in one order of all shingles.  So only
    sets that share one of those are compared, and a passage common to all costs nothing.
    """
    scratch = search.scratch
    placed = search.placed(crowd.select("cluster", "set", "row", "size"))
    split = placed.groupBy("cluster").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r != s")
    sets = scratch.keep(placed.join(split.select("cluster"), "cluster", "left_semi").select(
        "set", "row", "size", "root"), "open")
    if sets.isEmpty():
        return
    words = scratch.keep(search.marked.select("row", "text").join(small(sets.select("set", "row")), "row").select(
        "set", "text").mapInArrow(_spread, "set long, shingle long"), "shingles")
    counted = words.groupBy("shingle").agg(F.count("*").alias("n"))
    over, under = SHARE
    rarest = Window.partitionBy("set").orderBy("n", "shingle")
    ranked = words.join(counted, "shingle").withColumn("nth", F.row_number().over(rarest))
    kept = ranked.join(sets, "set").filter(
        F.col("nth") <= F.col("size") - F.floor((F.col("size") * over + under - 1) / under) + 1)
    prefixes = scratch.keep(kept.filter("n > 1").select("set", "size", "root", F.col("shingle").alias("key")),
                            "prefixes")
    scratch.drop("shingles")
    for turn in range(2):
        found = scratch.keep(_candidates(prefixes), f"rare-{turn}")
        if found.isEmpty():
            return
        tiles = (_pairs if turn else _tiles)(prefixes, found).join(sets.select("set", "root"), "set")
        search.compare(scratch.keep(tiles, f"rare-tiles-{turn}"), f"rare-{turn}")
        # Keys of one tile are done; of several tiles, what is still open meets in all pairs.
        again = found.filter("tiles > 1").select("key")
        sets = scratch.keep(search.placed(sets.drop("root")), f"open-{turn}")
        prefixes = scratch.keep(prefixes.join(again, "key", "left_semi").drop("root").join(
            sets.select("set", "root"), "set"), f"prefixes-{turn}")


def _pairs(members: DataFrame, found: DataFrame) -> DataFrame:
    """key, tile, set: sets dealt into all pairs of tiles."""
    dealt = members.join(found, "key").select(
        "key", "set", "tiles", F.pmod(F.xxhash64("set", "key"), F.col("tiles")).alias("own"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    return (dealt.select("key", "set", "own", other).filter("own != other")
            .select("key", (F.greatest("own", "other") * (1 << 31) + F.least("own", "other")
                            ).alias("tile"), "set"))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every shingle of every set."""
    for batch in pieces(batches, "text", 1 << 20):
        sets = [shingles(t) for t in texts(batch.column("text"))]
        names = np.repeat(batch.column("set").to_numpy(), [len(s) for s in sets])
        flat = np.concatenate(sets).view(np.int64)
        for at in range(0, len(flat), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[at:at + (1 << 16)]), pa.array(flat[at:at + (1 << 16)])],
                names=["set", "shingle"])


def first_rows(documents: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` (doc_id and text among them) of one row of each component.

    It is the one with the smallest doc_id, null last, then by hash of its columns; of rows that
    are alike any one.  Null and wordless texts are one set.  No rows: no rows.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = documents.select(*columns, F.monotonically_increasing_id().alias("row"))
    schema = T.StructType([*rows.schema.fields, T.StructField("set", T.LongType()),
                           T.StructField("size", T.LongType()),
                           T.StructField("fp", T.LongType()),
                           T.StructField("keys", T.ArrayType(T.LongType()))])
    marked = scratch.keep(rows.mapInArrow(_marker, schema), "rows")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id",
                     F.xxhash64(*columns).alias("code"), "row")
    sets = scratch.keep(marked.groupBy("set").agg(
        F.min(order).alias("first"), F.min(F.struct("row", "size", "fp", "keys")).alias("any"))
        .select("set", "any.*", "first"), "sets")
    linked = roots(scratch, marked, sets)
    named = sets.join(linked, sets["set"] == linked["node"], "left").select(
        "set", F.coalesce("root", "set").alias("root"), "first")
    chosen = named.groupBy("root").agg(F.min("first").alias("first")).select(
        "root", F.col("first.row").alias("row"))
    # Most rows stay: those that go are fewer, and a text need not move to learn that it stays.
    gone = marked.select("row", "set").join(chosen.select("row"), "row", "left_anti").select("row")
    gone = scratch.keep(gone, "gone")
    kept = marked.join(small(gone), "row", "left_anti")
    scratch.drop("sets", "searched", "fitting", "crowd")
    return kept.select(*columns)
