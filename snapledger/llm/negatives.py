"""Hard negatives of labelled vectors: exact integer products of tiles, merged heaps.

Vectors are made integer and dealt into tiles of anchors and of candidates.  A task multiplies one
pair of tiles by Strassen's recursion on int64 and keeps, for each anchor, the best few scores of
the tile; the heaps of all tiles of an anchor are merged by a ranking that Spark limits before
the shuffle.  The first round finds positives among rows of the same label, the second one
negatives in the window that each positive opens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Factor before components are rounded down (fixed by contract).
SCALE = 256
#: Rows of a tile at most, and bytes of a tile of wide vectors.
TILE, TILE_BYTES = 2048, 1 << 24
#: Anchors that are multiplied with a tile at once: bounds the matrix of scores.
STRIP = 256
#: A matrix with a side of this or less is multiplied directly.
LEAF = 32

_LEAST = np.iinfo(np.int64).min
_EXACT = 1 << 63


def _even(a: np.ndarray) -> np.ndarray:
    """With a row and a column of zeros where their number is odd."""
    out = np.zeros([n + n % 2 for n in a.shape], dtype=a.dtype)
    out[:len(a), :a.shape[1]] = a
    return out


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and of ``b`` by Strassen's recursion.

    Odd sides are padded with a zero.  int64 sums wrap, so that intermediates may exceed its
    range as long as the products themselves do not; other integers can be given as objects.
    """
    m, n, k = len(a), len(b), a.shape[1]
    if min(m, n, k) <= LEAF:
        return a @ b.T if a.dtype == object or not m * n * k else np.einsum("ik,jk->ij", a, b)
    if m % 2 or n % 2 or k % 2:
        return multiply(_even(a), _even(b))[:m, :n]
    m, n, k = m // 2, n // 2, k // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b21, b12, b22 = b[:n, :k], b[:n, k:], b[n:, :k], b[n:, k:]
    out = np.empty((2 * m, 2 * n), dtype=a.dtype)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    part = multiply(a11 + a22, b11 + b22)
    c11[:], c22[:] = part, part
    part = multiply(a21 + a22, b11)
    c21[:] = part
    c22 -= part
    part = multiply(a11, b12 - b22)
    c12[:] = part
    c22 += part
    part = multiply(a22, b21 - b11)
    c11 += part
    c21 += part
    part = multiply(a11 + a12, b22)
    c11 -= part
    c12 += part
    c22 += multiply(a21 - a11, b11 + b12)
    c11 += multiply(a12 - a22, b21 + b22)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of two matrices of whole numbers held as doubles, exact, as int64.

    Where a score might not fit, Python's integers are multiplied; a score beyond int64 is held
    at the end of its range.
    """
    reach = max(1, a.shape[1]) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if reach < _EXACT:
        return multiply(a.astype(np.int64), b.astype(np.int64))
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(multiply(whole(a), whole(b)), _LEAST + 1, _EXACT - 1).astype(np.int64)


def heap(scores: np.ndarray, allowed: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, column) of the ``size`` best allowed scores of every row, of equals the first."""
    held = np.where(allowed, np.maximum(scores, _LEAST + 1), _LEAST)
    line = np.arange(len(held))
    for _ in range(min(size, held.shape[1])):
        at = held.argmax(axis=1)
        live = held[line, at] > _LEAST
        if not live.any():
            return
        yield line[live], at[live]
        held[line, at] = _LEAST


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Components made whole, short vectors padded with zeros."""
    vectors = column.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * out)


class _Tile:
    def __init__(self, table: pa.Table, width: int):
        ids, rows = (table.column(c).to_numpy() for c in ("id", "row"))
        order = np.lexsort((rows, ids))
        self.table = table.take(pa.array(order))
        self.id, self.row = ids[order], rows[order]
        self.label = self.table.column("label").to_numpy()
        self.vectors = _matrix(self.table.column("v"), width)


def _positives(width: int, size: int) -> Callable:
    def work(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        a, c = _Tile(anchors, width), _Tile(candidates, width)
        found = [np.zeros((4, 0), dtype=np.int64)]
        for label in np.unique(a.label):
            own, theirs = np.flatnonzero(a.label == label), np.flatnonzero(c.label == label)
            for strip in np.split(own, range(STRIP, len(own), STRIP)):
                scores = products(a.vectors[strip], c.vectors[theirs])
                other = a.row[strip][:, None] != c.row[theirs]
                for line, at in heap(scores, other, size):
                    found.append(np.stack([a.row[strip[line]], c.id[theirs[at]], c.row[theirs[at]],
                                           scores[line, at]]))
        rows = np.concatenate(found, axis=1)
        return pa.table(dict(zip(("anchor", "id", "row", "score"), rows)))

    return work


def _negatives(width: int, size: int, low: int, high: int) -> Callable:
    def work(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        a, c = _Tile(anchors, width), _Tile(candidates, width)
        wanted = a.table.column("wanted").to_pylist()
        found = [np.zeros((7, 0), dtype=np.int64)]
        for first in range(0, len(a.id), STRIP):
            part = slice(first, first + STRIP)
            scores = products(a.vectors[part], c.vectors)
            other = a.label[part][:, None] != c.label
            for k in range(max(map(len, wanted[part]), default=0)):
                has = np.array([w for w, p in enumerate(wanted[part]) if len(p) > k])
                chosen = [wanted[first + w][k] for w in has]
                score = [p["score"] for p in chosen]
                least = np.array([-(-low * s // 100) for s in score], dtype=np.int64)
                most = np.array([high * s // 100 for s in score], dtype=np.int64)
                inside = (other[has] & (scores[has] >= least[:, None])
                          & (scores[has] <= most[:, None]))
                for line, at in heap(scores[has], inside, size):
                    found.append(np.stack([
                        a.row[part][has[line]], np.full(len(line), k),
                        np.array([chosen[w]["id"] for w in line], dtype=np.int64),
                        np.array([score[w] for w in line], dtype=np.int64),
                        c.id[at], c.row[at], scores[has[line], at]]))
        rows = np.concatenate(found, axis=1)
        return pa.table(dict(zip(("anchor", "k", "positive_id", "positive_score", "id", "row", "score"),
                                 rows)))

    return work


def _finite(vector: Column) -> Column:
    scaled = F.transform(vector, lambda x: x.cast("double") * SCALE)
    return ~F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, tile: int = TILE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` holds vec_id, embedding, label; ``anchor`` says which of them are anchors.  A score
    is the inner product of two vectors whose components are multiplied by 256 and rounded down.
    The positives of an anchor are the best ``positives`` other rows of its label, the negatives
    of a positive the best ``negatives`` rows of other labels whose score is ``low`` to ``high``
    per cent of the positive's.  Equal scores go by vec_id.

    Rows with a null id, label, vector or component, or a component that is not finite (also
    after multiplication), take no part.  Vectors of different lengths are padded with zeros.
    Repeated rows are rows like others: each is an anchor, and a positive of its twin.  A score
    beyond a long is held at the end of its range.  No rows or no anchors: no rows.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    vector = F.transform("embedding", lambda x: x.cast("double"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull()
              & F.col("embedding").isNotNull() & F.coalesce(_finite(F.col("embedding")), F.lit(False)))
    kept = scratch.keep(rows.filter(usable).select(
        F.col("vec_id").cast("long").alias("id"), "label", vector.alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.monotonically_increasing_id().alias("row")), "rows")
    total = kept.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"),
                     F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    tile = max(1, min(tile, TILE_BYTES // (8 * max(1, total.width))))
    across, down = max(1, -(-total.n // tile)), max(1, -(-total.anchors // tile))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    candidates = kept.drop("anchor").select("*", own(across, 1).alias("x")).select(
        "*", numbers(down).alias("y")).groupBy("x", "y")

    def tiles(anchors: DataFrame, work: Callable, schema: str, name: str) -> DataFrame:
        placed = anchors.select("*", own(down, 2).alias("y")).select("*", numbers(across).alias("x"))
        return scratch.keep(placed.groupBy("x", "y").cogroup(candidates).applyInArrow(work, schema), name)

    def merged(heaps: DataFrame, size: int, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
        return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)

    anchors = kept.filter("anchor").drop("anchor")
    best = merged(tiles(anchors, _positives(total.width, positives),
                        "anchor long, id long, row long, score long", "positives"), positives, "anchor")
    wanted = best.groupBy("anchor").agg(F.array_sort(F.collect_list(
        F.struct("rank", "id", "score"))).alias("wanted"))
    asked = scratch.keep(anchors.join(wanted, anchors["row"] == wanted["anchor"]).drop("anchor"), "asked")
    found = tiles(asked, _negatives(total.width, negatives, low, high),
                  "anchor long, k long, positive_id long, positive_score long, id long, row long, "
                  "score long", "negatives")
    ranked = merged(found, negatives, "anchor", "k")
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return ranked.join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
