"""Shards of equal size by vector bin packing on bytes, tokens and rows.

Rows with equal text form a group.  Groups are packed as bundles: a group that is large for a
shard is a bundle of its own, or several if no shard can hold it; all others are hashed into a
fixed number of bundles, so that the packing itself sees a bounded number of vectors whatever the
size of the corpus.
Bundles are placed from large to small, each on the shard where the dot product of its vector
with the residual capacity is highest, among those whose bytes still have room for it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, text_key

SHARDS = 40
#: Bundles of small groups per shard.  A group above 1 / LARGE of a shard (in bytes, tokens or
#: rows) is packed by itself, so there are at most 3 * SHARDS * LARGE of those; one above a whole
#: shard is cut into pieces of about 2 / LARGE of a shard.
BUNDLES, LARGE = 256, 64
#: Bytes of a row besides its text (fixed by contract).
ROW_BYTES = 16


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each bundle; ``vectors`` are in units of one shard's fair share."""
    load = np.zeros((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), dtype=np.int32)
    for k in np.lexsort((np.arange(len(vectors)), -vectors.max(axis=1))):
        v = vectors[k]
        residual = 1.0 - load
        fits = residual[:, 0] >= v[0]
        score = np.where(fits, residual @ v, -np.inf) if fits.any() else residual[:, 0]
        out[k] = np.argmax(score)
        load[out[k]] += v
    return out


def pack(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, tokens, text_crc32, shard, slot for every row of ``documents``.

    Only ``doc_id`` and ``text`` are read.  ``size`` is the text's UTF-8 bytes plus 16, a token
    is a word between ASCII white space, slots of a shard run from 0 without gaps.  A null text
    counts as empty.  Rows with equal text share a shard unless together they are more than a
    shard's fair share of bytes, tokens or rows, then they are dealt out in pieces, also those
    that repeat one id.  A very long text is one row and stays whole.  Repeated rows and null ids
    are rows like others.  No rows: no rows.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "sharding")
    text = text_key()
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    rows = scratch.keep(documents.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.size(words).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("same"),
        F.monotonically_increasing_id().alias("row")), "rows")

    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
            F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    fair = np.maximum(np.array([total.bytes or 0, total.tokens or 0, total.rows], float), 1) / shards
    share = F.greatest(*[F.col(c) / float(f) for c, f in zip(("bytes", "tokens", "rows"), fair)])
    large = (rows.groupBy("same").agg(*sums).withColumn("share", share)
             .filter(F.col("share") > 1 / LARGE).orderBy("same").collect())
    # Rows of a group that is cut are told apart by their ids, by their place if ids repeat.
    over = [g.same for g in large if g.share > 1]
    ids = rows.filter(F.col("same").isin(over)).groupBy("same", "doc_id").count()
    repeated = {r.same for r in ids.groupBy("same").agg(F.max("count").alias("most")).collect()
                if r.most > 1} if over else set()
    bundles = shards * BUNDLES
    base, table = bundles, []
    for group in large:
        cut = 1 if group.share <= 1 else min(group.rows, int(np.ceil(group.share * LARGE / 2)))
        table.append((group.same, base, cut, group.same in repeated))
        base += cut
    heavy = F.broadcast(spark.createDataFrame(table, "same long, base long, cut long, places boolean"))
    code = F.when(F.col("places"), F.xxhash64("row")).otherwise(F.xxhash64(F.coalesce("doc_id", "row")))
    piece = F.col("base") + F.pmod(code, "cut")
    bundle = F.when(F.col("base").isNotNull(), piece).otherwise(F.pmod(F.xxhash64("same"), F.lit(bundles)))
    rows = rows.join(heavy, "same", "left").withColumn("bundle", bundle).drop("base", "cut", "places")

    packed = rows.groupBy("bundle").agg(*sums).orderBy("bundle").collect()
    vectors = np.array([[r.bytes, r.tokens, r.rows] for r in packed], float).reshape(-1, 3) / fair
    shard = place(vectors, shards)
    offset, filled = [], [0] * shards
    for r, s in zip(packed, shard.tolist()):
        offset.append(filled[s])
        filled[s] += r.rows
    where = spark.createDataFrame(
        [(r.bundle, s, o) for r, s, o in zip(packed, shard.tolist(), offset)],
        "bundle long, shard int, first long")
    order = Window.partitionBy("bundle").orderBy("same", "doc_id", "row")
    return (rows.withColumn("nth", F.row_number().over(order) - 1)
            .join(F.broadcast(where), "bundle")
            .select("doc_id", "size", "tokens", "text_crc32", "shard",
                    (F.col("first") + F.col("nth")).cast("long").alias("slot")))
