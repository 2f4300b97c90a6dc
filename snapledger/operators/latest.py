"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import is_small


def latest(df: DataFrame, keys: Sequence[str], ts: str,
           within: DataFrame | None = None, spread: int = 1) -> DataFrame:
    """All rows whose ``ts`` is the greatest of their key; tied rows are all kept.  Rows with a
    NULL key or instant are none of them.

    ``within`` is a dimension keyed by ``keys``: only its keys are wanted, its other columns
    are joined on.  If its rows are counted to fit a broadcast, so do the maxima, which come
    from a hash aggregate over two columns: they are joined back on key and instant, and the
    history is not shuffled.

    Otherwise ``rank = 1`` is taken in one scan.  Spark limits the groups before the shuffle
    (``WindowGroupLimit``), so a key sends its local maxima of each input partition and nothing
    else, whether it is hot, or unknown to the dimension.

    With ``spread`` above 1, rows that tie at the maximum of a key are dealt over so many tasks;
    see :func:`spread_latest`.
    """
    keys = list(keys)
    rows = df.dropna(subset=[*keys, ts])
    if within is not None and is_small(within):
        newest = rows.groupBy(*keys).agg(F.max(ts).alias(ts)).join(within, keys)
        return rows.join(F.broadcast(newest), [*keys, ts])
    if spread > 1:
        newest = spread_latest(rows, keys, ts, spread)
        return newest if within is None else newest.join(within, keys)
    window = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    others = [c for c in df.columns if c not in (*keys, ts)]
    newest = (rows.withColumn("_rank", F.rank().over(window)).filter("_rank = 1")
              .select(*keys, ts, *others))
    return newest if within is None else newest.join(within, keys)


def spread_latest(rows: DataFrame, keys: Sequence[str], ts: str, spread: int) -> DataFrame:
    """The latest rows of each key, where a key may have masses of tied ones.

    Rows are dealt into ``spread`` parts of their key.  Each part is ranked by itself, limited
    before the shuffle, so no task holds more of a key than one part.  The maxima of the keys,
    from a hash aggregate over two columns, are repeated for each part and joined to it.  That
    is ``spread`` small rows for each key: for keys that are few beside the rows.
    """
    keys = list(keys)
    part = F.pmod(F.monotonically_increasing_id(), F.lit(spread)).cast("int")
    window = Window.partitionBy(*keys, "_part").orderBy(F.col(ts).desc())
    local = (rows.withColumn("_part", part).withColumn("_rank", F.rank().over(window))
             .filter("_rank = 1").drop("_rank"))
    newest = rows.groupBy(*keys).agg(F.max(ts).alias(ts)).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    others = [c for c in rows.columns if c not in (*keys, ts)]
    return local.join(newest, [*keys, "_part", ts]).select(*keys, ts, *others)


def latest_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``, which must be total within a key.

    Spark limits the groups before the shuffle (``WindowGroupLimit``), so a key sends at
    most one row per input partition.  NULL keys form no group and are dropped.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.dropna(subset=list(keys)).withColumn("_rank", F.row_number().over(window))
            .filter("_rank = 1").drop("_rank"))
