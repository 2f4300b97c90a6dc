"""Merging a batch into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import duplicated_keys


class DuplicateKeys(ValueError):
    """A merge source holds several rows for one key."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise unless ``keys`` identify the rows of ``df``; one aggregate, one number back."""
    count = duplicated_keys(df, keys).agg(F.count(F.lit(1))).first()[0]
    if count:
        raise DuplicateKeys(f"{count} values of {list(keys)} occur more than once")
    return df


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` inserted or overwritten; nothing is deleted.

    ``source`` must be unique on ``keys``.  Only its keys enter the join, so for a batch
    that fits a broadcast the target is filtered where it lies.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``source`` whose key is not in ``target``: what an insert-ignore appends."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def dedup_batch(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key of a (micro-)batch.

    Repeats in later batches are left to :func:`insert_new` against the table.  There is no
    watermark: a key that arrives for the first time is kept however late it is.
    """
    return df.dropDuplicates(list(keys))
