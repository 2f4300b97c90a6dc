"""Key hygiene: missing keys, duplicates, orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def drop_incomplete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL key go, before any column is filled."""
    return df.dropna(subset=list(keys))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key by ``order`` (arrival: file, then position in it).

    NULL is a key value like any other here.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """Distinct keys of ``df`` that the dimension lacks.

    The keys are made distinct first, so a hot key crosses the join as one row.
    """
    wanted = df.select(key).filter(F.col(key).isNotNull()).distinct()
    known = dimension.select(F.col(dimension_key).alias(key))
    return wanted.join(known, key, "left_anti")


def orphan_sample(orphans: DataFrame, key: str, size: int = 10) -> DataFrame:
    """The first few orphans in key order, for an error message."""
    return orphans.orderBy(key).limit(size)
