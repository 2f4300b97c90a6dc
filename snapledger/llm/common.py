"""Helpers that several operators share: staged tables, Arrow columns, skew-safe lookups."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc, scratch_dir

#: White space of the word definition shared by the word-based operators (fixed by contract).
SPACES = " \t\n\x0b\f\r"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver has it, and keep time zones out."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    return pin_utc(spark)


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs only its tasks and
    nothing is computed twice."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root = spark, scratch_dir(spark, purpose)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Enough partitions for ``rows``, and never fewer than the session shuffles into."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // per_partition))


def small(table: DataFrame, limit: int = 1 << 21) -> DataFrame:
    """A narrow table, to be broadcast if it is counted to have at most ``limit`` rows; a larger
    one is left to an ordinary join."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def lookup(left: DataFrame, table: DataFrame, key: str, weight: str, total: int,
           hot: int = 1000) -> DataFrame:
    """``left`` joined to the one row that ``table`` has for each value of ``key``.

    ``weight`` is the number of rows of ``left`` with that value.  Values with more than
    ``total / hot`` rows are at most ``hot`` in number, so their rows of ``table`` are
    broadcast and the rows of ``left`` that carry them stay where they are; all others go
    through an ordinary join.
    """
    heavy = F.col(weight) * hot > total
    often = F.broadcast(table.filter(heavy).drop(weight))
    rest = left.join(often.select(key), key, "left_anti")
    return left.join(often, key).unionByName(rest.join(table.filter(~heavy).drop(weight), key))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 22
           ) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (at least one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if n is None else n for n in pc.binary_length(
            batch.column(column)).to_pylist()], dtype=np.int64)
        bins = (np.cumsum(sizes) - sizes) // limit
        starts = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a partition; callers size partitions so that this is bounded."""
    kept = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(kept).combine_chunks() if kept else None


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def text_key(name: str = "text") -> Column:
    """A column without nulls for text."""
    return F.coalesce(F.col(name), F.lit(""))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text leaves ``remainder``; a null id is never held out."""
    code = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(code % modulus == remainder, F.lit(False))
