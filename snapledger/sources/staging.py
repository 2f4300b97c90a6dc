"""Intermediate results written once to the shared scratch folder and read several times.

A written table survives lost executors, has exact sizes for the planner, and lets each
check read only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .envelope import entity_columns

Stage = Callable[[DataFrame], DataFrame]


@contextmanager
def staging(spark: SparkSession) -> Iterator[Stage]:
    """A function that writes a frame and hands back the written table; all of them are
    removed at the end."""
    root = scratch_dir(spark, "stage")
    count = 0

    def stage(df: DataFrame) -> DataFrame:
        nonlocal count
        count += 1
        path = f"{root}/{count}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage_columns(stage: Stage, envelope: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Elements of an envelope scan as text columns: those of ``fields`` that occur at all.

    Which ones occur is observed while the columns are written, so documents are parsed once.
    """
    seen = Observation()
    observed = envelope.observe(seen, *[
        F.bool_or(F.map_contains_key("entity", name)).alias(name) for name in fields])
    written = stage(entity_columns(observed, fields))
    return written.drop(*[name for name in fields if not seen.get[name]])
