"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register ``f(tables) -> DataFrame`` under ``name`` with the SQL it must agree with."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(pin_utc(spark), folder)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Common numeric types for comparison: DECIMAL as DOUBLE, integers as BIGINT."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            casts[field.name] = F.col(field.name).cast("bigint")
    return df.withColumns(casts) if casts else df
