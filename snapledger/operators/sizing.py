"""Broadcasting behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; exact file sizes for a plain scan, no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's own broadcast threshold in bytes; -1 turns broadcasting off."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def counted_bytes(df: DataFrame) -> int:
    """Bytes of the rows themselves: eight per value, and the length of texts and binaries.

    One aggregate.  Unlike the estimate it knows nothing of compression and sees what an
    explode makes.  Nested values count by their text.
    """
    parts = [F.lit(8 * len(df.columns) + 8)]
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(column.cast("string")), F.lit(0)))
    return int(df.agg(F.coalesce(F.sum(sum(parts[1:], parts[0]).cast("bigint")), F.lit(0))).first()[0])


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` fits a broadcast: first by the estimate, which costs nothing, and then by
    its counted bytes, which no compression or explode can belie."""
    limit = broadcast_limit(df)
    return estimated_bytes(df) <= limit and counted_bytes(df) <= limit
