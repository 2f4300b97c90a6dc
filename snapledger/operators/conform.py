"""Bringing a frame to a table's declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import nan_to_null


def conform(df: DataFrame, schema: T.StructType,
            defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Select, order and cast to ``schema``; fill defaults; NaN to NULL.

    Casts are ANSI: a value the target type cannot hold fails the job.  A column absent
    from ``df`` takes its default, or NULL if the schema allows it.
    """
    defaults = defaults or {}
    absent = [f.name for f in schema.fields
              if f.name not in df.columns and f.name not in defaults and not f.nullable]
    if absent:
        raise ValueError(f"no value for required columns {absent}")
    df = nan_to_null(df)

    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]))
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def surrogate_key(keys: Sequence[str]) -> Column:
    """A repeatable 64-bit id from the natural key; needs no global sequence.

    A hash: two keys can share an id once a table has billions of rows.  Such tables take
    :func:`packed_key`.
    """
    return F.xxhash64(*[F.col(k) for k in keys])


#: Microseconds of any instant of the years 1 to 9999, moved by ``_SHIFT``, lie within 0 and this.
_INSTANTS = 10 ** 18
_SHIFT = 10 ** 17


def packed_key(number: str, instant: str) -> Column:
    """A DECIMAL(38,0) that holds a 64-bit number and an instant, so no two keys share one:
    ``number * 10^18 + microseconds since 1970 + 10^17``."""
    micros = F.unix_micros(F.col(instant).cast("timestamp")).cast("decimal(19,0)")
    high = F.col(number).cast("decimal(19,0)") * F.lit(_INSTANTS).cast("decimal(19,0)")
    return (high.cast("decimal(38,0)") + (micros + F.lit(_SHIFT))).cast("decimal(38,0)")


def unpacked_key(key: str) -> tuple[Column, Column]:
    """The number and the instant that a :func:`packed_key` holds."""
    low = F.pmod(F.col(key), F.lit(_INSTANTS).cast("decimal(38,0)"))
    number = ((F.col(key) - low) / F.lit(_INSTANTS).cast("decimal(19,0)")).cast("bigint")
    return number, F.timestamp_micros((low - F.lit(_SHIFT)).cast("bigint"))
