"""Numeric coercion of text, guarded ratios and exact half-up means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal literals only: leaves out hex, digit separators, type suffixes, NaN and infinity,
# which a bare TRY_CAST would accept in part.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
#: Measures and capacities may have fractions; six digits of them are kept.
EXACT, EXACT_SUM = "decimal(18,6)", "decimal(24,6)"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def to_number_or_null(text: Column) -> Column:
    """Text to DOUBLE; anything that is not a finite decimal literal becomes NULL."""
    number = F.trim(text).try_cast("double")
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    return F.when(text.rlike(NUMBER_PATTERN), finite)


def _integer(text: Column, kind: str) -> Column:
    """Digit strings only.  A failing TRY_CAST is far slower than the pattern; so it is shown
    only what it can read."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(kind))


def to_long_or_null(text: Column) -> Column:
    """Text to BIGINT, truncating toward zero.  Digit strings never pass through DOUBLE, so ids
    above 2^53 keep every digit."""
    return F.coalesce(_integer(text, "bigint"), to_number_or_null(text).try_cast("bigint"))


def flag_to_number(text: Column) -> Column:
    """JSON booleans arrive as the text ``true``/``false``; map them to 1/0."""
    return F.when(text == "true", F.lit("1")).when(text == "false", F.lit("0")).otherwise(text)


def to_int_or_zero(text: Column) -> Column:
    """Numeric text to INT truncating toward zero, everything else to 0."""
    return F.coalesce(_integer(text, "int"), to_number_or_null(text).try_cast("int"), F.lit(0))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating-point column (write boundary)."""
    floating = {f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType))
                for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(floating) if floating else df


def guarded_ratio(value: Column, capacity: Column, scale: int = 3) -> Column:
    """``value / capacity`` rounded half-up; 0 without a positive capacity, NULL without a value."""
    exact = capacity.cast(EXACT)
    ratio = F.round(value.cast(EXACT) / F.nullif(exact, F.lit(0).cast(EXACT)), scale)
    return (F.when(value.isNull(), F.lit(None))
            .when(exact > 0, ratio)
            .otherwise(F.lit(0))).cast(T.DecimalType(14, scale))


def capped_ratio(value: Column, capacity: Column, scale: int = 3) -> Column:
    """Rounded first, then capped at 1."""
    ratio = guarded_ratio(value, capacity, scale)
    return F.when(ratio.isNotNull(), F.least(ratio, F.lit(1).cast(T.DecimalType(14, scale))))


def mean_half_up(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` of an exact sum, rounded half-up without leaving DECIMAL."""
    divisor = F.nullif(count.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(total.cast(EXACT_SUM) / divisor, scale)


def mean_ratio_half_up(total: Column, count: Column, capacity: Column, scale: int = 3) -> Column:
    """Mean of ``value / capacity`` over a group with one capacity.

    ``sum / (count * capacity)`` is exact; averaging rounded quotients is not.  Without a
    positive capacity every ratio of the group is 0, and so is the mean.
    """
    exact = capacity.cast(EXACT)
    divisor = F.nullif(count.cast("decimal(12,0)") * exact, F.lit(0).cast(EXACT_SUM))
    return F.when(exact > 0, F.round(total.cast(EXACT_SUM) / divisor, scale)) \
        .otherwise(F.lit(0)).cast(T.DecimalType(18, scale))
