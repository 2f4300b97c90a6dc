"""The six rule types.  A rule is data; this module turns it into aggregate expressions."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import to_number_or_null

CRITICAL, WARNING = "CRITICAL", "WARNING"

# The names under which results and alerts are recorded.
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
UNIQUE = "expect_column_values_to_be_unique"
ROW_COUNT = "expect_table_row_count_to_be_between"


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None = None
    params: dict[str, Any] = field(default_factory=dict)
    severity: str = WARNING
    reason: str = ""

    @property
    def target(self) -> str:
        return self.column or "table"


def exists(column: str, severity: str = CRITICAL, reason: str = "") -> Rule:
    return Rule(EXISTS, column, {}, severity, reason)


def not_null(column: str, severity: str = CRITICAL, reason: str = "") -> Rule:
    return Rule(NOT_NULL, column, {}, severity, reason)


def between(column: str, low, high, severity: str = WARNING, reason: str = "") -> Rule:
    return Rule(BETWEEN, column, {"min_value": low, "max_value": high}, severity, reason)


def in_set(column: str, values, severity: str = WARNING, reason: str = "") -> Rule:
    return Rule(IN_SET, column, {"value_set": list(values)}, severity, reason)


def unique(column: str, severity: str = CRITICAL, reason: str = "") -> Rule:
    return Rule(UNIQUE, column, {}, severity, reason)


def row_count(low: int, high: int, severity: str = CRITICAL, reason: str = "") -> Rule:
    return Rule(ROW_COUNT, None, {"min_value": low, "max_value": high}, severity, reason)


def present(df: DataFrame, name: str) -> Column:
    """Neither NULL nor NaN."""
    value = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def broken(df: DataFrame, rule: Rule) -> Column:
    """Row-level predicate: does this row break the rule?  Never NULL."""
    value = F.col(f"`{rule.column}`")
    there = present(df, rule.column)
    if rule.kind == NOT_NULL:
        return ~there
    is_text = isinstance(df.schema[rule.column].dataType, T.StringType)
    if rule.kind == BETWEEN:
        low, high = rule.params["min_value"], rule.params["max_value"]
        if is_text and not isinstance(low, str):
            # Raw feeds hold text; what cannot be read as a number is out of range.
            value = to_number_or_null(value)
        inside = value.between(F.lit(low), F.lit(high))
    elif rule.kind == IN_SET:
        values = rule.params["value_set"]
        inside = value.isin([str(v) if is_text else v for v in values])
    else:
        raise ValueError(f"{rule.kind} is not a row-level rule")
    return there & ~F.coalesce(inside, F.lit(False))


def is_row_rule(rule: Rule) -> bool:
    return rule.kind in (NOT_NULL, BETWEEN, IN_SET)
