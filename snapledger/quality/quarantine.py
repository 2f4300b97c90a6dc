"""Opt-in row quarantine: mark each row with the row-level rules it breaks, then split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rules import Rule, broken, is_row_rule

VIOLATIONS = "_violations"


def mark(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_violations``: ``rule(column)`` for every broken row-level rule, in rule order.

    Map-only, so both halves can be written from one scan by partitioning on the split.
    """
    named = [F.when(broken(df, r), F.lit(f"{r.kind}({r.column})"))
             for r in rules if is_row_rule(r) and r.column in df.columns]
    marks = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return df.withColumn(VIOLATIONS, marks)


def valid(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def rejected(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(VIOLATIONS) > 0)
