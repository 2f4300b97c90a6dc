"""Table contracts: what a database would enforce on write, checked before publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..operators.keys import duplicated_keys, orphan_keys, orphan_sample


class ContractViolation(ValueError):
    """A frame breaks the contract of the table it is meant for."""


@dataclass(frozen=True)
class TableContract:
    """Constraints in the order in which they are reported.

    ``checks`` are SQL predicates; as in SQL, a NULL outcome passes.  ``foreign_keys`` map a
    column to ``(table, column)``.
    """

    name: str
    required: Sequence[str] = ()
    not_null: Sequence[str] = ()
    not_blank: Sequence[str] = ()
    checks: Sequence[str] = ()
    max_length: Mapping[str, int] | None = None
    digits: Mapping[str, tuple[int, int]] | None = None
    unique: Sequence[Sequence[str]] = ()
    foreign_keys: Mapping[str, tuple[str, str]] | None = None

    def row_constraints(self) -> list[tuple[str, Column]]:
        """``(constraint, predicate of a violating row)``."""
        found = [(f"not_null({c})", F.col(c).isNull()) for c in self.not_null]
        found += [(f"not_blank({c})", is_blank(F.col(c).cast("string"))) for c in self.not_blank]
        found += [(f"check({p})", ~F.expr(p)) for p in self.checks]
        found += [(f"max_length({c}, {n})", F.length(c) > n)
                  for c, n in (self.max_length or {}).items()]
        found += [(f"digits({c}, {p}, {s})",
                   F.abs(F.round(F.col(c).cast("decimal(38,10)"), s)) >= F.lit(10 ** (p - s)))
                  for c, (p, s) in (self.digits or {}).items()]
        return found


def contract_counts(df: DataFrame, contract: TableContract,
                    tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``constraint_no, constraint, violations`` for every constraint, lazily.

    Row constraints share one scan.  A uniqueness constraint counts the rows in repeated
    key groups, a foreign key the distinct keys without a parent.
    """
    missing = [c for c in contract.required if c not in df.columns]
    if missing:
        raise ContractViolation(f"{contract.name}: missing columns {missing}")
    rows = contract.row_constraints()
    frames = []
    if rows:
        counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, bad) in enumerate(rows)])
        frames.append(_as_rows(counted, 0, [name for name, _ in rows]))
    number = len(rows)
    for keys in contract.unique:
        total = duplicated_keys(df, list(keys)).selectExpr(
            f"coalesce(sum(rows), 0) AS c{number}")
        frames.append(_as_rows(total, number, [f"unique({', '.join(keys)})"]))
        number += 1
    for column, (table, parent) in (contract.foreign_keys or {}).items():
        orphans = orphan_keys(df, (tables or {})[table], column, parent)
        frames.append(_as_rows(orphans.selectExpr(f"count(1) AS c{number}"), number,
                               [f"foreign_key({column} -> {table}.{parent})"]))
        number += 1
    return reduce(DataFrame.unionByName, frames)


def _as_rows(counted: DataFrame, first: int, names: Sequence[str]) -> DataFrame:
    """One row of counters ``c<n>`` to one row per constraint."""
    quoted = [n.replace("\\", "\\\\").replace("'", "\\'") for n in names]
    structs = [f"named_struct('constraint_no', {i}, 'constraint', '{n}', "
               f"'violations', CAST(c{i} AS BIGINT))" for i, n in enumerate(quoted, first)]
    return counted.selectExpr(f"inline(array({', '.join(structs)}))")


def verify(df: DataFrame, contract: TableContract,
           tables: Mapping[str, DataFrame] | None = None) -> None:
    """Raise on the first broken constraint; an orphan is reported with sample keys."""
    counts = sorted(contract_counts(df, contract, tables).collect(),
                    key=lambda r: r.constraint_no)
    broken = next((r for r in counts if r.violations), None)
    if broken is None:
        return
    message = f"{contract.name}: {broken.constraint} broken by {broken.violations} "
    if not broken.constraint.startswith("foreign_key"):
        raise ContractViolation(message + "rows")
    index = broken.constraint_no - len(contract.row_constraints()) - len(contract.unique)
    column, (table, parent) = list((contract.foreign_keys or {}).items())[index]
    sample = orphan_sample(orphan_keys(df, tables[table], column, parent), column)
    raise ContractViolation(message + f"keys, first {[r[0] for r in sample.collect()]}")
