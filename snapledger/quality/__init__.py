"""Declarative quality rules, suites with a severity gate, table contracts, quarantine."""

from .contract import ContractViolation, TableContract, contract_counts, verify
from .engine import (
    QualityGateError,
    alerts_of,
    evaluate,
    fetch_results,
    gate,
    validate,
    validation_row,
)
from .quarantine import mark, rejected, valid
from .rules import Rule, between, exists, in_set, not_null, row_count, unique

__all__ = [
    "ContractViolation", "QualityGateError", "Rule", "TableContract", "alerts_of", "between",
    "contract_counts", "evaluate", "exists", "fetch_results", "gate", "in_set", "mark",
    "not_null", "rejected", "row_count", "unique", "valid", "validate", "validation_row",
    "verify",
]
