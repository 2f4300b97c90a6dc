"""Running a suite: one scan for all row rules, results as rows, then alerts and the gate."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rules import CRITICAL, EXISTS, ROW_COUNT, UNIQUE, Rule, broken, is_row_rule, present

RESULT = T.StructType([
    T.StructField("rule_no", T.IntegerType(), False),
    T.StructField("rule_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
    T.StructField("checked", T.LongType(), True),      # rows the rule looked at
    T.StructField("unexpected", T.LongType(), True),   # rows that break it
    T.StructField("success", T.BooleanType(), False),
])


class QualityGateError(ValueError):
    """A critical rule failed; its results and alerts have been saved."""


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _as_rows(counted: DataFrame, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """One row of counters (``seen<n>``, ``bad<n>``, ``ok<n>``) to one row per rule."""
    structs = []
    for number, rule in rules:
        texts = [_literal(t) for t in (rule.kind, rule.target, rule.severity, rule.reason)]
        values = [str(number), *texts, f"seen{number}", f"bad{number}", f"ok{number}"]
        fields = [f"'{f.name}', CAST({v} AS {f.dataType.simpleString()})"
                  for f, v in zip(RESULT.fields, values)]
        structs.append(f"named_struct({', '.join(fields)})")
    return counted.selectExpr(f"inline(array({', '.join(structs)}))")


def _aggregated(df: DataFrame, rules: Sequence[tuple[int, Rule]],
                snapshot: str | None, element: str | None) -> DataFrame:
    """All rules that need no regrouping of the data, folded into one pass.

    Counters are taken per snapshot (the whole frame is one snapshot by default) and then
    added up; a row-count rule must hold for every snapshot, one without elements included.
    """
    counted_rules = [(n, r) for n, r in rules if is_row_rule(r) and r.column in df.columns]
    real = F.lit(True) if element is None else F.col(f"`{element}`").isNotNull()
    counters = [F.count_if(real).alias("rows")]
    for number, rule in counted_rules:
        counters.append(F.count_if(real & broken(df, rule)).alias(f"bad{number}"))
        counters.append(F.count_if(real & present(df, rule.column)).alias(f"seen{number}"))
    per_snapshot = df.groupBy(snapshot).agg(*counters) if snapshot else df.agg(*counters)

    names = [c for c in per_snapshot.columns if c != snapshot]
    totals = [F.expr(f"coalesce(sum({c}), 0)").alias(c) for c in names]
    totals.append(F.count(F.lit(1)).alias("snapshots"))
    for number, rule in rules:
        if rule.kind == ROW_COUNT:
            outside = f"NOT ({_within('rows', rule)})"
            totals.append(F.expr(f"count_if({outside})").alias(f"off{number}"))
            totals.append(F.expr(f"coalesce(sum(rows) FILTER (WHERE {outside}), 0)")
                          .alias(f"bad{number}"))

    outcomes = []
    for number, rule in rules:
        if rule.kind == ROW_COUNT:
            # Without any row there is no snapshot to count; 0 rows must be acceptable.
            ok = f"CASE WHEN snapshots = 0 THEN {_within('0', rule)} ELSE off{number} = 0 END"
            outcomes += [f"rows AS seen{number}", f"{ok} AS ok{number}"]
        elif rule.column not in df.columns:
            outcomes += [f"NULL AS seen{number}", f"NULL AS bad{number}", f"false AS ok{number}"]
        elif rule.kind == EXISTS:
            outcomes += [f"rows AS seen{number}", f"0 AS bad{number}", f"true AS ok{number}"]
        else:
            outcomes.append(f"bad{number} = 0 AS ok{number}")
    return _as_rows(per_snapshot.agg(*totals).selectExpr("*", *outcomes), rules)


def _within(rows: str, rule: Rule) -> str:
    return f"{rows} BETWEEN {int(rule.params['min_value'])} AND {int(rule.params['max_value'])}"


def _uniqueness(df: DataFrame, number: int, rule: Rule) -> DataFrame:
    """Every member of a repeated value is unexpected; NULLs are ignored.

    Counts are combined before the shuffle, so a hot value crosses it as one row per task.
    """
    groups = (df.filter(present(df, rule.column)).groupBy(F.col(f"`{rule.column}`"))
              .agg(F.count(F.lit(1)).alias("n")))
    counted = groups.selectExpr(f"coalesce(sum(n), 0) AS seen{number}",
                                f"coalesce(sum(n) FILTER (WHERE n > 1), 0) AS bad{number}")
    return _as_rows(counted.selectExpr("*", f"bad{number} = 0 AS ok{number}"), [(number, rule)])


def evaluate(df: DataFrame, rules: Sequence[Rule], snapshot: str | None = None,
             element: str | None = None) -> DataFrame:
    """One row per rule (schema :data:`RESULT`), lazily.

    ``df`` is scanned once for everything but uniqueness, which adds one aggregation on the
    column concerned.  A rule on a missing column fails; it does not raise.  ``snapshot``
    names the column that separates snapshots when ``df`` holds several.  A row whose column
    ``element`` is null only says that its snapshot exists: no rule counts it as a row.
    """
    numbered = list(enumerate(rules, start=1))
    grouped = [(n, r) for n, r in numbered if r.kind == UNIQUE and r.column in df.columns]
    single = [pair for pair in numbered if pair not in grouped]
    frames = [_aggregated(df, single, snapshot, element)] if single else []
    real = df if element is None else df.filter(F.col(f"`{element}`").isNotNull())
    frames += [_uniqueness(real, n, r) for n, r in grouped]
    return reduce(DataFrame.unionByName, frames)


def fetch_results(df: DataFrame, rules: Sequence[Rule], snapshot: str | None = None,
                  element: str | None = None) -> list[Row]:
    """The results on the driver: as many rows as there are rules."""
    return sorted(evaluate(df, rules, snapshot, element).collect(), key=lambda r: r.rule_no)


def validation_row(results: Sequence[Row], suite: str, dag_id: str, at: datetime,
                   extra: dict | None = None) -> dict:
    """The log entry of one suite run; ``details`` holds the counts of every rule."""
    passed = sum(r.success for r in results)
    details = {"rules": [{"rule": r.rule_name, "column": r.column_name, "checked": r.checked,
                          "unexpected": r.unexpected, "success": r.success} for r in results],
               **(extra or {})}
    return {"run_time": at, "dag_id": dag_id, "suite_name": suite,
            "success": passed == len(results), "nb_expectations": len(results),
            "nb_successful": passed, "nb_failed": len(results) - passed,
            "details": json.dumps(details)}


def alerts_of(results: DataFrame, suite: str, dag_id: str, at: Column | datetime) -> DataFrame:
    """One unresolved alert per failed rule, with that rule's own severity and reason."""
    return results.filter(~F.col("success")).select(
        (at if isinstance(at, Column) else F.lit(at)).alias("detected_at"),
        F.lit(dag_id).alias("dag_id"), F.lit(suite).alias("suite_name"),
        "column_name", "rule_name", "severity", F.col("reason").alias("detail"),
        F.lit(False).alias("resolved"))


def gate(results: Sequence[Row], suite: str) -> None:
    """Raise if a critical rule failed."""
    critical = [f"{r.rule_name}({r.column_name})" for r in results
                if not r.success and r.severity == CRITICAL]
    if critical:
        raise QualityGateError(f"{suite}: critical rules failed: {critical}")


def validate(spark: SparkSession, df: DataFrame, rules: Sequence[Rule], suite: str, dag_id: str,
             at: datetime, log, stop_on_critical: bool = True,
             extra: dict | None = None, snapshot: str | None = None,
             element: str | None = None) -> list[Row]:
    """Evaluate, save the validation row, save the alerts, and only then stop if need be.

    ``log`` offers ``validations(rows)`` and ``alerts(df)``; see ``plans.monitoring``.
    """
    results = fetch_results(df, rules, snapshot, element)
    log.validations([validation_row(results, suite, dag_id, at, extra)])
    if any(not r.success for r in results):
        log.alerts(alerts_of(spark.createDataFrame(results, RESULT), suite, dag_id, at))
    if stop_on_critical:
        gate(results, suite)
    return results
