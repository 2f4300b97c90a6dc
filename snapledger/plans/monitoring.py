"""Monitoring tables and the reports over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import mean_half_up
from ..operators.conform import conform, surrogate_key
from ..operators.latest import latest, latest_one
from ..operators.merge import insert_new
from ..quality.contract import verify
from ..schemas import (
    ALERT_DEFAULTS,
    ALERTS,
    ALERTS_CONTRACT,
    FRESHNESS,
    FRESHNESS_CONTRACT,
    RUNS,
    RUNS_CONTRACT,
    VALIDATIONS,
    VALIDATIONS_CONTRACT,
)
from ..sources.tables import AppendTable

#: No threshold is prescribed anywhere: three missed five-minute cycles.
FRESH_MINUTES = 15


class MonitoringLog:
    """The four append-only logs, each partitioned by day.

    While ``repeated`` is set, as for a batch that is offered again, entries whose id is stored
    are not appended a second time.
    """

    repeated = False

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.run_table = AppendTable(spark, f"{root}/pipeline_runs", RUNS, "start_time")
        self.validation_table = AppendTable(
            spark, f"{root}/ge_validation_results", VALIDATIONS, "run_time")
        self.alert_table = AppendTable(
            spark, f"{root}/data_quality_alerts", ALERTS, "detected_at")
        self.freshness_table = AppendTable(
            spark, f"{root}/data_freshness", FRESHNESS, "checked_at")

    def _rows(self, rows: Sequence[dict], schema, keys: Sequence[str]) -> DataFrame:
        given = [f for f in schema.fields if f.name != "id"]
        df = self.spark.createDataFrame(
            [tuple(r.get(f.name) for f in given) for r in rows], type(schema)(given))
        return df.withColumn("id", surrogate_key(keys))

    def _append(self, table: AppendTable, entries: DataFrame) -> None:
        if self.repeated:
            entries = insert_new(table.colliding(entries), entries, ["id"])
        table.append(entries)

    def validations(self, rows: Sequence[dict]) -> None:
        entries = self._rows(rows, VALIDATIONS, ["run_time", "dag_id", "suite_name"])
        verify(entries, VALIDATIONS_CONTRACT)
        self._append(self.validation_table, entries)

    def alerts(self, alerts: DataFrame) -> None:
        """All alerts of one suite run in one write."""
        keyed = alerts.withColumn("id", surrogate_key(
            ["detected_at", "dag_id", "suite_name", "rule_name", "column_name"]))
        rows = conform(keyed, ALERTS, ALERT_DEFAULTS)
        verify(rows, ALERTS_CONTRACT)
        self._append(self.alert_table, rows)

    def run(self, **row) -> None:
        """One attempt.  A retried run may have several; :meth:`runs` makes (dag, run) unique.
        While ``repeated`` is set, a run that has succeeded is not logged again; run ids are
        instants, and no attempt is logged before its run's day."""
        entry = self._rows([row], RUNS, ["dag_id", "run_id", "start_time"])
        verify(entry, replace(RUNS_CONTRACT, unique=()))
        if self.repeated:
            first = datetime.fromisoformat(row["run_id"]).date() - timedelta(days=1)  # clocks differ
            done = self.run_table.read(first).filter("status = 'success'")
            entry = insert_new(done, entry, ["dag_id", "run_id"])
        self.run_table.append(entry)

    def resolve(self, alerts: DataFrame, at: datetime | Column) -> None:
        """Close ``alerts`` (rows of :meth:`open_alerts`): each is appended once more, resolved."""
        self.alert_table.append(conform(resolved(alerts, at), ALERTS, ALERT_DEFAULTS))

    def all_alerts(self) -> DataFrame:
        """Every alert in its last state."""
        return last_state(self.alert_table.read())

    def open_alerts(self) -> DataFrame:
        return self.all_alerts().filter(~F.col("resolved"))

    def freshness(self, rows: DataFrame) -> None:
        rows = conform(rows.withColumn("id", surrogate_key(["checked_at", "source_name"])),
                       FRESHNESS)
        verify(rows, FRESHNESS_CONTRACT)
        self._append(self.freshness_table, rows)

    def recent_runs(self, size: int, dag: str | None = None) -> DataFrame:
        """The newest ``size`` attempts (of ``dag``); only as many days are read as are needed."""
        where = None if dag is None else F.col("dag_id") == dag
        return recent(self.run_table.newest(size, where), "start_time", size, "dag_id", "run_id")

    def recent_open_alerts(self, size: int, days: int | None = None) -> DataFrame:
        """The newest ``size`` open alerts (of the last ``days`` days of the log).

        A resolution is stored on the day of its alert, so whether an alert is open can be told
        from its day alone.
        """
        stored = self.alert_table.days()
        since = stored[-days] if days and days < len(stored) else None
        return recent_open_alerts(last_state(self.alert_table.read(since)), size)

    def last_records(self, sources: Sequence[str]) -> DataFrame:
        """source_name and the newest last_record_time logged for each source."""
        found = [self.freshness_table.newest(1, F.col("source_name") == s)
                 .select("source_name", "last_record_time") for s in sources]
        return reduce(DataFrame.unionByName, found)

    def runs(self) -> DataFrame:
        """One row per (dag, run): a retried run shows its last attempt."""
        return latest_one(self.run_table.read(), ["dag_id", "run_id"],
                          [F.desc("start_time"), F.desc("end_time"), F.desc("status")])


def run_history(runs: DataFrame, dag: str = "dag_id", start: str = "start_time",
                end: str = "end_time", status: str = "status",
                records: str = "records_processed", tiebreak: str = "run_id",
                failed: str = "failed") -> DataFrame:
    """Per dag: runs, failures, mean and longest duration in seconds, records, last status."""
    micros = (F.unix_micros(F.col(end).cast("timestamp"))
              - F.unix_micros(F.col(start).cast("timestamp")))
    finished = F.count("_micros") * 1000000
    return runs.withColumn("_micros", micros).groupBy(dag).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(F.col(status) == failed, 1).otherwise(0)).alias("failures"),
        mean_half_up(F.sum("_micros"), finished, 2).alias("mean_seconds"),
        F.round(F.max("_micros").cast("decimal(18,0)") / 1000000, 2).alias("max_seconds"),
        F.sum(records).alias("records"),
        F.max_by(status, F.struct(start, tiebreak)).alias("last_status"))


def freshness(df: DataFrame, source: str | Column, ts: str, checked_at: datetime | Column,
              threshold_minutes: float = FRESH_MINUTES) -> DataFrame:
    """Per source: newest instant, minutes since then (never negative), fresh or not.

    Instants are compared as session-zone timestamps.
    """
    checked = checked_at if isinstance(checked_at, Column) else F.lit(checked_at)
    newest = df.groupBy((F.col(source) if isinstance(source, str) else source)
                        .alias("source_name")).agg(F.max(ts).alias("last_record_time"))
    micros = (F.unix_micros(checked.cast("timestamp"))
              - F.unix_micros(F.col("last_record_time").cast("timestamp")))
    minutes = F.round(F.greatest(micros, F.lit(0)).cast("decimal(18,0)") / 60000000, 2)
    return newest.filter(F.col("last_record_time").isNotNull()).select(
        checked.alias("checked_at"), "source_name", "last_record_time",
        minutes.cast("decimal(12,2)").alias("delay_minutes"),
        (minutes <= F.lit(threshold_minutes)).alias("is_fresh"))


def latest_validations(validations: DataFrame) -> DataFrame:
    """The newest outcome of each suite."""
    return latest(validations, ["suite_name"], "run_time")


def resolved(alerts: DataFrame, at: datetime | Column) -> DataFrame:
    """The same alerts, resolved at ``at``."""
    return alerts.withColumns({"resolved": F.lit(True),
                               "resolved_at": at if isinstance(at, Column) else F.lit(at)})


def last_state(alerts: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """One row per alert of an append-only log; a resolution outranks the alert itself."""
    return latest_one(alerts, list(key), [F.desc("resolved"), F.asc("resolved_at")])


def open_alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return (alerts.filter(~F.col("resolved")).groupBy("severity")
            .agg(F.count(F.lit(1)).alias("open_alerts"), F.max("detected_at").alias("newest")))


def recent(df: DataFrame, ts: str, size: int, *tiebreak: str) -> DataFrame:
    """The newest ``size`` rows (``TakeOrderedAndProject``: no full sort)."""
    return df.orderBy(F.desc(ts), *tiebreak).limit(size)


def recent_open_alerts(alerts: DataFrame, size: int) -> DataFrame:
    return recent(alerts.filter(~F.col("resolved")), "detected_at", size,
                  "suite_name", "rule_name", "column_name")
