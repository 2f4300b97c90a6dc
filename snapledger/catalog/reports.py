"""Monitoring reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.monitoring import (
    freshness,
    last_state,
    latest_validations,
    open_alerts_by_severity,
    recent,
    recent_open_alerts,
    resolved,
    run_history,
)
from ..session import scratch_dir
from ..sources import AppendTable
from .products import props_k
from .quality import ALERTS_SQL, line_alerts
from .registry import Tables, query

RUNS_SQL = """(SELECT event_type AS dag_id, event_id, ts AS start_time,
    CAST(round(value * 100) AS BIGINT) * 10000 AS micros,
    CASE WHEN k < 10 THEN 'failed' ELSE 'success' END AS status, k AS records
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


@query("run_history", f"""
    SELECT dag_id, count(*) AS runs,
           CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failures,
           ((2 * CAST(sum(micros) AS BIGINT) + count(*) * 10000) // (2 * count(*) * 10000))
               / 100.0::DOUBLE AS mean_seconds,
           max(micros) / 1000000.0::DOUBLE AS max_seconds,
           CAST(sum(records) AS BIGINT) AS records,
           arg_max(status, (start_time, event_id)) AS last_status
    FROM {RUNS_SQL} GROUP BY dag_id""")
def history(tables: Tables) -> DataFrame:
    """events as a run log: ``value`` is the duration, a low count a failure."""
    micros = F.round(F.col("value") * 100).cast("bigint") * 10000
    runs = tables("events").select("*", props_k()).select(
        F.col("event_type").alias("dag_id"), F.col("event_id").alias("run_id"),
        F.col("ts").alias("start_time"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + micros)
        .alias("end_time"),
        F.when(F.col("k") < 10, "failed").otherwise("success").alias("status"),
        F.col("k").alias("records_processed"))
    return run_history(runs)


@query("freshness", """
    SELECT TIMESTAMP '2024-01-31 00:00:00' AS checked_at, source_name, last_record_time,
           ((2 * us + 600000) // 1200000) / 100.0::DOUBLE AS delay_minutes,
           ((2 * us + 600000) // 1200000) / 100.0 <= 30 AS is_fresh
    FROM (SELECT event_type AS source_name, max(ts) AS last_record_time,
                 greatest(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts)), 0) AS us
          FROM events GROUP BY event_type)""")
def source_freshness(tables: Tables) -> DataFrame:
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return freshness(tables("events"), "event_type", "ts", at, threshold_minutes=30)


@query("open_alerts_recent", ALERTS_SQL
       + " ORDER BY detected_at DESC, suite_name, rule_name, column_name LIMIT 3")
def alerts_recent(tables: Tables) -> DataFrame:
    return recent_open_alerts(line_alerts(tables), 3)


@query("open_alerts_by_severity", f"""
    SELECT severity, count(*) AS open_alerts, max(detected_at) AS newest
    FROM ({ALERTS_SQL}) WHERE NOT resolved GROUP BY severity""")
def alerts_by_severity(tables: Tables) -> DataFrame:
    return open_alerts_by_severity(line_alerts(tables))


@query("open_alerts_after_resolution", f"""
    SELECT severity, count(*) AS open_alerts, max(detected_at) AS newest
    FROM ({ALERTS_SQL}) WHERE severity <> 'WARNING' OR column_name = 'l_quantity'
    GROUP BY severity""")
def alerts_after_resolution(tables: Tables) -> DataFrame:
    """Warnings but those on quantities have been resolved, as further rows of the log."""
    log = line_alerts(tables)
    closed = resolved(log.filter("severity = 'WARNING' AND column_name <> 'l_quantity'"),
                      F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    states = last_state(log.unionByName(closed, allowMissingColumns=True),
                        ["detected_at", "dag_id", "suite_name", "rule_name", "column_name"])
    return open_alerts_by_severity(states)


@query("freshness_silent_source", """
    SELECT TIMESTAMP '2024-01-31 00:00:00' AS checked_at, source_name, last_record_time,
           ((2 * us + 600000) // 1200000) / 100.0::DOUBLE AS delay_minutes,
           ((2 * us + 600000) // 1200000) / 100.0 <= 1440 AS is_fresh
    FROM (SELECT event_type AS source_name, max(ts) AS last_record_time,
                 greatest(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts)), 0) AS us
          FROM events WHERE event_type <> 'error' OR ts < TIMESTAMP '2024-01-15 00:00:00'
          GROUP BY event_type)""")
def silent_freshness(tables: Tables) -> DataFrame:
    """A source that fell silent weeks ago is judged by what is stored, not by a batch."""
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    stored = tables("events").filter("event_type <> 'error' OR ts < '2024-01-15 00:00:00'")
    return freshness(stored, "event_type", "ts", at, threshold_minutes=1440)


@query("latest_validation", """
    SELECT suite_name, run_time, event_id, success FROM (
        SELECT event_type AS suite_name, ts AS run_time, event_id, value >= 50 AS success,
               max(ts) OVER (PARTITION BY event_type) AS newest FROM events)
    WHERE run_time = newest""")
def validations(tables: Tables) -> DataFrame:
    """events as a validation log: the newest outcome of each suite."""
    return latest_validations(tables("events").select(
        F.col("event_type").alias("suite_name"), F.col("ts").alias("run_time"), "event_id",
        (F.col("value") >= 50).alias("success")))


@query("recent_runs_lookback", """
    SELECT event_type AS dag_id, ts AS start_time, event_id AS run_id FROM events
    WHERE event_type = 'purchase' ORDER BY ts DESC, event_id LIMIT 20""")
def recent_lookback(tables: Tables) -> DataFrame:
    """The same over a log kept by day: days are opened from the newest on, until 20 are found."""
    table = AppendTable(tables.spark, scratch_dir(tables.spark, "runs"), T.StructType.fromDDL(
        "dag_id string not null, start_time timestamp_ntz not null, run_id long not null"), "start_time")
    table.append(tables("events").select(F.col("event_type").alias("dag_id"),
                                         F.col("ts").alias("start_time"), F.col("event_id").alias("run_id")))
    purchases = table.newest(20, F.col("dag_id") == "purchase")
    return recent(purchases, "start_time", 20, "run_id")


@query("recent_runs", """
    SELECT event_type, ts, event_id, value FROM events WHERE event_type = 'purchase'
    ORDER BY ts DESC, event_id LIMIT 20""")
def recent_runs(tables: Tables) -> DataFrame:
    """The newest entries of one dag in a log."""
    log = tables("events").filter("event_type = 'purchase'")
    return recent(log.select("event_type", "ts", "event_id", "value"), "ts", 20, "event_id")
