"""Analytic products: current state, profiles, indicators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import capped_ratio, guarded_ratio
from ..operators import (
    current_state,
    hourly_partials,
    hourly_profile,
    latest,
    latest_one,
    network_kpis,
    partials_to_profile,
)
from ..operators.profiles import Roles
from ..session import scratch_dir
from ..sources import overwrite_days
from .registry import Tables, query

STOCK = Roles(key="partkey", ts="l_shipdate", available="quantity", capacity="p_size",
              free="l_discount", label="p_name")
USAGE = Roles(key="user_id", ts="ts", available="k", capacity="capacity", label="c_name")


def stock_readings(tables: Tables) -> DataFrame:
    """lineitem as a fact: part, instant, available units."""
    return tables("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("partkey"), "l_shipdate",
        F.col("l_quantity").cast("int").alias("quantity"), "l_discount")


def stock_dimension(tables: Tables) -> DataFrame:
    return tables("part").select(F.col("p_partkey").alias("partkey"), "p_name", "p_size")


def usage_readings(tables: Tables) -> DataFrame:
    """events as a fact: user, instant, the count held in ``props``."""
    return tables("events").select("event_id", "user_id", "ts", "event_type", props_k())


def props_k():
    return F.get_json_object("props", "$.k").cast("int").alias("k")


def usage_dimension(tables: Tables) -> DataFrame:
    """customer as a dimension; the nation number plays the capacity, some are 0."""
    return tables("customer").select(F.col("c_custkey").alias("user_id"), "c_name",
                                     F.col("c_nationkey").alias("capacity"))


def stock_state(tables: Tables) -> DataFrame:
    facts = stock_readings(tables).drop("l_orderkey", "l_linenumber")
    return current_state(facts, stock_dimension(tables), STOCK)


STATE_SQL = """
    SELECT l_partkey AS partkey, l_shipdate, CAST(l_quantity AS BIGINT) AS quantity, l_discount,
           p_name, CAST(p_size AS BIGINT) AS p_size,
           CASE WHEN p_size > 0 THEN least(
                ((2000 * CAST(l_quantity AS BIGINT) + p_size) // (2 * p_size)) / 1000.0, 1.0)
                ELSE 0.0 END::DOUBLE AS ratio,
           l_quantity = 0 AS is_empty, l_discount = 0 AS is_full
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    WHERE l_shipdate = (SELECT max(m.l_shipdate) FROM lineitem m
                        WHERE m.l_partkey = l.l_partkey)"""


@query("latest_snapshot", STATE_SQL)
def latest_snapshot(tables: Tables) -> DataFrame:
    return stock_state(tables)


@query("latest_event_per_user", """
    SELECT user_id, event_id, ts, event_type, k, c_name FROM (
        SELECT user_id, event_id, ts, event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) e JOIN customer ON c_custkey = user_id
    WHERE rn = 1""")
def latest_event_per_user(tables: Tables) -> DataFrame:
    newest = latest_one(usage_readings(tables), ["user_id"],
                        [F.desc("ts"), F.desc("event_id")])
    return newest.join(usage_dimension(tables).drop("capacity"), "user_id")


@query("latest_ties", """
    SELECT l_returnflag, shipped, l_orderkey, l_linenumber FROM (
        SELECT *, date_trunc('quarter', l_shipdate)::TIMESTAMP AS shipped FROM lineitem)
    QUALIFY rank() OVER (PARTITION BY l_returnflag ORDER BY shipped DESC) = 1""")
def latest_ties(tables: Tables) -> DataFrame:
    """Few keys with masses of rows at the greatest instant, dealt over tasks."""
    lines = tables("lineitem").select("l_returnflag", F.date_trunc("quarter", "l_shipdate").cast(
        "timestamp_ntz").alias("shipped"), "l_orderkey", "l_linenumber")
    return latest(lines, ["l_returnflag"], "shipped", spread=32)


def _profile_sql(fact: str, key: str, label: str, capacity: str, value: str, bucket: str) -> str:
    return f"""
    SELECT {key}, {label}, bucket,
           ((200 * total + n) // (2 * n)) / 100.0::DOUBLE AS mean_available,
           CASE WHEN {capacity} > 0
                THEN ((2000 * total + n * {capacity}) // (2 * n * {capacity})) / 1000.0
                ELSE 0.0 END::DOUBLE AS mean_ratio,
           times_empty, n AS observations
    FROM (SELECT {key}, {label}, {capacity}, {bucket} AS bucket, CAST(sum(v) AS BIGINT) AS total,
                 CAST(sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS BIGINT) AS times_empty,
                 count(*) AS n
          FROM (SELECT *, {value} AS v FROM {fact}) GROUP BY ALL)"""


HOURLY_SQL = _profile_sql(
    fact="(SELECT user_id, ts, props, c_name, CAST(c_nationkey AS BIGINT) AS capacity "
         "FROM events JOIN customer ON c_custkey = user_id)",
    key="user_id", label="c_name", capacity="capacity",
    value="CAST(json_extract_string(props, '$.k') AS BIGINT)",
    bucket="CAST(extract(hour FROM ts) AS BIGINT)")


@query("hourly_profile", HOURLY_SQL)
def hourly_profile_ordered(tables: Tables) -> DataFrame:
    profile = hourly_profile(usage_readings(tables), usage_dimension(tables), USAGE)
    return profile.orderBy("user_id", "bucket")


@query("hourly_profile_incremental", HOURLY_SQL)
def hourly_profile_incremental(tables: Tables) -> DataFrame:
    """Partials of two loads, kept per day in a table, rolled up afterwards.  The second load
    starts within the first one's last day and rewrites that day."""
    path = scratch_dir(tables.spark, "partials")
    readings = usage_readings(tables)
    first_end, second_start = date(2024, 1, 16), date(2024, 1, 15)
    for load in (readings.filter(F.col("ts") < F.lit(first_end).cast("timestamp_ntz")),
                 readings.filter(F.col("ts") >= F.lit(second_start).cast("timestamp_ntz"))):
        overwrite_days(hourly_partials(load, USAGE, day=F.to_date("ts")), path)
    return partials_to_profile(tables.spark.read.parquet(path), usage_dimension(tables), USAGE)


@query("hourly_ratio", _profile_sql(
    fact="(SELECT l_partkey AS partkey, l_shipdate, l_quantity, p_name, "
         "CAST(p_size AS BIGINT) AS p_size FROM lineitem JOIN part ON p_partkey = l_partkey)",
    key="partkey", label="p_name", capacity="p_size", value="CAST(l_quantity AS BIGINT)",
    bucket="CAST(extract(month FROM l_shipdate) AS BIGINT)"))
def hourly_ratio(tables: Tables) -> DataFrame:
    return hourly_profile(stock_readings(tables), stock_dimension(tables), STOCK,
                          bucket=F.month("l_shipdate"))


KPI_SQL = f"""
    SELECT count(*) AS keys,
           CAST(sum(CASE WHEN is_empty THEN 1 ELSE 0 END) AS BIGINT) AS empty_keys,
           CAST(sum(CASE WHEN is_full THEN 1 ELSE 0 END) AS BIGINT) AS full_keys,
           ((2 * CAST(sum(CAST(round(ratio * 1000) AS BIGINT)) AS BIGINT) + count(ratio))
            // (2 * nullif(count(ratio), 0))) / 1000.0::DOUBLE AS mean_ratio,
           CAST(sum(quantity) AS BIGINT) AS total_available,
           CAST(sum(p_size) AS BIGINT) AS total_free,
           max(l_shipdate) AS last_update
    FROM ({STATE_SQL})"""


def _kpis(state: DataFrame) -> DataFrame:
    return network_kpis(state, "quantity", "p_size", "l_shipdate")


@query("network_kpis", KPI_SQL)
def network(tables: Tables) -> DataFrame:
    return _kpis(stock_state(tables))


@query("network_kpis_empty", KPI_SQL + " WHERE quantity < 0")
def network_empty(tables: Tables) -> DataFrame:
    return _kpis(stock_state(tables).filter("quantity < 0"))


@query("network_view", KPI_SQL)
def network_view(tables: Tables) -> DataFrame:
    """The indicators as a view, computed when it is read."""
    _kpis(stock_state(tables)).createOrReplaceTempView("network_indicators")
    return tables.spark.sql("SELECT * FROM network_indicators")


@query("guarded_ratio", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, partkey, q AS quantity,
           CASE WHEN cap > 0 THEN ((2000 * q + cap) // (2 * cap)) / 1000.0 ELSE 0.0 END::DOUBLE
               AS ratio,
           CASE WHEN cap > 0 THEN least(((2000 * q + cap) // (2 * cap)) / 1000.0, 1.0)
                ELSE 0.0 END::DOUBLE AS capped
    FROM (SELECT l_orderkey, l_linenumber, l_partkey AS partkey,
                 CAST(l_quantity AS BIGINT) AS q, CAST(p_size - 1 AS BIGINT) AS cap
          FROM lineitem JOIN part ON p_partkey = l_partkey)""")
def ratios(tables: Tables) -> DataFrame:
    """Every reading against a capacity that is 0 for some parts."""
    capacity = F.col("p_size") - 1
    return stock_readings(tables).join(stock_dimension(tables), "partkey").select(
        "l_orderkey", "l_linenumber", "partkey", "quantity",
        guarded_ratio(F.col("quantity"), capacity).alias("ratio"),
        capped_ratio(F.col("quantity"), capacity).alias("capped"))
