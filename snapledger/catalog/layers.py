"""The bike-share layer builds and whole batch runs on documents packed from the tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.bikeshare import (
    INFORMATION_COLUMNS,
    STATUS_COLUMNS,
    bronze_columns,
    build_readings,
    build_station,
    file_instant,
)
from ..plans.medallion import (
    INFORMATION,
    STATUS,
    Settings,
    Warehouse,
    check_freshness,
    run_batch,
)
from ..session import scratch_dir
from ..sources import explode_payload, land
from ..streaming import start_feed
from .cleaning import RAW_TYPES
from .products import props_k
from .registry import Tables, query
from .sources import PER_DOCUMENT, pack


def _scan(documents: DataFrame, feed: str, stamp) -> DataFrame:
    """Documents as an envelope scan would deliver them: with file name and time."""
    file = F.concat(F.lit(f"bronze/{feed}/{feed}_"), stamp, F.lit("-"), "chunk", F.lit(".json"))
    located = documents.withColumns({
        "file": file, "file_time": F.lit("2024-01-01 00:00:00").cast("timestamp")})
    return explode_payload(located.select("file", "file_time", "payload"), "payload")


def part_information(tables: Tables) -> DataFrame:
    """part as stations, in two snapshots: the second revises the larger parts.

    One brand's ids are not numeric, one type's names are missing, some sizes are unreadable.
    """
    parts = tables("part")

    def snapshot(rows: DataFrame, stamp: str, extra: int) -> DataFrame:
        station = F.when(F.col("p_brand") == "Brand#9", F.concat(F.lit("x"), "p_partkey")) \
            .otherwise(F.col("p_partkey").cast("string"))
        size = F.when(F.col("p_size") == 7, F.lit("n/a")) \
            .otherwise((F.col("p_size") + extra).cast("string"))
        documents = pack(rows, "p_partkey", [
            station.alias("station_id"), F.col("p_brand").alias("stationCode"),
            F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("name"),
            (F.lit(48) + F.col("p_size") / 100).alias("lat"), F.lit("2.5").alias("lon"),
            size.alias("capacity"), F.lit(None).cast("string").alias("station_opening_hours")])
        return _scan(documents, "station_information", F.lit(stamp))

    return snapshot(parts, "20240101_080000", 0).unionByName(
        snapshot(parts.filter("p_size > 25"), "20240101_080500", 100))


@query("station_build", """
    SELECT p_partkey AS id_station, p_brand AS code_station, p_name AS nom,
           48 + p_size / 100.0::DOUBLE AS latitude, 2.5::DOUBLE AS longitude,
           CASE WHEN p_size = 7 THEN 0 WHEN p_size > 25 THEN p_size + 100 ELSE p_size END::BIGINT
               AS capacite, NULL::VARCHAR AS horaires_ouverture
    FROM part WHERE p_brand <> 'Brand#9' AND p_type <> 'PROMO'""")
def station_build(tables: Tables) -> DataFrame:
    return build_station(bronze_columns(part_information(tables), INFORMATION_COLUMNS))


CADENCE_MINUTES = 5


def status_documents(tables: Tables) -> DataFrame:
    """events as status documents (chunk, payload, stamp), one every five minutes; users are the
    stations and occur several times in a document."""
    events = tables("events").select("*", props_k())
    raw = F.when(F.col("event_type") == "view", F.concat(F.col("k").cast("string"), F.lit(".9"))) \
        .otherwise(F.col("k").cast("string"))
    documents = pack(events, "event_id", [
        F.col("user_id").alias("station_id"), F.col("event_type").alias("stationCode"),
        raw.alias("num_bikes_available"),
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise((100 - F.col("k")).cast("string")).alias("num_docks_available"),
        F.expr(RAW_TYPES.replace("any", "mechanical").replace("', event_type, '", "ebike"))
        .alias("num_bikes_available_types"),
        (F.col("k") > 50).alias("is_installed"), F.lit(1).alias("is_returning"),
        F.lit("true").alias("is_renting"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("last_reported")])
    seconds = F.lit(1704067200) + F.col("chunk") * CADENCE_MINUTES * 60
    return documents.withColumn("stamp", F.timestamp_seconds(seconds))


def event_status(tables: Tables, where: str = "true") -> DataFrame:
    """The status documents (those for which ``where`` holds) as scanned."""
    return _scan(status_documents(tables).filter(where), "station_status",
                 F.date_format("stamp", "yyyyMMdd_HHmmss"))


READING_SQL = f"""
    SELECT user_id AS id_station, event_type AS code_station, date_collecte,
           k AS velos_disponibles,
           CASE WHEN event_type = 'error' THEN 0 ELSE 100 - k END AS bornes_disponibles,
           CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 2 ELSE 1 END::BIGINT
               AS velos_mecaniques,
           CASE event_type WHEN 'error' THEN 0 ELSE k END AS velos_electriques,
           CASE WHEN k > 50 THEN 1 ELSE 0 END::BIGINT AS est_installee,
           1::BIGINT AS retour_possible, 1::BIGINT AS location_possible,
           date_trunc('second', ts)::TIMESTAMP AS dernier_signalement
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_collecte
                                       ORDER BY event_id) AS rn
          FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                       TIMESTAMP '2024-01-01 00:00:00'
                       + to_minutes(CAST({CADENCE_MINUTES} * (event_id // {PER_DOCUMENT}) AS BIGINT))
                       AS date_collecte FROM events))
    WHERE rn = 1"""


def _without_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("reading_build", READING_SQL)
def reading_build(tables: Tables) -> DataFrame:
    readings = build_readings(bronze_columns(event_status(tables), STATUS_COLUMNS),
                              file_instant())
    return _without_zone(readings, "date_collecte", "dernier_signalement").drop("id_releve")


def customer_documents(tables: Tables) -> DataFrame:
    return pack(tables("customer"), "c_custkey", [
        F.col("c_custkey").alias("station_id"), F.col("c_mktsegment").alias("stationCode"),
        F.col("c_name").alias("name"), F.lit(48.5).alias("lat"), F.lit(2.5).alias("lon"),
        F.col("c_nationkey").alias("capacity"), F.lit("24/7").alias("station_opening_hours")])


def customer_information(tables: Tables) -> DataFrame:
    return _scan(customer_documents(tables), "station_information", F.lit("20240101_000000"))


def loaded_warehouse(tables: Tables) -> Warehouse:
    """A full batch run: all gates, contracts, merges and gold tables."""
    warehouse = Warehouse(tables.spark, scratch_dir(tables.spark, "warehouse"))
    at = datetime(2024, 1, 31, tzinfo=timezone.utc)
    run_batch(warehouse, customer_information(tables), event_status(tables), at,
              Settings(rows=(1, 10**12)))
    return warehouse


CURRENT_SQL = f"""
    WITH reading AS ({READING_SQL})
    SELECT id_station, c_name AS nom, 48.5::DOUBLE AS latitude, 2.5::DOUBLE AS longitude,
           CAST(c_nationkey AS BIGINT) AS capacite, velos_disponibles, bornes_disponibles,
           velos_mecaniques, velos_electriques,
           CASE WHEN c_nationkey > 0 THEN least(
               ((2000 * velos_disponibles + c_nationkey) // (2 * c_nationkey)) / 1000.0, 1.0)
               ELSE 0.0 END::DOUBLE AS taux_disponibilite,
           velos_disponibles = 0 AS est_vide, bornes_disponibles = 0 AS est_pleine,
           date_collecte AS derniere_collecte
    FROM reading r JOIN customer ON c_custkey = id_station
    WHERE date_collecte = (SELECT max(date_collecte) FROM reading m
                           WHERE m.id_station = r.id_station)"""

HOURLY_SQL = f"""
    SELECT id_station, c_name AS nom, heure,
           ((200 * total + n) // (2 * n)) / 100.0::DOUBLE AS moy_velos_disponibles,
           CASE WHEN c_nationkey > 0
                THEN ((2000 * total + n * c_nationkey) // (2 * n * c_nationkey)) / 1000.0
                ELSE 0.0 END::DOUBLE AS moy_taux_disponibilite,
           nb_fois_vide, n AS nb_observations
    FROM (SELECT id_station, extract(hour FROM date_collecte)::BIGINT AS heure,
                 CAST(sum(velos_disponibles) AS BIGINT) AS total, count(*) AS n,
                 CAST(sum(CASE WHEN velos_disponibles = 0 THEN 1 ELSE 0 END) AS BIGINT)
                     AS nb_fois_vide
          FROM ({READING_SQL}) GROUP BY 1, 2) JOIN customer ON c_custkey = id_station"""


@query("medallion_current", CURRENT_SQL)
def medallion_current(tables: Tables) -> DataFrame:
    return _without_zone(loaded_warehouse(tables).current.read(), "derniere_collecte")


@query("medallion_hourly", HOURLY_SQL)
def medallion_hourly(tables: Tables) -> DataFrame:
    return loaded_warehouse(tables).hourly.read()


@query("medallion_cycles", HOURLY_SQL)
def medallion_cycles(tables: Tables) -> DataFrame:
    """Three cycles: half of the documents, then some of these again with others, then the rest,
    each of which is older than documents seen before.  A cycle without a document is no cycle."""
    warehouse = Warehouse(tables.spark, scratch_dir(tables.spark, "warehouse"))
    for day, where in ((29, "chunk % 4 < 2"), (30, "chunk % 4 IN (1, 2)"), (31, "chunk % 4 = 3")):
        status = event_status(tables, where)
        if not status.isEmpty():
            run_batch(warehouse, customer_information(tables), status,
                      datetime(2024, 1, day, tzinfo=timezone.utc), Settings(rows=(1, 10**12)))
    return warehouse.hourly.read()


def fed_warehouse(tables: Tables) -> Warehouse:
    """Documents landed and consumed by the feed, which is stopped and started again: first three
    of four, then one of them again with those left out, which are late by then."""
    spark = tables.spark
    root = scratch_dir(spark, "feed")
    warehouse = Warehouse(spark, f"{root}/warehouse")

    def landed(documents: DataFrame, feed: str) -> None:
        land(documents.withColumn("feed", F.lit(feed)), f"{root}/bronze", "feed", "stamp", "payload")

    landed(customer_documents(tables).withColumn("stamp", F.lit("2024-01-01").cast("timestamp")), INFORMATION)
    for where in ("chunk % 4 <> 2", "chunk % 4 IN (1, 2)"):
        landed(status_documents(tables).filter(where), STATUS)
        start_feed(warehouse, f"{root}/bronze/feed={INFORMATION}", f"{root}/bronze/feed={STATUS}",
                   f"{root}/checkpoint", Settings(rows=(1, 10**12))).awaitTermination()
    return warehouse


@query("stream_medallion", CURRENT_SQL)
def stream_medallion(tables: Tables) -> DataFrame:
    return _without_zone(fed_warehouse(tables).current.read(), "derniere_collecte")


@query("stream_monitoring", f"""
    WITH reading AS ({READING_SQL}),
    numbered AS (SELECT *, CAST(epoch(date_collecte - TIMESTAMP '2024-01-01') AS BIGINT)
                           // {CADENCE_MINUTES * 60} % 4 AS part FROM reading),
    warned AS (  -- the docks of an error cannot be read, which is worth a warning in each batch
        SELECT CAST(bool_or(part <> 2) AS BIGINT) + CAST(bool_or(part IN (1, 2)) AS BIGINT) AS n
        FROM (SELECT event_id // {PER_DOCUMENT} % 4 AS part FROM events WHERE event_type = 'error'))
    SELECT 'pipeline_runs' AS log, 'silver_transformation' AS name, 'success' AS outcome,
           count(*) FILTER (part <> 2) AS n FROM numbered
    UNION ALL SELECT 'pipeline_runs', 'silver_transformation', 'success', count(*) FILTER (part = 2) FROM numbered
    UNION ALL SELECT 'pipeline_runs', 'gold_transformation', 'success',
              count(DISTINCT id_station) FILTER (part <> 2) FROM numbered JOIN customer ON c_custkey = id_station
    UNION ALL SELECT 'pipeline_runs', 'gold_transformation', 'success',
              count(DISTINCT id_station) FROM numbered JOIN customer ON c_custkey = id_station
    UNION ALL SELECT 'ge_validation_results', s, 'true', 2
              FROM (SELECT unnest(['silver_station_suite', 'silver_releve_suite', 'gold_suite']) AS s)
    UNION ALL SELECT 'ge_validation_results', 'bronze_suite', 'false', n FROM warned WHERE n > 0
    UNION ALL SELECT 'ge_validation_results', 'bronze_suite', 'true', 2 - coalesce(n, 0) FROM warned
              WHERE coalesce(n, 0) < 2
    UNION ALL SELECT 'data_quality_alerts', 'bronze_suite', 'WARNING', n FROM warned WHERE n > 0
    UNION ALL SELECT 'data_freshness', 'station_information', '2024-01-01 00:00:00', 3
    UNION ALL SELECT 'data_freshness', 'station_status', strftime(newest, '%Y-%m-%d %H:%M:%S'), count(*) FROM (
        SELECT max(date_collecte) AS newest FROM numbered WHERE part <> 2
        UNION ALL SELECT max(date_collecte) FROM numbered WHERE part IN (1, 2)
        UNION ALL SELECT max(date_collecte) FROM numbered) GROUP BY newest""")
def stream_monitoring(tables: Tables) -> DataFrame:
    """What both runs of the feed have logged, and a check of freshness by the clock after them."""
    warehouse = fed_warehouse(tables)
    check_freshness(warehouse, datetime(2024, 1, 31, tzinfo=timezone.utc))
    log = warehouse.log
    runs = log.run_table.read().select(
        F.lit("pipeline_runs").alias("log"), F.col("dag_id").alias("name"),
        F.col("status").alias("outcome"), F.col("records_processed").alias("n"))
    counted = [
        (log.validation_table, "ge_validation_results", "suite_name", F.col("success").cast("string")),
        (log.alert_table, "data_quality_alerts", "suite_name", F.col("severity")),
        (log.freshness_table, "data_freshness", "source_name",
         F.date_format("last_record_time", "yyyy-MM-dd HH:mm:ss"))]
    for table, log_name, name, outcome in counted:
        runs = runs.unionByName(table.read().groupBy(
            F.lit(log_name).alias("log"), F.col(name).alias("name"), outcome.alias("outcome")).agg(
            F.count(F.lit(1)).alias("n")))
    return runs
