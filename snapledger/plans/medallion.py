"""Batch runs bronze -> silver -> gold over a warehouse folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import batch_instant
from ..operators.merge import insert_new, upsert
from ..operators.profiles import roll_up
from ..quality.contract import verify
from ..quality.engine import validate
from ..quality.quarantine import mark, rejected, valid
from ..quality.rules import ROW_COUNT
from ..quality.suites import (
    SNAPSHOT_ROWS,
    bronze_suite,
    gold_suite,
    reading_suite,
    station_suite,
)
from ..schemas import (
    CURRENT,
    CURRENT_CONTRACT,
    DAMAGED,
    HOURLY,
    HOURLY_CONTRACT,
    PARTIALS,
    READING,
    READING_CONTRACT,
    READING_KEY,
    REJECTED_READING,
    SETTLED,
    STATION,
    STATION_CONTRACT,
    SUSPECT_STATION,
)
from ..sources.envelope import read_envelope
from ..sources.landing import LANDED_GLOB, latest_snapshot
from ..sources.staging import Stage, stage_columns, staging
from ..sources.tables import AppendTable, VersionedTable, first_day, overwrite_days
from .bikeshare import (
    INFORMATION_COLUMNS,
    STATUS_COLUMNS,
    build_current,
    build_hourly,
    build_readings,
    build_station,
    daily_partials,
    known_latest,
    network_sql,
    origin_instant,
    unreadable_counts,
)
from .monitoring import MonitoringLog, freshness

SILVER_DAG = "silver_transformation"
GOLD_DAG = "gold_transformation"
INFORMATION, STATUS = "station_information", "station_status"
NETWORK_VIEW = "indicateurs_reseau"


@dataclass(frozen=True)
class Settings:
    """``rows`` bounds one snapshot; ``variant`` is ``runtime`` or ``full``.

    ``incremental`` derives gold from the batch and the previous gold instead of re-reading
    the whole history; both give the same tables.  Hourly sums of days more than
    ``settle_days`` before the newest reading are not added up again in every cycle.

    With ``quarantine`` readings that break a row rule are set aside instead of merged, and
    stations that do are listed as suspect; without it such rows only raise alerts.

    A reading must belong to a station of its own batch.  ``known_stations`` also accepts those
    of earlier batches, as is needed to catch up on snapshots older than the station document.
    """

    rows: tuple[int, int] = SNAPSHOT_ROWS
    variant: str = "runtime"
    incremental: bool = True
    settle_days: int = 7
    quarantine: bool = False
    known_stations: bool = False
    fresh_minutes: float = 15


class Warehouse:
    """Where the tables live."""

    def __init__(self, spark: SparkSession, root: str, database: str = "default"):
        root = root.rstrip("/")
        self.spark, self.database = spark, database
        self.station = VersionedTable(spark, f"{root}/silver/station", STATION)
        self.reading = AppendTable(
            spark, f"{root}/silver/releve_disponibilite", READING, "date_collecte")
        self.rejected = AppendTable(
            spark, f"{root}/silver/releve_rejete", REJECTED_READING, "date_collecte")
        self.suspect = VersionedTable(spark, f"{root}/silver/station_suspecte", SUSPECT_STATION)
        self.damaged = AppendTable(spark, f"{root}/bronze/damaged", DAMAGED, "file_time")
        self.partials_path = f"{root}/silver/partials_horaires"
        self.settled = VersionedTable(spark, f"{root}/silver/cumuls_horaires", SETTLED)
        self.current = VersionedTable(spark, f"{root}/gold/disponibilite_courante", CURRENT)
        self.hourly = VersionedTable(spark, f"{root}/gold/tendance_horaire", HOURLY)
        self.log = MonitoringLog(spark, f"{root}/monitoring")

    def partials(self) -> DataFrame:
        return self.spark.read.schema(PARTIALS).parquet(self.partials_path)

    def define_views(self) -> None:
        """Point the catalog at the published version.

        The view is stored in the session catalog, so every session that shares it sees the
        version of the last publication under the same name, and computes the view when it reads.
        """
        path = self.current.current_path()
        if path:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{NETWORK_VIEW} AS "
                           + network_sql(f"parquet.`{path}`"))


def run_latest(wh: Warehouse, information_path: str, status_path: str, at: datetime,
               settings: Settings = Settings(), glob: str = LANDED_GLOB,
               instant: datetime | Column | None = None) -> None:
    """One cycle over the newest snapshot of each feed.

    ``instant`` defaults to the document's own stamp, so that a repeat changes nothing;
    pass ``at`` to stamp readings with the time of the run instead.
    """
    information, status = (read_envelope(wh.spark, latest_snapshot(wh.spark, path, glob), glob=glob)
                           for path in (information_path, status_path))
    run_batch(wh, information, status, at, settings, instant)


def run_batch(wh: Warehouse, information: DataFrame, status: DataFrame, at: datetime,
              settings: Settings = Settings(), instant: datetime | Column | None = None) -> None:
    """Envelopes of any number of snapshots to silver, then gold, with a run-log entry."""
    def silver() -> tuple:
        return run_silver(wh, information, status, at, settings, instant)

    batch = _logged(wh, SILVER_DAG, at, silver)
    _logged(wh, GOLD_DAG, at, lambda: run_gold(wh, at, settings, since=batch[1]))


def _logged(wh: Warehouse, dag: str, at: datetime, step: Callable[[], tuple]) -> tuple:
    """Run ``step``; its outcome goes to the run log, its first result as record count."""
    entry = {"dag_id": dag, "run_id": at.isoformat(), "start_time": datetime.now(timezone.utc)}
    try:
        result = step()
    except Exception as error:
        wh.log.run(**entry, end_time=datetime.now(timezone.utc), status="failed",
                   error_message=str(error))
        raise
    wh.log.run(**entry, end_time=datetime.now(timezone.utc), status="success",
               records_processed=result[0])
    return result


def run_silver(wh: Warehouse, information: DataFrame, status: DataFrame, at: datetime,
               settings: Settings = Settings(),
               instant: datetime | Column | None = None) -> tuple[int, date | None]:
    """Validate, transform, validate, check, merge.

    Nothing is merged unless every gate and contract holds; what the gates found is saved
    either way.  Returns the number of new readings and the first day of the batch.
    """
    spark, log = wh.spark, wh.log
    with staging(spark) as stage:
        bronze = stage_columns(stage, status, STATUS_COLUMNS)
        validate(spark, bronze, bronze_suite(settings.rows), "bronze_suite", SILVER_DAG, at, log,
                 snapshot="file", element="pos")
        described = stage_columns(stage, information, INFORMATION_COLUMNS)
        station = stage(build_station(described))
        reading = stage(build_readings(bronze, origin_instant(bronze) if instant is None else instant))
        validate(spark, station, station_suite(settings.rows, settings.variant),
                 "silver_station_suite", SILVER_DAG, at, log)
        validate(spark, reading, reading_suite(settings.rows), "silver_releve_suite",
                 SILVER_DAG, at, log, snapshot="date_collecte",
                 extra={"read_as_zero": unreadable_counts(bronze).first().asDict()})
        if settings.quarantine:
            reading = set_aside(wh, stage, station, reading, settings)
        verify(station, STATION_CONTRACT)
        parents = station.select("id_station")
        if settings.known_stations:
            parents = parents.unionByName(wh.station.read().select("id_station"))
        verify(reading, READING_CONTRACT, {"station": parents})
        merged = merge_silver(wh, station, reading)
        log_freshness(wh, described, reading, at, settings)
        return merged


def set_aside(wh: Warehouse, stage: Stage, station: DataFrame, reading: DataFrame,
              settings: Settings) -> DataFrame:
    """Store the offending rows and return the readings that break no rule."""
    suspects = rejected(mark(station, station_suite(settings.rows, settings.variant)))
    wh.suspect.replace(suspects)
    marked = stage(mark(reading, reading_suite(settings.rows)))
    bad = rejected(marked)
    wh.rejected.append(insert_new(wh.rejected.colliding(bad), bad, READING_KEY))
    return valid(marked)


def merge_silver(wh: Warehouse, station: DataFrame, reading: DataFrame) -> tuple[int, date | None]:
    """Upsert the dimension, then append the readings not yet stored."""
    wh.station.replace(upsert(wh.station.read(), station, ["id_station"]))
    span = wh.reading.span_of(reading)
    count = wh.reading.append(insert_new(wh.reading.colliding(reading, span), reading, READING_KEY))
    return count, span and first_day(span)


def log_freshness(wh: Warehouse, information: DataFrame, reading: DataFrame, at: datetime,
                  settings: Settings) -> None:
    """How old the newest snapshot of each feed is."""
    seen = reading.select(F.lit(STATUS).alias("source"), F.col("date_collecte").alias("instant"))
    seen = seen.unionByName(information.select(
        F.lit(INFORMATION).alias("source"), batch_instant(origin_instant(information)).alias("instant")))
    wh.log.freshness(freshness(seen, "source", "instant", at, settings.fresh_minutes))


def check_freshness(wh: Warehouse, at: datetime, settings: Settings = Settings()) -> None:
    """Log the freshness of both feeds by what is stored, to be called on a timer: it needs no
    batch, so a feed that has gone silent is reported as well.  A feed never read is not reported.
    """
    known = wh.log.last_records([INFORMATION, STATUS]).select(
        F.col("source_name").alias("source"), F.col("last_record_time").alias("instant"))
    stored = wh.current.read().select(
        F.lit(STATUS).alias("source"), F.col("derniere_collecte").alias("instant"))
    wh.log.freshness(freshness(known.unionByName(stored), "source", "instant", at,
                               settings.fresh_minutes))


def run_gold(wh: Warehouse, at: datetime, settings: Settings = Settings(),
             since: date | None = None) -> tuple[int]:
    """Current state, then hourly trend, then validation that alerts but never stops.

    With ``since`` (the first day of the batch) and ``incremental`` set, only the days
    from there on are read, or from the newest gold row on if that is older, so that a cycle
    whose gold step failed is made up for by the next one.
    """
    stations, published = wh.station.read(), wh.current.read()
    newest = published.agg(F.to_date(F.max("derniere_collecte"))).first()[0]
    incremental = settings.incremental and since is not None and newest is not None
    recent_from = min(since, newest) if incremental else None
    recent = wh.reading.read(recent_from)

    # Only the days read are rewritten; partials of other days stay as they are.  This comes
    # before the current state moves the starting point of the next cycle.
    overwrite_days(daily_partials(recent), wh.partials_path)

    candidates = recent
    if incremental:
        known = known_latest(published)
        # A reading may come from both sides; ties are kept by latest(), so remove it here.
        candidates = (recent.select(*known.columns).unionByName(known)
                      .dropDuplicates(READING_KEY))
    wh.current.replace(upsert(published, build_current(candidates, stations), ["id_station"]),
                       check=lambda written: verify(written, CURRENT_CONTRACT))
    current = wh.current.read()

    sums = hourly_sums(wh, recent_from, settings.settle_days)
    wh.hourly.replace(build_hourly(sums, stations), sort=["id_station", "heure"],
                      check=lambda written: verify(written, HOURLY_CONTRACT))
    wh.define_views()

    results = validate(wh.spark, current, gold_suite(settings.rows, settings.variant),
                       "gold_suite", GOLD_DAG, at, wh.log, stop_on_critical=False)
    return (next(r.checked for r in results if r.rule_name == ROW_COUNT),)


def hourly_sums(wh: Warehouse, changed_from: date | None, settle_days: int) -> DataFrame:
    """Partials of the whole history, days long past already added up.

    The settled sums and the day they reach are one table version, so they cannot disagree.
    They advance as days pass; a change to a settled day (``None``: any day) rebuilds them.
    """
    partials, settled = wh.partials(), wh.settled.read()
    through = settled.agg(F.max("through")).first()[0]
    newest = wh.current.read().agg(F.to_date(F.max("derniere_collecte"))).first()[0]
    if newest is None:
        return partials.drop("day")
    cutoff = newest - timedelta(days=settle_days)

    if through is None or changed_from is None or changed_from < through:
        added = partials.filter(F.col("day") < F.lit(cutoff)).drop("day")
        through = None
    elif through < cutoff:
        added = settled.drop("through").unionByName(partials.filter(
            F.col("day").between(F.lit(through), F.lit(cutoff - timedelta(days=1)))).drop("day"))
    else:
        added = None
    if added is not None:
        wh.settled.replace(roll_up(added, "id_station").withColumn("through", F.lit(cutoff)))
        settled, through = wh.settled.read(), cutoff
    open_days = partials.filter(F.col("day") >= F.lit(through))
    return settled.drop("through").unionByName(open_days.drop("day"))
