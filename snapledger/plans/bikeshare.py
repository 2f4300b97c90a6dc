"""Layer builds of the bike-share configuration: pure DataFrame transformations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    batch_instant,
    epoch_to_timestamp,
    flag_to_number,
    instant_from_name,
    pivot_sum,
    to_int_or_zero,
    to_long_or_null,
    to_number_or_null,
    to_text,
)
from ..operators.conform import conform, packed_key
from ..operators.keys import dedup_first, drop_incomplete
from ..operators.profiles import (
    Roles,
    current_state,
    hourly_partials,
    network_kpis,
    partials_to_profile,
)
from ..schemas import (
    BIKE_TYPES,
    BIKE_TYPES_FIELD,
    CURRENT,
    HOURLY,
    HOURLY_DEFAULTS,
    INFORMATION_FIELDS,
    READING,
    READING_COUNTS,
    READING_FLAGS,
    READING_KEY,
    STATION,
    STATUS_FIELDS,
)
from ..sources.envelope import entity_columns, present_columns, project_required

INFORMATION_COLUMNS = list(INFORMATION_FIELDS)
STATUS_COLUMNS = [*STATUS_FIELDS, BIKE_TYPES_FIELD]
ORIGIN = ["file", "file_time", "pos"]
#: :func:`file_instant`, where it was read once for each document before its elements were spread.
TAKEN = "taken"

ROLES = Roles(key="id_station", ts="date_collecte", available="velos_disponibles",
              capacity="capacite", free="bornes_disponibles", label="nom")


def bronze_columns(envelope: DataFrame, fields: list[str]) -> DataFrame:
    """The elements as text columns: those of ``fields`` that occur in the feed at all."""
    return entity_columns(envelope, present_columns(envelope, fields))


def file_instant() -> Column:
    """When a landed file was taken: the stamp in its path, else its modification time."""
    return F.coalesce(instant_from_name(F.col("file")), F.col("file_time"))


def with_instant(documents: DataFrame) -> DataFrame:
    """Documents with their instant, so that no element has to read it from the path again."""
    return documents.withColumn(TAKEN, file_instant())


def origin_instant(bronze: DataFrame) -> Column:
    return F.col(TAKEN) if TAKEN in bronze.columns else file_instant()


def origin(bronze: DataFrame) -> list[str]:
    return [*ORIGIN, TAKEN] if TAKEN in bronze.columns else ORIGIN


def build_station(bronze: DataFrame) -> DataFrame:
    """Station dimension.  Of several snapshots the newest wins, within one the first row."""
    renamed = (project_required(bronze, [*origin(bronze), *INFORMATION_FIELDS])
               .withColumnsRenamed(INFORMATION_FIELDS))
    typed = renamed.withColumns({
        "id_station": to_long_or_null(F.col("id_station")),
        "code_station": to_text(F.col("code_station")),
        "nom": to_text(F.col("nom")),
        "latitude": to_number_or_null(F.col("latitude")),
        "longitude": to_number_or_null(F.col("longitude")),
    })
    keyed = drop_incomplete(typed, ["id_station", "nom"]).withColumn(
        "capacite", to_int_or_zero(F.col("capacite")))
    arrival = [origin_instant(bronze).desc(), F.col("file").desc(), F.col("pos").asc()]
    return conform(dedup_first(keyed, ["id_station"], arrival), STATION)


def typed_readings(bronze: DataFrame, instant: datetime | Column) -> DataFrame:
    """Complete readings with typed columns, repeats included; works on a stream as well."""
    fields = {**STATUS_FIELDS, BIKE_TYPES_FIELD: "types"}
    renamed = (project_required(bronze, [*origin(bronze), *fields]).withColumnsRenamed(fields)
               .withColumn("date_collecte", batch_instant(instant)))
    counted = renamed.withColumn("sums", pivot_sum(F.col("types"), BIKE_TYPES))
    typed = counted.withColumns({
        **{name: F.col(f"sums.{name}") for name in BIKE_TYPES},
        "id_station": to_long_or_null(F.col("id_station")),
        "code_station": to_text(F.col("code_station")),
        "dernier_signalement": epoch_to_timestamp(
            to_number_or_null(F.col("dernier_signalement"))),
    })
    return drop_incomplete(typed, READING_KEY).withColumns({
        **{c: to_int_or_zero(F.col(c)) for c in READING_COUNTS if c not in BIKE_TYPES},
        **{c: to_int_or_zero(flag_to_number(F.col(c))) for c in READING_FLAGS},
    })


def build_readings(bronze: DataFrame, instant: datetime | Column) -> DataFrame:
    """Reading fact.  ``instant`` is the batch instant, one per snapshot."""
    arrival = [F.col("file").asc(), F.col("pos").asc()]
    unique = dedup_first(typed_readings(bronze, instant), READING_KEY, arrival)
    return conform(unique.withColumn("id_releve", packed_key(*READING_KEY)), READING)


def unreadable_counts(bronze: DataFrame) -> DataFrame:
    """One row: per numeric field, how many given values will be read as 0."""
    numeric = [c for c in STATUS_FIELDS if c not in ("station_id", "stationCode", "last_reported")
               and c in bronze.columns]
    return bronze.agg(*[
        F.count_if(F.col(c).isNotNull()
                   & to_number_or_null(flag_to_number(F.col(c))).try_cast("int").isNull())
        .alias(c) for c in numeric])


def build_current(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Current availability per station, from any frame that holds its latest reading."""
    dimension = stations.select("id_station", "nom", "latitude", "longitude", "capacite")
    facts = readings.select("id_station", "date_collecte", *READING_COUNTS)
    state = current_state(facts, dimension, ROLES).withColumnsRenamed({
        "date_collecte": "derniere_collecte", "ratio": "taux_disponibilite",
        "is_empty": "est_vide", "is_full": "est_pleine"})
    return conform(state, CURRENT)


def known_latest(current: DataFrame) -> DataFrame:
    """The readings a published current table stands for; with a new batch they replace the
    history as input of :func:`build_current`."""
    return current.select("id_station", F.col("derniere_collecte").alias("date_collecte"),
                          *READING_COUNTS)


def daily_partials(readings: DataFrame) -> DataFrame:
    return hourly_partials(readings, ROLES, day=F.to_date("date_collecte"))


def build_hourly(partials: DataFrame, stations: DataFrame) -> DataFrame:
    profile = partials_to_profile(partials, stations, ROLES).withColumnsRenamed({
        "bucket": "heure", "mean_available": "moy_velos_disponibles",
        "mean_ratio": "moy_taux_disponibilite", "times_empty": "nb_fois_vide",
        "observations": "nb_observations"})
    return conform(profile, HOURLY, HOURLY_DEFAULTS)


def network_sql(table: str) -> str:
    """:func:`network_view` as text, to be stored as a view in a catalog."""
    return f"""
        SELECT count(*) AS nb_stations_total,
               sum(CASE WHEN est_vide THEN 1 ELSE 0 END) AS nb_stations_vides,
               sum(CASE WHEN est_pleine THEN 1 ELSE 0 END) AS nb_stations_pleines,
               round(sum(taux_disponibilite) / nullif(
                   cast(count(taux_disponibilite) AS decimal(18,0)), cast(0 AS decimal(18,0))), 3)
                   AS taux_disponibilite_moyen,
               sum(velos_disponibles) AS total_velos_disponibles,
               sum(bornes_disponibles) AS total_bornes_disponibles,
               max(derniere_collecte) AS derniere_mise_a_jour
        FROM {table}"""


def network_view(current: DataFrame) -> DataFrame:
    return network_kpis(current, "velos_disponibles", "bornes_disponibles", "derniere_collecte",
                        "taux_disponibilite", "est_vide", "est_pleine").withColumnsRenamed({
        "keys": "nb_stations_total", "empty_keys": "nb_stations_vides",
        "full_keys": "nb_stations_pleines", "mean_ratio": "taux_disponibilite_moyen",
        "total_available": "total_velos_disponibles", "total_free": "total_bornes_disponibles",
        "last_update": "derniere_mise_a_jour"})
