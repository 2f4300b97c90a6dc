"""Table schemas and contracts of the bike-share configuration and of monitoring.

Column names, types, key and check constraints are fixed values: consumers of the tables
rely on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .quality.contract import TableContract

_LONG, _INT, _SHORT, _DOUBLE = T.LongType(), T.IntegerType(), T.ShortType(), T.DoubleType()
_TEXT, _BOOL, _TIME, _DATE = T.StringType(), T.BooleanType(), T.TimestampType(), T.DateType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


# --- feeds: fields read from each element, and their names in silver -----------------------

INFORMATION_FIELDS = {
    "station_id": "id_station",
    "stationCode": "code_station",
    "name": "nom",
    "lat": "latitude",
    "lon": "longitude",
    "capacity": "capacite",
    "station_opening_hours": "horaires_ouverture",
}

STATUS_FIELDS = {
    "station_id": "id_station",
    "stationCode": "code_station",
    "num_bikes_available": "velos_disponibles",
    "num_docks_available": "bornes_disponibles",
    "is_installed": "est_installee",
    "is_returning": "retour_possible",
    "is_renting": "location_possible",
    "last_reported": "dernier_signalement",
}
BIKE_TYPES_FIELD = "num_bikes_available_types"
BIKE_TYPES = {"velos_mecaniques": "mechanical", "velos_electriques": "ebike"}

# --- silver -----------------------------------------------------------------------------

STATION = _struct(
    ("id_station", _LONG, False), ("code_station", _TEXT), ("nom", _TEXT, False),
    ("latitude", _DOUBLE), ("longitude", _DOUBLE), ("capacite", _INT, False),
    ("horaires_ouverture", _TEXT))

STATION_CONTRACT = TableContract(
    name="station",
    required=["id_station", "code_station", "nom", "latitude", "longitude", "capacite"],
    not_null=["id_station", "nom", "capacite"],
    not_blank=["nom"],
    checks=["capacite >= 0"],
    max_length={"code_station": 30},
    unique=[["id_station"]])

READING = _struct(
    ("id_releve", T.DecimalType(38, 0), False), ("id_station", _LONG, False), ("code_station", _TEXT),
    ("date_collecte", _TIME, False),
    ("velos_disponibles", _INT, False), ("bornes_disponibles", _INT, False),
    ("velos_mecaniques", _INT, False), ("velos_electriques", _INT, False),
    ("est_installee", _SHORT), ("retour_possible", _SHORT), ("location_possible", _SHORT),
    ("dernier_signalement", _TIME))

READING_COUNTS = ["velos_disponibles", "bornes_disponibles", "velos_mecaniques",
                  "velos_electriques"]
READING_FLAGS = ["est_installee", "retour_possible", "location_possible"]
READING_KEY = ["id_station", "date_collecte"]

READING_CONTRACT = TableContract(
    name="releve_disponibilite",
    required=["id_station", "code_station", "date_collecte", *READING_COUNTS, *READING_FLAGS,
              "dernier_signalement"],
    not_null=["id_station", "date_collecte", *READING_COUNTS],
    checks=[f"{c} >= 0" for c in READING_COUNTS],
    max_length={"code_station": 30},
    unique=[READING_KEY],
    foreign_keys={"id_station": ("station", "id_station")})

# Opt-in quarantine: what was kept out of, or is suspect in, the tables above.
_VIOLATIONS = T.StructField("_violations", T.ArrayType(T.StringType()))
REJECTED_READING = T.StructType([*READING.fields, _VIOLATIONS])
SUSPECT_STATION = T.StructType([*STATION.fields, _VIOLATIONS])

# --- gold -------------------------------------------------------------------------------

CURRENT = _struct(
    ("id_station", _LONG, False), ("nom", _TEXT, False), ("latitude", _DOUBLE),
    ("longitude", _DOUBLE), ("capacite", _INT, False),
    ("velos_disponibles", _INT, False), ("bornes_disponibles", _INT, False),
    ("velos_mecaniques", _INT, False), ("velos_electriques", _INT, False),
    ("taux_disponibilite", T.DecimalType(5, 3)),
    ("est_vide", _BOOL, False), ("est_pleine", _BOOL, False),
    ("derniere_collecte", _TIME, False))

CURRENT_CONTRACT = TableContract(
    name="disponibilite_courante",
    not_null=["id_station", "nom", "capacite", *READING_COUNTS, "est_vide", "est_pleine",
              "derniere_collecte"],
    checks=["taux_disponibilite BETWEEN 0 AND 1", "velos_disponibles >= 0",
            "bornes_disponibles >= 0"],
    unique=[["id_station"]])

HOURLY = _struct(
    ("id_station", _LONG, False), ("nom", _TEXT, False), ("heure", _SHORT, False),
    ("moy_velos_disponibles", T.DecimalType(6, 2)),
    ("moy_taux_disponibilite", T.DecimalType(5, 3)),
    ("nb_fois_vide", _INT, False), ("nb_observations", _INT, False))
HOURLY_DEFAULTS = {"nb_fois_vide": 0, "nb_observations": 0}

HOURLY_CONTRACT = TableContract(
    name="tendance_horaire",
    not_null=["id_station", "nom", "heure", "nb_fois_vide", "nb_observations"],
    checks=["heure BETWEEN 0 AND 23", "nb_observations >= 0"],
    digits={"moy_velos_disponibles": (6, 2), "moy_taux_disponibilite": (5, 3)},
    unique=[["id_station", "heure"]])

# Mergeable sums behind the hourly profile; one directory per day.
PARTIALS = _struct(
    ("id_station", _LONG), ("bucket", _SHORT), ("total", _LONG), ("values", _LONG),
    ("times_empty", _LONG), ("observations", _LONG), ("day", _DATE))

# Their sums over all days before ``through``, so that a cycle need not add up the whole past.
SETTLED = _struct(*[(f.name, f.dataType) for f in PARTIALS.fields if f.name != "day"],
                  ("through", _DATE))

# --- bronze -------------------------------------------------------------------------------

# Documents that could not be read, whole, so that they can be mended and read again.
DAMAGED = _struct(
    ("file", _TEXT, False), ("file_time", _TIME, False), ("payload", _TEXT), ("reason", _TEXT, False),
    ("found_at", _TIME, False))
DAMAGED_KEY = ["file", "file_time"]

# --- monitoring ---------------------------------------------------------------------------

RUNS = _struct(
    ("id", _LONG, False), ("dag_id", _TEXT, False), ("run_id", _TEXT, False),
    ("start_time", _TIME, False), ("end_time", _TIME), ("status", _TEXT, False),
    ("records_processed", _LONG), ("error_message", _TEXT))

VALIDATIONS = _struct(
    ("id", _LONG, False), ("run_time", _TIME, False), ("dag_id", _TEXT, False),
    ("suite_name", _TEXT, False), ("success", _BOOL, False), ("nb_expectations", _INT, False),
    ("nb_successful", _INT, False), ("nb_failed", _INT, False), ("details", _TEXT),
    ("rapport_url", _TEXT))

RUNS_CONTRACT = TableContract(
    name="pipeline_runs",
    not_null=["dag_id", "run_id", "start_time", "status"],
    max_length={"dag_id": 100, "run_id": 200, "status": 20},
    unique=[["dag_id", "run_id"]])

VALIDATIONS_CONTRACT = TableContract(
    name="ge_validation_results",
    not_null=["run_time", "dag_id", "suite_name", "success", "nb_expectations",
              "nb_successful", "nb_failed"],
    max_length={"dag_id": 100, "suite_name": 100})

ALERTS = _struct(
    ("id", _LONG, False), ("detected_at", _TIME, False), ("dag_id", _TEXT, False),
    ("suite_name", _TEXT, False), ("column_name", _TEXT), ("rule_name", _TEXT, False),
    ("severity", _TEXT, False), ("detail", _TEXT), ("resolved", _BOOL, False),
    ("resolved_at", _TIME))
ALERT_DEFAULTS = {"severity": "WARNING", "resolved": False}

ALERTS_CONTRACT = TableContract(
    name="data_quality_alerts",
    not_null=["detected_at", "dag_id", "suite_name", "rule_name", "severity", "resolved"],
    checks=["severity IN ('INFO', 'WARNING', 'CRITICAL')"],
    max_length={"dag_id": 100, "suite_name": 100, "column_name": 100, "rule_name": 200,
                "severity": 20})

# Wider than two integer digits per week would allow: a source may be silent for months.
FRESHNESS = _struct(
    ("id", _LONG, False), ("checked_at", _TIME, False), ("source_name", _TEXT, False),
    ("last_record_time", _TIME, False), ("delay_minutes", T.DecimalType(12, 2), False),
    ("is_fresh", _BOOL, False))

FRESHNESS_CONTRACT = TableContract(
    name="data_freshness",
    not_null=["checked_at", "source_name", "last_record_time", "delay_minutes", "is_fresh"],
    checks=["delay_minutes >= 0"],
    max_length={"source_name": 100})
