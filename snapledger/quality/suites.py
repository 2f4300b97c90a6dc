"""Rule suites of the bike-share configuration.

Columns, bounds and severities are fixed values.  ``full`` adds the rules that are declared
for a layer but were never part of its run-time suite.
"""

from __future__ import annotations

from .rules import CRITICAL, Rule, between, exists, in_set, not_null, row_count, unique

#: Accepted number of rows of one snapshot of the network.
SNAPSHOT_ROWS = (1400, 1600)
MAX_COUNT = 200
MAX_CAPACITY = 100
LATITUDE = (48.0, 49.0)
LONGITUDE = (2.0, 3.0)

ALWAYS_SET = "needed by every later step"
COUNT_RANGE = "counts are never negative and no known site exceeds the maximum"
POSITION = "outside the area served: corrupt coordinates"
FLAG = "a flag is 0 or 1; anything else is a parsing problem"
SIZE = "an incomplete or duplicated snapshot has an unusual number of rows"


def bronze_suite(rows: tuple[int, int] = SNAPSHOT_ROWS) -> list[Rule]:
    return [
        exists("station_id", reason=ALWAYS_SET),
        not_null("station_id", reason=ALWAYS_SET),
        not_null("num_bikes_available", reason="the central measure; a gap biases all results"),
        between("num_bikes_available", 0, MAX_COUNT, reason=COUNT_RANGE),
        between("num_docks_available", 0, MAX_COUNT, reason=COUNT_RANGE),
        row_count(*rows, reason=SIZE),
    ]


def station_suite(rows: tuple[int, int] = SNAPSHOT_ROWS, variant: str = "runtime") -> list[Rule]:
    extra = [not_null("latitude", reason="not shown on a map without a position"),
             not_null("longitude", reason="not shown on a map without a position")]
    return [
        not_null("id_station", reason="primary key"),
        unique("id_station", reason="primary key"),
        not_null("nom", reason="shown on dashboards"),
        *(extra if variant == "full" else []),
        between("capacite", 0, MAX_CAPACITY, reason="no known site exceeds the maximum"),
        between("latitude", *LATITUDE, reason=POSITION),
        between("longitude", *LONGITUDE, reason=POSITION),
        row_count(*rows, reason=SIZE),
    ]


def reading_suite(rows: tuple[int, int] = SNAPSHOT_ROWS) -> list[Rule]:
    counts = ["velos_disponibles", "bornes_disponibles", "velos_mecaniques", "velos_electriques"]
    flags = ["est_installee", "retour_possible", "location_possible"]
    return [
        not_null("id_station", reason="a reading belongs to a station"),
        not_null("date_collecte", reason="a reading has an instant"),
        not_null("velos_disponibles", reason="the central measure; a gap biases all results"),
        *[between(c, 0, MAX_COUNT, reason=COUNT_RANGE) for c in counts],
        *[in_set(c, [0, 1], reason=FLAG) for c in flags],
        row_count(*rows, reason=SIZE),
    ]


def gold_suite(rows: tuple[int, int] = SNAPSHOT_ROWS, variant: str = "runtime") -> list[Rule]:
    full = variant == "full"
    return [
        not_null("id_station", reason="primary key"),
        *([not_null("nom", reason="shown on dashboards")] if full else []),
        not_null("taux_disponibilite", reason="the central indicator"),
        between("taux_disponibilite", 0, 1, CRITICAL, reason="a capped ratio"),
        between("velos_disponibles", 0, MAX_COUNT, reason=COUNT_RANGE),
        *([between("bornes_disponibles", 0, MAX_COUNT, reason=COUNT_RANGE)] if full else []),
        between("latitude", *LATITUDE, reason=POSITION),
        between("longitude", *LONGITUDE, reason=POSITION),
        *([in_set("est_vide", [True, False], CRITICAL, reason="a boolean"),
           in_set("est_pleine", [True, False], CRITICAL, reason="a boolean")] if full else []),
        row_count(*rows, reason="one row per station"),
        *([not_null("derniere_collecte", reason="drives freshness monitoring")] if full else []),
    ]
