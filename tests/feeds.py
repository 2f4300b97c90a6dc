"""Small feeds written as documents."""

import json
import os
from datetime import datetime, timezone

BOUNDS = (1, 10)


def at(hour, minute=0, day=1):
    return datetime(2026, 1, day, hour, minute, tzinfo=timezone.utc)


def station(station_id, code, name, lat, lon, capacity, hours=None):
    return {"station_id": station_id, "stationCode": code, "name": name, "lat": lat, "lon": lon,
            "capacity": capacity, "station_opening_hours": hours}


def status(station_id, code, bikes, docks, types, reported, **flags):
    return {"station_id": station_id, "stationCode": code, "num_bikes_available": bikes,
            "num_docks_available": docks, "num_bikes_available_types": types,
            "is_installed": 1, "is_returning": 1, "is_renting": 1, "last_reported": reported,
            **flags}


def types(mechanical, ebike):
    return [{"mechanical": mechanical}, {"ebike": ebike}]


def write(folder, feed, stamp, elements):
    folder = os.path.join(str(folder), feed)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{feed}_{stamp}.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump({"data": {"stations": elements}, "lastUpdatedOther": 1, "ttl": 3600}, file,
                  ensure_ascii=False, indent=2)
    return path


STATIONS = [
    station(101, "16107", "Alpha", 48.86, 2.27, 16),
    station(102, "16108", "Beta", 48.87, 2.28, 3),
    station(102, "16108", "Beta copy", 48.87, 2.28, 9),
    station(103, "16109", "Gamma", 48.88, 2.29, None),
    station("x", "16110", "Delta", 48.89, 2.30, 10),
    station(105, "16111", None, 48.90, 2.31, 10),
]
STATUS_1 = [
    status(101, "16107", 1, 15, types(1, 0), 1767254000),
    status(102, "16108", 5, 0, types(2, 3), "x"),
    status(103, "16109", 0, 4, "not a list", None),
]
STATUS_2 = [status(101, "16107", 0, 16, types(0, 0), 1767254300)]


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()),
                  key=lambda r: [(v is None, str(v)) for v in r])
