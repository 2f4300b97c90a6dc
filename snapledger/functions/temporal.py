"""Instants: epoch seconds, batch stamps, hour of day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole seconds representable by a signed 64-bit nanosecond clock.
# Instants outside 1677-09-21 .. 2262-04-11 are treated as unreadable.
MIN_EPOCH_SECONDS = -9223372036
MAX_EPOCH_SECONDS = 9223372036

STAMP_FORMAT = "yyyyMMdd_HHmmss"
STAMP_PATTERN = r"(\d{8}_\d{6})"
#: The stamp in the file's own name; a folder's stamp counts only as ``batch_ts=<stamp>``.
NAME_PATTERN = STAMP_PATTERN + r"[^/]*$"
FOLDER_PATTERN = r"(?:^|/)batch_ts=" + STAMP_PATTERN + r"(?:/|$)"


def epoch_to_timestamp(seconds: Column) -> Column:
    """Numeric epoch seconds to an instant; out-of-range and NULL input give NULL."""
    in_range = seconds.between(MIN_EPOCH_SECONDS, MAX_EPOCH_SECONDS)
    return F.when(in_range, F.timestamp_seconds(F.when(in_range, seconds)))


def batch_instant(instant: datetime | Column) -> Column:
    """The instant stamped on every row of a batch, at second precision.

    It is an argument, never the clock at evaluation time: a re-run of the same batch must
    produce the same keys.
    """
    value = instant if isinstance(instant, Column) else F.lit(instant)
    return F.date_trunc("second", value)


def instant_from_name(path: Column) -> Column:
    """The ``yyyyMMdd_HHmmss`` stamp of a landed file, read as UTC; NULL without one.

    It is the first stamp in the file's name, else that of a ``batch_ts=`` folder.  Stamps in
    the names of other folders say nothing about the file.
    """
    found = [F.try_to_timestamp(F.regexp_extract(path, pattern, 1), F.lit(STAMP_FORMAT))
             for pattern in (NAME_PATTERN, FOLDER_PATTERN)]
    return F.coalesce(*found)


def stamp(instant: Column) -> Column:
    """Inverse of :func:`instant_from_name`."""
    return F.date_format(instant, STAMP_FORMAT)


def hour_of_day(instant: Column, tz: str | None = None) -> Column:
    """0..23 in the session zone, or in ``tz`` for local-hour profiles."""
    local = F.from_utc_timestamp(instant, tz) if tz else instant
    return F.hour(local).cast("smallint")
