"""The three analytic products over a fact of readings and a dimension with a capacity:
current state per key, profile per key and hour, network-wide indicators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import EXACT, capped_ratio, mean_half_up, mean_ratio_half_up
from ..functions.temporal import hour_of_day
from .latest import latest


@dataclass(frozen=True)
class Roles:
    """Which columns play which part.  ``key`` has one name on both sides."""

    key: str
    ts: str
    available: str
    capacity: str
    free: str | None = None
    label: str | None = None


def current_state(readings: DataFrame, dimension: DataFrame, roles: Roles) -> DataFrame:
    """Latest reading(s) of every dimension key with ``ratio``, ``is_empty``, ``is_full``.

    Readings without a dimension row are dropped; tied latest readings are all kept.
    """
    available = F.col(roles.available)
    derived = {"ratio": capped_ratio(available, F.col(roles.capacity)),
               "is_empty": available == 0}
    if roles.free:
        derived["is_full"] = F.col(roles.free) == 0
    return latest(readings, [roles.key], roles.ts, within=dimension).withColumns(derived)


def hourly_partials(readings: DataFrame, roles: Roles, bucket: Column | None = None,
                    day: Column | None = None) -> DataFrame:
    """Mergeable sums per key and bucket (hour of day by default), per day if ``day`` is given.

    Ratios are left out on purpose: they use the capacity known at roll-up time.  Partials of
    several frames can be unioned; their size does not depend on the number of readings.
    Sums are BIGINT for a whole measure, else DECIMAL with six digits of fraction.
    """
    groups = [F.col(roles.key),
              (hour_of_day(F.col(roles.ts)) if bucket is None else bucket).alias("bucket")]
    if day is not None:
        groups.append(day.alias("day"))
    whole = isinstance(readings.schema[roles.available].dataType, T.IntegralType)
    value = F.col(roles.available).cast("bigint" if whole else EXACT)
    return readings.groupBy(*groups).agg(
        F.sum(value).alias("total"),
        F.count(value).alias("values"),
        F.sum(F.when(F.col(roles.available) == 0, 1).otherwise(0)).alias("times_empty"),
        F.count(F.lit(1)).alias("observations"))


SUMS = ["total", "values", "times_empty", "observations"]


def roll_up(partials: DataFrame, key: str) -> DataFrame:
    """Add up partials per key and bucket."""
    return partials.groupBy(key, "bucket").agg(*[F.sum(c).alias(c) for c in SUMS])


def partials_to_profile(partials: DataFrame, dimension: DataFrame, roles: Roles) -> DataFrame:
    """Partials of any number of days to ``key, label, bucket, mean_available, mean_ratio,
    times_empty, observations``."""
    return _profile(roll_up(partials, roles.key), dimension, roles)


def hourly_profile(readings: DataFrame, dimension: DataFrame, roles: Roles,
                   bucket: Column | None = None) -> DataFrame:
    """The profile over all readings at once."""
    return _profile(hourly_partials(readings, roles, bucket), dimension, roles)


def _profile(rolled: DataFrame, dimension: DataFrame, roles: Roles) -> DataFrame:
    """The dimension is joined to the rolled-up rows, not to the history."""
    label = [roles.label] if roles.label else []
    total, count, capacity = F.col("total"), F.col("values"), F.col(roles.capacity)
    joined = rolled.join(dimension.select(roles.key, roles.capacity, *label), roles.key)
    return joined.select(
        roles.key, *label, "bucket",
        mean_half_up(total, count, 2).alias("mean_available"),
        mean_ratio_half_up(total, count, capacity, 3).alias("mean_ratio"),
        "times_empty", "observations")


def network_kpis(state: DataFrame, available: str, free: str, ts: str, ratio: str = "ratio",
                 is_empty: str = "is_empty", is_full: str = "is_full") -> DataFrame:
    """One row over a current-state frame.  On empty input the count is 0, the rest NULL.

    The mean is taken over the already rounded ratios.
    """
    mean = F.sum(ratio) / F.nullif(F.count(ratio).cast("decimal(18,0)"),
                                   F.lit(0).cast("decimal(18,0)"))
    return state.agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum(F.when(F.col(is_empty), 1).otherwise(0)).alias("empty_keys"),
        F.sum(F.when(F.col(is_full), 1).otherwise(0)).alias("full_keys"),
        F.round(mean, 3).alias("mean_ratio"),
        F.sum(available).alias("total_available"),
        F.sum(free).alias("total_free"),
        F.max(ts).alias("last_update"))
