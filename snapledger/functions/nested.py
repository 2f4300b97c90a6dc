"""Sums over arrays of small JSON objects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import flag_to_number, to_int_or_zero


def pivot_sum(json_array: Column, keys: Mapping[str, str]) -> Column:
    """JSON text holding an array of objects to ``STRUCT<output: BIGINT, ...>``.

    ``keys`` maps output field to object key.  Each field is the sum of that key over the
    array.  An element that is not an object is skipped; text that is not an array sums to 0.
    """
    # One odd element makes the typed parse of the whole array NULL.  Only such rows are parsed
    # again element by element.
    one_by_one = F.transform(F.from_json(json_array, "array<string>"),
                             lambda e: F.from_json(e, "map<string,string>"))
    objects = F.coalesce(F.from_json(json_array, "array<map<string,string>>"), one_by_one)
    counts = F.transform(objects, lambda o: F.transform_values(
        o, lambda _, v: to_int_or_zero(flag_to_number(v))))
    zero = F.struct(*[F.lit(0).cast("bigint").alias(name) for name in keys])

    def add(acc: Column, obj: Column) -> Column:
        return F.struct(*[
            (acc[name] + F.coalesce(F.try_element_at(obj, F.lit(key)), F.lit(0))).alias(name)
            for name, key in keys.items()])

    return F.coalesce(F.aggregate(counts, zero, add), zero)
