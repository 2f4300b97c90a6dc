"""Column builders: every function takes and returns JVM-side ``Column`` expressions."""

from .nested import pivot_sum
from .numeric import (
    capped_ratio,
    flag_to_number,
    guarded_ratio,
    mean_half_up,
    mean_ratio_half_up,
    nan_to_null,
    to_int_or_zero,
    to_long_or_null,
    to_number_or_null,
)
from .temporal import batch_instant, epoch_to_timestamp, hour_of_day, instant_from_name, stamp
from .text import is_blank, to_text

__all__ = [
    "batch_instant", "capped_ratio", "epoch_to_timestamp", "flag_to_number", "guarded_ratio",
    "hour_of_day", "instant_from_name", "is_blank", "mean_half_up", "mean_ratio_half_up",
    "nan_to_null", "pivot_sum", "stamp", "to_int_or_zero", "to_long_or_null",
    "to_number_or_null", "to_text",
]
