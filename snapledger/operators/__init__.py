"""Generic operators: DataFrame in, DataFrame out."""

from .conform import conform, packed_key, surrogate_key, unpacked_key
from .latest import latest, latest_one
from .merge import dedup_batch, insert_new, require_unique, upsert
from .keys import dedup_first, drop_incomplete, duplicated_keys, orphan_keys, orphan_sample
from .profiles import (
    current_state,
    hourly_partials,
    hourly_profile,
    network_kpis,
    partials_to_profile,
    roll_up,
)
from .sizing import counted_bytes, estimated_bytes

__all__ = [
    "conform", "counted_bytes", "current_state", "dedup_batch", "dedup_first",
    "drop_incomplete", "duplicated_keys", "estimated_bytes", "hourly_partials",
    "hourly_profile", "insert_new", "latest", "latest_one", "network_kpis", "orphan_keys",
    "orphan_sample", "partials_to_profile", "require_unique", "roll_up",
    "packed_key", "surrogate_key", "unpacked_key", "upsert",
]
