"""Reading landed snapshots and reading/writing versioned tables."""

from .envelope import (
    entity_columns,
    explode_payload,
    present_columns,
    project_required,
    read_documents,
    read_envelope,
    sort_out,
    stream_documents,
    stream_envelope,
)
from .landing import land, landed_files, latest_file, latest_snapshot
from .profile import (
    document_structure,
    drift,
    element_profile,
    feed_profile,
    json_key_profile,
)
from .staging import stage_columns, staging
from .tables import AppendTable, VersionedTable, overwrite_days

__all__ = [
    "AppendTable", "VersionedTable", "document_structure", "drift", "element_profile", "entity_columns", "explode_payload",
    "feed_profile", "json_key_profile", "land", "landed_files", "latest_file",
    "latest_snapshot",
    "overwrite_days", "present_columns", "project_required", "read_documents", "read_envelope",
    "sort_out", "stage_columns", "staging", "stream_documents", "stream_envelope",
]
