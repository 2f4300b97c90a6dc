"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anything but control white space, separators U+001C..U+001F, U+0085 and Unicode spaces.
VISIBLE_PATTERN = r"[^\t-\r\x1c-\x20\x85\p{Z}]"


def to_text(value: Column) -> Column:
    """Cast to STRING; NULL stays NULL (never the word ``None``)."""
    return value.cast("string")


def is_blank(text: Column) -> Column:
    """Empty after stripping white space at both ends; NULL is not blank."""
    return F.coalesce(~text.rlike(VISIBLE_PATTERN), F.lit(False))
