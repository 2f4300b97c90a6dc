"""The operators bound to the driver's tables, each with an independent SQL statement."""

from .registry import ORACLES, QUERIES
from . import cleaning, layers, merging, products, quality, reports, sources, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
