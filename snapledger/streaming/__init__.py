"""Structured Streaming: the same runs, fed by newly landed files."""

from .current import latest_state, start_current, start_latest
from .feed import replay, start_feed, start_freshness

__all__ = ["latest_state", "replay", "start_current", "start_feed", "start_freshness", "start_latest"]
