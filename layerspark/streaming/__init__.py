"""Interaction streams and the layer change feed."""

from layerspark.streaming.events import (
    gate,
    gated_writer,
    latest_view,
    picks_to_rows,
    read_events,
    rows_writer,
)
from layerspark.streaming.feed import layer_change_feed
from layerspark.streaming.throttling import throttle, throttle_interactions, throttle_stream

__all__ = [
    "gate",
    "gated_writer",
    "latest_view",
    "layer_change_feed",
    "picks_to_rows",
    "read_events",
    "rows_writer",
    "throttle",
    "throttle_interactions",
    "throttle_stream",
]
