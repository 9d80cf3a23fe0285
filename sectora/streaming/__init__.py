"""Structured Streaming: rebuild reports from a stream of definition-change events."""

from sectora.streaming.rebuild import CHANGE_EVENT_SCHEMA, change_events, start_rebuild_stream

__all__ = ["CHANGE_EVENT_SCHEMA", "change_events", "start_rebuild_stream"]
