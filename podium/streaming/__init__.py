"""Incremental landing with Structured Streaming (A6 as a stream)."""

from podium.streaming.landing import land_stream

__all__ = ["land_stream"]
